"""Raw and processed file sources and sinks (SRC1-SRC7, SNK1-SNK4)."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.operators.cleaning import SPARK_TYPES, Contract, to_float

# Fixed value: the text tokens pandas' CSV reader turns into missing values.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
             "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


@dataclass(frozen=True)
class SourceDescriptor:
    """A raw source: where it is, its format and what it is keyed by."""

    name: str
    path: str
    file_format: str  # csv | geojson | parquet
    grain: str = ""
    candidate_keys: tuple[tuple[str, ...], ...] = ()
    categorical_hints: tuple[str, ...] = ()
    reader_options: dict = field(default_factory=dict)
    source_category: str = ""
    encoding: str = "utf-8"
    steward: str = ""
    immutable: bool = True
    description: str = ""
    known_limitations: str = ""


def read_raw_csv(spark: SparkSession, path: str, na_tokens: list[str] | None = NA_TOKENS) -> DataFrame:
    """SRC1/SRC6: header CSV, every column as STRING, pandas NA tokens -> NULL."""
    df = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("inferSchema", False).csv(path)
    )
    if na_tokens:
        df = df.select(*[F.when(F.col(c).isin(na_tokens), F.lit(None)).otherwise(F.col(c)).alias(c) for c in df.columns])
    return df


def read_csv_with_contract(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """SRC6: cleaned CSV read back with the contract's types (bad values -> NULL)."""
    raw = read_raw_csv(spark, path, na_tokens=[""])
    cols = []
    for f in contract.fields:
        c = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)
        kind = SPARK_TYPES[f.type]
        cols.append((to_float(c) if kind == "double" else c.try_cast(kind)).alias(f.name))
    return raw.select(*cols)


GEOJSON_SCHEMA = "struct<features: array<struct<properties: map<string, string>, geometry: string>>>"


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: one row per feature (raw_feature_index, neighbourhood, neighbourhood_group, geometry_type,
    geometry as JSON text, properties as a map of texts).

    A FeatureCollection file is one JSON document, so each file is parsed (once) by one task; many files
    spread over many tasks.  A feature without properties or geometry has nulls.
    """
    docs = spark.read.option("wholetext", True).text(path)
    features = docs.select(F.posexplode(F.from_json("value", GEOJSON_SCHEMA)["features"]).alias("raw_feature_index", "f"))
    return features.select(
        "raw_feature_index",
        F.col("f.properties")["neighbourhood"].alias("neighbourhood"),
        F.col("f.properties")["neighbourhood_group"].alias("neighbourhood_group"),
        F.get_json_object("f.geometry", "$.type").alias("geometry_type"),
        F.col("f.geometry").alias("geometry"),
        F.col("f.properties").alias("properties"),
    )


def load_sources(spark: SparkSession, descriptors: list[SourceDescriptor]) -> dict[str, DataFrame]:
    """SRC3: name -> lazy DataFrame for every descriptor; unknown formats raise."""
    out = {}
    for d in descriptors:
        if d.file_format == "csv":
            out[d.name] = read_raw_csv(spark, d.path)
        elif d.file_format == "geojson":
            out[d.name] = read_geojson_features(spark, d.path)
        elif d.file_format == "parquet":
            out[d.name] = spark.read.parquet(d.path)
        else:
            raise ValueError(f"Unsupported raw dataset format: {d.file_format}")
    return out


def read_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """SRC4/SRC5: Parquet tables by name; a missing path fails with the full list."""
    missing = []
    for name, path in paths.items():
        try:
            spark.read.parquet(path).schema  # noqa: B018 - resolves the files
        except Exception:  # AnalysisException: path does not exist
            missing.append(path)
    if missing:
        raise FileNotFoundError("Missing expected processed artifacts: " + ", ".join(missing))
    return {name: spark.read.parquet(path) for name, path in paths.items()}


#: Bytes of a file that a hashing task holds at once.
HASH_CHUNK = 8 << 20


def hashed_files(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """One row per file: ``path``, ``size_bytes``, ``sha256``.  The listing reads no content; tasks stream
    each file in chunks, so files may have any size.  Files of no bytes are not listed (Spark skips them)."""
    # content is not selected, so only names and lengths are listed
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths).select("path", F.col("length").alias("size_bytes"))

    def hashed(batches):
        from pyarrow import fs

        for batch in batches:
            sums = []
            for path in batch.column("path").to_pylist():
                # names are listed unescaped
                if path.startswith("file:"):
                    system, inner = fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
                else:
                    system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
                digest = hashlib.sha256()
                with system.open_input_stream(inner) as stream:
                    while chunk := stream.read(HASH_CHUNK):
                        digest.update(chunk)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], names=["path", "size_bytes", "sha256"])

    # one file a task at most times: the listing may come as a few partitions
    return listed.repartition("path").mapInArrow(hashed, "path string, size_bytes long, sha256 string")


def file_manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC7: one row per file: path, size in bytes, SHA-256 of the content, import date."""
    return hashed_files(spark, path, glob).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "size_bytes", "sha256",
        F.current_date().alias("import_date"))


def provenance_manifest(spark: SparkSession, descriptors: list[SourceDescriptor]) -> DataFrame:
    """SRC7: one row per described source: what it is and who keeps it, with its file's facts."""
    names = ["dataset_name", "canonical_path", "source_category", "file_format", "encoding", "steward", "immutable",
             "description", "known_limitations"]
    told = spark.createDataFrame(
        [(d.name, d.path, d.source_category, d.file_format, d.encoding, d.steward, d.immutable, d.description,
          d.known_limitations) for d in descriptors],
        ", ".join(f"{n} {'boolean' if n == 'immutable' else 'string'}" for n in names))
    files = hashed_files(spark, [d.path for d in descriptors]).select(
        F.regexp_replace("path", "^file:/*", "/").alias("_path"), "size_bytes", "sha256",
        F.current_date().alias("import_date"))
    plain = F.regexp_replace("canonical_path", "^file:/*", "/")
    return told.withColumn("original_filename", F.regexp_extract("canonical_path", r"([^/]+)$", 1)).join(
        files, plain == F.col("_path"), "left").drop("_path")


def write_processed(df: DataFrame, name: str, root: str, sources: list[str],
                    generation_date: dt.date | None = None, sort_keys: list[str] | None = None) -> DataFrame:
    """SNK1/SRT1: write Parquet and CSV (header) plus a one-row manifest; returns the manifest.

    With ``sort_keys`` both outputs are in global order: part by part in the order of the file names
    (range shuffles, nulls first).  The row count reads no column of the written Parquet, only its footers.
    """
    spark = df.sparkSession
    (df.orderBy(*sort_keys) if sort_keys else df).write.mode("overwrite").parquet(f"{root}/parquet/{name}")
    written = spark.read.parquet(f"{root}/parquet/{name}")
    ordered = written.orderBy(*sort_keys) if sort_keys else written
    ordered.write.mode("overwrite").option("header", True).csv(f"{root}/csv/{name}")
    manifest = written.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("dataset_name"),
        "row_count",
        F.lit("|".join(df.columns)).alias("columns"),
        F.lit("|".join(sources)).alias("source_datasets"),
        F.lit((generation_date or dt.date.today()).isoformat()).alias("generation_date"),
    )
    manifest.write.mode("overwrite").parquet(f"{root}/manifest/{name}")
    return spark.read.parquet(f"{root}/manifest/{name}")


def write_versioned(df: DataFrame, name: str, root: str, version: str | None, sources: list[str],
                    sort_keys: list[str] | None = None) -> DataFrame:
    """SNK2/SNK3: as SNK1 under ``root/<version>`` (or ``root`` when no version)."""
    base = root if version is None else f"{root}/{version}"
    return write_processed(df, name, base, sources, sort_keys=sort_keys)


def write_tables(tables: dict[str, DataFrame], root: str, sources: dict[str, list[str]]) -> DataFrame:
    """SNK4: write every cleaned table; returns the union of their manifests."""
    manifests = [write_processed(df, name, root, sources.get(name, [])) for name, df in tables.items()]
    out = manifests[0]
    for m in manifests[1:]:
        out = out.unionByName(m)
    return out


def publish(df: DataFrame, name: str, root: str, sources: list[str], sort_keys: list[str] | None = None) -> DataFrame:
    """SNK1 published atomically: the outputs go to a folder of their own under ``root/staged``, and the last
    write adds one row (one file, renamed into place) to ``root/published/<name>``.  A run that stops half
    way leaves the former version as it was; ``read_published`` never sees the unfinished one.

    Returns the manifest row with ``base`` (the version's folder) and ``published_at``."""
    base = f"{root}/staged/{name}/{uuid.uuid4().hex}"
    manifest = write_processed(df, name, base, sources, sort_keys=sort_keys)
    row = manifest.withColumns({"base": F.lit(base), "published_at": F.current_timestamp()})
    row.coalesce(1).write.mode("append").parquet(f"{root}/published/{name}")
    return published_versions(df.sparkSession, name, root).where(F.col("base") == base)


def published_versions(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The manifests of all finished versions of a table."""
    return spark.read.parquet(f"{root}/published/{name}")


def read_published(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The Parquet output of the last finished version (ties in time: the larger folder name)."""
    last = published_versions(spark, name, root).agg(F.max(F.struct("published_at", "base")).alias("v")).first()["v"]
    return spark.read.parquet(f"{last['base']}/parquet/{name}")
