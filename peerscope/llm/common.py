"""Helpers shared by the operators: table access, Arrow column access, byte scanning, components."""

from __future__ import annotations

import contextlib
import ctypes
import pickle
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.session import ensure_checkpoint_dir

#: Text bytes a task scans at once; numpy temporaries are about 60 times this size.
CHUNK_BYTES = 1 << 19
BATCH_BYTES = 4 << 20
BATCH_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


class Shared:
    """A broadcast object whose class may live in this package (pickled by value, loaded once per
    Python worker).  Only for objects of a fixed size bound; ``value`` reads it inside tasks."""

    def __init__(self, spark: SparkSession, thing) -> None:
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(thing))

    @property
    def value(self):
        if not hasattr(self.data, "thing"):
            self.data.thing = pickle.loads(self.data.value)
        return self.data.thing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let the batches that Python tasks receive follow their bytes, not only their rows: texts vary
    from one word to many pages.  A limit that the session already has is kept if it is lower."""
    limit = int(spark.conf.get(BATCH_BYTES_SETTING, str(BATCH_BYTES)))
    if limit <= 0 or limit > BATCH_BYTES:
        spark.conf.set(BATCH_BYTES_SETTING, str(BATCH_BYTES))


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: a cut in the lineage that
    survives lost executors."""
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/peerscope/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base`` with as many leading underscores as it takes not to clash with a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def column_arrays(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null value is empty."""
    col = batch.column(name).cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on from task to task, and what one
    stage's large arrays took would otherwise stay with the process through all later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def trimming(fn):
    """A function for ``mapInArrow`` that gives freed memory back when its task is done."""

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return run


def by_pieces(values: pa.Array, make, kind: pa.DataType, rows: int = 256) -> pa.Array:
    """``make`` of each value of a batch, turned into Arrow every ``rows`` rows, so that no more of its
    Python objects live at a time."""
    parts = []
    for at in range(0, len(values), rows):
        parts.append(pa.array([make(v) for v in values.slice(at, rows).to_pylist()], kind))
    release_memory()
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Consecutive row ranges (first, last) whose texts hold about ``limit`` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of byte ranges from one prefix sum: h(s, e) = sum(b[i] * P**(i - s)) mod 2**64, mixed.

    Powers are kept for the longest buffer seen, so one object serves a whole task.
    """

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * CHUNK_BYTES + 1)
            with np.errstate(over="ignore"):
                base, inv = np.full(n, self.BASE, np.uint64), np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64)
                base[0] = inv[0] = 1
                self.power, self.inverse = np.cumprod(base, out=base), np.cumprod(inv, out=inv)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of ``data`` (length + 1 values) for :meth:`ranges`."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (prefix[end] - prefix[start]) * self.inverse[start]
            return mixed(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))

    def windows(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every ``size``-byte window (window i starts at byte i)."""
        n = len(prefix) - size
        if n <= 0:  # a buffer shorter than a window
            return np.empty(0, np.uint64)
        with np.errstate(over="ignore"):
            return mixed((prefix[size:] - prefix[:n]) * self.inverse[:n])


def word_bounds(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run of word bytes; runs never cross a row's end."""
    n = len(is_word)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~after | cut[1:])) + 1
    return starts, ends


def ranges_concat(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All integers of the ranges [lo, hi), one range after the other."""
    n = (hi - lo).astype(np.int64)
    total = int(n.sum())
    if total == 0:
        return np.empty(0, np.int64)
    first = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return first + np.arange(total)


def find_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of ``n`` nodes' component under the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while True:
            hop = new[new]
            if np.array_equal(hop, new):
                break
            new = hop
        if np.array_equal(new, root):
            return root
        root = new


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component = smallest reachable node.

    Large-star / small-star contraction: each round is two shuffles of the edge table and the
    number of rounds grows with the logarithm of a component's size.  A hub's neighbours are
    never gathered; each side needs only the minimum, which aggregates before the shuffle.
    Every round is a written table, so a lost executor costs one round at most.
    """
    e = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    nodes = e.select(F.col("a").alias("node")).union(e.select(F.col("b").alias("node"))).distinct()
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node are tied to the node's minimum
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: the neighbours below a node, and the node, are tied to their minimum
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("k"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = saved(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        if new.count() == e.count() and new.exceptAll(e).isEmpty():
            break
        e = new
    return nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("m")), "node", "left").groupBy("node").agg(
        F.least("node", F.min("m")).alias("component")
    )


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys that several rows have (null is no key)."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)


def tied_by_key(members: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes that share a key, from ``members`` (key, node)."""
    least = members.groupBy("key").agg(F.min("node").alias("b"))
    return members.join(least, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def numbered(df: DataFrame, base: str) -> tuple[DataFrame, str]:
    """``df`` with a row number, given once and written, and the number's column name: decisions about rows
    can go by it when ids repeat or are null."""
    name = fresh_name(df, base)
    return saved(df.withColumn(name, F.monotonically_increasing_id()), base.strip("_")), name


def sorted_groups(batches, key: list[str]):
    """Tables of equal ``key`` from batches that are sorted by it; only the current group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in key]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            here = tuple(c[a] for c in cols)
            if held and here != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = here
    if held:
        yield last, pa.Table.from_batches(held)


def split_parts(rows: DataFrame, keys: list[str], parts: DataFrame, by: str) -> DataFrame:
    """``rows`` dealt to pairs of parts (u, v) of their group, with each row's own ``part``.

    ``parts`` (keys, _b) has the number of parts of each large group.  Rows fall into parts by a
    hash of ``by``; a part meets itself and each other part once, in a group of its own."""
    n = F.coalesce("_b", F.lit(1)).cast("int")
    out = rows.join(parts, keys, "left").withColumn("_b", n)
    out = out.withColumn("part", F.pmod(F.xxhash64(by), F.col("_b")).cast("int"))
    out = out.select("*", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)).alias("_o"))
    return out.withColumns({"u": F.least("part", "_o"), "v": F.greatest("part", "_o")}).drop("_b", "_o")
