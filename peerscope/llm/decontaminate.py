"""Benchmark decontamination over a positional inverted index (operator 3).

The training texts are indexed once: a shard (about ``SHARD_BYTES`` of text) is one row that holds its
documents, its sorted term keys and one packed list of word positions per term.  Shards are built and
searched where they lie; building and searching shuffle nothing.

A phrase search looks up the lists of the phrase's terms in a shard, starts from the rarest list and
intersects it with the next rarest ones, each shifted by its term's offset; what is left are exact
start positions.  A phrase with one absent term is dropped for the whole shard before any list is
read.  ``slop`` > 0 asks for the terms in order within that many extra words (proximity).

Words: A-Z lower-cased, then runs of characters outside 00-2F, 3A-60, 7B-7F (digits, a-z and
everything from U+0080 on).  Terms are 64-bit hashes of the words; a false match would need the
same collision at every offset of a phrase.

Tasks turn the test items into blocks of at most ``BLOCK_BYTES`` of text, which are written; one block at a
time is broadcast, run against all shards and its matches written before the next, so no memory follows the
size of the benchmark.

Defined results: null and empty texts have no words and no hits; an item without words never occurs;
repeated documents are separate rows; repeated items count once per item id; a null item id is
never listed, though its words are hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import Rolling, column_arrays, fresh_name, row_chunks, saved, trimming, word_bounds

SHARD_BYTES = 1 << 19
BLOCK_BYTES = 4 << 20
WINDOW = 13
#: Positions left free behind each document, so that no phrase of up to this length crosses a border.
GAP = 1 << 16

INDEX_SCHEMA = "uid long, keys array<long>, n_words array<int>, terms binary, offsets binary, positions binary"


def fold_table() -> np.ndarray:
    """Byte -> lower-case byte (A-Z only)."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_table() -> np.ndarray:
    """Lower-cased byte -> whether it belongs to a word; bytes from 80 on are parts of characters that do."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = t[0x61:0x7B] = t[0x80:] = True
    return t


def words_of(data: np.ndarray, offsets: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """(term of each word, number of words per row) of a block of texts."""
    low = fold_table()[data]
    starts, ends = word_bounds(word_table()[low], offsets)
    terms = rolling.ranges(rolling.prefix(low), starts, ends)
    return terms, np.diff(np.searchsorted(starts, offsets))


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = "postings") -> DataFrame:
    """The positional index of ``df`` (one row per shard), written once to the shared folder."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, uid = Rolling(), TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = batch.column(0)
            data, offsets = column_arrays(batch, "text")
            for a, b in row_chunks(offsets, SHARD_BYTES):
                terms, counts = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], rolling)
                place = np.arange(len(terms), dtype=np.int64) + np.repeat(np.arange(b - a) * GAP, counts)
                order = np.argsort(terms, kind="stable")
                terms = terms[order]
                first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1]))) if len(terms) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uid], pa.int64()),
                        pa.array([keys.slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                        pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([terms[first].tobytes()], pa.binary()),
                        pa.array([np.append(first, len(terms)).astype("<i4").tobytes()], pa.binary()),
                        pa.array([place[order].astype("<u4" if (b - a) < (1 << 15) else "<i8").tobytes()], pa.binary()),
                    ],
                    names=["uid", "keys", "n_words", "terms", "offsets", "positions"],
                )
                uid += b - a

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    # lists of positions don't repeat: a dictionary would only take memory
    return saved(rows.mapInArrow(trimming(shards), INDEX_SCHEMA), name, **{"parquet.enable.dictionary": "false"})


class Shard:
    """One index row: posting lists by term, and documents by position."""

    def __init__(self, row: dict) -> None:
        self.uid, self.keys = row["uid"], row["keys"]
        self.n_words = np.array(row["n_words"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.offsets = np.frombuffer(row["offsets"], "<i4").astype(np.int64)
        wide = self.offsets[-1] and len(row["positions"]) // self.offsets[-1] == 8
        self.positions = np.frombuffer(row["positions"], "<i8" if wide else "<u4")
        self.first = np.concatenate(([0], np.cumsum(self.n_words)[:-1])) + np.arange(len(self.keys)) * GAP

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """List number of each term, -1 where the shard lacks it."""
        if not len(self.terms):
            return np.full(len(terms), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, number: int) -> np.ndarray:
        return self.positions[self.offsets[number] : self.offsets[number + 1]].astype(np.int64)

    def exact(self, lists: np.ndarray) -> np.ndarray:
        """Start positions of the phrase whose terms have these lists, from the rarest term on."""
        sizes = self.offsets[lists + 1] - self.offsets[lists]
        found = None
        for i in np.argsort(sizes, kind="stable"):
            here = self.postings(lists[i])
            if found is None:
                found = here - i
            else:
                at = np.minimum(np.searchsorted(here, found + i), len(here) - 1)
                found = found[here[at] == found + i]
            if not len(found):
                break
        return found

    def near(self, lists: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the shortest run from each start that has the terms in order within
        ``slop`` extra words.  Only documents with the rarest term are searched."""
        sizes = self.offsets[lists + 1] - self.offsets[lists]
        rare = np.unique(self.documents(self.postings(lists[int(np.argmin(sizes))])))
        start = self.postings(lists[0])
        start = start[np.isin(self.documents(start), rare)]
        end = start.copy()
        for number in lists[1:]:
            here = self.postings(number)
            at = np.searchsorted(here, end, side="right")
            ok = at < len(here)
            start, end = start[ok], here[at[ok]]
        ok = end - start < len(lists) + slop
        return start[ok], end[ok] + 1

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, side="right") - 1


def item_blocks(items: DataFrame, key: str, text: str) -> DataFrame:
    """The test items as written rows of at most about ``BLOCK_BYTES`` of text, one item at least: block,
    item keys, words per item, terms of all words.  Tasks take the words; the driver sees the sum of sizes."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, block = Rolling(), TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = column_arrays(batch, "text")
            for a, b in row_chunks(offsets, BLOCK_BYTES):
                terms, counts = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], rolling)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.string())),
                        pa.array([counts.astype("<i8").tobytes()], pa.binary()),
                        pa.array([terms.tobytes()], pa.binary()),
                    ],
                    names=["block", "items", "counts", "terms"],
                )
                block += 1

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rows = rows.repartition(1 + size // BLOCK_BYTES)
    return saved(rows.mapInArrow(trimming(blocks), "block long, items array<string>, counts binary, terms binary"), "items")


def phrases_of(counts: np.ndarray, window: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, item) of each phrase of items with ``counts`` words laid end to end.

    ``window``: consecutive words of a phrase; an item of fewer words is one phrase.  None: whole items."""
    length = counts if window is None else np.minimum(counts, window)
    n = np.where(counts > 0, counts - length + 1, 0)
    item = np.repeat(np.arange(len(counts)), n)
    inside = np.arange(len(item)) - np.repeat(np.cumsum(n) - n, n)
    return (np.cumsum(counts) - counts)[item] + inside, length[item], item


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text",
           window: int | None = WINDOW, slop: int = 0) -> DataFrame:
    """Matches of the items' phrases: uid, key (document), hits (distinct word numbers inside the
    document, covered by a match), items (keys of the items that match).  One row per document and
    block of items; documents without a match have no row.

    Each block's matches are written before the next block is sent, so one block is held at a time."""
    spark = index.sparkSession
    schema = "uid long, key long, hits array<int>, items array<string>"
    blocks = item_blocks(items, key, text)
    out = saved(spark.createDataFrame([], schema), "matches")

    def matches(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, counts, terms = shared.value
            terms = np.frombuffer(terms, np.uint64)
            first_word, length, owner = phrases_of(np.frombuffer(counts, "<i8"), window)
            for batch in batches:
                for number in range(batch.num_rows):
                    shard = Shard(batch.slice(number, 1).to_pylist()[0])
                    docs, starts, ends, found = [], [], [], []
                    lists = shard.lookup(terms)
                    absent = np.concatenate(([0], np.cumsum(lists < 0)))
                    for i in np.flatnonzero(absent[first_word] == absent[first_word + length]):
                        here = lists[first_word[i] : first_word[i] + length[i]]
                        if slop:
                            s, e = shard.near(here, slop)
                        else:
                            s = shard.exact(here)
                            e = s + len(here)
                        if len(s):
                            d = shard.documents(s)
                            docs.append(d)
                            starts.append(s - shard.first[d])
                            ends.append(np.minimum(e - shard.first[d], shard.n_words[d]))
                            found.append(np.full(len(s), owner[i]))
                    if not docs:
                        continue
                    d, s, e, o = map(np.concatenate, (docs, starts, ends, found))
                    order = np.argsort(d, kind="stable")
                    d, s, e, o = d[order], s[order], e[order], o[order]
                    first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
                    result = []
                    for a, b in zip(first, np.append(first[1:], len(d)), strict=True):
                        cover = np.zeros(shard.n_words[d[a]] + 1, np.int64)
                        np.add.at(cover, s[a:b], 1)
                        np.add.at(cover, e[a:b], -1)
                        hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
                        result.append((shard.uid + int(d[a]), shard.keys[d[a]], hit.tolist(),
                                       [names[x] for x in np.unique(o[a:b])]))
                    cols = list(zip(*result, strict=True))
                    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["uid", "key", "hits", "items"]
                    )

        return index.mapInArrow(trimming(run), schema)

    for (block,) in blocks.select("block").collect():  # one number per block
        row = blocks.where(F.col("block") == block).first()
        shared = spark.sparkContext.broadcast((row["items"], bytes(row["counts"]), bytes(row["terms"])))
        out = out.union(saved(matches(shared), "matches"))
        shared.destroy()
    return out


def contamination(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """Per indexed document: uid, key, n_words, n_hit, n_items, items (sorted), contaminated.

    A document is contaminated when at least one word in twenty lies inside an item's window."""
    docs = index.select(
        "uid", F.posexplode(F.arrays_zip("keys", "n_words")).alias("_at", "_d")
    ).select((F.col("uid") + F.col("_at")).alias("uid"), F.col("_d.keys").alias("key"), F.col("_d.n_words").cast("long").alias("n_words"))
    found = search(index, items, key, text).groupBy("uid").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.collect_list("items"))))).alias("items"),
    )
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return docs.join(found, "uid", "left").select(
        "uid",
        "key",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows.  A verdict depends on the text alone, so rows go by 64 bits of
    their text's hash, whatever ids they have or share."""
    name = fresh_name(docs, "text_hash")
    rows = docs.withColumn(name, F.xxhash64(F.col(text)))
    bad = contamination(build_index(rows, name, text), items).where("contaminated").select(F.col("key").alias(name)).distinct()
    return rows.join(bad, name, "left_anti").select(*docs.columns)
