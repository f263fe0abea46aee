"""Token-id files: Parquet list columns that can be read in part (operator 11).

``write_tokens`` encodes every text, appends the end id and writes one row per document in ascending
order of its key:

    key, part, before, n_tokens, ids (list of 32-bit integers)

Files are range-partitioned by the key and sorted inside, so file order is key order.  ``ids`` is
dictionary-encoded (a vocabulary has few distinct values) or, with ``encoding="delta"``, written as
DELTA_BINARY_PACKED, as the sorted key and the running count ``before`` always are.  Row groups and
pages have set sizes and every column chunk has a column and an offset index, so a reader with a
range of keys fetches only the pages that hold it, and one that wants counts never touches the ids.

``before`` counts the tokens of the same part that come earlier; ``starts`` adds the totals of the parts
before it (one row per part, not per document), so the place of a document in the whole stream costs
no shuffle of documents.

Defined results: null and empty texts hold the end id alone; null keys come first; rows of equal keys
are ordered by a hash of their text; identical rows stay apart as rows of their own; other columns are
not written.  An empty table gives an empty one.  Special tokens that a text spells out become their
ids, as the library does by default.

The library cuts a text into pieces by a fixed pattern and encodes each piece by itself, so a task lets
it encode each distinct piece once and keeps the ids in two bounded generations.  The cuts of a run of
texts come from the classes of its characters, all at once; new pieces go straight to the library's model,
since most of its time on a piece goes into cutting it anew and into its records.  Texts with a special
token or with characters that the pattern's classes may see differently go to the library whole.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerscope.llm.bpe import byte_symbols
from peerscope.llm.common import trimming
from peerscope.session import ensure_checkpoint_dir

END_ID = 2
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1024
#: Characters that are encoded at once.
ENCODE_BYTES = 1 << 20

#: Pieces of one memo generation, and the longest piece that is kept.
MEMO_PIECES, MEMO_LENGTH = 200_000, 64
#: Characters whose class (white space, digit, letter) may differ between Python and the library: Unicode
#: blanks, separators, fractions, and all above Latin Extended-B, whose classes differ between versions.
ODD = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbe]|[^\x00-\u024f]")
#: Classes of the other characters in the vocabulary's pattern:
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
LETTER, DIGIT, SIGN, UNSURE, BLANK, WHITE = range(6)
CLASSES = np.array([
    UNSURE if ODD.match(c) else BLANK if c == " " else WHITE if re.match(r"\s", c) else DIGIT if re.match(r"\d", c) else LETTER if re.match(r"[^\W_]", c) else SIGN
    for c in map(chr, range(0x251))
], np.uint8)

_loaded: dict[str, PieceCoder] = {}


def cut(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The pieces of all texts, the place of each text's first one, and which texts have characters of ``ODD``;
    if any has, nothing is cut."""
    joined = "".join(texts)
    points, edges = np.frombuffer(joined.encode("utf-32-le"), "<u4"), np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=edges[1:])
    n = len(points)
    if not n:
        return pa.array([], pa.string()), edges, np.zeros(len(texts), bool)
    kind = CLASSES[np.minimum(points, len(CLASSES) - 1)]
    odd = np.zeros(len(texts), bool)
    odd[np.searchsorted(edges, np.flatnonzero(kind == UNSURE), side="right") - 1] = True
    if odd.any():
        return pa.array([], pa.string()), edges, odd
    white = kind >= BLANK
    followed = np.zeros(n, bool)  # by something that is not white, in the same text
    followed[:-1] = ~white[1:]
    followed[edges[1:][edges[1:] > 0] - 1] = False
    start = np.ones(n + 1, bool)
    # the last of several white characters stands apart; a blank belongs to what follows it
    start[1:n] = np.where(white[1:], ~white[:-1] | followed[1:], (kind[1:] != kind[:-1]) & (kind[:-1] != BLANK))
    start[edges] = True
    quotes = np.flatnonzero((points == ord("'")) & start[:n])
    if len(quotes):
        ends = edges[np.searchsorted(edges, quotes, side="right")]
        after = np.concatenate([points, np.zeros(2, points.dtype)])
        a = np.where(quotes + 1 < ends, after[quotes + 1], 0)
        b = np.where(quotes + 2 < ends, after[quotes + 2], 0)
        short = np.isin(a, [ord(c) for c in "sdmt"])
        long = (a == ord("l")) & (b == ord("l")) | ((a == ord("v")) | (a == ord("r"))) & (b == ord("e"))
        start[quotes[short | long] + 1] = False
        start[quotes[short] + 2] = True
        start[quotes[long] + 3] = True
    at = np.flatnonzero(start)
    firsts = np.searchsorted(at, edges)
    if not joined.isascii():  # the other characters have two bytes each
        at = at + np.concatenate([[0], np.cumsum(points >= 0x80)])[at]
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(joined.encode())), firsts, odd


class PieceCoder:
    """A byte-level vocabulary of the tokenizers library with a memo of its pieces."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.symbols = dict(enumerate(byte_symbols()))
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def written(self, piece: str) -> str:
        """The symbols of a piece's bytes; printable ASCII but the blank stands for itself."""
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", self.symbols[32])
        return piece.encode().decode("latin-1").translate(self.symbols)

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, each merged by the library's model from the symbols of its bytes."""
        merged, written = self.library.model.tokenize, self.written
        return {p: array("i", [t.id for t in merged(written(p))]).tobytes() for p in pieces}

    def memoised(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.memo) > MEMO_PIECES:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        out = list(map(memo.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        kept = {p: ids for i in missing if (ids := old.get(p := pieces[i])) is not None}
        memo.update(kept)
        learnt = self.learn([p for i in missing if (p := pieces[i]) not in kept])
        memo.update(learnt)
        for i in missing:
            out[i] = memo[pieces[i]]
        for p in learnt:
            if len(p) > MEMO_LENGTH:
                del memo[p]
        return out

    def id_arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        pieces, firsts, odd = cut(texts)
        if self.special and any(map(self.special.search, texts)):
            odd |= [bool(self.special.search(t)) for t in texts]
        if odd.any():
            whole = iter(self.library.encode_batch_fast([t for t, o in zip(texts, odd, strict=True) if o], add_special_tokens=False))
            rest = iter(self.id_arrays([t for t, o in zip(texts, odd, strict=True) if not o]))
            return [np.array(next(whole).ids, "<i4") if o else next(rest) for o in odd]
        if not len(pieces):
            return [np.empty(0, "<i4")] * len(texts)
        coded = pieces.dictionary_encode()
        made = self.memoised(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.array([len(m) for m in made], np.int32) // 4
        flat, begins = np.frombuffer(b"".join(made), "<i4"), np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        counts = sizes[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(begins[which] - ends[:-1], counts) + np.arange(ends[-1])]
        at = ends[firsts].tolist()
        return [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        return [ids.tobytes() for ids in self.id_arrays(texts)]


def tokenizer(path: str) -> PieceCoder:
    """The tokenizer of a vocabulary file, loaded once per Python worker; truncation and padding off."""
    if path not in _loaded:
        _loaded[path] = PieceCoder(path)
    return _loaded[path]


def text_runs(texts: list[str | None], limit: int = ENCODE_BYTES):
    """Consecutive texts of about ``limit`` characters together, one text at least."""
    run: list[str] = []
    held = 0
    for t in texts:
        run.append(t or "")
        held += len(run[-1])
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run


def write_options(encoding: str, row_group_bytes: int, page_bytes: int, page_rows: int) -> dict[str, str]:
    """Parquet settings of the files: format 2 pages, delta for sorted integers, sizes as given."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    return {
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(),
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "compression": "zstd",
    }


def write_tokens(
    docs: DataFrame, vocabulary: str, path: str | None = None, key: str = "doc_id", text: str = "text",
    end_id: int = END_ID, encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS,
) -> str:
    """Write the token files of ``docs`` and return their folder (one in the shared folder by default)."""
    if path is None:
        path = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/peerscope/tokens-{uuid.uuid4().hex}"
    end = np.array([end_id], "<i4")

    def encode(batches):
        coder, part, before = tokenizer(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for run in text_runs(batch.column(1).to_pylist()):
                ids = coder.id_arrays(run)
                n = np.array([len(i) + 1 for i in ids], np.int64)
                offsets = np.zeros(len(n) + 1, np.int32)
                np.cumsum(n, out=offsets[1:])
                flat = np.concatenate([x for i in ids for x in (i, end)])
                starts = before + offsets[:-1].astype(np.int64)
                before += int(offsets[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(run)), pa.array(np.full(len(n), part, np.int32)), pa.array(starts),
                     pa.array(n), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=[key, "part", "before", "n_tokens", "ids"],
                )
                at += len(run)

    # the hash and the row number keep rows of one key apart, so that a hot key may span partitions
    rows = docs.select(F.col(key), F.col(text)).withColumns(
        {"_h": F.xxhash64(F.col(text)), "_n": F.monotonically_increasing_id()}
    )
    order = [F.col(key).asc_nulls_first(), F.col("_h"), F.col("_n")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = docs.schema[key].dataType.simpleString()
    out = rows.select(key, text).mapInArrow(
        trimming(encode), f"`{key}` {kind}, part int, before long, n_tokens long, ids array<int>"
    )
    options = write_options(encoding, row_group_bytes, page_bytes, page_rows)
    out.write.options(**options).parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """The files' rows, or some columns and a range of them: a condition on the key or on counts reaches
    the row groups' statistics and the page indexes, and unread columns aren't fetched."""
    rows = spark.read.parquet(path)
    if where is not None:
        rows = rows.where(where)
    return rows if columns is None else rows.select(*columns)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, first): how many tokens the parts before each one hold.  Reads the counts alone."""
    totals = read_tokens(spark, path, ["part", "n_tokens"]).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(earlier, F.lit(0)).cast("long").alias("first"))


def with_starts(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` of token files with ``start``, the number of tokens of all documents before each."""
    first = F.broadcast(starts(rows.sparkSession, path))  # one row per written file
    return rows.join(first, "part").withColumn("start", F.col("first") + F.col("before")).drop("first")


def ids_crc32(ids: str):
    """Unsigned CRC-32 of each list's ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(lists: pa.Array) -> pa.Array:
        raw = memoryview(np.asarray(lists.values.cast(pa.int32())).astype("<u4")).cast("B")
        at = lists.offsets.to_numpy()
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())

    return crc(F.col(ids))
