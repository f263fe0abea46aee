"""BPE encoding and decoding with a contiguous rank array (operator 10).

A word is held as two short lists: the part boundaries' symbol ids and, beside them, the merge rank
of each part with its right neighbour.  The smallest rank is found by scanning the array, one
boundary is deleted and the two neighbouring ranks are looked up anew, until no adjacent pair has a
rank.  Words longer than ``SCAN_LIMIT`` symbols use a heap over the same arrays (same merge order),
since repeated scans of a long array are quadratic.

The pieces of a text are memoised per task process in two generations of ``MEMO_ENTRIES`` entries: a
full one becomes the old one, so common words stay and memory is bounded.

Defined results: null and empty texts have no tokens (empty ids, empty decoded text); other columns
of the input pass through unless they have the name of an output column, which is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.llm.common import Shared, by_pieces, trimming

#: Symbols up to which a word is merged by scanning the rank array.
SCAN_LIMIT = 96
#: Entries of one memo generation.
MEMO_ENTRIES = 100_000
NO_RANK = 1 << 30
#: White space of the vocabulary's pattern (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def unpacked(ids: bytes) -> array:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out


class WordBPE:
    """A word-level BPE vocabulary: normalise, cut, merge by rank, and back from ids to text."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.token = [""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        self.pair = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pair.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        symbols = byte_symbols()
        self.inner = [vocab.get(s) for s in symbols]
        self.last = [vocab.get(s + self.suffix) for s in symbols]
        self._patterns()

    def _patterns(self) -> None:
        # ids of the pieces met lately, and what was held before that was full
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # the alternatives begin with different characters, so the commonest may come first
        self.piece = regex.compile(rf"\p{{L}}+|'s|'t|'re|'ve|'m|'ll|'d|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        self.ascii_piece = re.compile(r"[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-z0-9 \t-\r]+")
        specials = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

    def __getstate__(self) -> dict:
        kept = ("suffix", "special", "token", "pair", "inner", "last")
        return {k: getattr(self, k) for k in kept}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._patterns()

    def merge(self, ids: list[int]) -> list[int]:
        """Merged symbol ids of one word (the rank-array scan)."""
        if len(ids) > SCAN_LIMIT:
            return self._merge_long(ids)
        find = self.pair.get
        none = (NO_RANK, -1)
        found = [find(p, none) for p in zip(ids, ids[1:], strict=False)]
        ranks = [f[0] for f in found]
        made = [f[1] for f in found]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            at = ranks.index(low)
            ids[at] = made[at]
            del ids[at + 1], ranks[at], made[at]
            if at < len(ranks):
                ranks[at], made[at] = find((ids[at], ids[at + 1]), none)
            if at:
                ranks[at - 1], made[at - 1] = find((ids[at - 1], ids[at]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges in the same order for a long word: a heap instead of the scan."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\x01") * n
        find = self.pair.get
        heap = []
        for i in range(n - 1):
            if f := find((ids[i], ids[i + 1])):
                heap.append((f[0], i, ids[i], ids[i + 1], f[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = new, 0, after[j]
            if after[j] < n:
                before[after[j]] = i
                if f := find((new, ids[after[j]])):
                    heapq.heappush(heap, (f[0], i, new, ids[after[j]], f[1]))
            if (h := before[i]) >= 0 and (f := find((ids[h], new))):
                heapq.heappush(heap, (f[0], h, ids[h], new, f[1]))
        return [x for x, live in zip(ids, alive, strict=True) if live]

    def piece_ids(self, piece: str) -> bytes:
        """Ids (little-endian unsigned 32-bit) of one piece of the pattern."""
        raw = piece.encode("utf-8", "surrogatepass")
        inner = self.inner
        ids = [inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        return packed(self.merge(ids))

    def pieces(self, text: str) -> list[str]:
        """The normalised text cut by the vocabulary's pattern."""
        if text.isascii():
            return self.ascii_piece.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        # a capital sigma is lowered by itself, without regard to its place in the word
        return self.piece.findall("".join(c.lower() for c in text) if "Σ" in text else text.lower())

    def plain_ids(self, text: str) -> bytes:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.old = {}, self.memo
        memo, old, out = self.memo, self.old, []
        for piece in self.pieces(text):
            ids = memo.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    ids = self.piece_ids(piece)
                if len(piece) <= 64:
                    memo[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.cut is None or "<|" not in text:
            return self.plain_ids(text)
        parts = []
        for part in self.cut.split(text):
            known = self.special.get(part)
            parts.append(self.plain_ids(part) if known is None else known.to_bytes(4, "little"))
        return b"".join(parts)

    def decode(self, ids: bytes | None) -> str:
        """Tokens joined by a blank (the vocabulary file has no decoder step)."""
        return " ".join(map(self.token.__getitem__, unpacked(ids or b"")))


def load(spark: SparkSession, path: str):
    """The vocabulary as a broadcast variable: a fixed file of a few MB, not data that grows."""
    with open(path, encoding="utf-8") as f:
        return Shared(spark, WordBPE(json.load(f)))


def encoder(model):
    """Arrow UDF text -> ids as binary (little-endian unsigned 32-bit)."""

    @F.arrow_udf("binary")
    def bpe_encode(texts: pa.Array) -> pa.Array:
        return by_pieces(texts, model.value.encode, pa.binary())

    return bpe_encode


def decoder(model):
    """Arrow UDF ids -> text."""

    @F.arrow_udf("string")
    def bpe_decode(ids: pa.Array) -> pa.Array:
        return by_pieces(ids, model.value.decode, pa.string())

    return bpe_decode


def with_tokens(df: DataFrame, model, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with the column ``ids``: the encoded text (binary, 4 bytes a token)."""
    return df.withColumn(ids, encoder(model)(F.col(text)))


def token_count(ids: str | Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def round_trip(df: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256 (encode, then decode the ids).

    Ids and decoded texts are digested where they are made: only the digests leave the task."""

    def run(batches):
        coder = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                made = []
                for body in rows.column(1).to_pylist():
                    ids = coder.encode(body)
                    made.append((len(ids) // 4, sha256(ids).hexdigest(),
                                 sha256(coder.decode(ids).encode("utf-8", "surrogatepass")).hexdigest()))
                n, ids_digest, text_digest = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n, pa.int64()), pa.array(ids_digest), pa.array(text_digest)],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(
        trimming(run), f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
