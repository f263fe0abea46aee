"""Toxicity scores of deobfuscated text: a noisy channel, Viterbi decoding, then a learnt lexicon (operator 9).

1. A character model: trigram counts of all words of all documents (a-z, one class for other
   letters, word borders); every task's counts are summed by Spark into one fixed-size table.
2. The channel: a token that could be disguised (letters mixed with digits or signs, letters repeated
   three times or more, single letters spaced out) becomes a lattice: each character may stand for the
   letters it looks like, may be itself, or may be dropped (separators, repetitions, signs at the
   edge).  Viterbi decoding over the last two letters picks the likeliest restored word.
3. The score: weights of words and of word beginnings are lower confidence bounds of log odds from
   labelled documents; a document is described by its strongest words and how many there are, and a
   logistic model turns this into a score.  For its fit, each half of the labelled documents is
   described by the weights that the other half gives.

The labelled rows are a bounded sample (``TRAIN_ROWS``, by a hash of the id), and the lexicon keeps
the words of those texts; the character model and the scores cover every row and whole texts.

Defined results: null and empty texts get the model's score of a text without marked words; rows that
repeat get equal scores; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import Shared, by_pieces, column_arrays, row_chunks, trimming

#: Labelled rows the classifier is fitted to, at most (a hash of the id picks them).
TRAIN_ROWS = 40_000
#: Least weight of a word of the lexicon, which is bounded by the words of ``TRAIN_ROWS`` texts.
LEAST_WEIGHT = 1.0
#: Standard errors that a word's log odds are lowered by.
CAUTION = 1.5
#: Distinct tokens memoised per task process.
MEMO_ENTRIES = 150_000

# Letters that a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "[": "c", "€": "e", "£": "l",
    "¡": "i", "µ": "u", "§": "s", "#": "h", "%": "x", "*": "aeiou",
}
#: Channel costs (negative logs): a disguise, keeping a sign, dropping a sign, dropping a repetition,
#: dropping a blank between spaced-out letters, dropping one of two equal letters.
SWAP, KEEP, DROP, DROP_REPEAT, DROP_BLANK, DROP_DOUBLED = 1.0, 6.0, 2.5, 0.4, 0.2, 3.0
CLASSES = 28  # border, a-z, other letters
EDGE = ".,;:!?\"'()[]{}*&%$#@-_/\\|<>=+~`…»«„“”’‘"


def letter_table() -> np.ndarray:
    """Byte -> class: 1-26 letters in either case, 27 bytes of other letters, 0 the rest (a border)."""
    t = np.zeros(256, np.int64)
    t[97:123] = t[65:91] = np.arange(1, 27)
    t[0x80:] = 27
    return t


def trigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): counts of all character trigrams of all texts; each task sends one small table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = letter_table(), np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            data, offsets = column_arrays(batch, "text")
            for a, b in row_chunks(offsets):
                c = classes[data[offsets[a] : offsets[b]]]
                c = np.concatenate(([0, 0], c, [0, 0]))
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(total[grams])], names=["gram", "n"])

    parts = df.select(F.col(text).alias("text")).mapInArrow(trimming(count), "gram long, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def character_costs(counts: list[tuple[int, int]]) -> np.ndarray:
    """-log P(c | two before), interpolated with the bigram and unigram shares."""
    n = np.zeros(CLASSES**3)
    for gram, k in counts:
        n[gram] = k
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    two, one = n.sum(axis=0), n.sum(axis=(0, 1))
    p1 = (one + 1) / (one + 1).sum()
    p2 = (two + 50 * p1) / (two.sum(axis=1, keepdims=True) + 50)
    return -np.log((n + 20 * p2) / (n.sum(axis=2, keepdims=True) + 20))


class Restorer:
    """Decodes tokens through the channel; one per task process."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = costs.ravel().tolist()
        self._setup()

    def _setup(self) -> None:
        self.memo: dict[str, str] = {}
        self.spaced = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")
        self.repeated = re.compile(r"(.)\1+")

    def __getstate__(self) -> dict:
        return {"costs": self.costs}

    def __setstate__(self, state: dict) -> None:
        self.costs = state["costs"]
        self._setup()

    @staticmethod
    def _class(c: str) -> int:
        return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0

    def decode(self, token: str) -> str:
        """The likeliest word (words, where it holds blanks) behind a lower-cased token."""
        costs, classes = self.costs, self._class
        states = {(0, 0): (0.0, None)}  # the last two letter classes -> (cost, chain of letters)
        before = ""
        # a doubled letter is dropped more readily the more of them a token has
        doubled = DROP_DOUBLED / max(1, sum(len(m[0]) == 2 for m in self.repeated.finditer(token)))
        for i, c in enumerate(token):
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
                if c == before:
                    options.append(("", DROP_REPEAT if token[max(0, i - 2) : i] == c + c or token[i + 1 : i + 2] == c else doubled))
            elif c == " ":
                options += [("", DROP_BLANK), (" ", 0.0)]
            else:
                options += [(x, SWAP) for x in LOOKS_LIKE.get(c, "")]
                options.append(("", DROP))
                if c.isdigit():
                    options.append((c, KEEP))
            before = c
            new: dict = {}
            for (p, q), (cost, chain) in states.items():
                for out, step in options:
                    if not out:
                        key, total, link = (p, q), cost + step, chain
                    else:
                        k = classes(out)
                        total = cost + step + costs[(p * CLASSES + q) * CLASSES + k]
                        key, link = (q, k), (out, chain)
                    if key not in new or total < new[key][0]:
                        new[key] = (total, link)
            states = new
        best = min(states.items(), key=lambda s: s[1][0] + costs[(s[0][0] * CLASSES + s[0][1]) * CLASSES])
        out, chain = [], best[1][1]
        while chain is not None:
            out.append(chain[0])
            chain = chain[1]
        return "".join(reversed(out))

    def word(self, token: str) -> str:
        """The restored word of one token; plain words are only stripped and lower-cased."""
        found = self.memo.get(token)
        if found is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            low = token.lower()
            core = low.strip(EDGE)
            if core.isalpha():
                found = self.decode(core) if self.repeated.search(core) else core
            elif any(c.isalpha() for c in low):
                found = self.decode(low)
            else:
                found = ""
            if len(token) <= 64:
                self.memo[token] = found
        return found

    def tokens(self, text: str | None) -> list[str]:
        """Tokens of a text; single letters that are spaced out, by any white space, come as one token with blanks."""
        if not text:
            return []
        if not self.spaced.search(text):
            return text.split()
        out, at = [], 0
        for m in self.spaced.finditer(text):
            # signs that stand for letters count as letters beside one
            if any(map(str.isalpha, m[0])) and sum(c.isalpha() or c in LOOKS_LIKE for c in m[0]) >= 3:
                out += text[at : m.start()].split()
                out.append(" ".join(m[0].split()))
                at = m.end()
        return out + text[at:].split()

    def words(self, text: str | None) -> set[str]:
        word = self.word
        out = set()
        for t in set(self.tokens(text)):
            w = word(t)
            if " " in w:
                out.update(w.split())
            elif w:
                out.add(w)
        return out

    def text(self, text: str | None) -> str:
        """The whole text restored, words joined by a blank."""
        return " ".join(w for w in map(self.word, self.tokens(text)) if w)


def restored_text(df: DataFrame, restorer, text: str = "text", out: str = "restored_text") -> DataFrame:
    """``df`` with the restored text (``restorer``: a broadcast :class:`Restorer`)."""

    @F.arrow_udf("string")
    def restore(texts: pa.Array) -> pa.Array:
        return by_pieces(texts, restorer.value.text, pa.string())

    return df.withColumn(out, restore(F.col(text)))


def features_of(word: str) -> tuple[str, ...]:
    """What the lexicon may know a word by: itself and, for longer words, how it begins."""
    return (word, f"^{word[:4]}", f"^{word[:5]}") if len(word) > 5 else (word,)


class Weights(dict):
    """Word -> its strongest feature's weight, 0 without one; filled as words are met."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        w = max(self.lexicon.get(f, 0.0) for f in features_of(word))
        self[word] = w
        return w


def describe(words: set[str], weights: Weights) -> tuple[float, float, float, float]:
    """A document's features: its strongest word, its three strongest words, logs of how many words are
    marked and how many there are."""
    found = sorted(filter(None, map(weights.__getitem__, words)), reverse=True)
    return (found[0] if found else 0.0, sum(found[:3]), math.log1p(len(found)), math.log1p(len(words)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a small logistic model; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, restorer, key: str = "doc_id", text: str = "text", label: str = "toxic"):
    """(word weights, logistic coefficients) from the labelled rows of ``labels`` (key, label).

    ``labels`` must hold training rows only.  At most ``TRAIN_ROWS`` of them are used, which bounds the
    broadcast that picks their texts and the rows of the logistic fit."""
    spark = docs.sparkSession
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_y"))
    picked = rows.orderBy(F.xxhash64(key), key).limit(TRAIN_ROWS)
    half = F.pmod(F.xxhash64(F.col(key), F.lit("half")), F.lit(2)).cast("int")
    known = docs.select(key, text).join(F.broadcast(picked), key).select(
        F.col(text).alias("text"), (F.col("_y") == 1).cast("int").alias("_y"), half.alias("_h")
    )

    @F.arrow_udf("array<string>")
    def features(texts: pa.Array) -> pa.Array:
        r = restorer.value
        return by_pieces(texts, lambda t: list({f for w in r.words(t) for f in features_of(w)}), pa.list_(pa.string()))

    sizes = {(r["_y"], r["_h"]): r["count"] for r in known.groupBy("_y", "_h").count().collect()}
    n = {y: [sizes.get((y, h), 0) for h in (0, 1)] for y in (0, 1)}
    if not sum(n[1]) or not sum(n[0]):
        return {}, None
    cells = {f"n{y}{h}": F.count(F.when((F.col("_y") == y) & (F.col("_h") == h), 1)) for y in (0, 1) for h in (0, 1)}
    counted = known.select(F.explode(features("text")).alias("word"), "_y", "_h").groupBy("word").agg(
        *[c.alias(name) for name, c in cells.items()]
    )

    def weight(halves: tuple[int, ...]):
        """Lower confidence bound of the log odds, from the given halves of the sample."""
        a = sum((F.col(f"n1{h}") for h in halves), F.lit(0.5))
        b = sum((F.col(f"n0{h}") for h in halves), F.lit(0.5))
        of1, of0 = 1 + sum(n[1][h] for h in halves), 1 + sum(n[0][h] for h in halves)
        return F.log(a / of1) - F.log(b / of0) - CAUTION * F.sqrt(1 / a + 1 / b)

    both, first, second = weight((0, 1)), weight((0,)), weight((1,))
    best = counted.select("word", both.alias("w"), first.alias("w0"), second.alias("w1")).where(
        F.greatest("w", "w0", "w1") >= LEAST_WEIGHT
    )
    kept = best.collect()
    lexicons = [{r["word"]: r[c] for r in kept if r[c] >= LEAST_WEIGHT} for c in ("w", "w0", "w1")]
    shared = Shared(spark, [Weights(x) for x in lexicons])

    @F.arrow_udf("array<double>")
    def described(texts: pa.Array, halves: pa.Array) -> pa.Array:
        r, w = restorer.value, shared.value
        # a text is described by the words that the other half of the sample has marked
        made = [list(describe(r.words(t), w[2 - h])) for t, h in zip(texts.to_pylist(), halves.to_pylist(), strict=True)]
        return pa.array(made, pa.list_(pa.float64()))

    fit = known.select(described("text", "_h").alias("x"), "_y").groupBy("x", "_y").count().collect()
    x = np.array([r["x"] for r in fit]).reshape(-1, 4)
    times = np.array([r["count"] for r in fit])
    return lexicons[0], fit_logistic(np.repeat(x, times, axis=0), np.repeat(np.array([r["_y"] for r in fit]), times))


def channel(docs: DataFrame, text: str = "text"):
    """A broadcast :class:`Restorer` whose character model is counted over all of ``docs``.

    At most 28**3 counts come to the driver, whatever the size of the corpus."""
    counts = [(r[0], r[1]) for r in trigram_counts(docs, text).collect()]
    return Shared(docs.sparkSession, Restorer(character_costs(counts)))


def with_scores(df: DataFrame, restorer, weights: dict, beta, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the column ``out``: the toxicity score of every row's whole text."""
    if beta is None:
        return df.withColumn(out, F.lit(0.0))
    shared = Shared(df.sparkSession, (Weights(weights), [float(x) for x in beta]))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        r, (w, coefficients) = restorer.value, shared.value

        def of(text):
            z = sum(x * c for x, c in zip((*describe(r.words(text), w), 1.0), coefficients, strict=True))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return by_pieces(texts, of, pa.float64())

    return df.withColumn(out, score(F.col(text)))


def held_out(key: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its id as text is divisible by 5."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def scored_documents(docs: DataFrame, labels: DataFrame, out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``; the model is learnt from the labelled ones that are not held out."""
    restorer = channel(docs)
    weights, beta = train(docs, labels.where(~held_out()), restorer)
    return with_scores(docs, restorer, weights, beta, out=out)
