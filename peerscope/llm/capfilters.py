"""Embedding near-duplicates by spherical-cap filters (operator 4).

Vectors are normalised in double precision and turned by a seeded random rotation.  The filter
directions form a product code: the dimensions are cut into ``BLOCKS`` blocks, each block has the same
number of random unit vectors, and every combination of one per block is a direction.  A vector lies
in the cap of each direction whose inner product exceeds a threshold; these are list-decoded by
combining sorted partial sums, without visiting the other directions.  The number of directions
follows the number of vectors, and the threshold gives each vector ``CAPS`` caps of each of ``CODES``
codes on average (from the exact tail of a uniform direction), so caps stay small while the table
grows.  Two vectors at the link threshold share a smaller part of their caps the more directions there
are, so the caps of a vector grow slowly with the directions (``level_caps``): the caps that such a pair
is expected to share, and with them the recall, stay level.

Vectors meet in the caps they share and every pair of a cap is verified in double precision.  A pair
is counted only in the first cap that both lie in, so link counts need no table of pairs: a cap sends
partial counts and a spanning forest of its links.  A cap of more than ``CAP_ROWS`` rows is cut into
parts that meet pairwise in different tasks; nothing is capped or dropped.

Equal vectors (bit by bit) are one class: they meet others once and count for each other.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing (also not with equal ones); vectors of different lengths never link; repeated ids are separate
vectors that count as links of each other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import components, find_roots, repeated_keys, saved, sorted_groups, split_parts, tied_by_key, trimming

BLOCKS = 2
#: Independent codes, and the mean number of caps of a code that a vector lies in.  Recall at the
#: threshold grows with both; several codes even out directions that one code covers badly.
CODES, CAPS = 4, 12
#: Where CAPS holds: dimensions, directions of a code and cosine.
CAPS_AT = (64, 225**2, 0.95)
#: Rows of a cap that are compared in one task.
CAP_ROWS = 2048
SEED = 20240229


def tail(dim: int, a: float) -> float:
    """P(<x, f> > a) for a uniform direction x in ``dim`` dimensions."""
    t = np.linspace(a, 1, 4001)
    density = np.maximum(1 - t * t, 0) ** ((dim - 3) / 2)
    whole = math.exp(math.lgamma((dim - 1) / 2) + 0.5 * math.log(math.pi) - math.lgamma(dim / 2))
    return float(((density[1:] + density[:-1]) / 2 * np.diff(t)).sum() / whole)


def joint_tail(dim: int, a: float, cosine: float) -> float:
    """P(<x, f> > a and <y, f> > a) for a uniform direction f and unit vectors x, y at ``cosine``; ``a``
    is not negative and ``dim`` above 3 (f's projection on the plane of x and y, in polar coordinates)."""
    r = np.linspace(a, 1, 4001)[1:]
    width = np.maximum(2 * np.arccos(np.minimum(a / r, 1)) - math.acos(max(-1.0, min(1.0, cosine))), 0)
    density = r * np.maximum(1 - r * r, 0) ** ((dim - 4) / 2) * width
    return float(((density[1:] + density[:-1]) / 2 * np.diff(r)).sum()) * (dim - 2) / (2 * math.pi)


def level_caps(dim: int, directions: int, cosine: float, caps: float = CAPS) -> float:
    """Mean caps of a code with which a pair at ``cosine`` is expected to share as many of them as with
    ``caps`` at ``CAPS_AT``; never fewer than ``caps``."""

    def cut(share, reached) -> float:
        low, high = 0.0, 1.0
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (mid, high) if reached(mid) > share else (low, mid)
        return low

    dim0, directions0, cosine0 = CAPS_AT
    at = cut(min(0.5, caps / directions0), lambda a: tail(dim0, a))
    share = directions0 * joint_tail(dim0, at, cosine0) / directions
    if dim <= 3 or joint_tail(dim, 0.0, cosine) <= share:
        return max(caps, directions)  # all vectors meet
    return max(caps, directions * tail(dim, cut(share, lambda a: joint_tail(dim, a, cosine))))


class ProductCode:
    """One code's filter directions for vectors of one length."""

    def __init__(self, dim: int, words: int, caps: float = CAPS, number: int = 0) -> None:
        rng = np.random.default_rng([SEED, dim, number])
        self.dim, self.blocks = dim, max(1, min(BLOCKS, dim))
        self.words = words ** (BLOCKS // self.blocks)
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = np.linspace(0, dim, self.blocks + 1).astype(int)
        self.code = []
        for a, b in zip(self.cuts, self.cuts[1:], strict=False):
            c = rng.normal(size=(self.words, b - a))
            self.code.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(self.blocks))
        low, high, share = -1.0, 1.0, min(1.0, caps / self.words**self.blocks)
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (mid, high) if tail(dim, mid) > share else (low, mid)
        # in three dimensions or fewer the caps are whole spheres: all vectors meet
        self.threshold = low if dim > 3 else -2.0

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of every direction whose inner product with a row exceeds the threshold."""
        x = unit @ self.rotation
        sums = [x[:, a:b] @ c.T for a, b, c in zip(self.cuts, self.cuts[1:], self.code, strict=False)]
        half = (self.blocks + 1) // 2
        left, right = self._combined(sums[:half]), self._combined(sums[half:])
        if right is None:
            row, col = np.nonzero(left > self.threshold)
            return row, col
        order = np.argsort(-right, axis=1)
        down = np.take_along_axis(right, order, axis=1)
        row, first = np.nonzero(left > (self.threshold - down[:, :1]))
        # partial sums of the right half that still reach the threshold: a prefix of the sorted row
        need = self.threshold - left[row, first]
        n = np.zeros(len(row), np.int64)
        step = 1 << (down.shape[1].bit_length())
        while step:
            probe = n + step
            ok = probe <= down.shape[1]
            ok[ok] = down[row[ok], probe[ok] - 1] > need[ok]
            n[ok] = probe[ok]
            step >>= 1
        at = np.repeat(np.arange(len(row)), n)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        return row[at], first[at] * right.shape[1] + order[row[at], rank]

    @staticmethod
    def _combined(sums: list[np.ndarray]) -> np.ndarray | None:
        out = None
        for s in sums:
            out = s if out is None else (out[:, :, None] + s[:, None, :]).reshape(len(s), -1)
        return out


def usable(col):
    """Whether a vector can link: present, all components finite, not zero."""
    finite = F.forall(col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(col, lambda v: v != 0), F.lit(False))


def stored(df: DataFrame, vector: str):
    """The vector column as array<float> if it is one, else as array<double>: what tasks exchange."""
    kind = df.schema[vector].dataType.simpleString()
    return F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")


def vector_classes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(dim, vector, rep, low, mult): one row per distinct usable vector, a number of its own, its smallest
    id and its rows.  The number holds for a written table."""
    rows = df.where(usable(F.col(vector))).select(F.col(key).alias("_k"), stored(df, vector).alias("_v"))
    rows = rows.withColumn("_u", F.monotonically_increasing_id())
    return rows.groupBy("_v").agg(F.min("_u").alias("rep"), F.min("_k").alias("low"), F.count("*").alias("mult")).select(
        F.size("_v").alias("dim"), F.col("_v").alias("vector"), "rep", "low", "mult"
    )


def unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows normalised in double precision (scaled first, so that no square overflows or vanishes)."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), "<f4" if len(raw[0]) == 4 * dim else "<f8").reshape(len(raw), dim)


def _list_type(words: int) -> str:
    """Cap numbers take four bytes while they fit."""
    return "<i4" if CODES * words**BLOCKS < 1 << 31 else "<i8"


def cap_members(classes: DataFrame, words: int, caps: float, threshold: float) -> DataFrame:
    """(dim, cap, rep, mult, vector, caps): a class's row in each cap it lies in; ``caps`` are all of its caps."""
    schema = "dim int, cap long, rep long, mult long, vector binary, caps binary"

    def decode(batches):
        codes: dict[int, list[ProductCode]] = {}
        steps: dict[int, int] = {}  # vectors decoded at a time: about 256 of CAPS caps
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims):
                if dim not in codes:
                    level = level_caps(int(dim), words**BLOCKS, threshold, caps)
                    codes[dim] = [ProductCode(int(dim), words, level, k) for k in range(CODES if dim > 3 else 1)]
                    steps[dim] = max(1, min(256, int(256 * CAPS / level)))
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), steps[dim]):
                    some = pa.array(at[lo : lo + steps[dim]])
                    part = batch.take(some)
                    x = np.asarray(part.column("vector").flatten()).reshape(len(some), dim)
                    unit = unit_rows(x)
                    decoded = [c.decode(unit) for c in codes[dim]]
                    row = np.concatenate([r for r, _ in decoded])
                    cap = np.concatenate([c + k * words**BLOCKS for k, (_, c) in enumerate(decoded)])
                    order = np.lexsort((cap, row))
                    row, cap = row[order].astype(np.int64), cap[order].astype(np.int64)
                    ends = np.searchsorted(row, np.arange(len(some) + 1))
                    packed = cap.astype(_list_type(words))
                    lists = [packed[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
                    raw = [v.tobytes() for v in x]
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(row), dim, np.int32)),
                            pa.array(cap),
                            part.column("rep").take(take),
                            part.column("mult").take(take),
                            pa.array(raw, pa.binary()).take(take),
                            pa.array(lists, pa.binary()).take(take),
                        ],
                        names=["dim", "cap", "rep", "mult", "vector", "caps"],
                    )

    return classes.select("dim", "vector", "rep", "mult").mapInArrow(trimming(decode), schema)


def first_shared(mine: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest cap that the rows a[i] and b[i] share (they share one at least); lists are sorted."""
    width = max(len(m) for m in mine)
    table = np.full((len(mine), width), np.iinfo(np.int64).max)
    for i, m in enumerate(mine):
        table[i, : len(m)] = m
    i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    while True:
        x, y = table[a, i], table[b, j]
        if (x == y).all():
            return x
        i += x < y
        j += y < x


def cap_links(members: DataFrame, words: int, threshold: float) -> DataFrame:
    """(a, b, n): with b null, n more links of class a; else a link of the spanning forests.

    Caps of more than CAP_ROWS rows are cut into parts by a hash of the class; each pair of parts
    meets in a task of its own."""
    sizes = members.groupBy("dim", "cap").agg(F.ceil(F.count("*") / CAP_ROWS).cast("int").alias("_b"))
    rows = split_parts(members, ["dim", "cap"], sizes.where("_b > 1"), "rep")

    def meet(batches):
        for (dim, cap, u, v), group in sorted_groups(batches, ["dim", "cap", "u", "v"]):
            if group.num_rows < 2:
                continue
            rep, mult, part = (np.asarray(group.column(c)) for c in ("rep", "mult", "part"))
            x = unit_rows(_matrix(group.column("vector"), int(dim)))
            caps = [np.frombuffer(c, _list_type(words)) for c in group.column("caps").to_pylist()]
            left = np.flatnonzero(part == u)
            right = left if u == v else np.flatnonzero(part == v)
            found = np.zeros(len(rep), np.int64)
            ends_a, ends_b = [], []
            for lo in range(0, len(left), 512):
                some = left[lo : lo + 512]
                i, j = np.nonzero(x[some] @ x[right].T >= threshold)
                i, j = some[i], right[j]
                keep = (i < j) if u == v else np.ones(len(i), bool)
                i, j = i[keep], j[keep]
                if not len(i):
                    continue
                own = first_shared(caps, i, j) == cap
                np.add.at(found, i[own], mult[j[own]])
                np.add.at(found, j[own], mult[i[own]])
                ends_a.append(i)
                ends_b.append(j)
            if not ends_a:
                continue
            root = find_roots(len(rep), np.concatenate(ends_a), np.concatenate(ends_b))
            tied = np.flatnonzero(root != np.arange(len(rep)))
            got = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((rep[got], rep[tied]))),
                    pa.array([None] * len(got) + rep[root[tied]].tolist(), pa.int64()),
                    pa.array(np.concatenate((found[got], np.zeros(len(tied), np.int64)))),
                ],
                names=["a", "b", "n"],
            )

    keys = ["dim", "cap", "u", "v"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimming(meet), "a long, b long, n long")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    caps: float = CAPS) -> DataFrame:
    """Per row of ``df``: key, n_links, component_id, kept (see the module's text).

    ``caps`` holds for vectors, directions and a threshold as in ``CAPS_AT``; see :func:`level_caps`."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("_e"))
    classes = saved(vector_classes(rows, "vec_id", "_e"), "vector-classes")
    words = max(4, math.ceil(classes.count() ** (1 / BLOCKS)))
    found = saved(cap_links(cap_members(classes, words, caps, threshold), words, threshold), "cap-links")
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    # an id that several vectors have belongs to one component
    several = rows.join(repeated_keys(rows, "vec_id"), "vec_id", "left_semi").where(usable(F.col("_e")))
    several = several.select(F.col("vec_id").alias("key"), stored(rows, "_e").alias("vector"))
    shared = saved(several.join(classes, "vector").select("key", F.col("rep").alias("node")).distinct(), "vector-ids")
    comp = components(found.where("b IS NOT NULL").select("a", "b").union(tied_by_key(shared)), "vector-components")
    placed = classes.join(comp, F.col("rep") == F.col("node"), "left").withColumn("_c", F.coalesce("component", "rep"))
    lowest = placed.groupBy("_c").agg(F.min("low").alias("_comp"))
    known = placed.join(lowest, "_c").join(links, F.col("rep") == F.col("a"), "left").select(
        "rep", F.col("vector").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("_links"), "_comp"
    )
    by_id = shared.join(known, F.col("node") == F.col("rep")).groupBy("key").agg(F.min("_comp").alias("_own"))
    able = rows.withColumn("_v", F.when(usable(F.col("_e")), stored(rows, "_e")))
    out = able.join(known, "_v", "left").join(by_id, F.col("vec_id") == F.col("key"), "left")
    comp_id = F.coalesce("_own", "_comp", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        comp_id.alias("component_id"),
        (F.col("vec_id") == comp_id).alias("kept"),
    )
