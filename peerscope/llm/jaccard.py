"""N-gram Jaccard join by T-occurrence search (operator 7).

A document is the set of its distinct word shingles (64-bit hashes).  Two sets of sizes n and m link
at Jaccard >= t when they share at least T = ceil(t (n + m) / (1 + t)) shingles.  DivideSkip splits the
inverted lists of a query into L long ones and the short rest: whoever reaches T overall occurs at
least T - L times in the short lists.

Over the cluster, the split is by frequency: a fixed-size sketch counts all shingles of all documents,
and only a set's n - ceil(t n) + 1 rarest shingles enter the distributed lists (the long lists, one
fewer than the least T, are left to the probe).  Within a list, pairs whose sizes or parity bitmaps
rule a link out are passed over (a bitmap has one bit per bucket of shingles; two sets differ in at
least as many shingles as their bitmaps do in bits), and the list sends a spanning forest of the rest.
The components of these forests are candidate groups that no link can leave.  Groups are then joined
exactly, each in a task: short lists are merged, long ones probed by binary search, and only pairs
that are not connected yet are looked for.  A group or list of more than ``GROUP_SETS`` sets or
``GROUP_SHINGLES`` shingles is cut into parts that meet pairwise, and a group of more than
``GROUP_PARTS`` parts is taken apart into its lists; nothing is capped.

Equal sets are one class from the start, so exact copies cost one posting each task.  Classes are known
by a 64-bit hash of the set and hashes of shingles are taken as the shingles themselves.

Defined results: null, empty and wordless texts have the empty set, link with nothing and are their own
component; a text of fewer words than a shingle has one shingle; the rows of a repeated id are in one
component (one row out for each row in).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import (
    Rolling, Shared, column_arrays, components, find_roots, mixed, ranges_concat, repeated_keys, row_chunks, saved,
    sorted_groups, split_parts, tied_by_key, trimming, word_bounds,
)

WORDS = 5
#: Jaccard threshold as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
SKETCH_BITS, SLICE_BITS = 20, 12
#: A candidate group is joined in one task up to this size.
GROUP_SETS, GROUP_SHINGLES, GROUP_PARTS = 2048, 2_000_000, 24
#: Postings of one list that a task holds at once.
LIST_ROWS = 1_000_000
#: DivideSkip's weight of the longest list's logarithm when it chooses the number of long lists.
MU = 0.25


def word_table() -> np.ndarray:
    """Lower-casing and word bytes: everything but blank and 09-0D."""
    t = np.ones(256, bool)
    t[0x20] = False
    t[0x09:0x0E] = False
    return t


class Shingler:
    """Shingle sets of blocks of texts; one per task."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.rolling, self.is_word = words, Rolling(), word_table()
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shingles, ends): row i has the sorted distinct shingles[ends[i]:ends[i + 1]]."""
        low = self.fold[data]
        starts, ends = word_bounds(self.is_word[low], offsets)
        h = self.rolling.ranges(self.rolling.prefix(low), starts, ends)
        at = np.searchsorted(starts, offsets)
        counts, k = np.diff(at), self.words
        with np.errstate(over="ignore"):
            total = np.zeros(max(0, len(h) - k + 1), np.uint64)
            for j in range(k):
                total += mixed(h[j : j + len(total)] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        full = mixed(total)
        n = np.where(counts >= k, counts - k + 1, counts > 0).astype(np.int64)
        bounds = np.concatenate(([0], np.cumsum(n)))
        out = np.empty(bounds[-1], np.uint64)
        for i in np.flatnonzero(n):
            a, b = bounds[i], bounds[i + 1]
            if counts[i] >= k:
                out[a:b] = full[at[i] : at[i] + n[i]]
                out[a:b].sort()
            else:  # the whole sequence is the only shingle
                value = np.uint64(counts[i])
                with np.errstate(over="ignore"):
                    for w in h[at[i] : at[i + 1]]:
                        value = mixed(np.array([value * np.uint64(0x9E3779B97F4A7C15) + w]))[0]
                out[a] = value
        if not len(out):
            return out, bounds
        keep = np.ones(len(out), bool)
        keep[1:] = out[1:] != out[:-1]
        keep[bounds[:-1][n > 0]] = True
        return out[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]


def class_ids(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's set (rows with an empty set: 0)."""
    n = np.diff(ends)
    out = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mixed(shingles * np.uint64(0xBF58476D1CE4E5B9)), ends[:-1][some])
            out[some] = mixed(sums + n[some].astype(np.uint64))
    return out.view(np.int64)


def least_overlap(n, m):
    """Shared shingles from which sets of sizes n and m reach the threshold."""
    return -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))


def parity_bitmaps(shingles: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """Per row, a bit per bucket: whether an odd number of its shingles fall into it.  The number of
    buckets is the power of two from the set's size on, 64 at least."""
    out = []
    for a, b in zip(ends, ends[1:], strict=False):
        if a == b:
            out.append(None)
            continue
        width = max(64, 1 << int(b - a - 1).bit_length())
        odd = np.bincount((shingles[a:b] >> np.uint64(8)).astype(np.int64) & (width - 1), minlength=width) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def possible_pairs(n: np.ndarray, bitmaps: list[bytes], left: np.ndarray, right: np.ndarray):
    """(i, j) of left and right rows whose sizes and bitmaps do not rule out a link."""
    width = np.array([len(b) for b in bitmaps])
    out_i, out_j = [], []

    def folded(rows, to):
        m = np.frombuffer(b"".join(bitmaps[r] for r in rows), np.uint64).reshape(len(rows), -1)
        return m if m.shape[1] * 8 == to else m[:, : to // 8] ^ m[:, to // 8 :]

    for w in np.unique(width):
        for mine, others in ((left, right), (right, left)):
            a = mine[width[mine] == w]
            b = others[(width[others] == 2 * w) | ((width[others] == w) & (mine is left))]
            if not len(a) or not len(b):
                continue
            x = folded(a, w)
            y = np.empty((len(b), w // 8), np.uint64)
            for at in (width[b] == w, width[b] != w):
                if at.any():
                    y[at] = folded(b[at], w)
            step = max(1, (1 << 21) // y.size)
            for lo in range(0, len(a), step):
                i = a[lo : lo + step]
                apart = np.bitwise_count(x[lo : lo + step, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                total = n[i][:, None] + n[b][None, :]
                need = least_overlap(total, 0)
                ok = (apart <= total - 2 * need) & (need <= np.minimum(n[i][:, None], n[b][None, :]))
                p, q = np.nonzero(ok)
                out_i.append(i[p])
                out_j.append(b[q])
    if not out_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def described(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """One row per document (key, n, cls, bitmap), and each task's part of the frequency sketch (slice,
    counts); a set's bitmap comes once per task."""

    def describe(batches):
        make, sketch, seen = Shingler(words), np.zeros(1 << SKETCH_BITS, np.int64), set()
        for batch in batches:
            data, offsets = column_arrays(batch, "text")
            keys = batch.column("key")
            for a, b in row_chunks(offsets):
                s, ends = make.sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sketch += np.bincount((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                none, cls = pa.nulls(b - a), class_ids(s, ends)
                bitmaps = parity_bitmaps(s, ends)
                for i, c in enumerate(cls.tolist()):
                    if c in seen:
                        bitmaps[i] = None
                    seen.add(c)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), pa.array(np.diff(ends)), pa.array(cls), pa.array(bitmaps, pa.binary()),
                     none.cast(pa.int32()), none.cast(pa.binary())],
                    names=["key", "n", "cls", "bitmap", "slice", "counts"],
                )
        parts = [p.astype("<i8") for p in np.split(sketch, 1 << (SKETCH_BITS - SLICE_BITS))]
        used = [i for i, p in enumerate(parts) if p.any()]
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
             pa.array(used, pa.int32()), pa.array([parts[i].astype("<i4").tobytes() for i in used], pa.binary())],
            names=["key", "n", "cls", "bitmap", "slice", "counts"],
        )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(trimming(describe), "key long, n long, cls long, bitmap binary, slice int, counts binary")


def sketch_of(rows: DataFrame) -> np.ndarray:
    """The summed sketch: 2**SKETCH_BITS counts whatever the size of the corpus."""

    def add(batches):
        for (number,), group in sorted_groups(batches, ["slice"]):
            total = sum(np.frombuffer(c, "<i4").astype(np.int64) for c in group.column("counts").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["slice", "counts"]
            )

    parts = rows.where("slice IS NOT NULL").select("slice", "counts").repartition("slice").sortWithinPartitions("slice")
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in parts.mapInArrow(trimming(add), "slice int, counts binary").toLocalIterator():
        out[r["slice"] << SLICE_BITS : (r["slice"] + 1) << SLICE_BITS] = np.frombuffer(r["counts"], "<i8")
    return out


def frequent(sketch: np.ndarray) -> np.ndarray:
    """The sketch with counts that chance explains set to 0, so that only frequent shingles stand out."""
    mean = sketch.mean()
    return np.where(sketch > mean + 8 * math.sqrt(mean) + 4, sketch, 0)


def postings(docs: DataFrame, text: str, words: int, rare) -> DataFrame:
    """(shingle, cls): the rarest n - ceil(t n) + 1 shingles of each set; copies in a task once."""

    def emit(batches):
        make, order, seen = Shingler(words), rare.value, set()
        for batch in batches:
            data, offsets = column_arrays(batch, "text")
            for a, b in row_chunks(offsets):
                s, ends = make.sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                cls, n = class_ids(s, ends), np.diff(ends)
                weight = order[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                out, rows = [], []
                for i in np.flatnonzero(n):
                    if int(cls[i]) in seen:
                        continue
                    seen.add(int(cls[i]))
                    lo, hi = ends[i], ends[i + 1]
                    short = n[i] - -(-NUMERATOR * n[i] // DENOMINATOR) + 1
                    w = weight[lo:hi]
                    out.append(s[lo : lo + short] if not w.any() else s[lo:hi][np.argsort(w, kind="stable")[:short]])
                    rows.append(i)
                if rows:
                    k = [len(x) for x in out]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(cls[rows], k))], names=["shingle", "cls"]
                    )

    return docs.select(F.col(text).alias("text")).mapInArrow(trimming(emit), "shingle long, cls long")


def short_lists(rows: DataFrame) -> DataFrame:
    """(list, cls): the members of each list of two classes or more.  Lists with the same members are
    one: a list is known by a hash of its members."""

    def members(s, c, whole):
        start = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        size = np.diff(np.append(start, len(s)))
        again = np.zeros(len(s), bool)
        again[1:] = (s[1:] == s[:-1]) & (c[1:] == c[:-1])
        shared = np.repeat(np.logical_or.reduceat(np.repeat(c[start], size) != c, start), size)
        own = mixed(s[start].view(np.uint64))
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(np.where(again, np.uint64(0), mixed(c.view(np.uint64))), start)
        number = np.repeat(np.where(whole(s[start]), mixed(sums), own).view(np.int64), size)
        keep = shared & ~again
        return pa.RecordBatch.from_arrays([pa.array(number[keep]), pa.array(c[keep])], names=["list", "cls"])

    def merge(batches):
        held, parted = [np.empty(0, np.int64)] * 2, None  # parted: a list of which a part has been handed on

        def whole(x):
            return x != parted if parted is not None else np.ones(len(x), bool)

        for batch in batches:
            s, c = (np.concatenate((h, np.asarray(x))) for h, x in zip(held, batch.columns, strict=True))
            if not len(s):
                continue
            cut = int(np.searchsorted(s, s[-1]))  # the last list may go on in the next batch
            if cut:
                yield members(s[:cut], c[:cut], whole)
            held = [s[cut:], c[cut:]]
            if len(held[0]) > LIST_ROWS:  # hand on what there is; the first member stays
                parted = held[0][0]
                yield members(*held, whole)
                held = [h[:1] for h in held]
        if len(held[0]):
            yield members(*held, whole)

    ordered = rows.select("shingle", "cls").repartition("shingle").sortWithinPartitions("shingle", "cls")
    return ordered.mapInArrow(trimming(merge), "list long, cls long").distinct()


def list_forests(rows: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of the pairs that may link, inside each list of ``rows``
    (list, u, v, part, cls, n, bitmap)."""
    keys = ["list", "u", "v"]

    def meet(batches):
        for (_, u, v), group in sorted_groups(batches, keys):
            if group.num_rows < 2:
                continue
            cls, n, part = (np.asarray(group.column(c)) for c in ("cls", "n", "part"))
            i, j = possible_pairs(n, group.column("bitmap").to_pylist(), np.flatnonzero(part == u), np.flatnonzero(part == v))
            root = find_roots(len(cls), i, j)
            tied = np.flatnonzero(root != np.arange(len(cls)))
            yield pa.RecordBatch.from_arrays([pa.array(cls[tied]), pa.array(cls[root[tied]])], names=["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimming(meet), "a long, b long").distinct()


def linked(shingles: np.ndarray, ends: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest connected row of each row, over the links between the rows ``left`` and ``right``.

    DivideSkip: each left row is a query against the inverted lists of the right rows."""
    sizes, count = np.diff(ends), len(ends) - 1
    root = np.arange(count)
    rows = np.repeat(right, sizes[right])
    values = shingles[ranges_of(ends, right)]
    order = np.lexsort((rows, values))
    rows, values = rows[order], values[order]
    terms, first = np.unique(values, return_index=True)
    bounds = np.append(first, len(values))
    keys = np.repeat(np.arange(len(terms)), np.diff(bounds)) * count + rows  # sorted: for binary probes
    for q in left[np.argsort(sizes[left], kind="stable")]:
        if (root[right] == root[q]).all():
            continue
        mine = shingles[ends[q] : ends[q + 1]]
        at = np.minimum(np.searchsorted(terms, mine), len(terms) - 1)
        lists = at[terms[at] == mine]
        least = -(-NUMERATOR * sizes[q] // DENOMINATOR)
        if len(lists) < least:
            continue
        length = bounds[lists + 1] - bounds[lists]
        n_long = min(int(least / (MU * math.log2(length.max() + 1) + 1)), int(least) - 1)
        by_length = np.argsort(length, kind="stable")
        short, long = lists[by_length[: len(lists) - n_long]], lists[by_length[len(lists) - n_long :]]
        seen = np.bincount(rows[ranges_concat(bounds[short], bounds[short + 1])], minlength=count)
        need = least_overlap(sizes[q], sizes)
        some = np.flatnonzero((seen >= np.maximum(need - n_long, 1)) & (root != root[q]))
        if not len(some):
            continue
        if len(long):
            probe = (long[:, None] * count + some[None, :]).ravel()
            hit = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            seen[some] += (keys[hit] == probe).reshape(len(long), len(some)).sum(axis=0)
        found = some[seen[some] >= need[some]]
        if len(found):
            tied = np.unique(np.append(root[found], root[q]))
            root[np.isin(root, tied)] = tied[0]
    return root


def ranges_of(ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return ranges_concat(ends[rows], ends[rows + 1])


def group_links(routed: DataFrame, words: int) -> DataFrame:
    """(a, b): a spanning forest of the links inside each group of ``routed`` (keys, part, text)."""
    keys = ["kind", "grp", "u", "v"]

    def join(batches):
        make = Shingler(words)
        for (_, _, u, v), group in sorted_groups(batches, keys):
            if group.num_rows < 2:
                continue
            part = np.asarray(group.column("part"))
            texts = pa.RecordBatch.from_arrays([group.column("text").combine_chunks()], names=["text"])
            data, offsets = column_arrays(texts, "text")
            s, ends = make.sets(data, offsets)
            cls, n = class_ids(s, ends), np.diff(ends)
            # a class once; a repeated id may have brought another text along
            _, once = np.unique(cls, return_index=True)
            once = once[n[once] > 0]
            left = once[part[once] == u]
            right = once[part[once] == v]
            if not len(left) or not len(right) or len(once) < 2:
                continue
            root = linked(s, ends, left, right)
            tied = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(cls[tied]), pa.array(cls[root[tied]])], names=["a", "b"])

    return routed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimming(join), "a long, b long")


def class_components(docs: DataFrame, key: str, text: str, words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with key, n, cls; table cls -> component id, for classes that link; keys of several rows
    with their component)."""
    facts = saved(described(docs, key, text, words), "shingle-sets")
    rows = facts.where("slice IS NULL").select("key", "n", "cls")
    rare = Shared(docs.sparkSession, frequent(sketch_of(facts)))
    lists = saved(short_lists(postings(docs, text, words, rare)), "short-lists")

    def part_count(sets, shingles):
        return F.ceil(F.greatest(sets / GROUP_SETS, shingles / GROUP_SHINGLES)).cast("int")

    # bitmaps of the classes that have company; a class may have come from several tasks
    listed = lists.select("cls").distinct()
    bitmaps = facts.where("bitmap IS NOT NULL").select("cls", "n", "bitmap").join(listed, "cls").groupBy("cls", "n").agg(
        F.min("bitmap").alias("bitmap")
    )
    large = lists.groupBy("list").agg(F.ceil(F.count("*") / GROUP_SETS).cast("int").alias("_b")).where("_b > 1")
    may = list_forests(split_parts(lists.join(bitmaps, "cls"), ["list"], large, "cls"))
    groups = components(may, "candidates")
    reps = rows.where("n > 0").groupBy("cls").agg(F.min("key").alias("rep"), F.max("n").alias("n"))
    members = saved(
        groups.select(F.col("node").alias("cls"), F.col("component").alias("grp")).join(reps, "cls"), "candidate-groups"
    )
    sizes = members.groupBy("grp").agg(part_count(F.count("*"), F.sum("n")).alias("_b"))
    huge = sizes.where(F.col("_b") > GROUP_PARTS).select("grp")
    whole = split_parts(members.join(huge, "grp", "left_anti"), ["grp"], sizes.where(F.col("_b").between(2, GROUP_PARTS)), "cls")
    apart = lists.join(members.join(huge, "grp", "left_semi"), "cls").select(F.col("list").alias("grp"), "cls", "rep", "n")
    load = apart.groupBy("grp").agg(part_count(F.count("*"), F.sum("n")).alias("_b")).where("_b > 1")
    parts = split_parts(apart, ["grp"], load, "cls")
    columns = ["grp", "u", "v", "part", "rep"]
    routes = whole.select(F.lit(0).alias("kind"), *columns).union(parts.select(F.lit(1).alias("kind"), *columns))
    texts = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
    edges = group_links(texts.join(routes, "rep"), words)
    # an id that several sets have belongs to one component
    shared = rows.where("n > 0").join(repeated_keys(rows, "key"), "key", "left_semi").select("key", F.col("cls").alias("node"))
    shared = saved(shared.distinct(), "jaccard-ids")
    comp = components(edges.union(tied_by_key(shared)), "jaccard-links")
    known = comp.join(reps, F.col("node") == F.col("cls")).select("cls", "component", "rep")
    lowest = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = known.join(lowest, "component").select("cls", "component_id").unionByName(
        reps.join(known.select("cls"), "cls", "left_anti").select("cls", F.col("rep").alias("component_id"))
    )
    by_id = shared.join(found, F.col("node") == F.col("cls")).groupBy("key").agg(F.min("component_id").alias("_own"))
    return rows, found, by_id


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: key (as doc_id), n_shingles, component_id."""
    rows, comp, by_id = class_components(docs, key, text, words)
    out = rows.join(comp, "cls", "left").join(by_id, "key", "left")
    linked_id = F.when(F.col("n") > 0, F.col("component_id"))
    return out.select(
        F.col("key").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("_own", linked_id, "key").alias("component_id"),
    )
