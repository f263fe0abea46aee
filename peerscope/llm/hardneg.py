"""Hard-negative mining with a multiway hyperplane tree of distance ranges (operator 13).

The score of two vectors is the inner product of their components ``floor(256 * x)``.  For each anchor
its best ``n_positives`` rows of the same label are found, and for each of those the best
``n_negatives`` rows of other labels whose score lies between 30 % and 90 % of the positive's.

Index: a tree (GNAT).  A node has up to ``WAYS`` split points and a row belongs to its nearest one.  For
each split point and for the origin, the node stores the range of distances to every sibling subtree,
taken over all rows of the subtree.  A window of scores [lo, hi] around an anchor is an annulus of
distances, |a|^2 + |x|^2 - 2 hi to |a|^2 + |x|^2 - 2 lo, with |x|^2 from the subtree's range to the
origin; a subtree is skipped when for some split point the distances that the annulus allows miss
the subtree's range.  Leaves are exact: every row of a visited leaf is scored.

The split points come from a sample of ``SAMPLE`` rows (a documented bound; the tree is a broadcast of at
most that size); all rows are routed, all ranges cover all rows, and a search visits every leaf that
can't be ruled out, so results are exact and no recall is given up.  Large leaves are cut into blocks
of about ``BLOCK_ROWS`` rows.  A search runs twice: a few near leaves first, whose k-th best scores
narrow the windows, then all others that the narrowed annuli reach.  Rows and visits of a block meet in
a sorted stream: a task holds one block and a few hundred visiting anchors at a time.

Of equal vectors with equal labels only the first ids can be among the first k of any list, so the
index keeps k + 1 of them (counted inside map tasks before the shuffle): a hot vector can't fill a leaf.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no
part; an empty vector scores 0; a shorter vector counts as padded with zeros; repeated rows (same id,
label and vector) are one row; rows that share an anchor's id are never its positives; an anchor without
positives and positives without negatives give no rows.  Components beyond 2**31 after scaling raise
an error in the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.llm.common import Shared, saved, trimming

SAMPLE = 8192
WAYS = 8
#: Sampled rows down to which a node is not split.
LEAF_SAMPLE = 24
BLOCK_ROWS = 2048
#: Anchors scored against a block at once, and the leaves that a search begins with.
QUERY_ROWS = 256
SCALE = 256.0
LOW, HIGH = 30, 90
NO_BOUND = 1 << 62
WINDOWS = "array<struct<pid:bigint,lo:bigint,hi:bigint>>"


def matrix(vectors: list[bytes], width: int | None = None) -> np.ndarray:
    """Rows of 32-bit components as float64, padded with zeros to the longest (or to ``width``)."""
    sizes = {len(v) for v in vectors}
    width = max([*(s // 4 for s in sizes), width or 0], default=0)
    if len(sizes) == 1 and sizes == {4 * width}:
        return np.frombuffer(b"".join(vectors), np.int32).reshape(len(vectors), width).astype(np.float64)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v) // 4] = np.frombuffer(v, np.int32)
    return out


def level(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices padded with zeros to one width."""
    width = max(a.shape[1], b.shape[1])
    return tuple(m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` with all rows of ``b``."""
    a, b = level(a, b)
    if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2.0**53:  # every sum is exact
        return (a @ b.T).astype(np.int64)
    whole = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return whole.astype(np.int64)  # raises beyond 64 bits


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of rows to split points and, in the last column, to the origin."""
    x, points = level(x, points)
    norm = (x * x).sum(1)
    square = norm[:, None] + (points * points).sum(1)[None, :] - 2.0 * (x @ points.T)
    return np.sqrt(np.maximum(np.concatenate([square, norm[:, None]], axis=1), 0.0))


class Node:
    def __init__(self, points: np.ndarray, children: list) -> None:
        self.points, self.children = points, children  # a child is a Node or a leaf's number
        m = len(points)
        #: lo[i, j], hi[i, j]: distances of subtree j to split point i (i = m: to the origin)
        self.lo, self.hi = np.full((m + 1, m), np.inf), np.full((m + 1, m), -np.inf)


class Tree:
    def __init__(self, sample: np.ndarray) -> None:
        self.nodes: list[Node] = []
        self.n_leaves = 0
        self.root = self._grow(np.unique(sample, axis=0) if len(sample) else sample)

    def _leaf(self) -> int:
        self.n_leaves += 1
        return self.n_leaves - 1

    def _grow(self, rows: np.ndarray):
        if len(rows) <= LEAF_SAMPLE:
            return self._leaf()
        # split points far from each other: each next one has the largest distance to those before
        chosen = [int(np.argmax(((rows - rows.mean(0)) ** 2).sum(1)))]
        gap = ((rows - rows[chosen[0]]) ** 2).sum(1)
        while len(chosen) < WAYS and gap.max() > 0:
            chosen.append(int(np.argmax(gap)))
            gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        node = Node(rows[chosen], [])
        node.number = len(self.nodes)
        self.nodes.append(node)
        own = distances(rows, node.points)[:, :-1].argmin(1)
        node.children = [self._grow(rows[own == j]) for j in range(len(chosen))]
        return node

    def walk(self, x: np.ndarray, choose, subtree=None) -> Iterator[tuple[Node | int, np.ndarray, np.ndarray | None]]:
        """(node, row numbers, distances) and (leaf, row numbers, None) of all that is reached from the root
        when ``choose(node, rows, distances)`` gives each child's rows as a boolean matrix."""
        todo = [(self.root if subtree is None else subtree, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not isinstance(node, Node):
                yield node, rows, None
                continue
            d = distances(x[rows], node.points)
            yield node, rows, d
            into = choose(node, rows, d)
            todo += [(child, rows[into[:, j]]) for j, child in enumerate(node.children)]

    @staticmethod
    def nearest(node: Node, rows: np.ndarray, d: np.ndarray) -> np.ndarray:
        return d[:, :-1].argmin(1)[:, None] == np.arange(len(node.children))[None, :]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)
        for node, rows, d in self.walk(x, self.nearest):
            if d is None:
                out[rows] = node
        return out

    def near_leaves(self, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The leaf that each row would fall into in every subtree of the root: where a search begins."""
        starts = self.root.children if isinstance(self.root, Node) else [self.root]
        return [(n, r) for s in starts for n, r, d in self.walk(x, self.nearest, s) if d is None]

    def reached(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows) of all leaves that may hold a score of ``lo`` to ``hi`` with the row."""
        norm = (x * x).sum(1)
        slack = 1e-6 * (1.0 + norm)

        def choose(node, rows, d):
            n_lo, n_hi = node.lo[-1] ** 2, node.hi[-1] ** 2  # of the children
            q, s = norm[rows][:, None], slack[rows][:, None]
            inner = q + n_lo[None, :] - 2.0 * hi[rows][:, None] - s
            outer = q + n_hi[None, :] - 2.0 * lo[rows][:, None] + s
            ok = (outer >= 0) & np.isfinite(n_lo)[None, :]  # subtrees without rows have no range
            r1, r2 = np.sqrt(np.maximum(inner, 0.0)), np.sqrt(np.maximum(outer, 0.0))
            edge = 1e-6 * (1.0 + r2)
            for i in range(d.shape[1]):  # few: split points and the origin
                at = d[:, i][:, None]
                low = np.maximum(at - r2, r1 - at) - edge
                ok &= (low <= node.hi[i][None, :]) & (at + r2 + edge >= node.lo[i][None, :])
            return ok

        return [(n, r) for n, r, d in self.walk(x, choose) if d is None]


def vector_rows(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, vec) of the rows that take part; ``vec``: floor(256 x) as 32-bit integers, packed."""

    def pack(batches):
        for batch in batches:
            lists = batch.column(2)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate(([0], np.cumsum(n)))
            x = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            ok = (bad[at[1:]] == bad[at[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False)
            whole = np.floor(SCALE * np.where(np.isfinite(x), x, 0.0))
            used = np.repeat(ok, n)
            if np.abs(whole[used]).max(initial=0) >= 2.0**31:
                raise OverflowError("a component is too large to be scaled to 32 bits")
            packed = np.where(used, whole, 0.0).astype(np.int32)
            vec = [packed[a:b].tobytes() for a, b, k in zip(at[:-1], at[1:], ok, strict=True) if k]
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(vec, pa.binary())],
                names=["id", "label", "vec"],
            )

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return rows.select("id", "label", "v").mapInArrow(trimming(pack), "id long, label long, vec binary")


def build_tree(rows: DataFrame) -> Tree:
    """A tree over a bounded sample (hash order), with ranges over all rows."""
    some = rows.orderBy(F.xxhash64("vec", "id"), "id").limit(SAMPLE).select("vec").collect()
    tree = Tree(matrix([bytes(r["vec"]) for r in some]))
    shared = Shared(rows.sparkSession, tree)

    def ranges(batches):
        held = shared.value
        for node in held.nodes:
            node.lo[:], node.hi[:] = np.inf, -np.inf
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0).to_pylist())
                for node, _, d in held.walk(x, held.nearest):
                    if d is None:
                        continue
                    own = d[:, :-1].argmin(1)
                    for j in np.unique(own):
                        mine = d[own == j]
                        node.lo[:, j] = np.minimum(node.lo[:, j], mine.min(0))
                        node.hi[:, j] = np.maximum(node.hi[:, j], mine.max(0))
        out = [
            (node.number, i, j, node.lo[i, j], node.hi[i, j])
            for node in held.nodes for j in range(node.lo.shape[1]) if np.isfinite(node.lo[0, j])
            for i in range(node.lo.shape[0])
        ]
        cols = list(zip(*out, strict=True)) or [[]] * 5
        types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["node", "i", "j", "lo", "hi"]
        )

    found = rows.select("vec").mapInArrow(trimming(ranges), "node int, i int, j int, lo double, hi double")
    # a row per node and pair of its split points: bounded by the sample, not by the rows
    for r in found.groupBy("node", "i", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
        node = tree.nodes[r["node"]]
        node.lo[r["i"], r["j"]], node.hi[r["i"], r["j"]] = r["lo"], r["hi"]
    return tree


class Index:
    """The tree (shared with tasks) and the rows by (leaf, block): ``blocks`` (leaf, n_blocks) and
    ``rows`` (leaf, block, id, label, vec)."""

    def __init__(self, rows: DataFrame, keep: int) -> None:
        spark = rows.sparkSession
        self.tree = Shared(spark, build_tree(rows))
        shared = self.tree

        @F.arrow_udf("int")
        def leaf(vec: pa.Array) -> pa.Array:
            return pa.array(shared.value.leaf_of(matrix(vec.to_pylist())), pa.int32())

        first = Window.partitionBy("vec", "label").orderBy("id")
        some = rows.select("*", F.row_number().over(first).alias("_n")).where(F.col("_n") <= keep).drop("_n")
        some = saved(some.withColumn("leaf", leaf("vec")), "negatives-leaves")
        counts = some.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("n_blocks"))
        self.blocks = saved(counts, "negatives-blocks")  # a row per leaf: bounded by the sample
        dealt = some.join(F.broadcast(self.blocks), "leaf")
        block = F.pmod(F.xxhash64("vec", "id", "label"), F.col("n_blocks")).cast("int")
        self.rows = saved(dealt.select("leaf", block.alias("block"), "id", "label", "vec"), "negatives-index")

    def visits(self, queries: DataFrame, begin: bool) -> DataFrame:
        """``queries`` (qid, id, label, vec, windows) once per block they go to: the blocks of a few near
        leaves (``begin``) or of all other leaves that a window reaches."""
        shared = self.tree

        def spread(batches):
            tree = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, QUERY_ROWS):
                    part = batch.slice(at, QUERY_ROWS)
                    x = matrix(part.column("vec").to_pylist())
                    near = tree.near_leaves(x)
                    if begin:
                        found = near
                    else:
                        spans = [[(w["lo"], w["hi"]) for w in ws] for ws in part.column("windows").to_pylist()]
                        lo = np.array([min(a for a, _ in s) for s in spans], np.float64)
                        hi = np.array([max(b for _, b in s) for s in spans], np.float64)
                        been = {}
                        for n, r in near:
                            been.setdefault(n, set()).update(r.tolist())
                        found = [(n, np.array([i for i in r.tolist() if i not in been.get(n, ())], np.int64))
                                 for n, r in tree.reached(x, lo, hi)]
                    for n, r in found:
                        if len(r):
                            out = part.take(pa.array(r))
                            yield out.append_column("leaf", pa.array(np.full(len(r), n, np.int32)))

        kind = f"qid long, id long, label long, vec binary, windows {WINDOWS}"
        rows = queries.select("qid", "id", "label", "vec", "windows").mapInArrow(trimming(spread), f"{kind}, leaf int")
        rows = rows.join(F.broadcast(self.blocks), "leaf")
        return rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")).drop("n_blocks")

    def search(self, queries: DataFrame, same: bool, k: int, begin: bool) -> DataFrame:
        """(qid, pid, id, score): each visited block's first ``k`` rows in every window of every query, of
        the query's label (``same``, without its own id) or of other labels."""

        def scan(batches):
            key, ids, labels, vecs, x = None, [], [], [], None
            for batch in batches:
                cols = batch.to_pydict()
                queue: list[int] = []
                for i, where in enumerate(zip(cols["leaf"], cols["block"], strict=True)):
                    if where != key:
                        if queue:
                            yield from answers(cols, queue, ids, labels, x)
                        key, ids, labels, vecs, x, queue = where, [], [], [], None, []
                    if cols["qid"][i] is None:
                        ids.append(cols["id"][i])
                        labels.append(cols["label"][i])
                        vecs.append(cols["vec"][i])
                    elif len(ids):
                        if x is None:
                            x, vecs = matrix(vecs), []
                            ids, labels = np.array(ids, np.int64), np.array(labels, np.int64)
                        queue.append(i)
                        if len(queue) >= QUERY_ROWS:
                            yield from answers(cols, queue, ids, labels, x)
                            queue = []
                if queue:
                    yield from answers(cols, queue, ids, labels, x)

        def answers(cols, queue, ids, labels, x):
            s = scores(matrix([cols["vec"][i] for i in queue]), x)
            out = []
            for i, row in zip(queue, s, strict=True):
                if same:
                    allowed = (labels == cols["label"][i]) & (ids != cols["id"][i])
                else:
                    allowed = labels != cols["label"][i]
                for w in cols["windows"][i]:
                    hit = np.flatnonzero(allowed & (row >= w["lo"]) & (row <= w["hi"]))
                    if len(hit) > k:
                        hit = hit[np.lexsort((ids[hit], -row[hit]))[:k]]
                    out += [(cols["qid"][i], w["pid"], int(ids[h]), int(row[h])) for h in hit]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["qid", "pid", "id", "score"]
                )

        visits = self.visits(queries, begin)
        none = [F.lit(None).cast("long").alias("qid"), F.lit(None).cast(WINDOWS).alias("windows")]
        names = ["leaf", "block", "qid", "id", "label", "vec", "windows"]
        both = self.rows.select("*", *none).select(*names).unionByName(visits.select(*names))
        ordered = both.repartition("leaf", "block").sortWithinPartitions("leaf", "block", F.col("qid").asc_nulls_first())
        return ordered.mapInArrow(trimming(scan), "qid long, pid long, id long, score long")


def first_k(found: DataFrame, k: int) -> DataFrame:
    """(qid, pid, id, score, rank): the first ``k`` of every list."""
    best = Window.partitionBy("qid", "pid").orderBy(F.col("score").desc(), "id")
    return found.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k)


def top_in_windows(index: Index, queries: DataFrame, same: bool, k: int, name: str) -> DataFrame:
    """The first ``k`` rows of every window of every query: two searches (see the module's text)."""
    seeds = saved(first_k(index.search(queries, same, k, True), k).drop("rank"), f"{name}-seeds")
    full = seeds.groupBy("qid", "pid").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k)
    w = queries.select("qid", "id", "label", "vec", F.explode("windows").alias("w")).select("qid", "id", "label", "vec", "w.*")
    w = w.join(full.select("qid", "pid", "kth"), ["qid", "pid"], "left")
    window = F.struct("pid", F.coalesce("kth", "lo").alias("lo"), "hi")  # an equal score may still win by its id
    left = w.groupBy("qid").agg(
        F.first("id").alias("id"), F.first("label").alias("label"), F.first("vec").alias("vec"),
        F.collect_list(window).alias("windows"),  # at most one per positive
    )
    return first_k(seeds.unionByName(index.search(saved(left, f"{name}-left"), same, k, False)), k)


def hard_negatives(
    df: DataFrame, anchors: str, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    n_positives: int = 5, n_negatives: int = 10,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchors`` is a condition
    on the key, written with the name ``id``."""
    rows = saved(vector_rows(df, key, vector, label).distinct(), "negatives-rows")
    index = Index(rows, max(n_positives, n_negatives) + 1)
    everything = F.array(F.struct(F.lit(-1).cast("long").alias("pid"), F.lit(-NO_BOUND).alias("lo"), F.lit(NO_BOUND).alias("hi")))
    asked = rows.where(anchors).withColumn("qid", F.monotonically_increasing_id()).withColumn("windows", everything)
    queries = saved(asked.select("qid", "id", "label", "vec", "windows"), "negatives-anchors")
    found = top_in_windows(index, queries, True, n_positives, "positives")
    # positives of one anchor are told apart by their rank: an id may belong to several rows
    positives = saved(
        found.select("qid", F.col("rank").cast("long").alias("pid"), F.col("id").alias("positive_id"),
                     F.col("score").alias("positive_score")), "negatives-positives")
    # whole numbers: LOW * p <= 100 * n <= HIGH * p, in steps of 100 so that nothing overflows
    rest = F.pmod(F.col("positive_score"), F.lit(100))
    hundreds = F.expr("(positive_score - pmod(positive_score, 100)) div 100")
    lo = LOW * hundreds + F.ceil(LOW * rest / 100).cast("long")
    hi = HIGH * hundreds + F.floor(HIGH * rest / 100).cast("long")
    spans = positives.select("qid", F.struct("pid", lo.alias("lo"), hi.alias("hi")).alias("w")).where("w.lo <= w.hi")
    spans = spans.groupBy("qid").agg(F.collect_list("w").alias("windows"))
    again = saved(queries.drop("windows").join(spans, "qid"), "negatives-windows")
    negatives = top_in_windows(index, again, False, n_negatives, "negatives")
    out = negatives.join(positives, ["qid", "pid"]).join(queries.select("qid", F.col("id").alias("anchor_id")), "qid")
    return out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
