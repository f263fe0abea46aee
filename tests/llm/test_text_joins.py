"""Operators 3 (decontamination), 7 (Jaccard join) and 8 (repeated bytes) against plain versions."""
import random

import numpy as np
import pytest

from peerscope.llm import decontaminate, jaccard, repeats
from tests.llm import brute

VOCAB = ["alpha", "beta", "gamma", "Delta", "épsilon", "zeta1", "eta", "theta"]


def corpus(seed, n=60):
    """Texts with exact and near copies, shared passages, nulls, empty and short ones."""
    rng = random.Random(seed)
    base = [" ".join(rng.choice(VOCAB) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 90))) for _ in range(n // 3)]
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one two"), (4, "One TWO"), (5, "x" * 350)]
    for i in range(6, n):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = "edit" + str(rng.randrange(1000))
        if rng.random() < 0.3:
            w.insert(rng.randrange(len(w) + 1), passage)
        rows.append((i, " ".join(w)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, i, "c") for i, t in rows], "doc_id long, text string, n long, cls string").repartition(3)


@pytest.mark.parametrize("limits", [(2048, 2_000_000, 24), (3, 2_000_000, 24), (3, 2_000_000, 1), (2048, 20, 1)])
@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, monkeypatch, seed, limits):
    monkeypatch.setattr(jaccard, "GROUP_SETS", limits[0])
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", limits[1])
    monkeypatch.setattr(jaccard, "GROUP_PARTS", limits[2])
    rows = corpus(seed)
    got = jaccard.jaccard_join(frame(spark, rows))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute.jaccard(rows)


def test_jaccard_degenerate(spark):
    df = frame(spark, [(1, "a b c d e f")])
    assert jaccard.jaccard_join(df.where("doc_id = 9")).count() == 0
    assert [tuple(r) for r in jaccard.jaccard_join(df).collect()] == [(1, 2, 1)]
    nulls = frame(spark, [(1, None), (2, "")])
    assert sorted(tuple(r) for r in jaccard.jaccard_join(nulls).collect()) == [(1, 0, 1), (2, 0, 2)]
    twice = frame(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f")])
    assert sorted(tuple(r) for r in jaccard.jaccard_join(twice).collect()) == [(3, 2, 3), (5, 2, 3), (5, 2, 3)]


def test_divide_skip_finds_every_link():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(30):
        base = rng.integers(0, 2**63, 60).astype(np.uint64)
        sets = []
        for _ in range(40):
            s = np.where(rng.random(60) < rng.choice([0.02, 0.1, 0.2]), rng.integers(0, 2**63, 60).astype(np.uint64), base)
            sets.append(np.unique(s[: rng.integers(1, 60)]))
        ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
        root = jaccard.linked(np.concatenate(sets), ends, np.arange(40), np.arange(40))
        links = [(a, b) for a in range(40) for b in range(a)
                 if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
        want = brute.roots(range(40), links)
        assert {a: set(np.flatnonzero(root == root[a])) for a in range(40)} == {
            a: {b for b in range(40) if want[b] == want[a]} for a in range(40)
        }


@pytest.mark.parametrize("hot,chunk,block", [(2000, 1 << 20, 1 << 19), (1, 1 << 20, 1 << 19), (2000, 200, 400)])
def test_repeats(spark, monkeypatch, hot, chunk, block):
    monkeypatch.setattr(repeats, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    rows = [(i, t if i % 7 else (t or "") + "né" * 90) for i, t in corpus(5)]
    rows += [(100, "ab" * 900), (101, "z" * 99), (102, "q" * 100), (103, "q" * 100), (-4, "ab" * 60)]
    got = repeats.remove_repeats(frame(spark, rows))
    cols = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]
    assert sorted((*r[:4], bytes(r[4])) for r in got.select(*cols).collect()) == brute.repeats(rows)


def test_repeats_degenerate(spark):
    df = frame(spark, [(1, None), (2, ""), (3, "short")])
    assert repeats.remove_repeats(df.where("doc_id = 9")).count() == 0
    assert {r["n_removed"] for r in repeats.remove_repeats(df).collect()} == {0}
    twice = frame(spark, [(1, "w" + "y" * 120), (1, "w" + "y" * 120), (2, "é" * 60 + "y" * 110)])
    got = sorted(tuple(r)[:1] + tuple(r)[2:5] for r in repeats.remove_repeats(twice).collect())
    assert got == [(1, 121, 119, 1), (1, 121, 119, 1), (2, 230, 228, 1)]
    cut = repeats.shortened(twice)
    assert cut.columns == twice.columns
    assert sorted(r["text"] for r in cut.collect()) == ["wy", "wy", "é"]


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 700)
    rows = corpus(8)
    items = [(1, rows[10][1]), (2, "ONE two"), (3, None), (4, "..."), (5, " ".join(f"shared{i}" for i in range(5, 30))),
             (5, "gamma7"), (None, "one"), (60, rows[20][1]), (7, "one two")]
    df = frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(decontaminate.build_index(df), bench)
    cols = ["key", "n_words", "n_hit", "items", "contaminated"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == brute.contamination(rows, items)
    assert decontaminate.contamination(decontaminate.build_index(df.where("n = -1")), bench).count() == 0
    none = decontaminate.contamination(decontaminate.build_index(df), bench.where("item_id = -1"))
    assert {r["n_hit"] for r in none.collect()} == {0}
    kept = decontaminate.clean_documents(df, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute.contamination(rows, items) if not r[4])


def test_phrases_of_items():
    first, length, item = decontaminate.phrases_of(np.array([3, 0, 2, 5]), 3)
    assert list(zip(first.tolist(), length.tolist(), item.tolist(), strict=True)) == [
        (0, 3, 0), (3, 2, 2), (5, 3, 3), (6, 3, 3), (7, 3, 3)]
    first, length, item = decontaminate.phrases_of(np.array([3, 0, 2]), None)
    assert (first.tolist(), length.tolist(), item.tolist()) == ([0, 3], [3, 2], [0, 2])
    assert [len(x) for x in decontaminate.phrases_of(np.array([], np.int64), 3)] == [0, 0, 0]


def test_blocks_of_items_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    items = spark.range(400).selectExpr("id AS item_id", "concat_ws(' ', 'w', id, repeat('v ', 20)) AS text")
    blocks = decontaminate.item_blocks(items, "item_id", "text").collect()
    assert len(blocks) > 5 and max(len(b["terms"]) // 8 for b in blocks) <= 3000
    assert sorted(int(i) for b in blocks for i in b["items"]) == list(range(400))
    assert len({b["block"] for b in blocks}) == len(blocks)


def test_proximity(spark):
    rows = [(1, "a x b c"), (2, "a b x x x c"), (3, "c b a"), (4, "a b"), (5, "a b c a q b q c")]
    index = decontaminate.build_index(frame(spark, rows))
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    exact = decontaminate.search(index, items, window=None)
    assert {r["key"]: r["hits"] for r in exact.collect()} == {5: [0, 1, 2]}
    near = decontaminate.search(index, items, window=None, slop=1)
    assert {r["key"]: r["hits"] for r in near.collect()} == {1: [0, 1, 2, 3], 5: [0, 1, 2]}
    wide = decontaminate.search(index, items, window=None, slop=3)
    assert {r["key"]: r["hits"] for r in wide.collect()} == {1: [0, 1, 2, 3], 2: [0, 1, 2, 3, 4, 5], 5: list(range(8))}
