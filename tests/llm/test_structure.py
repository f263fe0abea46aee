"""Structure repair against a uniform-cost search over whole edit strings."""
import hashlib
import heapq
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from peerscope.llm import structure
from peerscope.llm.queries import QUERIES
from tests.conftest import SMALL

FINAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, letters, initials) by Dijkstra over (cost, letters): ties come out in ASCII order.  States are
    the initials so far, cut to what a later row can still see."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, letters, at, made = heapq.heappop(heap)
        if at == len(rows) and FINAL.fullmatch(made):
            return cost, letters
        key = (at, made if len(made) < 3 else made[:1] + made[-2:] + str(len(made) % 2))
        if (key, letters) in done or len(letters) > 2 * len(rows) + 3:
            continue
        done.add((key, letters))

        def push(extra, letter, to, initials, cost=cost, letters=letters):
            if re.fullmatch(r"s?(ua)*u?", initials):
                heapq.heappush(heap, (cost + extra, letters + letter, to, initials))

        for c in "ua":
            push(2, "I", at, made + c)
        if at < len(rows):
            initial, fault = rows[at]
            push(3, "D", at + 1, made)
            if fault not in ("blank", "duplicate"):
                extra = 1 if fault else 0
                if initial:
                    push(extra, "K", at + 1, made + initial)
                for c in "ua":
                    push(2 + extra, "R", at + 1, made + c)
    raise AssertionError


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u", "a", "s", "x", ""]), st.sampled_from([None, None, "truncated", "blank", "duplicate"])), max_size=6),
       st.integers(1, 4))
def test_search_is_cheapest_and_first_in_ascii_order(rows, block):
    assert structure.cheapest_edits(rows, block) == cheapest(rows)


def test_blocks_do_not_change_long_answers():
    rows = [("uaaus"[i * i % 5], (None, "truncated", None, "blank")[i % 4]) for i in range(600)]
    assert structure.cheapest_edits(rows, 32) == structure.cheapest_edits(rows, 50) == structure.cheapest_edits(rows, 17)
    clean = [("ua"[i % 2], None) for i in range(20_000)]
    assert structure.cheapest_edits(clean) == (0, "K" * 20_000)


def plain(rows):
    """The report of one conversation's rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults = set(), []
    for _, role, text in rows:
        cut = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not cut else "duplicate" if (role, text) in seen else None if cut[-1] in ".!?" else "truncated")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, letters = cheapest(list(zip(initials, faults, strict=True)))
    kept, left, last = [], list(rows), ""
    for c in letters:
        role, text = ("assistant" if last == "u" else "user"), ""
        if c != "I":
            _, was, text = left.pop(0)
            if c == "D":
                continue
            role = was if c == "K" else role
        kept.append(f"{role}:{text}")
        last = role[:1]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in structure.FAULTS), illegal,
            cost, letters, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def test_report_with_nulls_ties_repeats_and_clashing_names(spark):
    rows = [
        (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi there!"), (1, 3, "assistant", "No stop"),
        (2, None, "system", "Be good."), (2, 0, "assistant", "First."), (2, 0, "assistant", "First."), (2, 5, "user", None),
        (None, None, None, None), (None, 2, "user", " \t\n"), (None, 2, "", "x."), (3, None, "user", "a.\n"), (3, None, "Assistant", "b"),
    ]
    df = spark.createDataFrame([(*r, 9, "z", "K") for r in rows], "conv_id long, turn long, role string, text string, ord int, fault string, seq string")
    names = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,), (4,)], "conv_id long")
    got = {r[0]: tuple(r)[1:] for r in structure.repair_report(df, names).collect()}
    want = {c: plain([r[1:] for r in rows if r[0] == c]) for c in (1, 2, 3, None)}
    want[4] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want
    assert structure.repair_report(df.where("conv_id = 77")).count() == 0


def test_a_long_conversation_with_long_texts(spark):
    df = spark.range(3000).selectExpr(
        "7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat(repeat('long text ', 50), id, '.') AS text")
    row = structure.repair_report(df.where("turn % 100 <> 50")).first()
    assert (row["gaps"], row["illegal"], row["cost"]) == (30, 30, 60) and row["audit"].count("I") == 30


def test_repaired_rows_are_well_formed(spark):
    rows = structure.damaged(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    faulted = structure.with_faults(rows).cache()
    left = structure.repaired_rows(faulted, structure.edit_plan(faulted)).where("role IS NOT NULL")
    for _, group in left.toPandas().groupby("conv_id"):
        assert FINAL.fullmatch("".join(group.sort_values("seq")["role"].str[:1]))


def test_damage_matches_checksums(spark):
    import zlib

    df = spark.createDataFrame([(i, t, "assistant", "a. b! c?") for i in range(20) for t in range(5)], "conv_id long, turn long, role string, text string")
    want = []
    for i in range(20):
        for t in range(5):
            k = zlib.crc32(f"{i}:{t}".encode()) % 20
            if k:
                row = (i, t, "user" if k == 4 else "assistant", {1: "", 2: "a b c"}.get(k, "a. b! c?"))
                want += [row] * (2 if k == 3 else 1)
    assert sorted(map(tuple, structure.damaged(df).collect())) == sorted(want)


def test_query_reports_every_conversation(spark):
    n = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
    assert QUERIES["op12_structure_repair"](spark, SMALL).count() == n
