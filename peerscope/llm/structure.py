"""Conversation structure repair by iterative-deepening A* (operator 12).

A conversation is well formed when its roles' initials match ``(s?(ua)+)?``.  ``with_faults`` orders the
rows of each conversation and marks each row's first fault; ``edit_plan`` finds the cheapest edits:

    Keep 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty user or assistant turn) 2;
    blank and duplicate rows must be deleted; a truncated row that stays costs 1 more.

Among the cheapest, the edits whose initials come first in ASCII order are chosen.  The role of an
insert or a rerole follows from the state before it, so the initials determine the result.

The search is depth first in ASCII order under a cost bound that grows to the least cost any pruned
path asked for; a transposition table keeps, for each failed (row, state), the least further cost it is
known to need, so no state is entered twice with a budget that can't do.  The first accepting path under
the first sufficient bound is the answer.  Long conversations are searched in blocks of ``BLOCK_ROWS``
rows, last block first: the costs of the states behind a block are then known exactly, and both the
time and the tables stay linear in the conversation.  (Of two paths through a block neither is a
prefix of the other unless they are equal, since both end with the edit of the block's last row;
inserts before a row belong to that row's block.  So the ASCII order is settled inside blocks.)

Texts are never held: the search sees two bytes a row, digests fold a sorted stream.  A conversation's
edit string and digest are sequential, so that fold runs in one task per conversation.

Defined results: nulls of role and text count as one space; null turns come first and equal turns are
ordered by role, then text; rows with a null conversation form one of their own; an empty role has
no initial and can't be kept; a conversation without rows has no edits.  Repeated rows are duplicates.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.llm.common import saved, trimming

BLOCK_ROWS = 32
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: States by what came last: nothing, a system, a user or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: The state that keeping a role with this initial leads to.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state that the next made turn leads to, and the roles of made turns.
MADE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
END = "end"  # the place behind the last row, where inserts are still possible


class BlockSearch:
    """Cheapest edits through consecutive rows [(initial, fault)] with known costs behind them."""

    def __init__(self, rows: list[tuple[str, str | None]], behind: tuple[int, int, int, int]) -> None:
        self.rows, self.behind = rows, behind
        self.least = [min(behind)] * (len(rows) + 1)
        for at in range(len(rows) - 1, -1, -1):
            fault = rows[at][1]
            must = DELETE_COST if fault in ("blank", "duplicate") else TRUNCATED_COST if fault == "truncated" else 0
            self.least[at] = self.least[at + 1] + must
        self.failed: dict[tuple[int, int], int] = {}

    def edits(self, at: int, state: int):
        """(letter, cost, next row, next state) in ASCII order of the letters."""
        initial, fault = self.rows[at]
        made = MADE[state]
        if fault == END:
            if state in ACCEPTED:
                yield "", 0, at + 1, state
            yield INSERT, INSERT_COST, at, made
            return
        yield DELETE, DELETE_COST, at + 1, state
        yield INSERT, INSERT_COST, at, made
        if fault in (None, "truncated"):
            extra = TRUNCATED_COST if fault else 0
            kept = KEPT.get((state, initial))
            if kept is not None:
                yield KEEP, extra, at + 1, kept
            yield REROLE, REROLE_COST + extra, at + 1, made

    def probe(self, at: int, state: int, left: int) -> int | None:
        """None when a path within ``left`` was found (its letters are in ``trail``, last first), otherwise
        the least cost that a path from here is known to need."""
        if at == len(self.rows):
            if self.behind[state] > left:
                return self.behind[state]
            self.exit = state
            return None
        need = self.failed.get((at, state), self.least[at])
        if need > left:
            return need
        asked = []
        for letter, cost, to, then in self.edits(at, state):
            got = self.probe(to, then, left - cost)
            if got is None:
                self.trail.append(letter)
                return None
            asked.append(cost + got)
        self.failed[at, state] = low = max(need, min(asked))
        return low

    def solve(self, state: int) -> tuple[int, str, int]:
        """(cost with what lies behind, letters, state behind) of the answer from ``state``."""
        bound = self.least[0]
        while True:
            self.trail: list[str] = []
            got = self.probe(0, state, bound)
            if got is None:
                return bound, "".join(reversed(self.trail)), self.exit
            bound = got


def cheapest_edits(rows: list[tuple[str, str | None]], block: int = BLOCK_ROWS) -> tuple[int, str]:
    """(cost, letters) of the answer for the rows (initial, fault) of one conversation."""
    if not rows:
        return 0, ""
    firsts = list(range(0, len(rows), block))
    behind, found = (0, 0, 0, 0), []
    for first in reversed(firsts):
        part = rows[first : first + block]
        if not found:
            part = [*part, ("", END)]
        search = BlockSearch(part, behind)
        paths = [search.solve(s) for s in ((START,) if first == 0 else (START, SYSTEM, USER, ASSISTANT))]
        behind = tuple(p[0] for p in paths)
        found.append(paths)
    state, letters = START, []
    for paths in reversed(found):
        _, some, state = paths[state]
        letters.append(some)
    return behind[START], "".join(letters)


def with_faults(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of all conversations in order: conv_id, ord (from 1), turn, role, text, initial, fault
    (blank, duplicate, truncated or null), illegal (roles that can't follow each other), new_turn."""
    rows = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    rows = rows.repartition("conv_id")  # every window below keeps this partitioning
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.select("*", F.row_number().over(in_order).alias("ord"))
    by_ord = Window.partitionBy("conv_id").orderBy("ord")
    initial = F.substring("role", 1, 1)
    rows = rows.select("*", initial.alias("initial"))
    pair = F.concat(F.lag("initial").over(by_ord), F.col("initial"))
    rows = rows.select(
        "*",
        F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(by_ord))).alias("new_turn"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("_same"),
    )
    seen = F.row_number().over(Window.partitionBy("conv_id", "_same").orderBy("ord")) > 1
    rows = rows.select("*", seen.alias("_seen"), F.rtrim(F.col("text"), F.lit(BLANKS)).alias("_cut"))
    fault = (
        F.when(F.col("_cut") == "", "blank")
        .when(F.col("_seen"), "duplicate")
        .when(~F.substring("_cut", -1, 1).isin(".", "!", "?"), "truncated")
    )
    return rows.select("conv_id", "ord", "turn", "role", "text", "initial", fault.alias("fault"), "illegal", "new_turn")


def edit_plan(faulted: DataFrame) -> DataFrame:
    """The edits of every conversation of ``with_faults``: conv_id, seq (from 0), edit, cost, ord (the row
    that is kept, reroled or deleted; null for inserts), role (of an insert or a rerole)."""
    names = ["conv_id", "seq", "edit", "cost", "ord", "role"]

    def plan(batches):
        conv, rows, out = None, [], []

        def table(made):
            cols = list(zip(*made, strict=True)) or [[]] * len(names)
            types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        def solved():
            state, at = START, 0
            for seq, letter in enumerate(cheapest_edits(rows)[1]):
                if letter == INSERT:
                    state = MADE[state]
                    yield conv, seq, letter, INSERT_COST, None, ROLE[state]
                    continue
                initial, fault = rows[at]
                at += 1
                extra = TRUNCATED_COST if fault == "truncated" else 0
                if letter == DELETE:
                    yield conv, seq, letter, DELETE_COST, at, None
                elif letter == KEEP:
                    state = KEPT[state, initial]
                    yield conv, seq, letter, extra, at, None
                else:
                    state = MADE[state]
                    yield conv, seq, letter, REROLE_COST + extra, at, ROLE[state]

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for c, initial, fault in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if rows and c != conv:
                    for row in solved():
                        out.append(row)
                        if len(out) >= 4096:
                            yield table(out)
                            out = []
                    rows = []
                conv = c
                rows.append((initial, fault))
        if rows:
            for row in solved():
                out.append(row)
                if len(out) >= 4096:
                    yield table(out)
                    out = []
        if out:
            yield table(out)

    kind = faulted.schema["conv_id"].dataType.simpleString()
    rows = faulted.select("conv_id", "initial", "fault", "ord").repartition("conv_id").sortWithinPartitions("conv_id", "ord")
    return rows.select("conv_id", "initial", "fault").mapInArrow(
        trimming(plan), f"conv_id {kind}, seq long, edit string, cost long, ord long, role string"
    )


def repaired_rows(faulted: DataFrame, plan: DataFrame) -> DataFrame:
    """The edits with the rows they leave: conv_id, seq, edit, cost, role, text (null role: deleted)."""
    was = faulted.select(F.col("conv_id").alias("_c"), F.col("ord").alias("_o"), F.col("role").alias("_r"), "text")
    rows = plan.join(was, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("ord") == F.col("_o")), "left")
    gone = F.col("edit") == DELETE
    return rows.select(
        "conv_id", "seq", "edit", "cost", F.when(~gone, F.coalesce("role", "_r")).alias("role"),
        F.when(F.col("edit") == INSERT, "").when(~gone, F.col("text")).alias("text"),
    )


def repair_digests(repaired: DataFrame) -> DataFrame:
    """Per conversation with edits: conv_id, cost, audit (the edits' initials in order) and
    repaired_sha256 (``role:text`` of the rows that are left, joined by newlines)."""
    names = ["conv_id", "cost", "audit", "repaired_sha256"]

    def fold(batches):
        done, conv, state, conv_type = [], None, None, None

        def flushed():
            cols = list(zip(*done, strict=True)) or [[]] * 4
            types = [conv_type, pa.int64(), pa.string(), pa.string()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        def close():
            done.append((conv, state[0], state[1].decode(), state[2].hexdigest()))

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for c, edit, cost, role, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, [0, bytearray(), hashlib.sha256(), b""]
                state[0] += cost
                state[1] += edit.encode()
                if role is not None:
                    state[2].update(state[3] + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    state[3] = b"\n"
            if done:
                yield flushed()
        if state is not None:
            close()
            yield flushed()

    kind = repaired.schema["conv_id"].dataType.simpleString()
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return rows.select("conv_id", "edit", "cost", "role", "text").mapInArrow(
        trimming(fold), f"conv_id {kind}, cost long, audit string, repaired_sha256 string"
    )


def fault_counts(faulted: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps (turn numbers that are missing), blank, duplicate, truncated, illegal."""
    span = F.max("turn") - F.min("turn") + 1 - F.sum(F.col("new_turn").cast("long"))
    counts = [F.sum((F.col("fault") == f).cast("long")) for f in FAULTS]
    return faulted.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(f) for c, f in zip(counts, FAULTS, strict=True)],
        F.sum(F.col("illegal").cast("long")).alias("illegal"),
    )


def repair_report(df: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest edits and digest of each conversation of ``df`` (conv_id, turn, role, text).

    ``conversations`` (conv_id), if given, names the conversations to report: those without rows in
    ``df`` have zeros, no edits and the digest of an empty text."""
    faulted = saved(with_faults(df), "conversation-faults")
    plan = saved(edit_plan(faulted), "conversation-edits")
    digests = repair_digests(repaired_rows(faulted, plan))
    names = (df if conversations is None else conversations).select("conv_id").distinct()
    out = names
    for found in (fault_counts(faulted), digests):
        found = found.withColumnRenamed("conv_id", "_c")
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    zeros = ["gaps", *FAULTS, "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of ``conv_id:turn``: of twenty rows one each is
    dropped, emptied, robbed of its full stops, repeated, or given to the user."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = df.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).cast("int").alias("_k"),
    ).where("_k <> 0")
    kind = F.col("_k")
    rows = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return rows.drop("_copy")
