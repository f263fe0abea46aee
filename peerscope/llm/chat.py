"""Chat formatting with typed content parts (operator 1).

A visitor walks a turn's parts (text, image, audio, document) in order and flattens them into one
string: text is escaped, every other part becomes an ordered placeholder ``<|kind:n|>``; the
attachment it stands for and the tokens it expands to are recorded beside it.  A turn is written as

    <|im_start|>ROLE newline CONTENT<|im_end|> newline

Escaping is reversible and leaves no control string inside a text: in ``<|``, ``<\\|``, ``<\\\\|`` ... one
more backslash is put behind the ``<``, so an escaped text never holds ``<|``.  Neighbouring text parts are
joined before they are escaped, so a control string can't be dealt out over them (what else may follow a
text, a placeholder or the turn's end, begins with ``<`` and completes none).  In roles a backslash and a newline are written ``\\\\`` and ``\\n`` as well.

``read_turns`` parses formatted turns back; ``conversation_digests`` reads whole conversations as a
stream sorted by conversation and turn, with running hashes, so the memory of a task holds one turn
and not one conversation.  (A SHA-256 over a conversation is sequential; only that fold follows the
conversation, formatting and parsing work row by row.)

Defined results: null text or parts are empty; a null role is an empty role; a null turn comes first;
equal (conversation, turn) rows are ordered by role, then text; rows with a null conversation form
one conversation of their own.  Negative, infinite and NaN sizes of attachments count as zero.  Text parts that
follow each other are read back as one.  Unknown part kinds raise an error in the task.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import trimming

START, END = "<|im_start|>", "<|im_end|>"
PARTS_TYPE = (
    "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)
ATTACHMENTS_TYPE = "array<struct<ordinal:int,kind:string,ref:string,tokens:bigint>>"
#: Token counts of expanded attachments: image patches, audio frames a second, tokens a page.
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 512
#: Tokens that an attachment expands to at most (what a 64-bit count can hold).
MOST_TOKENS = 2**62
LOSS_ROLE = "assistant"

_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_MARK = re.compile(r"<\|(image|audio|document):(\d+)\|>")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def size_of(x: float | None):
    """An attachment's size; nothing, negative, infinite and NaN sizes count as zero."""
    return x if x is not None and math.isfinite(x) and x > 0 else 0


class PartVisitor:
    """Flattens the parts of one turn; ``ordinal`` runs over the turn's attachments."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.attachments: list[dict] = []
        self.pending: list[str] = []  # texts since the last placeholder: escaped together

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown content part {kind!r}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        self.pending.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        w, h = size_of(part.get("width")), size_of(part.get("height"))
        self._attach("image", part, math.ceil(w / PATCH) * math.ceil(h / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(min(size_of(part.get("seconds")) * FRAMES_PER_SECOND, MOST_TOKENS)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, size_of(part.get("pages")) * TOKENS_PER_PAGE)

    def flush(self) -> None:
        self.out.append(escape("".join(self.pending)))
        self.pending.clear()

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.flush()
        n = len(self.attachments)
        self.out.append(f"<|{kind}:{n}|>")
        self.attachments.append({"ordinal": n, "kind": kind, "ref": part.get("ref"), "tokens": tokens})


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, list[dict]]:
    visitor = PartVisitor()
    for part in parts or []:
        if part is not None:
            visitor.visit(part)
    visitor.flush()
    return f"{START}{escape_role(role or '')}\n{''.join(visitor.out)}{END}\n", visitor.attachments


def read_turns(formatted: str):
    """(role, content parts) of each turn of a formatted string; raises where the format is broken."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn mark at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END + "\n", line + 1)
        role = unescape_role(formatted[at + len(START) : line])
        body, parts, last = formatted[line + 1 : end], [], 0
        for m in _MARK.finditer(body):
            if m.start() > last:
                parts.append(("text", unescape(body[last : m.start()])))
            parts.append((m[1], int(m[2])))
            last = m.end()
        if last < len(body):
            parts.append(("text", unescape(body[last:])))
        yield role, parts
        at = end + len(END) + 1


def text_parts(text: str = "text"):
    """A column of parts with one text part, for tables that hold plain texts."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                            F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
                            F.lit(None).cast("int").alias("pages")))


def format_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """One row per turn: conv, turn, role, formatted, attachments, attachment_tokens.

    A conversation's formatted text is its turns' ``formatted`` strings in order of turn.
    """

    @F.arrow_udf(f"formatted string, attachments {ATTACHMENTS_TYPE}")
    def render(roles: pa.Array, contents: pa.Array) -> pa.Array:
        made = [format_turn(r, p) for r, p in zip(roles.to_pylist(), contents.to_pylist(), strict=True)]
        kind = pa.list_(pa.struct([("ordinal", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], kind)],
            names=["formatted", "attachments"],
        )

    out = df.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        render(F.col(role), F.col(parts)).alias("_r"),
    )
    tokens = F.aggregate("_r.attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return out.select(
        "conv_id", "turn", "role", "_r.formatted", "_r.attachments", tokens.alias("attachment_tokens")
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars (see the module's text)."""

    def fold(batches):
        key, state = None, None
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
            done.clear()
            return out

        for batch in batches:
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or conv != key:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(text)
                for role, parts in read_turns(text):
                    content = "".join(p for kind, p in parts if kind == "text")
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                    if role == LOSS_ROLE:
                        state[2] += len(content)
                        state[3].update(content.encode("utf-8", "surrogatepass"))
            if done:
                yield flushed()
        close()
        yield flushed()

    ordered = (
        formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "formatted", "turn", "role")
        .repartition(F.col("conv_id"))
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "formatted")
    )
    return ordered.select("conv_id", "formatted").mapInArrow(
        trimming(fold),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
