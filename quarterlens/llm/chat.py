"""Operator 9: chat formatting that is proved by reading it back.

Grammar of the rendered text:

    conversation = turn*
    turn         = "### " role ": " body "</turn>" "\\n"

A turn is rendered with its text as it is, parsed again by the deterministic
parser, and compared with the source.  Only if they differ, because the text
holds a control string (``### `` or ``</turn>``) or backslashes where they
would be read as escapes, the conflicting places are escaped and the turn is
rendered and compared again: a control string gets a backslash in front, and
backslashes before it or before the end are doubled.  A turn that would still
differ raises an error.

Turns are formatted row by row without a shuffle.  ``read_back`` streams a
conversation's pieces in order through the parser and running digests, so not
even a conversation of very many turns is held in memory.

Edge cases: a null text or role is an empty string; rows that tie on turn are
ordered by role, then text; null turns come first; rows with a null conv_id
form one conversation; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, LEARNED = "### ", "</turn>", "assistant"
_CONTROL = re.compile(r"(?<!\\)(\\*)(### |</turn>)")
_CONFLICT = re.compile(r"(?<!\\)(\\*)(### |</turn>|\Z)")
_ROLE = re.compile(r"((?:[^\\:\n]|\\.)*): ", re.DOTALL)
PIECES = "conv_id long, turn long, role string, text string, piece string, mask_start long, mask_end long"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


class GrammarError(ValueError):
    pass


def escape(text: str) -> str:
    return _CONFLICT.sub(lambda m: m[1] * 2 + ("\\" if m[2] else "") + m[2], text)


def render(role: str, body: str) -> tuple[str, int, int]:
    """(rendered turn, start and end of the body in it)."""
    head = OPEN + re.sub(r"([\\:\n])", r"\\\1", role) + ": "
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, body start, body end) of each turn; raises GrammarError."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at) or not (m := _ROLE.match(text, at + len(OPEN))):
            raise GrammarError(f"no turn begins at {at}")
        role = re.sub(r"\\(.)", r"\1", m[1], flags=re.DOTALL)
        start = at = m.end()
        out = []
        while True:
            m = _CONTROL.search(text, at)
            if not m:
                raise GrammarError("a turn is not closed")
            slashes = len(m[1])
            out += [text[at:m.start()], "\\" * (slashes // 2)]
            at = m.end()
            if slashes % 2:
                out.append(m[2])
            elif m[2] == CLOSE:
                break
            else:
                raise GrammarError(f"a turn begins inside a turn at {m.start()}")
        end = m.start(2)
        if not text.startswith("\n", at):
            raise GrammarError(f"text after the turn's end at {at}")
        at += 1
        turns.append((role, "".join(out), start, end))
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, escaped only if it would not read back otherwise, and its body's place."""
    for body in (text, escape(text)):
        piece, start, end = render(role, body)
        try:
            if [t[:2] for t in parse(piece)] == [(role, text)]:
                return piece, start, end
        except GrammarError:
            pass
    raise GrammarError(f"turn does not read back: {role!r}")


def format_turns(turns: DataFrame) -> DataFrame:
    """One rendered piece per row of ``turns(conv_id, turn, role, text)``.

    A conversation's formatted text is its pieces in the order of turn, role,
    text.  ``mask_start`` and ``mask_end`` delimit, in the piece, what a model
    learns from (null outside assistant turns).
    """

    def form(batches):
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            formed = [format_turn(r, t) for r, t in zip(roles, texts)]
            learned = [r == LEARNED for r in roles]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array([f[0] for f in formed], pa.string()),
                 pa.array([f[1] if k else None for f, k in zip(formed, learned)], pa.int64()),
                 pa.array([f[2] if k else None for f, k in zip(formed, learned)], pa.int64())],
                names=[f.split()[0] for f in PIECES.split(", ")])

    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        blank("role"), blank("text")).mapInArrow(form, PIECES)


def formatted_conversations(pieces: DataFrame) -> DataFrame:
    """(conv_id, formatted): whole conversations as one string each, for those that fit in a row."""
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "piece")))
    return pieces.groupBy("conv_id").agg(F.concat_ws("", F.transform(listed, lambda p: p["piece"])).alias("formatted"))


class _Digest:
    """Running digests of one conversation, fed with its pieces."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece, start, end):
        for role, text, body_start, body_end in parse(piece):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if start is not None and (start, end) == (body_start, body_end):
                self.loss_chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.chars += len(piece)

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(pieces: DataFrame) -> DataFrame:
    """Parse the formatted conversations and digest what is recovered, one row each."""
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches):
        now, rows = None, []

        def flush():
            columns = zip(*rows) if rows else [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            rows.clear()
            return batch

        for batch in batches:
            for conv_id, piece, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now is None or now.conv_id != conv_id:
                    if now:
                        rows.append(now.row())
                    now = _Digest(conv_id)
                now.add(piece, start, end)
            if len(rows) > 10_000:
                yield flush()
        if now:
            rows.append(now.row())
        yield flush()

    return (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "piece", "mask_start", "mask_end").mapInArrow(read, DIGESTS))
