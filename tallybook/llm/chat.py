"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation, every control string being one of ``CONTROLS``:

    conversation := turn*
    turn         := "<s>" kinds ":" role "[INST]" text "[/INST]"   (a turn that isn't learned)
                  | "<s>" kinds ":" role "[SAY]" text "</s>"       (a turn under the loss mask)

where role and text hold no control string. Formatting renders a turn with its text as it is,
parses the result with a deterministic parser and compares what comes back. While they differ, the
control strings that stand in role or text are escaped, one kind after the other, until parse and
source are identical. The escape puts a backslash and a digit in a control string's place, and
marks backslashes themselves, so it can be undone; which kinds are escaped is written into the
turn's head, so a text without conflicts stays just as it was.

A conversation's turns are sorted by turn, role and text (nulls first) and streamed: a task holds
a batch of turns, never a conversation, and each turn is a piece of the formatted text. Null text
or role is empty. Repeated rows are turns of their own. Rows without a conversation id form one
conversation without an id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import prepare, trimmed

# The control strings of the template.
OPEN, ASK, SAY, CLOSE_ASK, CLOSE_SAY = "<s>", "[INST]", "[SAY]", "[/INST]", "</s>"
CONTROLS = (OPEN, ASK, SAY, CLOSE_ASK, CLOSE_SAY)
LEARNED = "assistant"
CLOSER = {ASK: CLOSE_ASK, SAY: CLOSE_SAY}
KINDS = "01234"
_ESCAPE, _DOUBLED = "\\", "_"
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))

PIECES = ("conv_id long, piece_no long, role string, text string, piece string, "
          "mask_start int, mask_end int, escaped string")


def escape(text: str, kinds: str) -> str:
    """Put other strings in the place of control strings; ``kinds`` are digits into CONTROLS."""
    if not kinds:
        return text
    out = text.replace(_ESCAPE, _ESCAPE + _DOUBLED)
    for k in kinds:
        out = out.replace(CONTROLS[int(k)], _ESCAPE + k)
    return out


def unescape(text: str, kinds: str) -> str | None:
    """What was escaped, or None if it can't have been."""
    if not kinds:
        return text
    parts = text.split(_ESCAPE)
    out = [parts[0]]
    for part in parts[1:]:
        mark = part[:1]
        if mark != _DOUBLED and (not mark or mark not in kinds):
            return None
        out.append((_ESCAPE if mark == _DOUBLED else CONTROLS[int(mark)]) + part[1:])
    return "".join(out)


def render(role: str, text: str, kinds: str) -> tuple[str, int, int]:
    """A turn's piece, and the span of its text inside."""
    learned = role == LEARNED
    head = f"{OPEN}{kinds}:{escape(role, kinds)}{SAY if learned else ASK}"
    body = escape(text, kinds)
    return head + body + (CLOSE_SAY if learned else CLOSE_ASK), len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, str, int, int]] | None:
    """(role, text, escaped kinds, text start, text end) of all turns, or None if it's no
    conversation. Control strings decide alone, one after the other; nothing is tried twice."""
    marks = [(m.start(), m.end(), m.group()) for m in _CONTROL.finditer(formatted)]
    if len(marks) % 3:
        return None
    at, turns = 0, []
    for (a, b, opened), (c, d, middle), (e, f, closed) in zip(
            marks[::3], marks[1::3], marks[2::3], strict=True):
        if a != at or opened != OPEN or middle not in CLOSER or closed != CLOSER[middle]:
            return None
        kinds, colon, role = formatted[b:c].partition(":")
        if not colon or not all(k in KINDS for k in kinds):
            return None
        role, text = unescape(role, kinds), unescape(formatted[d:e], kinds)
        if role is None or text is None or (role == LEARNED) != (middle == SAY):
            return None
        turns.append((role, text, kinds, d, e))
        at = f
    return turns if at == len(formatted) else None


def format_turn(role: str, text: str) -> tuple[str, int, int, str]:
    """A piece that parses back to exactly this turn, escaping no more kinds than it takes."""
    kinds = ""
    while True:
        piece, start, end = render(role, text, kinds)
        if parse(piece) == [(role, text, kinds, start, end)]:
            return piece, start, end, kinds
        conflict = next(k for k, c in zip(KINDS, CONTROLS, strict=True)
                        if k not in kinds and (c in role or c in text))
        kinds = "".join(sorted(kinds + conflict))


def format_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row a turn, in order within its task: a conversation's formatted text is its pieces by
    piece_no, joined by nothing; mask_start and mask_end are code points in the piece, null outside
    the loss mask. All pieces of a conversation are in one partition, one after another."""
    prepare(conversations.sparkSession)
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number = object(), 0
        for batch in batches:
            ids, roles, bodies = (batch.column(k).to_pylist() for k in (0, 2, 3))
            numbers, made = [], []
            for one, r, t in zip(ids, roles, bodies, strict=True):
                number = number + 1 if one == current else 0
                current = one
                numbers.append(number)
                made.append(format_turn(r, t))
            masked = [r == LEARNED for r in roles]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), batch.column(2), batch.column(3),
                 pa.array([m[0] for m in made], pa.string()),
                 pa.array([m[1] if y else None for m, y in zip(made, masked, strict=True)],
                          pa.int32()),
                 pa.array([m[2] if y else None for m, y in zip(made, masked, strict=True)],
                          pa.int32()),
                 pa.array([m[3] for m in made], pa.string())],
                names=[x.split()[0] for x in PIECES.split(", ")])

    return ordered.select("conv_id", "turn", "role", "text").mapInArrow(trimmed(run), PIECES)


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of every conversation, from its formatted pieces and mask alone. ``pieces`` must be
    as ``format_turns`` gives them. Columns: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_escaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        done: list[tuple] = []
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("conv_id", "piece", "mask_start", "mask_end")]
            for one, piece, start, end in zip(*columns, strict=True):
                if state is None or state[0] != one:
                    if state is not None:
                        done.append(_finished(state))
                    state = [one, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for r, t, kinds, _, _ in parse(piece) or []:
                    state[1] += 1
                    state[2].update(f"{r}\n{t}\n".encode())
                    state[6] += bool(kinds)
                    if start is not None:
                        masked = unescape(piece[start:end], kinds)
                        state[3] += len(masked)
                        state[4].update(masked.encode())
                state[5] += len(piece)
            if done:
                yield _digests(done)
                done = []
        if state is not None:
            yield _digests([_finished(state)])

    return pieces.mapInArrow(trimmed(run), "conv_id long, n_turns long, turns_sha256 string, "
                             "loss_chars long, loss_sha256 string, formatted_chars long, "
                             "n_escaped long")


def _finished(state: list) -> tuple:
    one, turns, digest, chars, masked, size, escaped = state
    return one, turns, digest.hexdigest(), chars, masked.hexdigest(), size, escaped


def _digests(done: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
        names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
               "formatted_chars", "n_escaped"])
