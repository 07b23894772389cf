"""Conversation structure repair: the cheapest edits that make turns alternate, by Hirschberg.

A repaired conversation is empty, or an optional system turn followed by user and assistant turns in
pairs. Edits: keep a turn (K, 0), give it the role user or assistant (R, 2), delete it (D, 3; blank
and repeated turns must go), insert an empty user or assistant turn anywhere (I, 2); a truncated
turn that stays costs 1 more. Of the cheapest edits, the audit (their letters) that is ASCII-least
is taken.

There are four states: nothing yet, after system, after user, after assistant. Every letter leads
from a state to one state only, so an audit says everything, and of two audits that lead over
different states behind one turn neither begins with the other. Hence a vector of four costs and
the order of the four least audits is all that is needed to go forward, and four costs to go back.
Divide and conquer: forward and backward vectors meet in the middle, the cheapest crossing (of
equal ones the one with the least audit) is fixed, and both halves are solved alike, in linear space.

The same runs at two levels, so that no conversation has to fit in a task. A range exchange sorts
narrow rows (no texts); each task cuts them into *pieces* of one conversation, whose four-by-four
costs and orders take the place of a turn's. Crossings between pieces are chosen first, from those
alone; then every piece is solved by itself. Equal turns of a conversation are one row with a count.
Only the last step reads a conversation's texts in order, row by row, as a digest asks for.

Turns go by ``turn`` (nulls first), then by a digest of role and text; null role or text is one
space, a null conversation is one like any other. Rows that repeat a turn count as repeated.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.frames import prepare, stored, trimmed

# Costs of edits, and of a truncated turn that stays.
COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
# Turns of a piece; pieces up to this long are remembered by their turns.
PIECE, SHORT = 4096, 24
_INF = 1 << 60
# Bits of a turn's code: its initial (3: any other), truncated, must be deleted.
_CUT, _GONE = 4, 8

Edge = tuple[int, int, int, int]


# -- the grammar -----------------------------------------------------------------------------

def _inserted(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: int) -> int | None:
    if initial == 0:
        return SYSTEM if state == START else None
    role = {1: USER, 2: ASSISTANT}.get(initial)
    return role if role == _inserted(state) else None


# What may happen at a turn: insertions before it, then its own letter, in ASCII order.
STEPS = sorted("I" * k + x for k in range(3) for x in "KRD")


def _edges(code: int) -> list[Edge]:
    """(state, next state, cost, number of the step) for a turn of this code."""
    out = []
    for state in range(4):
        for number, step in enumerate(STEPS):
            at, cost = state, COST["I"] * (len(step) - 1)
            for _ in step[1:]:
                at = _inserted(at)
            letter = step[-1]
            if letter == "D":
                out.append((state, at, cost + COST["D"], number))
            elif not code & _GONE:
                to = _kept(at, code & 3) if letter == "K" else _inserted(at)
                if to is not None:
                    stays = TRUNCATED if code & _CUT else 0
                    out.append((state, to, cost + COST[letter] + stays, number))
    return out


EDGES = [_edges(code) for code in range(16)]
# Insertions that end a conversation in each state.
CLOSING = ["", "II", "I", ""]


# -- divide and conquer ------------------------------------------------------------------------

def _advance(costs: list[int], ranks: list[int], edges: list[Edge]) -> tuple[list[int], list[int]]:
    """Costs of the four states one step later, and the order of their least audits."""
    best: list[tuple[int, int, int] | None] = [None] * 4
    for state, to, cost, order in edges:
        if costs[state] < _INF:
            key = (costs[state] + cost, ranks[state], order)
            if best[to] is None or key < best[to]:
                best[to] = key
    reached = sorted((k[1], k[2], to) for to, k in enumerate(best) if k)
    rank = [0] * 4
    for place, (_, _, to) in enumerate(reached):
        rank[to] = place
    return [k[0] if k else _INF for k in best], rank


def _forward(steps: list[list[Edge]], low: int, high: int, start: int
             ) -> tuple[list[int], list[int]]:
    costs, ranks = [_INF] * 4, [0] * 4
    costs[start] = 0
    for edges in steps[low:high]:
        costs, ranks = _advance(costs, ranks, edges)
    return costs, ranks


def _backward(steps: list[list[Edge]], low: int, high: int, end: int) -> list[int]:
    costs = [_INF] * 4
    costs[end] = 0
    for edges in reversed(steps[low:high]):
        before = [_INF] * 4
        for state, to, cost, _ in edges:
            if costs[to] + cost < before[state]:
                before[state] = costs[to] + cost
        costs = before
    return costs


def ending(steps: list[list[Edge]]) -> tuple[int, int]:
    """State behind the last step of the least cheapest audit, and its cost, closing included."""
    costs, ranks = _forward(steps, 0, len(steps), START)
    closed = [c + COST["I"] * len(CLOSING[k]) for k, c in enumerate(costs)]
    end = min(range(4), key=lambda k: (closed[k], ranks[k]))
    return end, closed[end]


def crossings(steps: list[list[Edge]], start: int, end: int) -> list[int]:
    """The state behind every step of the least cheapest audit from state to state."""
    states = [START] * len(steps)
    work = [(0, len(steps), start, end)]
    while work:
        low, high, first, last = work.pop()
        if high - low == 1:
            states[low] = last
        elif high > low:
            middle = (low + high) // 2
            ahead, ranks = _forward(steps, low, middle, first)
            behind = _backward(steps, middle, high, last)
            cross = min(range(4), key=lambda k: (ahead[k] + behind[k], ranks[k]))
            work += [(low, middle, first, cross), (middle, high, cross, last)]
    return states


def _taken(edges: list[Edge], state: int, to: int) -> int:
    return min((cost, order) for s, t, cost, order in edges if s == state and t == to)[1]


def _solve(codes: bytes, start: int, end: int) -> list[tuple[int, str]]:
    """(state before, step) of every turn of a piece."""
    steps = [EDGES[c] for c in codes]
    out, state = [], start
    for edges, to in zip(steps, crossings(steps, start, end), strict=True):
        out.append((state, STEPS[_taken(edges, state, to)]))
        state = to
    return out


def _through(codes: bytes) -> list[Edge]:
    """A piece as one step: costs and order of least audits between all states."""
    steps = [EDGES[c] for c in codes]
    out = []
    for state in range(4):
        costs, ranks = _forward(steps, 0, len(steps), state)
        out += [(state, to, costs[to], ranks[to]) for to in range(4) if costs[to] < _INF]
    return out


_solve_short = functools.lru_cache(maxsize=1 << 14)(_solve)
_through_short = functools.lru_cache(maxsize=1 << 14)(_through)


def solve(codes: bytes, start: int, end: int) -> list[tuple[int, str]]:
    return (_solve_short if len(codes) <= SHORT else _solve)(codes, start, end)


def through(codes: bytes) -> list[Edge]:
    return (_through_short if len(codes) <= SHORT else _through)(codes)


# -- turns as narrow rows ----------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults, by crc32 of conv_id:turn modulo 20: 0 drops
    the row, 1 empties the text, 2 takes its full stops away, 3 repeats the row, 4 makes it the
    user's. Nulls count as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    fault, text = F.crc32(key) % 20, F.coalesce("text", space)
    return conversations.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(
            text).alias("text"), fault.alias("fault")).filter("fault <> 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), (F.col("fault") == 3).cast("int")))).drop(
        "copy", "fault")


def _identity() -> Column:
    """Equal for equal role and text."""
    return F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))


def _judged(turns: DataFrame) -> DataFrame:
    """One row for equal turns of a conversation: conv_id, turn, digest, copies, code, blank, seen
    (an earlier turn has the same role and text)."""
    role = F.col("role")
    initial = F.when(role.startswith("s"), 0).when(role.startswith("u"), 1).when(
        role.startswith("a"), 2).otherwise(3)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~blank & ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    groups = stored(turns.select(
        "conv_id", "turn", _identity().alias("digest"), initial.cast("int").alias("initial"),
        blank.alias("blank"), cut.alias("cut")).groupBy(
        "conv_id", "turn", "digest", "initial", "blank", "cut").agg(
        F.count("*").alias("copies")), "turn-groups")
    # The earliest turn of each role and text: one row a key on both sides, whatever repeats.
    first = groups.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))["turn"].alias("t"))
    found = groups.join(first.withColumn("first", F.lit(True)), (
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
        & F.col("turn").eqNullSafe(F.col("t"))), "left")
    seen = F.col("first").isNull()
    gone = F.col("blank") | seen
    return found.select(
        "conv_id", "turn", "digest", "copies", "blank", "cut", seen.alias("seen"),
        (F.col("initial") + F.when(F.col("cut"), _CUT).otherwise(0)
         + F.when(gone, _GONE).otherwise(0)).alias("code"))


def _faults(judged: DataFrame) -> DataFrame:
    """Per conversation: rows, gaps, blank, duplicate, truncated."""
    fresh = ~F.col("blank") & ~F.col("seen")
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return judged.groupBy("conv_id").agg(
        F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(
            F.col("copies") - fresh.cast("long"))).alias("duplicate"),
        F.sum((fresh & F.col("cut")).cast("long")).alias("truncated"))


# -- pieces ------------------------------------------------------------------------------------

_PIECES = ("piece long, conv_id {id}, turns array<{turn}>, digests array<string>, "
           "copies array<long>, codes binary, edges binary, illegal long")


def _pieces(judged: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in judged.schema.fields}
    order = ["conv_id", "turn", "digest"]
    rows = judged.select(*order, "copies", "code").repartitionByRange(*order).sortWithinPartitions(
        *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(0)
            same = np.zeros(n, bool)
            known = np.asarray(ids.is_valid())
            values = ids.to_pylist()
            same[1:] = [a == b for a, b in zip(values[1:], values[:-1], strict=True)]
            same[1:] &= known[1:] == known[:-1]
            begins = np.flatnonzero(~same)
            starts = np.concatenate([np.arange(a, b, PIECE) for a, b in zip(
                begins, np.append(begins[1:], n), strict=True)])
            edges = np.append(starts, n).tolist()
            offsets = pa.array(edges, pa.int32())
            codes = batch.column(4).to_numpy(zero_copy_only=False).astype(np.uint8)
            copies = batch.column(3).to_numpy(zero_copy_only=False)
            parts, tables, illegal = [], [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                parts.append(codes[a:b].tobytes())
                tables.append(np.array(through(parts[-1]), np.int64).tobytes())
                initials = codes[a:b] & 3
                # Equal turns next to each other are illegal as well.
                illegal.append(int((copies[a:b] - 1).sum())
                               + int((~_legal(initials[:-1], initials[1:])).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(number, number + len(starts))), ids.take(pa.array(starts)),
                 pa.ListArray.from_arrays(offsets, batch.column(1)),
                 pa.ListArray.from_arrays(offsets, batch.column(2)),
                 pa.ListArray.from_arrays(offsets, batch.column(3)),
                 pa.array(parts, pa.binary()), pa.array(tables, pa.binary()),
                 pa.array(illegal, pa.int64())],
                names=["piece", "conv_id", "turns", "digests", "copies", "codes", "edges",
                       "illegal"])
            number += len(starts)

    schema = _PIECES.format(id=kinds["conv_id"], turn=kinds["turn"])
    return stored(rows.mapInArrow(trimmed(run), schema), "pieces")


def _legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether two initials may follow each other."""
    table = np.zeros((4, 4), bool)
    for a, b in LEGAL:
        table[INITIALS.index(a), INITIALS.index(b)] = True
    return table[before, after]


def _crossed(pieces: DataFrame) -> DataFrame:
    """For every piece the states it begins and ends in, whether it is its conversation's last, and
    on the last one the conversation's cost (but for turns that repeat one before) and its illegal
    neighbours. What is held at a time is 4 x 4 numbers a piece of one conversation."""
    rows = pieces.select("conv_id", "piece", "edges", "illegal",
                         F.substring("codes", 1, 1).alias("first"),
                         F.expr("substring(codes, -1, 1)").alias("last"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def finished(held: list[tuple]) -> list[tuple]:
        steps = [list(map(tuple, np.frombuffer(h[2], np.int64).reshape(-1, 4).tolist()))
                 for h in held]
        illegal = sum(h[3] for h in held)
        for one, two in zip(held[:-1], held[1:], strict=True):
            illegal += not _legal(one[5][0] & 3, two[4][0] & 3)
        end, cost = ending(steps)
        states = crossings(steps, START, end)
        return [(h[1], begin, state, k == len(held) - 1, h[0], *(
            (cost, illegal) if k == len(held) - 1 else (None, None)))
            for k, (h, begin, state) in enumerate(
                zip(held, [START, *states[:-1]], states, strict=True))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][0] != row[0]:
                    out += finished(held)
                    held = []
                held.append(row)
            if out:
                yield _table(out)
        if held:
            yield _table(finished(held))

    def _table(out: list[tuple]) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*out, strict=True)]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), id_type, pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["piece", "begin", "end", "closes", "conv_id", "cost", "illegal"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(pieces.schema["conv_id"].dataType)
    return stored(rows.mapInArrow(
        trimmed(run), "piece long, begin int, end int, closes boolean, "
        f"conv_id {kind}, cost long, illegal long"), "crossings")


def _steps(pieces: DataFrame, crossed: DataFrame) -> DataFrame:
    """conv_id, turn, digest, state, edits: what happens at each turn, with the edits of the turns
    that repeat it right behind, and at the last turn what closes the conversation."""
    rows = pieces.drop("edges", "illegal").join(
        crossed.select("piece", "begin", "end", "closes"), "piece").select(
        "conv_id", "turns", "digests", "copies", "codes", "begin", "end", "closes")
    kinds = {f.name: f.dataType for f in pieces.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.column(3).flatten().to_pylist()
            edits, states, owner = [], [], []
            for k, (codes, begin, end, closes) in enumerate(zip(
                    *[batch.column(c).to_pylist() for c in (4, 5, 6, 7)], strict=True)):
                for state, step in solve(codes, begin, end):
                    states.append(state)
                    edits.append(step + "D" * (copies[len(owner)] - 1))
                    owner.append(k)
                if closes:
                    edits[-1] += CLOSING[end]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), batch.column(1).flatten(),
                 batch.column(2).flatten(), pa.array(states, pa.int32()),
                 pa.array(edits, pa.string())],
                names=["conv_id", "turn", "digest", "state", "edits"])

    return rows.mapInArrow(trimmed(run), (
        f"conv_id {kinds['conv_id'].simpleString()}, turn "
        f"{kinds['turns'].elementType.simpleString()}, digest string, state int, edits string"))


# -- repaired conversations ----------------------------------------------------------------------

class Repaired(NamedTuple):
    """``edits``: conv_id, edit_no, edit, role, text, every edit in order (role and text null where
    a turn goes), all of a conversation in one partition, one after another. ``conversations``:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost."""

    edits: DataFrame
    conversations: DataFrame


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> Repaired:
    prepare(conversations.sparkSession)
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    judged = stored(_judged(turns), "judged-turns")
    pieces = _pieces(judged)
    crossed = _crossed(pieces)
    faults = _faults(judged)
    ends = crossed.filter("closes").select(
        F.col("conv_id").alias("same"), "illegal", F.col("cost").alias("least"))
    again = judged.groupBy(F.col("conv_id").alias("other")).agg(
        (F.sum(F.col("copies") - 1) * COST["D"]).alias("repeats"))
    summary = faults.join(ends, faults["conv_id"].eqNullSafe(ends["same"])).join(
        again, faults["conv_id"].eqNullSafe(again["other"])).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal",
        (F.col("least") + F.col("repeats")).alias("cost"))
    return Repaired(_edits(turns, _steps(pieces, crossed)), summary)


def _edits(turns: DataFrame, steps: DataFrame) -> DataFrame:
    """Texts and edits of a conversation meet in order; of equal turns the first text is used."""
    none = F.lit(None)
    rows = turns.select("conv_id", "turn", _identity().alias("digest"), F.lit(1).alias("kind"),
                        none.cast("int").alias("state"), none.cast("string").alias("edits"),
                        "role", "text").unionByName(
        steps.withColumns({"kind": F.lit(0), "role": none.cast("string"),
                           "text": none.cast("string")}))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest", "kind")
    rows = rows.select("conv_id", "kind", "state", "edits", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        id_type = to_arrow_type(turns_id)
        current, number, step = object(), 0, None
        for batch in batches:
            out: list[tuple] = []
            for one, is_text, state, edits, role, text in zip(
                    *[c.to_pylist() for c in batch.columns], strict=True):
                if one != current:
                    current, number = one, 0
                if not is_text:
                    step = (state, edits)
                elif step is not None:
                    at, step_edits = step
                    step = None
                    for letter in step_edits:
                        if letter == "D":
                            row = (one, number, letter, None, None)
                        elif letter == "K":
                            at = {0: SYSTEM, 1: USER, 2: ASSISTANT}[INITIALS.index(role[0])]
                            row = (one, number, letter, role, text)
                        else:
                            at = _inserted(at)
                            row = (one, number, letter, ROLES[at], "" if letter == "I" else text)
                        out.append(row)
                        number += 1
                        if len(out) >= 10_000:
                            yield _edit_batch(out, id_type)
                            out = []
            if out:
                yield _edit_batch(out, id_type)

    turns_id = turns.schema["conv_id"].dataType
    return rows.mapInArrow(trimmed(run), (
        f"conv_id {kind}, edit_no long, edit string, role string, text string"))


def _edit_batch(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
        names=["conv_id", "edit_no", "edit", "role", "text"])


def audits(edits: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 (role:text of the turns that stay, joined by newlines) of
    every conversation, from edits as ``repair`` gives them."""
    id_field = edits.schema["conv_id"].dataType
    kind = id_field.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        id_type = to_arrow_type(id_field)
        current, letters, digest, lines = object(), [], None, 0
        for batch in batches:
            done = []
            for one, _, edit, role, text in zip(*[c.to_pylist() for c in batch.columns],
                                                strict=True):
                if one != current or digest is None:
                    if digest is not None:
                        done.append((current, "".join(letters), digest.hexdigest()))
                    current, letters, digest, lines = one, [], hashlib.sha256(), 0
                letters.append(edit)
                if edit != "D":
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            if done:
                yield _audit_batch(done, id_type)
        if digest is not None:
            yield _audit_batch([(current, "".join(letters), digest.hexdigest())], id_type)

    return edits.select("conv_id", "edit_no", "edit", "role", "text").mapInArrow(
        trimmed(run), f"conv_id {kind}, audit string, repaired_sha256 string")


def _audit_batch(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*done, strict=True),
                                        (id_type, pa.string(), pa.string()), strict=True)],
        names=["conv_id", "audit", "repaired_sha256"])
