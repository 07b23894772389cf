"""Conversation repair against a search over all edits, and on odd conversations."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import repair

BLANKS = "\t\n\x0b\x0c\r "
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}
WRITTEN = {"u": "user:", "a": "assistant:"}


def plain_repair(turns):
    """(cost, audit, repaired lines) of (role, text, gone, cut) rows, by the state so far."""
    found = {"": (0, "", ())}

    def grown(found):
        found, again = dict(found), True
        while again:
            again = False
            for state, (cost, audit, lines) in list(found.items()):
                to = FOLLOWS[state]
                new = (cost + 2, audit + "I", (*lines, WRITTEN[to]))
                if to not in found or new < found[to]:
                    found[to], again = new, True
        return found

    for role, text, gone, cut in turns:
        after = {}
        for state, (cost, audit, lines) in grown(found).items():
            options = [(state, (cost + 3, audit + "D", lines))]
            if not gone:
                to = FOLLOWS[state]
                options.append((to, (cost + 2 + cut, audit + "R", (*lines, WRITTEN[to] + text))))
                kept = role[:1]
                if kept == to or (kept == "s" and state == ""):
                    options.append((kept, (cost + cut, audit + "K", (*lines, f"{role}:{text}"))))
            for to, new in options:
                if to not in after or new < after[to]:
                    after[to] = new
        found = after
    found = grown(found)
    return min(found[s] for s in ("", "a") if s in found)


def plain_report(rows):
    """Per conversation, all that the query returns, of rows (conv_id, turn, role, text)."""
    by_conv = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        numbers = [t[1] for t in turns if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, _, _, role, text in turns:
            blank = not text.strip(BLANKS)
            again = (role, text) in seen
            cut = not blank and not again and text.rstrip(BLANKS)[-1] not in ".!?"
            seen.add((role, text))
            counts[0] += blank
            counts[1] += again and not blank
            counts[2] += cut
            judged.append((role, text, blank or again, int(cut)))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au")
                      for a, b in zip(judged[:-1], judged[1:], strict=True))
        cost, audit, lines = plain_repair(judged)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def report(df, *names):
    found = repair.repair(df, *names)
    counts = {r["conv_id"]: tuple(r)[1:] for r in found.conversations.collect()}
    ends = {r["conv_id"]: tuple(r)[1:] for r in repair.audits(found.edits).collect()}
    assert counts.keys() == ends.keys()
    return {c: counts[c] + ends[c] for c in counts}


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            for _ in range(2 if fault == 3 else 1):
                yield conv, turn, "user" if fault == 4 else role, text


CODES = st.lists(st.sampled_from([*range(12), 1, 2, 1, 2]), min_size=1, max_size=10)


@settings(max_examples=400, deadline=None)
@given(codes=CODES, size=st.integers(1, 11))
def test_pieces_of_any_size_give_the_least_audit(codes, size):
    pieces = [bytes(codes[k:k + size]) for k in range(0, len(codes), size)]
    steps = [repair.through(p) for p in pieces]
    end, cost = repair.ending(steps)
    audit, begin = "", repair.START
    for piece, to in zip(pieces, repair.crossings(steps, repair.START, end), strict=True):
        audit += "".join(step for _, step in repair.solve(piece, begin, to))
        begin = to
    turns = [("suax"[c & 3], "", bool(c & 8), int(bool(c & 4))) for c in codes]
    assert (cost, audit + repair.CLOSING[end]) == plain_repair(turns)[:2]


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "assistant", "Hi!"),
    (2, 0, "user", "No end"), (2, 5, "assistant", "Yes."), (2, 6, "assistant", "Yes."),
    (2, 7, "user", " \t "), (2, 8, "user", ""), (2, 9, "tool", "result?"),
    (3, 0, None, None), (3, None, None, "x."), (3, None, "user", None), (3, 1, "assistant", "y!"),
    (4, 3, "assistant", "a."), (4, 3, "assistant", "a."), (4, 3, "user", "b."), (4, 3, "", "c."),
    (5, None, "user", "a? \n"), (5, None, "user", "b "), (5, None, "assistant", "ü."),
    (None, 0, "user", "null id."), (None, 1, "assistant", "fine."), (None, 1, "ua", "odd."),
    (6, 0, "system", " "), (7, 0, "user", "long " * 50_000 + "."), (8, 0, "Sam", "x."),
    (9, 0, "assistant", "a."), (9, 1, "system", "s."), (9, 2, "user", "u."), (9, 3, "user", "v."),
]
SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("parts", [1, 5])
def test_odd_conversations(spark, parts):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(parts).withColumn("edits", F.lit("clash"))
    assert report(df) == plain_report(ROWS)


def test_damage_and_other_names(spark):
    rows = [(c, t, r, x) for c in [None, *range(60)] for t, r, x in (
        (None, "user", f"n{c}."), (0, "system", "s."), (1, "user", f"Ask. {c}?"),
        (2, "assistant", None), (4, None, "a!"), (5, "assistant", "Done."))]
    df = spark.createDataFrame(rows, SCHEMA)
    damaged = list(plain_damage(rows))
    found = repair.damaged(df)
    assert sorted(map(str, found.collect())) == sorted(
        map(str, spark.createDataFrame(damaged, SCHEMA).collect()))
    named = found.toDF("thread", "number", "who", "said")
    assert report(named, "thread", "number", "who", "said") == plain_report(damaged)


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 50)
    rows = [(7, k // 2, ("user", "assistant", "system", "x")[zlib.crc32(b"%d" % k) % 4],
             f"{k % 900}" + ".,"[k % 7 == 0]) for k in range(2000)]
    rows += [(7, 3, "user", "3.")] * 1500  # one turn again and again
    rows += [(8, k, "user", "same.") for k in range(300)]
    rows += [(k, 0, "user", "one.") for k in range(20, 60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert report(df) == plain_report(rows)


def test_nothing_to_repair(spark):
    found = repair.repair(spark.createDataFrame([], SCHEMA))
    assert found.conversations.count() == 0 and repair.audits(found.edits).count() == 0
