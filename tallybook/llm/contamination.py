"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Normalising lower-cases A-Z and cuts at everything but letters, digits and bytes beyond ASCII. Each
distinct word of the benchmark becomes one symbol, any other word a symbol of no pattern; so a text
is a string of one symbol per word, which the automaton of all windows scans once. Word positions
map hits back to code points of the original text.

A window is ``size`` consecutive words of an item; an item of fewer words, but not none, is one
window. Null texts have no words. An item without an id still counts as hit words, but is not
listed; items that share an id are one item. Repeated rows are judged alike.

The automaton is shipped to every worker, so its size is checked: items of more than
``AUTOMATON_BYTES`` of text in all are dealt into parts by hash, and the documents are scanned once
for each part, every pass written before the next.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm import words
from tallybook.llm.frames import appended, once, stored

WINDOW = 10
AUTOMATON_BYTES = 2 << 20

# One byte to one byte: separators become blanks, capitals small letters.
NORMAL = bytes(int(words.ALNUM.folded[b]) if words.ALNUM.inside[b] else 32 for b in range(256))
_OTHER = "\0"
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(NORMAL).split()


class Matcher:
    """The automaton over windows of some items, as (item id, text) pairs."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item, text in items:
            coded = "".join(self._symbol(w) for w in normal_words(text))
            for i in range(max(1, len(coded) - size + 1) if coded else 0):
                held = owners.setdefault(coded[i:i + size], set())
                if item is not None:
                    held.add(item)
        self.automaton = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.automaton.add_word(window, (len(window), ids))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def _symbol(self, word: bytes) -> str:
        if word not in self.symbols:
            code = len(self.symbols) + 1
            self.symbols[word] = chr(code if code < 0xD800 else code + 0x800)
        return self.symbols[word]

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, spans of hit words (first, end), and the items found."""
        found = normal_words(text)
        if self.empty:
            return len(found), [], set()
        get = self.symbols.get
        coded = "".join([get(w, _OTHER) for w in found])
        ends, ids = [], set()
        for end, (size, owners) in self.automaton.iter(coded):
            ends.append((end + 1 - size, end + 1))
            ids |= owners
        ends.sort()
        merged: list[tuple[int, int]] = []
        for start, end in ends:
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return len(found), merged, ids


def original_spans(text: str, hits: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word spans as code point spans of the text they come from."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = words.spans(raw, np.array([0, len(raw)]), words.ALNUM)
    points = np.cumsum((raw & 0xC0) != 0x80)
    return [{"start": int(points[starts[a]]) - 1, "end": int(points[ends[b - 1] - 1])}
            for a, b in hits]


def _scan(df: DataFrame, items: list[tuple[str | None, str]], text: str, size: int) -> DataFrame:
    shared, name = df.sparkSession.sparkContext.broadcast((items, size)), uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        matcher = once(name, lambda: Matcher(*shared.value))
        n_words, hits, ids, spans = [], [], [], []
        for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
            n, found, owners = matcher.scan(value or "")
            n_words.append(n)
            hits.append([{"start": a, "end": b} for a, b in found])
            ids.append(sorted(owners))
            spans.append(original_spans(value, found) if found else [])
        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return [pa.array(n_words, pa.int64()), pa.array(hits, pair),
                pa.array(ids, pa.list_(pa.string())), pa.array(spans, pair)]

    return appended(df, [T.StructField("n_words", T.LongType()), T.StructField("word_spans", SPANS),
                         T.StructField("items", T.ArrayType(T.StringType())),
                         T.StructField("char_spans", SPANS)], compute, name)


def scan(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", size: int = WINDOW,
         automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Add n_words, word_spans (hit words), items (ids, sorted as text) and char_spans."""
    items = benchmark.select(F.col(item_id).cast("string").alias("id"),
                             F.col(item_text).alias("text")).filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // automaton_bytes))
    if parts == 1:
        return _scan(df, [tuple(r) for r in items.collect()], text, size)
    dealt = items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)))
    columns = [c for c in df.columns
               if c.lower() not in ("n_words", "word_spans", "items", "char_spans")]
    done = None
    for part in range(parts):
        some = [tuple(r) for r in dealt.filter(F.col("part") == part).drop("part").collect()]
        if done is None:
            done = _scan(df, some, text, size)
        else:
            kept = done.select(*columns, *[F.col(c).alias(f"_{c}") for c in
                                           ("word_spans", "items", "char_spans")])
            now = _scan(kept, some, text, size)
            done = now.select(
                *columns, "n_words",
                F.concat("_word_spans", "word_spans").alias("word_spans"),
                F.array_sort(F.array_union("_items", "items")).alias("items"),
                F.concat("_char_spans", "char_spans").alias("char_spans"))
        done = stored(done, "contamination")
    return done.withColumns({c: joined(c) for c in ("word_spans", "char_spans")})


def joined(spans: str) -> Column:
    """Spans in order, those that touch or overlap made one."""
    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"),
                         F.greatest(last["end"], span["end"]).alias("end"))
        before = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        longer = F.concat(before, F.array(grown))
        return F.when(span["start"] <= last["end"], longer).otherwise(
            F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(F.col(spans)), F.array().cast(SPANS), add)


def hit_words(spans: str = "word_spans") -> Column:
    return F.aggregate(F.col(spans), F.lit(0).cast("long"),
                       lambda n, s: n + s["end"] - s["start"])


def without_hits(df: DataFrame, text: str = "text") -> DataFrame:
    """Cut the hit spans, as found by ``scan``, out of every text."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for value, spans in zip(batch.column(batch.schema.get_field_index(text)).to_pylist(),
                                batch.column(batch.schema.get_field_index("char_spans"))
                                .to_pylist(), strict=True):
            for span in reversed(spans or []):
                value = value[:span["start"]] + value[span["end"]:]
            out.append(value)
        return [pa.array(out, pa.string())]

    cut = appended(df, [T.StructField("_cut", T.StringType())], compute)
    return cut.withColumn(text, F.col("_cut")).drop("_cut")
