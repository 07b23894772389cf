"""I-Match document fingerprints, with DataFrame functions only.

The lexicon is the terms whose document frequency lies in a band; a text's fingerprint is one hash
for each of several random subsets of the lexicon, of the text's distinct terms in that subset. That
hash is the exclusive-or of the terms' hashes: terms being distinct, it is the same in any order, so
Spark adds it up in fixed space where a sorted list would have to be collected and spilled. Subsets
of several densities serve short and long texts: a sparse subset of a long text has as few terms as
a dense one of a short text. The likeness of two fingerprints is the share of equal hashes among the
subsets that either text has terms of.

A text without any term of the lexicon has one hash, of all its distinct terms, and is like only
texts with the same. Null text is empty text. Equal texts have equal fingerprints.

The lower end of the band bounds the lexicon, whatever the corpus: at most (mean distinct terms of
a text) / ``DF_FROM`` terms can be in that share of all texts. It is broadcast up to
``LEXICON_ROWS`` rows and joined by shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.frames import partitions, stored

# Shares of all texts that a term of the lexicon is in.
DF_FROM, DF_TO = 0.002, 0.1
# Density d deals the lexicon into 2**d subsets at random, of which the first ``EACH`` are used.
DENSITIES, EACH = 8, 6
FIRST = [sum(min(EACH, 2 << k) for k in range(d)) for d in range(DENSITIES + 1)]
SUBSETS = FIRST[-1]
LEXICON_ROWS = 1_000_000
# Ranges of ids whose texts are sorted together: at most FAN squared.
FAN = 128


def term_ids(text: Column) -> Column:
    """Hashes of the distinct lower-case words."""
    found = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")
    return F.array_distinct(F.transform(found, lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, text: str = "text", df_from: float = DF_FROM,
            df_to: float = DF_TO) -> DataFrame:
    """(term, subsets): terms within the band, and a bit for each subset that has the term."""
    n = texts.count()
    counts = texts.select(F.explode(term_ids(F.col(text))).alias("term")).groupBy("term").agg(
        F.count("*").alias("df"))
    bits = F.lit(0).cast("long")
    for d in range(DENSITIES):
        drawn = f"cast(pmod(xxhash64(term, {d}), {2 << d}) as int)"
        bits = bits.bitwiseOR(F.expr(
            f"if({drawn} < {EACH}, shiftleft(1L, {FIRST[d]} + {drawn}), 0L)"))
    return stored(counts.filter(F.col("df").between(df_from * n, df_to * n)).select(
        "term", bits.alias("subsets")), "lexicon")


def fingerprint(hashes: Column) -> Column:
    """As text: 8 hex digits a subset, a dash for a subset without terms."""
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(
        F.right(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit(8)), F.lit("-"))), "")


def likeness(a: Column, b: Column) -> Column:
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: z))
    some = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()),
                           lambda z: z))
    return F.when(a == b, F.lit(1.0)).when(F.size(a) != F.size(b), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(same.cast("double"), some.cast("double")), F.lit(1.0)))


def _rank(value: Column, bounds: list[int]) -> Column:
    """How many bounds a value has reached."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b <= value))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) dealt into ranges of ids, each with the first rows of the next range.

    Adds bucket, place (number within the bucket), guest (a row lent by the next range) and
    next_text. After the last document comes the first. Equal ids are ordered by text, nulls
    first. One exchange; ranges come from quantiles of all ids."""
    count = min(partitions(docs), FAN * FAN)
    parts = [k / count for k in range(1, count)]
    stats = docs.agg(
        F.percentile_approx("doc_id", parts or [0.5], max(10_000, 20 * count)).alias("bounds"),
        F.min("doc_id").alias("least"), F.count("*").alias("n"),
        F.count("doc_id").alias("known")).first()
    least = stats["least"] if stats["known"] == stats["n"] else None
    # The least id starts no range of its own.
    bounds = sorted({b for b in (stats["bounds"] or []) if b > stats["least"]}) if parts else []
    step = max(1, -(-len(bounds) // FAN))
    outer = bounds[::step]
    inner = [bounds[k:k + step] for k in range(0, len(bounds), step)]
    doc_id = F.col("doc_id")
    top = _rank(doc_id, outer)
    if inner:
        own = F.element_at(F.lit([[]] + inner).cast("array<array<bigint>>"), top + 1)
        bucket = F.greatest(top - 1, F.lit(0)) * step + F.size(F.filter(own, lambda b: b <= doc_id))
    else:
        own, bucket = F.array().cast("array<bigint>"), top
    bucket = F.when(doc_id.isNull(), F.lit(0)).otherwise(bucket)
    last = len(bounds)
    place = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"), F.lit(0).alias("turn"))
    lent = F.struct((bucket - 1).alias("bucket"), F.lit(True).alias("guest"),
                    F.lit(0).alias("turn"))
    wrapped = F.struct(F.lit(last).alias("bucket"), F.lit(True).alias("guest"),
                       F.lit(1).alias("turn"))
    starts = F.array_contains(own, doc_id)
    dealt = docs.withColumn("at", F.explode(F.concat(
        F.array(place), F.when(starts, F.array(lent)).otherwise(F.array().cast(
            "array<struct<bucket:int,guest:boolean,turn:int>>")),
        F.when(doc_id.eqNullSafe(F.lit(least).cast("long")), F.array(wrapped)).otherwise(
            F.array().cast("array<struct<bucket:int,guest:boolean,turn:int>>")))))
    flat = dealt.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "at.*")
    sorted_ = Window.partitionBy("bucket").orderBy("turn", F.col("doc_id").asc_nulls_first(),
                                                   "text")
    return flat.repartition(max(1, last + 1), "bucket").select(
        "*", F.row_number().over(sorted_).alias("place"),
        F.lead("text").over(sorted_).alias("next_text"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """For every row (doc_id, text): n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. The edited text has its last quarter replaced by the beginning of
    the next document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms = lexicon(docs)
    if terms.count() <= LEXICON_ROWS:
        terms = F.broadcast(terms)
    rows = in_order(docs)
    edited = F.expr("concat(substring(text, 1, char_length(text) - char_length(text) div 4), "
                    "substring(next_text, 1, char_length(text) div 4))")
    rows = rows.withColumn("edited", F.when(~F.col("guest"), edited)).withColumns({
        "own_terms": term_ids(F.col("text")),
        "edited_terms": F.when(~F.col("guest"), term_ids(F.col("edited"))),
        "n_chars": F.char_length("text").cast("long"), "digest": F.sha2("edited", 256)})

    # An entry for each term of either text, and one a text that brings the row's other values, all
    # of fixed size, so that everything below is a hash aggregation.
    def entries(column: str, version: int) -> Column:
        terms_ = F.coalesce(F.col(column), F.array().cast("array<bigint>"))
        none = F.array(F.struct(F.lit(version).alias("version"),
                                F.lit(None).cast("long").alias("term")))
        return F.concat(none, F.transform(terms_, lambda t: F.struct(
            F.lit(version).alias("version"), t.alias("term"))))

    quarters = [F.conv(F.substring("digest", 1 + 16 * k, 16), 16, -10).cast("long")
                for k in range(4)]
    spread = rows.select(
        "bucket", "place", "doc_id", "guest", "n_chars",
        F.xxhash64(F.array_sort("own_terms")).alias("all0"),
        F.xxhash64(F.array_sort("edited_terms")).alias("all1"),
        *[q.alias(f"q{k}") for k, q in enumerate(quarters)],
        F.explode(F.concat(entries("own_terms", 0), entries("edited_terms", 1))).alias("entry"))
    carried = F.col("entry.term").isNull()
    spread = spread.select(
        "bucket", "place", "entry.*", *[F.when(carried, F.col(c)).alias(c) for c in (
            "doc_id", "guest", "n_chars", "q0", "q1", "q2", "q3")],
        F.when(carried, F.when(F.col("entry.version") == 0, F.col("all0")).otherwise(
            F.col("all1"))).alias("everything"))
    found = spread.join(terms, "term", "left").filter(
        F.col("term").isNull() | F.col("subsets").isNotNull())

    def subset(k: int) -> Column:
        return F.bit_xor(F.when(F.col("subsets").bitwiseAND(F.lit(1 << k)) != 0,
                                F.xxhash64("term"))).alias(f"h{k}")

    # A text's rows lie in one partition already: neither the sums nor the window is an exchange.
    texts = found.groupBy("bucket", "place", "version").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "guest", "n_chars", "everything",
                                      "q0", "q1", "q2", "q3")],
        *[subset(k) for k in range(SUBSETS)])
    each = [F.col(f"h{k}") for k in range(SUBSETS)]
    texts = texts.select(
        "bucket", "place", "version", "doc_id", "guest", "n_chars",
        F.concat(*[F.lpad(F.lower(F.hex(f"q{k}")), 16, "0") for k in range(4)]
                 ).alias("edited_sha256"),
        F.when(F.coalesce(*each).isNotNull(), F.array(*each)).otherwise(
            F.array("everything")).alias("own"))
    # A document's own text, its edited text, and the next document's own text follow each other.
    following = Window.partitionBy("bucket").orderBy("place", "version")
    pairs = texts.withColumns({"new": F.lead("own", 1).over(following),
                               "after": F.lead("own", 2).over(following)})
    return pairs.filter((F.col("version") == 0) & ~F.col("guest")).select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"))
