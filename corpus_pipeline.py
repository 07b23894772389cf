"""From raw documents to tokens: five stages, each on all that the one before has kept.

Each stage is (spark, docs, table folder) -> DataFrame and returns the columns of ``docs`` but for
the last; ``run`` writes every stage's result to the shared folder, reads it again, and deletes what
was written before it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import bpe, contamination, jaccard, language, passages
from tallybook.llm.frames import release, stored, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY_FILE = "byte_bpe_multi_50k.tiktoken"
# Ids of dropped documents that are broadcast at most; more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the documents that name their language; those whose text has none (null, or no
    letter) are rejected, and those that name none get the predicted one. Ambiguous ones stay: a
    short clean text is often ambiguous. If no document names a language, there is nothing to tell
    apart, and the letters alone decide."""
    model = language.fit(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language.predict(docs.withColumn("_text", F.col("text")), model, "_text", "_lang",
                             "_score", "_unsure")
    return found.filter(F.col("_lang") != language.UNKNOWN).withColumn(
        "lang", F.coalesce("lang", "_lang")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every component, whatever ids its rows share with others: that of smallest
    id, rows without one being last; among rows of that id, one of the least hash. A row with no
    other in its component stays, so does a row without words."""
    key = F.xxhash64("doc_id", "text")
    found = jaccard.near_duplicates(docs.withColumn("_key", key), "_key", links=False).filter(
        "n_shingles > 0").groupBy(F.col("doc_id").alias("_key")).agg(
        F.min("component_id").alias("component"), F.count("*").alias("n"))
    found = stored(found, "near-duplicates")
    several = found.groupBy("component").agg(F.sum("n").alias("rows")).filter("rows > 1")
    ids = docs.groupBy(key.alias("_key")).agg(F.min("doc_id").alias("doc_id"))
    members = stored(found.join(several.select("component"), "component").join(ids, "_key"),
                     "members")
    stays = members.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "_key"))["_key"].alias("first"))
    judged = stored(members.join(stays, "component").select(
        "_key", "n", (F.col("_key") == F.col("first")).alias("stays")), "judged")
    keyed = docs.withColumn("_key", key)
    kept = keyed.join(_sized(judged.filter("not stays").select("_key")), "_key", "left_anti")
    repeated = judged.filter("stays and n > 1").select("_key")
    if repeated.limit(1).count():
        least = kept.join(_sized(repeated), "_key", "left_semi").groupBy("_key").agg(
            F.min(F.struct(*docs.columns)).alias("row")).select("_key", "row.*")
        kept = kept.join(_sized(repeated), "_key", "left_anti").unionByName(least)
    return kept.select(*docs.columns)


def _sized(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; a document of nothing else goes. Null texts have
    no passages and stay. Rows of one id are one document here and don't repeat each other; a null
    id comes after all others."""
    found = passages.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    out = found.filter(~changed | (F.col("n_removed") < F.col("n_words"))).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("n_chars")))
    return out.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go. Null texts have none; without items all
    documents stay. Ids play no part."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.scan(docs, benchmark).filter(F.size("word_spans") == 0).select(
        *docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the text they decode to. A null text
    is empty and has no tokens; every row gives one, whatever its id."""
    vocabulary = bpe.read_vocabulary(
        public_tokenizers.path(VOCABULARY_FILE), public_tokenizers.PATTERN)
    return bpe.round_trip(docs.select("doc_id", "text"), vocabulary).select(
        "doc_id", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("decontamination", decontaminate),
    ("tokens", tokenize),
]

# Classifiers and merges of a vocabulary can't be expressed in SQL; the tests hold the pipeline
# against a plain version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = written()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        # What led to this result, the result before included, is of no more use.
        release(spark, start, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
