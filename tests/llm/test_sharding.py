"""The Feistel shuffle: a permutation, reproducible, computable both ways, bears odd tables."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import sharding


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 3000), seed=st.integers(0, 1 << 63))
def test_permutation_and_its_inverse(n, seed):
    places = sharding.permuted(np.arange(n), n, seed)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.permuted(places, n, seed, back=True).tolist() == list(range(n))


def test_wide_numbers_and_numbers_outside():
    n = (1 << 64) - 5
    for number in (0, 1, n - 1):
        shard, slot = sharding.locate(number, n, 1000, 3)
        assert sharding.number_at(shard, slot, n, 1000, 3) == number
    with pytest.raises(ValueError):
        sharding.permuted(np.array([10]), 10, 3)


def test_places_look_shuffled():
    places = sharding.permuted(np.arange(10_000), 10_000, 5).astype(float)
    assert abs(np.corrcoef(np.arange(10_000), places)[0, 1]) < 0.05
    other = sharding.permuted(np.arange(10_000), 10_000, 6).astype(float)
    assert abs(np.corrcoef(places, other)[0, 1]) < 0.05


@pytest.mark.parametrize("shards", [1, 3, 8, 100])
def test_shards_of_odd_rows(spark, odd_docs, shards):
    docs = odd_docs.withColumnRenamed("score", "Shard").withColumn("_piece", F.lit("x"))
    rows = sharding.shuffled(docs, ["doc_id"], shards, 9).collect()
    n = docs.count()
    assert sorted(r["row_number"] for r in rows) == list(range(n))
    by_shard = {}
    for r in rows:
        assert sharding.locate(r["row_number"], n, shards, 9) == (r["shard"], r["slot"])
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by_shard.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["row_number"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_same_result_however_stored(spark):
    rows = [(k % 40 if k % 3 else None, f"t{k % 17}") for k in range(500)]
    one = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    two = spark.createDataFrame(rows[::-1], "doc_id long, text string").coalesce(1)
    found = [sorted(map(str, sharding.shuffled(d, ["doc_id"], 8, 1).collect())) for d in (one, two)]
    assert found[0] == found[1]


def test_a_row_of_a_third_of_the_table_is_spread(spark):
    docs = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias(
        "doc_id"), F.lit("same").alias("text"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        rows = sharding.numbered(docs.repartition(4), ["doc_id"])[0]
    finally:
        spark.conf.set(coalesce, "true")
    largest = rows.filter("doc_id = 1").groupBy(F.input_file_name()).count().agg(F.max("count"))
    assert largest.first()[0] < 2800  # the table has four pieces of 2250 rows


def test_empty_table(spark, no_docs):
    found = sharding.shuffled(no_docs, ["doc_id"], 8, 1)
    assert found.count() == 0 and {"row_number", "shard", "slot"} <= set(found.columns)
