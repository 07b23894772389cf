"""Samples over distinct ids, links between sizes, and one pass for a token round trip."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from tallybook.llm import bpe, jaccard, toxicity
from tests.llm.conftest import prose

LABELS = "doc_id long, toxic int"


def test_repeated_labels_and_ids_without_documents_change_nothing(spark):
    rows = [(k, ("vile scum " if k % 2 else "kind words ") + prose(k, 20)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)], LABELS)
    many = labels.unionByName(spark.createDataFrame(
        [(3, 1)] * 2000 + [(4, 0)] * 2000 + [(1000 + k, k % 2) for k in range(500)], LABELS))
    one, two = (toxicity.fit(docs, found, sample=60) for found in (labels, many))
    assert np.array_equal(one.weights, two.weights) and one.intercept == two.intercept
    assert np.count_nonzero(one.weights)


def test_round_trip_is_encode_and_decode(spark, odd_docs):
    vocabulary = bpe.read_vocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    columns = ["doc_id", "text", "n_tokens", "token_ids", "decoded"]
    one = bpe.round_trip(odd_docs, vocabulary).select(*columns).collect()
    two = bpe.decode(bpe.encode(odd_docs, vocabulary), vocabulary).select(*columns).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_links_between_chunks_of_sizes(spark, monkeypatch):
    """Chunks of a few members, so that size classes and parts decide which of them meet."""
    monkeypatch.setattr(jaccard, "CHUNK", 6)
    base = prose(1, 300).split()
    texts = [" ".join(base[:n]) for n in range(60, 300, 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = [len(t.split()) - 4 for t in texts]
    want = {k: sum(100 * min(a, b) >= 75 * max(a, b) for b in sizes) - 1
            for k, a in enumerate(sizes)}
    found = jaccard.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["n_verified"] for r in found} == want
    assert {r["component_id"] for r in found} == {0}
    plain = jaccard.near_duplicates(docs, links=False)
    assert "n_verified" not in plain.columns and plain.filter(F.col("component_id") > 0).count() == 0
