"""The registered queries, the pipeline, and the package's place in the library."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")

import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from check import compare  # noqa: E402
from tallybook.llm import catalog  # noqa: E402
from tallybook.llm.frames import release, ship_package, stored, written  # noqa: E402
from tests.llm import plain  # noqa: E402
from tests.llm.conftest import prose  # noqa: E402

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    assert name in queries()
    verdict = compare(spark, con, name, SF)
    assert verdict.startswith(("ok", "rows only")) and "TYPES" not in verdict, verdict
    assert verdict.startswith("ok") == (name in oracle_sql())


def test_scores_of_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_suffix_tree", "op5_language_id", "op9_toxicity", "op8_imatch"):
        df = queries()[name](spark, SF)
        assert df.count() == docs == df.select("doc_id").distinct().count()


def whole_texts_plainly(docs, benchmark, languages):
    """The pipeline on rows (doc_id, text), step by step."""
    kept = [(d, t) for d, t in docs if languages[d] != "und"]
    first = {d for d, _, c in plain.components(kept) if d == c}
    kept = sorted((d, t) for d, t in kept if d in first)
    least, rows = {}, [(d, t, plain.words(t, lower=False)) for d, t in kept]
    for d, _, w in rows:
        for i in range(len(w) - 49):
            least.setdefault(tuple(w[i:i + 50]), d)
    texts = []
    for d, t, w in rows:
        gone = bytearray(len(w))
        for i in range(len(w) - 49):
            if least[tuple(w[i:i + 50])] < d:
                gone[i:i + 50] = b"\1" * 50
        left = [x for x, g in zip(w, gone, strict=True) if not g]
        if not any(gone):
            texts.append((d, t))
        elif left:
            texts.append((d, b" ".join(left).decode()))
    hit = {r[0] for r in plain.contamination(texts, benchmark) if r[-1]}
    return [(d, t) for d, t in texts if d not in hit]


def test_pipeline_against_a_plain_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select(
        "item_id", "text").collect()]
    languages = {r["doc_id"]: "und" if not any(c.isalpha() for c in r["text"] or "") else "some"
                 for r in docs.collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=catalog.bpe.read_vocabulary(
            public_tokenizers.path(catalog.VOCABULARY_FILE), public_tokenizers.PATTERN).ranks)
    want = Counter((d, len(library.encode_ordinary(t)), plain.sha(t.encode()))
                   for d, t in whole_texts_plainly(rows, benchmark, languages))
    found = corpus_pipeline.run(spark, SF)
    assert Counter(tuple(r) for r in found.select(
        "doc_id", "n_tokens", "decoded_sha256").collect()) == want
    assert 0 < len(want) < len(rows)


def test_release_keeps_one_table(spark):
    start = written()
    tables = [stored(spark.range(n + 1), f"t{n}") for n in range(3)]
    release(spark, start, keep=tables[1])
    assert written() == start + 1 and tables[1].count() == 2
    release(spark, start)
    assert written() == start


def test_stages_bear_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs.withColumn("n_chars", F.char_length("text")), no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(
        spark, odd_docs, SF).collect()}
    assert {5, 8, 16} <= kept and not {6, 7, 9, 18} & kept


def test_near_duplicates_are_judged_by_row(spark):
    """Rows that share an id, or have none, are kept or dropped as their own texts ask for."""
    a, b, c, d = (prose(900 + k, 60) for k in range(4))
    rows = [(1, a), (5, a + " tail"), (5, b), (5, c), (None, d), (None, d), (None, d + " tail"),
            (7, c), (8, b + " tail"), (8, b + " tail"), (None, None), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    ends = [r for r in got if r[0] is None and r[1]]
    assert len(ends) == 1 and ends[0][1] in (d, d + " tail") and got[ends[0]] == 1
    assert got - Counter(ends) == Counter([(1, a), (5, b), (5, c), (None, None), (None, None),
                                           (9, "")])


def test_unlabelled_documents_stay(spark):
    rows = [(1, prose(1, 30), None), (2, "Re.", None), (3, None, None), (4, "12 !", None),
            (5, "\u6f22\u5b57", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 5} and kept.columns == docs.columns


def test_nothing_else_imports_the_package(tmp_path):
    for path in (ROOT / "tallybook").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text().replace("fulfill", ""), path
    for name in ("__spark_entry__.py", "oracles.py"):
        (tmp_path / name).write_text((ROOT / name).read_text())
    source = ROOT / "tallybook"
    for path in source.rglob("*.py"):
        if "llm" not in path.parts:
            to = tmp_path / "tallybook" / path.relative_to(source)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_text(path.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                         text=True, check=True).stdout.split()
    assert int(out[0]) > 80 and out[1] == "False"


def test_workers_can_import_the_package(spark):
    ship_package(spark)
    assert "tallybook.zip" in spark.sparkContext._python_includes
