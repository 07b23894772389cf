from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallybook.operators import matching, reports, telegrams
from tallybook.plans import jobs
from tallybook.schemas import RESULTS, TELEGRAMS
from tallybook.sources.store import Store
from tests import fixtures as fx

SOURCES = ["core_banking", "card_processor"]
NOW = datetime(2024, 3, 8, 12)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    st = Store(str(tmp_path_factory.mktemp("store")))
    ps, ss = fx.random_rows(22, 60, 5)
    st.load(fx.frame(spark, ps + ss), "source_transactions")
    return st


@pytest.fixture(scope="module")
def run(spark, store):
    return jobs.reconcile(spark, store, SOURCES, start=fx.T0 - timedelta(days=1), now=NOW,
                          batch_id="RECON-1")


def test_run_records_batch_results_and_reports(spark, store, run):
    ps, ss = fx.random_rows(22, 60, 5)
    expected = fx.brute_force(ps, ss, True, True)
    matched = sum(1 for p, s in expected if p and s)
    assert (run.matched, run.unmatched) == (matched, len(expected) - matched)
    batch = jobs.get_batch(spark, store, "RECON-1").first()
    assert (batch["status"], batch["matched_count"], batch["total_transactions"]) == (
        "COMPLETED", run.matched, run.matched + run.unmatched)
    assert 0 < batch["match_rate"] < 1 and batch["completed_at"] is not None
    states = spark.read.parquet(store.path("reconciliation_batches")).orderBy("seq").collect()
    assert [r["status"] for r in states] == ["PENDING", "IN_PROGRESS", "COMPLETED"]
    before = store.batches(spark, NOW).first()
    assert before["status"] == "IN_PROGRESS" and before["completed_at"] is None
    report = spark.read.option("header", True).csv(store.path("reports") + "/RECON-1_summary")
    assert sum(int(r["count"]) for r in report.collect()) == len(expected)
    issues = spark.read.option("header", True).csv(
        store.path("reports") + "/RECON-1_discrepancies")
    assert issues.count() == len(expected) - sum(
        int(r["count"]) for r in report.filter("match_status = 'MATCHED'").collect())


def test_summary_is_observed_on_the_way(spark, store, run, tmp_path):
    written = store.read(spark, "reconciliation_results").filter("batch_id = 'RECON-1'")
    told = reports.summary(written)
    asked = []

    def watch(rows):
        seen = Observation()
        asked.append(seen)
        return rows.observe(seen, *reports.summary_metrics())

    Store(str(tmp_path / "copy")).replace_results(written, "RECON-1", watch)
    seen = reports.observed_summary(spark, "RECON-1", asked[0].get)
    assert seen.schema.simpleString() == told.schema.simpleString()
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, told.collect()))
    report = spark.read.option("header", True).csv(store.path("reports") + "/RECON-1_summary")
    assert sorted((r[1], r[2], r[3]) for r in report.collect()) == sorted(
        (r[1], str(r[2]), str(r[3])) for r in told.collect())


def test_nothing_observed_gives_no_summary(spark, tmp_path):
    st, seen = Store(str(tmp_path / "empty")), Observation()
    none = spark.createDataFrame([], RESULTS)
    st.replace_results(none, "none", lambda rows: rows.observe(seen, *reports.summary_metrics()))
    assert reports.observed_summary(spark, "none", seen.get).count() == 0


def test_repeated_run_replaces_its_results(spark, store, run):
    before = sorted(r[0] for r in store.read(spark, "reconciliation_results").select(
        "reconciliation_id").collect())
    again = jobs.reconcile(spark, store, SOURCES, start=fx.T0 - timedelta(days=1), now=NOW,
                           batch_id="RECON-1")
    after = sorted(r[0] for r in store.read(spark, "reconciliation_results").select(
        "reconciliation_id").collect())
    assert again == run and after == before


def test_other_run_is_kept_apart(spark, store, run):
    other = jobs.reconcile(spark, store, SOURCES, now=NOW, strategy="exact", batch_id="RECON-2")
    assert other.unmatched > run.unmatched
    counts = {r["batch_id"]: r["count"] for r in store.read(
        spark, "reconciliation_results").groupBy("batch_id").count().collect()}
    assert counts == {"RECON-1": run.matched + run.unmatched,
                      "RECON-2": other.matched + other.unmatched}
    assert jobs.list_batches(spark, store).count() == 2
    assert jobs.list_batches(spark, store, status="FAILED").count() == 0
    page = jobs.list_results(spark, store, "RECON-2", "UNMATCHED", limit=5)
    assert page.count() == 5 and {r["match_status"] for r in page.collect()} == {"UNMATCHED"}


def test_failed_run(spark, store, monkeypatch):
    def broken(*args, **kwargs):
        raise RuntimeError("no space")

    monkeypatch.setattr(matching, "match_star", broken)
    with pytest.raises(RuntimeError, match="no space"):
        jobs.reconcile(spark, store, SOURCES, now=NOW, batch_id="RECON-3")
    assert jobs.list_batches(spark, store, status="FAILED").first()["batch_id"] == "RECON-3"


def test_bad_arguments(spark, store):
    with pytest.raises(ValueError, match="at least one other"):
        jobs.reconcile(spark, store, ["core_banking"])
    with pytest.raises(ValueError, match="is none of"):
        jobs.reconcile(spark, store, SOURCES, strategy="best")


def test_incremental_load_adds_nothing_twice(spark, tmp_path):
    st = Store(str(tmp_path))
    first = fx.frame(spark, [fx.row("a"), fx.row("b")]).withColumn("created_at", F.lit(fx.T0))
    st.load(first, "source_transactions")
    more = fx.frame(spark, [fx.row("b"), fx.row("c")]).withColumn("created_at", F.lit(fx.T0))
    for _ in range(2):
        jobs.load_new(st, more, "core_banking")
    rows = jobs.list_transactions(spark, st, "core_banking")
    assert sorted(r["transaction_id"] for r in rows.collect()) == ["a", "b", "c"]


def test_saved_report_at_a_moment(spark, store, tmp_path):
    st = Store(str(tmp_path))
    for day, n in ((1, 5), (2, 7)):
        report = spark.createDataFrame([("MATCHED", n)], ["match_status", "n"])
        st.save_report(report, "daily", F.lit(datetime(2024, 1, day)))
    assert jobs.historical_report(spark, st, "daily").count() == 2
    then = jobs.historical_report(spark, st, "daily", datetime(2024, 1, 1, 12))
    assert [r["n"] for r in then.collect()] == [5]


def test_csv_load(spark, tmp_path):
    st = Store(str(tmp_path / "store"))
    (tmp_path / "a.csv").write_text(
        "transaction_id,source_system,transaction_date,amount,account_id,transaction_type,"
        "reference_id,status,payload,created_at,processing_timestamp\n"
        "t,core_banking,2024-01-02 03:04:05,1.00,A,fee,R,completed,,,\n")
    jobs.load_csv(spark, st, str(tmp_path / "a.csv"))
    audit = jobs.ingestion_audit(st.read(spark, "source_transactions"))
    assert [tuple(r) for r in audit["per_source"].collect()] == [("core_banking", 1)]
    assert audit["sample"].count() == 1


def test_telegram_summary_of_odd_rows(spark):
    at = datetime(2024, 1, 1, 3)
    rows = [(1, 1, None, 1, None, at, "b"), (2, 1, None, 1, at, None, "b"),
            (2, 1, 5, 1, at, at, "b"), (2, 1, 5, 1, at, at, "b")]
    pack = jobs.telegram_analysis(spark.createDataFrame(rows, TELEGRAMS))
    assert [tuple(r) for r in pack["per_month"].collect()] == [(None, None, 1), (2024, 1, 3)]
    assert [tuple(r) for r in pack["top_sources"].collect()] == [(None, 2), (5, 2)]
    assert tuple(pack["busiest_hour"].first()) == (3, 3)
    assert [tuple(r) for r in pack["handling_per_source"].collect()] == [(5, 0.0, 0.0, 0.0, 2)]
    nothing = jobs.telegram_analysis(spark.createDataFrame([], TELEGRAMS))
    assert nothing["total"].first()["rows"] == 0 and nothing["latest"].count() == 0
    assert tuple(nothing["handling_minutes"].first()) == (None, None, None)
    assert nothing["top_sources"].count() == nothing["busiest_hour"].count() == 0


def test_telegram_analysis(spark):
    rows = [(i, 1000, i % 3, 1, datetime(2024, 1 + i % 2, 1, i % 5),
             datetime(2024, 1 + i % 2, 1, i % 5, i % 7, 30) if i % 4 else None, "b")
            for i in range(1, 41)]
    pack = jobs.telegram_analysis(spark.createDataFrame(rows, TELEGRAMS))
    assert pack["total"].first()["rows"] == 40
    assert [tuple(r) for r in pack["per_month"].collect()] == [(2024, 1, 20), (2024, 2, 20)]
    assert [tuple(r) for r in pack["top_sources"].collect()] == [(1, 14), (0, 13), (2, 13)]
    assert tuple(pack["busiest_hour"].first()) == (0, 8)
    done = [r for r in rows if r[5]]
    minutes = [(r[5] - r[4]).total_seconds() / 60 for r in done]
    stats = pack["handling_minutes"].first()
    assert stats["avg_min"] == pytest.approx(sum(minutes) / len(minutes))
    assert (stats["min_min"], stats["max_min"]) == (min(minutes), max(minutes))
    assert sum(r["count"] for r in pack["handling_per_source"].collect()) == len(done)
    latest = pack["latest"].collect()
    assert len(latest) == 10 and latest[0]["DateIn"] == max(r[4] for r in done)
    frame = spark.createDataFrame(rows, TELEGRAMS)
    separate = {
        "per_month": telegrams.per_month(frame), "top_sources": telegrams.top_sources(frame),
        "busiest_hour": telegrams.busiest_hour(frame),
        "handling_minutes": telegrams.handling_minutes(frame),
        "handling_per_source": telegrams.handling_per_source(frame)}
    for name, report in separate.items():
        assert pack[name].columns == report.columns
        for one, two in zip(pack[name].collect(), report.collect(), strict=True):
            assert tuple(one) == pytest.approx(tuple(two))
    assert telegrams.in_month(frame, 2024, 2).count() == 20
    assert telegrams.in_month(frame, 2023, 12).count() == 0


def test_the_same_jobs_on_catalog_tables(spark, store, run):
    from tallybook.sources.store import CatalogStore, add_columns, create_tables
    create_tables(spark, "jobs_db")
    st = CatalogStore(spark, "jobs_db")
    ps, ss = fx.random_rows(22, 60, 5)
    st.load(fx.frame(spark, ps + ss), "source_transactions")
    for _ in range(2):
        again = jobs.reconcile(spark, st, SOURCES, start=fx.T0 - timedelta(days=1), now=NOW,
                               batch_id="RECON-1")
        assert again == run

    def ids(s):
        return sorted(r[0] for r in s.read(spark, "reconciliation_results").filter(
            "batch_id = 'RECON-1'").select("reconciliation_id").collect())

    assert ids(st) == ids(store)
    assert jobs.get_batch(spark, st, "RECON-1").first()["status"] == "COMPLETED"
    add_columns(spark, "jobs_db.source_transactions", {"checked": "STRING"})
    assert "checked" in jobs.list_transactions(spark, st, "core_banking").columns
    report = spark.createDataFrame([("MATCHED", 1)], ["match_status", "n"])
    st.save_report(report, "weekly", F.lit(datetime(2024, 1, 1)))
    assert jobs.historical_report(spark, st, "weekly", datetime(2023, 1, 1)).count() == 0
    with pytest.raises(ValueError, match="is none of"):
        st.load(fx.frame(spark, ps), "source_transactions", "ignore")


def test_reads_as_of_a_moment(spark, tmp_path):
    st = Store(str(tmp_path))
    old = fx.frame(spark, [fx.row("a")]).withColumn("created_at", F.lit(fx.T0))
    new = fx.frame(spark, [fx.row("b")]).withColumn("created_at", F.lit(NOW))
    for part in (old, new):
        st.load(part, "source_transactions")
    then = jobs.list_transactions(spark, st, as_of=fx.T0)
    assert [r["transaction_id"] for r in then.collect()] == ["a"]
    # What came after the moment is not known to a load as of then, so it is taken again.
    jobs.load_new(st, new, "core_banking", as_of=fx.T0)
    assert jobs.list_transactions(spark, st).count() == 3


def test_drawn_batch_ids_are_long(spark, store):
    run = jobs.reconcile(spark, store, SOURCES, now=NOW, strategy="exact")
    assert len(run.batch_id) == len("RECON-") + 36


def test_package_is_shipped_once(spark):
    from tallybook.session import ship_package
    ship_package(spark)
    before = list(spark.sparkContext._python_includes)
    ship_package(spark)
    assert spark.sparkContext._python_includes == before and "tallybook.zip" in before


def test_shuffles_follow_the_input(spark, tmp_path):
    from tallybook.session import remove_path, size_shuffles
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    path = str(tmp_path / "t")
    spark.range(100).repartition(9).write.parquet(path)
    try:
        assert size_shuffles(spark.read.parquet(path)) >= 4
        assert size_shuffles(spark.range(100).repartition(9)) == 18 == int(spark.conf.get(key))
    finally:
        spark.conf.unset(key)
    remove_path(spark, path)
    assert not (tmp_path / "t").exists()
