from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import pages, reports
from tallybook.schemas import BATCHES, RESULTS

T0 = datetime(2024, 2, 28, 22)


@pytest.fixture(scope="module")
def results(spark):
    kinds = [("MATCHED", None, None), ("MATCHED", None, None), ("PARTIAL", "AMOUNT", "1.50"),
             ("UNMATCHED", "MISSING_PRIMARY", "20.00")]
    rows = []
    for b in ("b1", "b2"):
        for i, (status, kind, amount) in enumerate(kinds * (2 if b == "b2" else 1)):
            rows.append((f"{b}-{i}", b, f"p{i}", f"s{i}", status, kind,
                         Decimal(amount) if amount else None, T0 + timedelta(days=i), "n"))
    return spark.createDataFrame(rows, RESULTS)


@pytest.fixture(scope="module")
def batches(spark):
    def b(name, day, sources, status):
        return (name, T0 + timedelta(days=day), sources, T0, T0, status, 0, 0, 0, T0, None)
    return spark.createDataFrame(
        [b("b1", 1, ["core", "card"], "COMPLETED"), b("b2", 2, ["core", "gate"], "FAILED"),
         b("b3", 2, ["core", "gate"], "COMPLETED")], BATCHES)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_summary(results):
    assert sorted(rows(reports.summary(results)))[:3] == [
        ("b1", "MATCHED", 2, Decimal("0.00")), ("b1", "PARTIAL", 1, Decimal("1.50")),
        ("b1", "UNMATCHED", 1, Decimal("20.00"))]


def test_batch_report(results, batches):
    out = {r["batch_id"]: r for r in reports.batch_report(batches, results).collect()}
    b2 = out["b2"]
    assert (b2["result_total_transactions"], b2["result_matched_count"], b2["partial_count"],
            b2["total_discrepancy_amount"]) == (8, 4, 2, Decimal("43.00"))
    assert out["b3"]["partial_count"] is None


def test_time_series(results):
    assert rows(reports.time_series(results, "day"))[0] == (
        date(2024, 2, 28), "MATCHED", 2, Decimal("0.00"))
    weeks = {r[0] for r in rows(reports.time_series(results, "week"))}
    assert weeks == {datetime(2024, 2, 26), datetime(2024, 3, 4)}
    months = {r[0] for r in rows(reports.time_series(results, "month"))}
    assert months == {datetime(2024, 2, 1), datetime(2024, 3, 1)}
    with pytest.raises(ValueError, match="is none of"):
        reports.time_series(results, "year")


def test_source_report(results, batches):
    out = rows(reports.by_source_system(results, batches))
    assert out[:3] == [("card", "MATCHED", 2, Decimal("0.00")),
                       ("card", "PARTIAL", 1, Decimal("1.50")),
                       ("card", "UNMATCHED", 1, Decimal("20.00"))]
    assert ("core", "MATCHED", 6, Decimal("0.00")) in out and out == sorted(out)


def test_rates_and_totals(results):
    assert reports.match_rate(results).first()[0] == 0.5
    assert reports.match_rate(results, partial_counts=True).first()[0] == 75.0
    assert reports.match_rate(results.limit(0)).first()[0] == 0.0
    assert sorted(rows(reports.batch_totals(results))) == [("b1", 3, 1, 4), ("b2", 6, 2, 8)]


def test_discrepancies(results):
    out = reports.discrepancies(results)
    assert out.count() == 6 and len(out.columns) == 9


def test_report_ids(results):
    at = F.lit(T0)
    def run():
        report = reports.with_report_id(reports.summary(results), "summary", at)
        return {r["report_id"] for r in report.collect()}
    assert run() == run() and len(run()) == 6


def test_pages(results, batches):
    assert [r["batch_id"] for r in pages.batches_page(batches).collect()] == ["b2", "b3", "b1"]
    assert [r["batch_id"] for r in
            pages.batches_page(batches, 1, 1, "COMPLETED").collect()] == ["b1"]
    page = pages.results_page(results, "b2", "MATCHED", limit=2, offset=1).collect()
    assert [r["reconciliation_id"] for r in page] == ["b2-4", "b2-1"]
    for limit in (0, 101):
        with pytest.raises(ValueError):
            pages.batches_page(batches, limit)
    with pytest.raises(ValueError):
        pages.batches_page(batches, 1, -1)


def test_batch_summary(results, batches):
    r = pages.batch_summary(batches, results, "b1").first()
    assert (r["status"], r["match_rate"]) == ("COMPLETED", 0.5)
    assert pages.batch_summary(batches, results, "b3").first()["match_rate"] == 0.0
    assert pages.batch_summary(batches, results, "b9").count() == 0


def test_pages_go_on_after_a_row(results, batches):
    whole = rows(pages.results_page(results, "b2"))
    first = pages.results_page(results, "b2", limit=3).collect()
    seen, last = [tuple(r) for r in first], first[-1]
    while True:
        page = pages.results_page(results, "b2", limit=3, after=(
            last["reconciliation_timestamp"], last["reconciliation_id"])).collect()
        if not page:
            break
        seen += [tuple(r) for r in page]
        last = page[-1]
    assert seen == whole
    with pytest.raises(ValueError, match="go on after"):
        pages.results_page(results, "b2", offset=10_001)
    assert [r["batch_id"] for r in pages.batches_page(
        batches, after=(T0 + timedelta(days=2), "b2")).collect()] == ["b3", "b1"]
