"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tallybook import session
from tallybook.operators import matching, pairs, reports
from tallybook.plans.catalog import Tables, queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


@pytest.mark.parametrize("name", [
    "exact_match", "fuzzy_candidates", "hybrid_match", "rules_tagged", "multi_source_results",
    "unmatched_primary", "incremental_new", "merge_status", "granted_rows"])
def test_no_cross_joins(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rules_take_three_joins(spark):
    text = plan(queries()["rules_tagged"](spark, SF))
    assert len(re.findall(r"(?:SortMerge|ShuffledHash|BroadcastHash)Join", text)) == 3
    assert len(re.findall(r"Scan parquet", text)) <= 6


def test_pairs_of_an_amount_band_are_spread_by_cell(spark):
    text = plan(queries()["rule_amount_skewed"](spark, SF))
    assert "BroadcastHashJoin" not in text
    assert re.findall(r"SortMergeJoin \[account_id#\d+, transaction_type#\d+, amount_cell#\d+L?\]", text)


def test_matching_reads_only_what_it_needs(t):
    text = plan(pairs.exact_pairs(t.core, t.second()))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert "o_orderpriority" not in schema


def test_filters_reach_the_scan(spark):
    text = plan(queries()["month_rows"](spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_telegram_reports_read_few_columns(spark):
    text = plan(queries()["top_sources"](spark, SF))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["user_id:bigint"]


def test_top_k_instead_of_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["page_transactions"](spark, SF))


def test_a_page_takes_no_more_rows_than_it_shows(spark):
    text = plan(queries()["page_after"](spark, SF))
    assert [int(n) for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", text)] == [100]


def test_source_report_explodes_sums_not_results(t):
    results = t.results()
    text = plan(reports.by_source_system(results, t.batches()))
    lines = text.splitlines()
    explode = next(i for i, x in enumerate(lines) if "explode(source_systems" in x)
    assert any("HashAggregate(keys=[batch_id" in x for x in lines[explode:])


def test_change_messages_are_parsed_once(spark):
    for name in ("cdc_decoded", "cdc_latest"):
        text = plan(queries()[name](spark, SF))
        assert len(re.findall(r"from_json\(", text)) == 1


def test_json_messages_need_no_schema_inference(spark, t):
    assert t.messages.select(F.col("value")).schema.simpleString() == "struct<value:string>"


def test_telegram_summary_is_one_scan(spark):
    text = plan(queries()["telegram_summary"](spark, SF))
    assert len(re.findall(r"FileScan parquet|Scan parquet", text)) == 1


def test_matching_reads_each_feed_once(t, monkeypatch):
    written = []

    def noted(df):
        written.append(plan(df))
        return session.durable(df)

    monkeypatch.setattr(matching, "durable", noted)
    rows = matching.outcomes(t.core, t.second())
    texts = [*written, plan(rows)]
    assert sum(len(re.findall(r"FileScan parquet|Scan parquet", x)) for x in texts) == len(
        re.findall(r"FileScan parquet|Scan parquet", plan(t.core.unionByName(t.second()))))
    assert not re.findall(r"FileScan parquet|Scan parquet", texts[-1])


def test_left_overs_take_one_exchange_of_each_side(t, monkeypatch):
    """The rows cross the network by the exact key once; their records are counted, and only what
    is left goes by record. No written row carries its id twice or is read for the other side."""
    written = []

    def noted(df):
        written.append((df.columns, plan(df)))
        return session.durable(df)

    monkeypatch.setattr(matching, "durable", noted)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, "-1")
    try:
        matching.outcomes(t.core, t.second())
    finally:
        t.spark.conf.set(key, before)
    assert [c for c, _ in written[:2]] == [matching.NARROW] * 2
    assert all("is_primary" not in text for _, text in written)
    # Up to the fuzzy phase: the rows and keys of either side, then the counts and what is left.
    at = next(i for i, (columns, _) in enumerate(written) if "pick" in columns)
    exchanges = [len(re.findall(r"Exchange hashpartitioning", text)) for _, text in written[:at]]
    assert sorted(exchanges) == [0, 0, 2, 2, 2, 2]
