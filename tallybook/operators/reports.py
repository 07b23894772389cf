"""Reports over reconciliation results. All are aggregations with map-side partials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.money import sum_or_zero
from tallybook.operators.results import RESULT_COLUMNS

INTERVALS = ("day", "week", "month")
STATUSES = ("MATCHED", "PARTIAL", "UNMATCHED")


def _totals() -> list[Column]:
    return [F.count("*").alias("count"),
            sum_or_zero(F.col("discrepancy_amount")).alias("total_discrepancy_amount")]


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("batch_id", "match_status").agg(*_totals())


def discrepancies(results: DataFrame) -> DataFrame:
    return results.filter(F.col("match_status").isin("PARTIAL", "UNMATCHED")).select(
        *RESULT_COLUMNS)


def _status_counts() -> list[Column]:
    status = F.col("match_status")
    return [F.count_if(status == word).alias(f"{word.lower()}_count")
            for word in STATUSES]


def summary_metrics() -> list[Column]:
    """What ``summary`` says of one batch as columns of a single row, to be observed while the
    results are written."""
    amount = F.col("discrepancy_amount")
    return [*_status_counts(),
            *[sum_or_zero(F.when(F.col("match_status") == word, amount)).alias(
                f"{word.lower()}_amount") for word in STATUSES]]


def observed_summary(spark: SparkSession, batch_id: str, seen: dict) -> DataFrame:
    """The rows of ``summary`` from observed metrics; a status that no result has gives none."""
    rows = [(batch_id, word, seen[f"{word.lower()}_count"], seen[f"{word.lower()}_amount"])
            for word in STATUSES if seen.get(f"{word.lower()}_count")]
    return spark.createDataFrame(
        rows, "batch_id string, match_status string, count long, "
              "total_discrepancy_amount decimal(28,2)")


def batch_stats(results: DataFrame) -> DataFrame:
    return results.groupBy("batch_id").agg(
        F.count("*").alias("total_transactions"), *_status_counts(),
        sum_or_zero(F.col("discrepancy_amount")).alias("total_discrepancy_amount"))


def batch_report(batches: DataFrame, results: DataFrame) -> DataFrame:
    """Every batch with its statistics, null for a batch without results. Counts that the batch
    row itself carries keep their names; the statistics get the prefix ``result_``."""
    stats = batch_stats(results)
    stats = stats.select("batch_id", *[
        F.col(c).alias(f"result_{c}") if c in batches.columns else F.col(c)
        for c in stats.columns if c != "batch_id"])
    return batches.join(stats, "batch_id", "left")


def time_series(results: DataFrame, interval: str = "day") -> DataFrame:
    """Counts per period and status. A day is a date; a week starts on Monday."""
    if interval not in INTERVALS:
        raise ValueError(f"interval {interval!r} is none of {INTERVALS}")
    when = F.col("reconciliation_timestamp")
    period = F.to_date(when) if interval == "day" else F.date_trunc(interval, when)
    return (results.groupBy(period.alias("period"), "match_status").agg(*_totals())
            .orderBy("period", "match_status"))


def by_source_system(results: DataFrame, batches: DataFrame) -> DataFrame:
    """Counts per source and status; a result counts under every source of its batch.

    Results are summed per batch and status before the join and the explode, so that neither
    sees a row per result.
    """
    per_batch = summary(results)
    return (per_batch.join(batches.select("batch_id", "source_systems"), "batch_id")
            .withColumn("source_system", F.explode("source_systems"))
            .groupBy("source_system", "match_status")
            .agg(F.sum("count").alias("count"),
                 F.sum("total_discrepancy_amount").cast("decimal(28,2)")
                  .alias("total_discrepancy_amount"))
            .orderBy("source_system", "match_status"))


def match_rate(results: DataFrame, partial_counts: bool = False) -> DataFrame:
    """One row: the share of matched results, 0 if there are none. ``partial_counts`` takes
    partial matches as matched, and gives percent."""
    good = ["MATCHED", "PARTIAL"] if partial_counts else ["MATCHED"]
    rate = F.coalesce(F.avg(F.col("match_status").isin(*good).cast("double")), F.lit(0.0))
    return results.agg((rate * 100 if partial_counts else rate).alias("match_rate"))


def batch_totals(results: DataFrame) -> DataFrame:
    """Counts for the batch row; a partial match counts as matched here."""
    matched = F.count_if(F.col("match_status").isin("MATCHED", "PARTIAL"))
    unmatched = F.count_if(F.col("match_status") == "UNMATCHED")
    return results.groupBy("batch_id").agg(
        matched.alias("matched_count"), unmatched.alias("unmatched_count"),
        (matched + unmatched).alias("total_transactions"))


def with_report_id(report: DataFrame, report_name: str, at: Column) -> DataFrame:
    """Add report_id, the same again for the same report row and time, and report_timestamp."""
    content = F.to_json(F.struct(*[F.col(c) for c in report.columns]))
    return report.withColumns({
        "report_id": F.sha2(F.concat_ws("|", F.lit(report_name), at.cast("string"), content), 256),
        "report_timestamp": at,
    })
