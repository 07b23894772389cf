"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: table folder. BENCH_CPUS: threads. BENCH_RUNS: timed runs per query after one
warm-up; the median counts. ``naive`` is a literal transcription of the hybrid matching (cross join
and filter, each of four results evaluated from the start), run as often.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.plans.catalog import Tables, queries

HEADLINES = [
    "flagship", "exact_match", "unmatched_primary", "fuzzy_candidates", "fuzzy_best",
    "hybrid_match", "multi_source_results", "greedy_one_to_one", "rules_tagged", "prepared",
    "tx_json_decoded", "summary", "batch_report", "source_report", "page_results",
    "incremental_new", "merge_status", "as_of", "retained_versions", "per_day_source",
    "minutes_per_source", "cdc_decoded", "cdc_latest", "cdc_stream", "hybrid_match_skewed",
    "fuzzy_best_skewed", "greedy_skewed", "rule_amount_skewed", "rule_date_skewed",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def naive_hybrid(spark: SparkSession, sf_dir: str) -> None:
    """A literal transcription: join, anti joins, cross join and filter, window; each of the four
    results is evaluated from the start."""
    t = Tables(spark, sf_dir)
    keys = ["account_id", "transaction_type", "amount", "status"]

    def build() -> list[DataFrame]:
        p, s = (df.select("transaction_id", "transaction_date", *keys)
                for df in (t.core, t.second()))
        a, b = p.alias("a"), s.alias("b")
        same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
        exact = a.join(b, same).select(F.col("a.transaction_id").alias("p_id"),
                                       F.col("b.transaction_id").alias("s_id"))

        def rest(df: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
            ids = pairs.select(F.col(side).alias("transaction_id")).distinct()
            return df.join(ids, "transaction_id", "left_anti")

        left, right = rest(p, exact, "p_id"), rest(s, exact, "s_id")
        a, b = left.alias("a"), right.alias("b")
        gap = F.abs(F.col("a.amount") - F.col("b.amount"))
        apart = F.abs(F.unix_timestamp(F.col("a.transaction_date").cast("timestamp"))
                      - F.unix_timestamp(F.col("b.transaction_date").cast("timestamp")))
        near = (a.crossJoin(b).filter(
            (F.col("a.account_id") == F.col("b.account_id"))
            & (F.col("a.transaction_type") == F.col("b.transaction_type"))
            & (gap <= F.col("a.amount") * 0.01) & (apart <= 86400)).select(
            F.col("a.transaction_id").alias("p_id"), F.col("b.transaction_id").alias("s_id"),
            (1 - gap / F.col("a.amount") * 0.5 - apart / 86400 * 0.5).alias("score")))
        best = near.withColumn("n", F.row_number().over(
            Window.partitionBy("p_id").orderBy(F.col("score").desc()))).filter("n = 1")
        matched = exact.unionByName(best.select("p_id", "s_id"))
        return [matched, matched, rest(left, best, "p_id"), rest(right, best, "s_id")]

    for df in build():
        consume(df)


def timed(run: Callable[[], None], runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
             .config("spark.driver.memory", "12g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    all_queries = queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        seconds[name] = timed(lambda: consume(all_queries[name](spark, sf_dir)), runs)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    naive = timed(lambda: naive_hybrid(spark, sf_dir), runs)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "naive": {"hybrid_match": naive},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
