"""Named queries over the warehouse tables: each is (spark, table folder) -> DataFrame.

Times are shown as plain timestamps of the UTC session. Averages are rounded to six digits, so
that the order of summation does not show.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators import (entitlements, history, matching, normalize, one_to_one, pages,
                                 pairs, profile, reports, results, rules, tables, telegrams)
from tallybook.schemas import TRANSACTIONS
from tallybook.session import configure, scratch_path
from tallybook.sources import feeds, files, json_rows, scans, store
from tallybook.streaming import cdc

Query = Callable[[SparkSession, str], DataFrame]
SYSTEMS = ["core_banking", "card_processor", "payment_gateway"]

# Moments and batches the queries ask about.
RANGE = (datetime(1996, 3, 1), datetime(1998, 9, 30, 12))
CUT = datetime(1999, 1, 1)
AS_OF = datetime(1998, 6, 15)
MOMENTS = [datetime(year, month, 1) for year in range(1993, 1999) for month in (1, 4, 7, 10)]
A_BATCH = "CARD-1997-03"
BATCH_STATES = ["PENDING", "IN_PROGRESS", "COMPLETED", "FAILED"]


def plain(df: DataFrame) -> DataFrame:
    """Instants as plain timestamps."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields])


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


# One account of the skewed feeds has a third of all rows, nineteen have the rest.
FEW_ACCOUNTS = "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 20 END"


class Tables:
    """The derived inputs of one table folder; ``skewed``: with few accounts."""

    def __init__(self, spark: SparkSession, sf_dir: str, skewed: bool = False):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.skewed = skewed
        self._frames: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._frames:
            frame = feeds.read_table(self.spark, self.sf_dir, name)
            if self.skewed and name == "orders":
                frame = frame.withColumn("o_custkey", F.expr(FEW_ACCOUNTS))
            self._frames[name] = frame
        return self._frames[name]

    @property
    def core(self) -> DataFrame:
        return feeds.primary_feed(self.read("orders"))

    def second(self, system: str = "card_processor", raw: bool = False) -> DataFrame:
        return feeds.secondary_feed(self.read("orders"), system, raw)

    def transactions(self, raw: bool = False) -> DataFrame:
        return feeds.all_feeds(self.read("orders"), raw)

    @property
    def telegrams(self) -> DataFrame:
        return feeds.telegrams(self.read("events"))

    @property
    def messages(self) -> DataFrame:
        return feeds.change_messages(self.read("events"))

    @property
    def history(self) -> DataFrame:
        return feeds.status_history(self.read("orders"))

    def star(self) -> DataFrame:
        return matching.match_star(self.transactions(), SYSTEMS)

    def results(self) -> DataFrame:
        """Results of the star, one batch per second system and month, dated by transaction."""
        at = F.coalesce("primary_transaction_date", "secondary_transaction_date")
        batch = F.concat(_batch_prefix(F.col("secondary_source")), F.date_format(at, "yyyy-MM"))
        return results.reconciliation_results(
            self.star(), batch, SYSTEMS[0], F.col("secondary_source"), at)

    def batches(self) -> DataFrame:
        months = self.core.groupBy(F.date_format("transaction_date", "yyyy-MM").alias("month")).agg(
            F.min("transaction_date").alias("start_date"),
            F.max("transaction_date").alias("end_date"), F.count("*").alias("n"))
        state = F.element_at(F.array(*[F.lit(s) for s in BATCH_STATES]),
                             F.substring("month", 6, 2).cast("int") % 4 + 1)
        return months.withColumns({
            "system": F.explode(F.array(*[F.lit(s) for s in SYSTEMS[1:]])), "status": state,
        }).select(
            F.concat(_batch_prefix(F.col("system")), "month").alias("batch_id"),
            F.col("end_date").alias("reconciliation_date"),
            F.array(F.lit(SYSTEMS[0]), F.col("system")).alias("source_systems"),
            "start_date", "end_date", "status", F.col("n").alias("total_transactions"),
            F.lit(0).cast("long").alias("matched_count"),
            F.lit(0).cast("long").alias("unmatched_count"),
            F.col("start_date").alias("created_at"),
            F.when(F.col("status") == "COMPLETED", F.col("end_date")).alias("completed_at"))


def _batch_prefix(system: Column) -> Column:
    return F.when(system == "card_processor", "CARD-").otherwise("GATE-")


def _flat(batches: DataFrame) -> DataFrame:
    return batches.withColumn("source_systems", F.array_join("source_systems", ","))


def _batch_results(t: Tables, at: Column) -> DataFrame:
    rows = matching.outcomes(t.core, t.second())
    return results.reconciliation_results(rows, "RECON-1", SYSTEMS[0], SYSTEMS[1], at)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid reconciliation of the core feed against the card feed, and its summary."""
    t = Tables(spark, sf_dir)
    return reports.summary(_batch_results(t, F.lit(AS_OF)))


# -- matching ------------------------------------------------------------------------------

def exact_match(t: Tables) -> DataFrame:
    return pairs.exact_pairs(t.core, t.second())


def unmatched_primary(t: Tables) -> DataFrame:
    return pairs.unmatched_rows(t.core, t.second())


def unmatched_secondary(t: Tables) -> DataFrame:
    return pairs.unmatched_rows(t.second(), t.core)


def fuzzy_candidates(t: Tables) -> DataFrame:
    return pairs.fuzzy_candidates(t.core, t.second()).select(
        "primary_transaction_id", "secondary_transaction_id", *pairs.GROUP, "amount_diff",
        "date_diff_seconds")


def fuzzy_best(t: Tables) -> DataFrame:
    return matching.match_transactions(t.core, t.second(), "fuzzy").matched


def hybrid_match(t: Tables) -> DataFrame:
    return matching.match_transactions(t.core, t.second(), "hybrid").matched


def hybrid_match_gateway(t: Tables) -> DataFrame:
    return matching.match_transactions(t.core, t.second("payment_gateway"), "hybrid").matched


def recon_results(t: Tables) -> DataFrame:
    return _batch_results(t, F.col("primary_transaction_date")).drop("reconciliation_timestamp")


def multi_source_results(t: Tables) -> DataFrame:
    return t.results()


def greedy_one_to_one(t: Tables) -> DataFrame:
    return one_to_one.one_to_one(t.core, t.second())


# -- rules ---------------------------------------------------------------------------------

def _rule(rule: Callable[[], rules.Rule], *more: str) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        return rule().apply(t.core, t.second()).select(
            "p_transaction_id", "s_transaction_id", "p_reference_id", "s_reference_id", *more)
    return query


def rules_tagged(t: Tables) -> DataFrame:
    return rules.tagged_standard(t.core, t.second()).select(
        "rule_name", "p_transaction_id", "s_transaction_id", "discrepancy_type")


# -- feeds ---------------------------------------------------------------------------------

def scan_range(t: Tables) -> DataFrame:
    return scans.source_in_range(t.transactions(), "card_processor", *RANGE)


def multi_source_scan(t: Tables) -> DataFrame:
    rows = scans.sources_in_range(t.transactions(), SYSTEMS[:2], *RANGE)
    by_source = scans.split_by_source(rows, SYSTEMS[:2])
    return by_source[SYSTEMS[0]].unionByName(by_source[SYSTEMS[1]])


def standardized(t: Tables) -> DataFrame:
    return normalize.standardize(t.transactions(raw=True).drop("created_at"))


def normalized(t: Tables) -> DataFrame:
    return normalize.normalize_source(normalize.standardize(t.transactions(raw=True))).select(
        "transaction_id", "source_system", "status", "transaction_type")


def enriched(t: Tables) -> DataFrame:
    return normalize.enrich(t.core)


def prepared(t: Tables) -> DataFrame:
    return normalize.prepare(t.transactions(raw=True))


def tx_json(t: Tables) -> DataFrame:
    return json_rows.encode(t.core)


def tx_json_decoded(t: Tables) -> DataFrame:
    return json_rows.decode(json_rows.encode(t.core), TRANSACTIONS)


# -- reports -------------------------------------------------------------------------------

def summary(t: Tables) -> DataFrame:
    return reports.summary(t.results())


def batch_report(t: Tables) -> DataFrame:
    batches = t.batches().select("batch_id", "status", "reconciliation_date")
    return reports.batch_report(batches, t.results())


def _series(interval: str) -> Callable[[Tables], DataFrame]:
    return lambda t: reports.time_series(t.results(), interval)


def source_report(t: Tables) -> DataFrame:
    return reports.by_source_system(t.results(), t.batches())


def discrepancies(t: Tables) -> DataFrame:
    return reports.discrepancies(t.results())


def match_rate(t: Tables) -> DataFrame:
    return rounded(reports.match_rate(t.results()), "match_rate")


def match_rate_pct(t: Tables) -> DataFrame:
    return rounded(reports.match_rate(t.results(), partial_counts=True), "match_rate")


def batch_totals(t: Tables) -> DataFrame:
    return reports.batch_totals(t.results())


# -- pages ---------------------------------------------------------------------------------

def page_batches(t: Tables) -> DataFrame:
    return _flat(pages.batches_page(t.batches(), limit=10, offset=5, status="COMPLETED"))


def page_results(t: Tables) -> DataFrame:
    return pages.results_page(t.results(), A_BATCH, "UNMATCHED", limit=100)


def page_transactions(t: Tables) -> DataFrame:
    return pages.transactions_page(t.transactions(), "card_processor", *RANGE, limit=100, offset=20)


def page_after(t: Tables) -> DataFrame:
    """The page that follows a given row."""
    return pages.transactions_page(t.transactions(), "card_processor", limit=100,
                                   after=(datetime(1997, 3, 1), "CP-1"))


def batch_summary(t: Tables) -> DataFrame:
    return _flat(rounded(pages.batch_summary(t.batches(), t.results(), A_BATCH), "match_rate"))


# -- tables --------------------------------------------------------------------------------

def incremental_new(t: Tables) -> DataFrame:
    existing = t.transactions().filter(F.col("transaction_date") < F.lit(CUT))
    return tables.new_transactions(t.second(), existing, "card_processor")


def category_update(t: Tables) -> DataFrame:
    return normalize.with_category(
        t.transactions(), F.col("source_system") == "core_banking").select(
        "transaction_id", "source_system", "transaction_type", "transaction_category")


def merge_status(t: Tables) -> DataFrame:
    target = t.transactions().select("transaction_id", "source_system", "status", "amount")
    return tables.merge(target, tables.pending_updates(target), "transaction_id", "id", ["status"])


def replace_batch_row(t: Tables) -> DataFrame:
    return _flat(tables.replace_batch(t.batches(), A_BATCH, "COMPLETED", F.lit(AS_OF), 120, 30))


def as_of(t: Tables) -> DataFrame:
    return history.as_of(t.history, "transaction_id", AS_OF)


def as_of_months(t: Tables) -> DataFrame:
    """Rows and amounts by status as they were at the beginning of every quarter, in one scan."""
    return history.as_of_each(t.history, "transaction_id", MOMENTS).groupBy(
        "moment", "status").agg(F.count("*").alias("count"), F.sum("amount").alias("amount"))


def store_merged(t: Tables) -> DataFrame:
    """A table of six months in which telegrams of one month get a new destination, in place."""
    kept = _months_stored(t)
    moved = kept.read(t.spark, "telegrams").filter(
        (F.col("month_in") == "2024-03") & (F.col("TelegramCode") % 3 == 0)).select(
        F.col("Id").alias("changed"), F.lit(9).alias("Destination"))
    kept.merge(t.spark, "telegrams", moved, "Id", "changed", ["Destination"])
    return kept.read(t.spark, "telegrams").drop("month_in")


def _months_stored(t: Tables) -> store.Store:
    kept = store.Store(scratch_path(t.spark, "months"))
    kept.load(feeds.telegrams_of_months(t.read("events")), "telegrams")
    return kept


def month_rows_stored(t: Tables) -> DataFrame:
    """The month predicate on a stored table of six months, of which one is read."""
    return telegrams.in_month(_months_stored(t).read(t.spark, "telegrams"), 2024, 3).drop(
        "month_in")


def commit_log(t: Tables) -> DataFrame:
    return history.commit_log(t.history)


def last_commits(t: Tables) -> DataFrame:
    return history.last_commits(t.history, 5)


def retained_versions(t: Tables) -> DataFrame:
    return history.retained(t.history, "transaction_id", AS_OF)


def changes_between(t: Tables) -> DataFrame:
    return history.changes_between(t.history, *RANGE)


def created_after(t: Tables) -> DataFrame:
    return tables.created_after(t.transactions(), CUT)


# -- profiles ------------------------------------------------------------------------------

def type_category(t: Tables) -> DataFrame:
    rows = normalize.with_category(t.transactions())
    return profile.per_type(rows, "core_banking", with_category=True)


def row_counts(t: Tables) -> DataFrame:
    return profile.row_counts({"source_transactions": t.transactions(),
                               "telegrams": t.telegrams, "history": t.history})


# -- telegrams -----------------------------------------------------------------------------

def minutes_fractional(t: Tables) -> DataFrame:
    return rounded(telegrams.handling_minutes(t.telegrams), "avg_min", "min_min", "max_min")


def telegram_summary(t: Tables) -> DataFrame:
    """The analysis pack's counts and handling times over several months, from one scan."""
    found = telegrams.summary(feeds.telegrams_of_months(t.read("events")))
    return found.select("part", "year", "month", "Source", "hour", "count", "handled",
                        *[F.round(c, 6).alias(name) for c, name in zip(
                            telegrams.summary_minutes(), ("avg_min", "min_min", "max_min"),
                            strict=True)])


def minutes_whole(t: Tables) -> DataFrame:
    return rounded(telegrams.handling_minutes(t.telegrams, fractional=False), "avg_min")


# -- change data ---------------------------------------------------------------------------

def cdc_decoded(t: Tables) -> DataFrame:
    return cdc.accepted(t.messages)


def cdc_rejected(t: Tables) -> DataFrame:
    return cdc.rejected(t.messages).select("offset", "reason")


def cdc_latest(t: Tables) -> DataFrame:
    return cdc.latest_state(t.messages)


def _streamed(t: Tables) -> tuple[str, str]:
    """Run the ingest stream over the messages, as files, to its end; table and quarantine."""
    root = scratch_path(t.spark, "cdc")
    t.messages.write.json(f"{root}/in", ignoreNullFields=False)
    query = cdc.ingest(cdc.file_messages(t.spark, f"{root}/in"), f"{root}/telegrams",
                       f"{root}/quarantine", f"{root}/checkpoint", available_now=True)
    query.awaitTermination()
    return f"{root}/telegrams", f"{root}/quarantine"


def cdc_stream(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_streamed(t)[0]).drop("ingest_batch", "month_in")


def cdc_stream_latest(t: Tables) -> DataFrame:
    """Apply the changes as a stream of files in any order, stopped and started again, with what has
    been applied folded in between."""
    root = scratch_path(t.spark, "cdc-latest")
    parts = t.messages.repartition(6, F.xxhash64("offset"))
    for half in (1, 0):
        parts.filter(F.xxhash64("value") % 2 == half if half else ~F.coalesce(
            F.xxhash64("value") % 2 == 1, F.lit(False))).write.mode("append").json(
            f"{root}/in", ignoreNullFields=False)
        cdc.apply_changes(cdc.file_messages(t.spark, f"{root}/in", 2), f"{root}/telegrams",
                          f"{root}/checkpoint", available_now=True).awaitTermination()
        if half:
            cdc.fold(t.spark, f"{root}/telegrams")
    return cdc.applied(t.spark, f"{root}/telegrams")


def cdc_stream_once(t: Tables) -> DataFrame:
    """Ingest messages of which some were sent twice."""
    root = scratch_path(t.spark, "cdc-once")
    feeds.sent_messages(t.messages).write.json(f"{root}/in", ignoreNullFields=False)
    sent = cdc.file_messages(t.spark, f"{root}/in", schema=cdc.SENT_MESSAGE)
    cdc.ingest(cdc.once(sent, "10 minutes"), f"{root}/telegrams", f"{root}/quarantine",
               f"{root}/checkpoint", available_now=True).awaitTermination()
    return t.spark.read.parquet(f"{root}/telegrams").drop("ingest_batch", "month_in")


def cdc_stream_rejected(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_streamed(t)[1]).select("offset", "reason")


def month_orders(t: Tables) -> DataFrame:
    """The month predicate on times of seven years, nearly all of which it drops."""
    return telegrams.in_month(t.core.select(
        "transaction_id", F.col("transaction_date").alias("DateIn")), 1997, 3)


# -- round trips through files and tables ----------------------------------------------------

def _core_csv(t: Tables) -> str:
    path = scratch_path(t.spark, "csv")
    store.export_csv(t.core, path)
    return path


def csv_read(t: Tables) -> DataFrame:
    return files.read_csv(t.spark, _core_csv(t))


def csv_inferred(t: Tables) -> DataFrame:
    rows = files.read_csv_inferred(t.spark, _core_csv(t))
    return rows.select("transaction_id", "transaction_date",
                       F.col("amount").cast("decimal(18,2)").alias("amount"), "status")


def _faulty_csv(t: Tables, rows: DataFrame) -> str:
    path = scratch_path(t.spark, "csv-faulty")
    feeds.faulty_lines(rows).write.option("header", True).option("quote", "").csv(path)
    return path


def csv_good(t: Tables) -> DataFrame:
    return files.read_csv_checked(t.spark, _faulty_csv(t, t.core))[0].drop("file")


def csv_rejected(t: Tables) -> DataFrame:
    rows = files.read_csv_checked(t.spark, _faulty_csv(t, t.core))[1]
    return rows.select("reason", F.substring_index("line", ",", 1).alias("transaction_id"))


def csv_new_files(t: Tables) -> DataFrame:
    """Three runs over a folder: one file set, nothing new, and another set; each file counts
    once."""
    root = scratch_path(t.spark, "csv-new")
    for run, rows in enumerate((t.core, None, t.second())):
        if rows is not None:
            feeds.faulty_lines(rows).write.option("header", True).option("quote", "").csv(
                f"{root}/in/{run}")
        files.load_new_files(t.spark, f"{root}/in", f"{root}/good", f"{root}/bad",
                             f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/good").drop("file", "load")


def payload_categories(t: Tables) -> DataFrame:
    """Transactions by type and the category that their payload names."""
    rows = json_rows.payloads(t.transactions())
    return rows.groupBy("transaction_type", json_rows.payload_field(
        "$.category", "string").alias("category")).agg(F.count("*").alias("count"))


def csv_directory(t: Tables) -> DataFrame:
    """Two feeds in one folder tree, of which one is asked for."""
    root = scratch_path(t.spark, "csv-tree")
    store.export_csv(t.core, f"{root}/core")
    store.export_csv(t.second(), f"{root}/more/card")
    return files.read_directory(t.spark, root, "card_processor")


def store_table(t: Tables) -> DataFrame:
    """Two loads into a partitioned table, read back with its partition column."""
    kept = store.Store(scratch_path(t.spark, "store"))
    for _ in range(2):
        kept.load(t.telegrams, "telegrams")
    return kept.read(t.spark, "telegrams")


def saved_results(t: Tables) -> DataFrame:
    """Results of one batch, written to the results table and read by its page query."""
    kept = store.Store(scratch_path(t.spark, "results"))
    kept.load(_batch_results(t, F.col("primary_transaction_date")).withColumn(
        "reconciliation_timestamp", F.lit(AS_OF)), "reconciliation_results")
    return pages.results_page(kept.read(t.spark, "reconciliation_results"), "RECON-1", "UNMATCHED",
                              limit=200).select("reconciliation_id", "match_status", "notes")


def granted_columns(t: Tables) -> DataFrame:
    grants = t.spark.createDataFrame(
        [("user-7", "id"), ("user-7", "DateIn"), ("user-7", "nothing"), ("user-8", "Body")],
        "user_name string, column_name string")
    return entitlements.granted_columns(t.telegrams, grants, "user-7")


# -- entitlements --------------------------------------------------------------------------

def granted_rows(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    grants = t.read("customer").select(
        F.concat(F.lit("user-"), F.col("c_nationkey").cast("string")).alias("user_name"),
        (k % 9).cast("int").alias("department"),
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(days=(k % 40).cast("int")))
        .alias("expires_at"))
    return entitlements.granted_rows(t.telegrams, "Source", grants, "user-7",
                                     datetime(2024, 2, 5)).select(
        "Id", "TelegramCode", "Source", "Destination", "DateIn", "DateOut", "Body")


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "exact_match": exact_match,
    "unmatched_primary": unmatched_primary,
    "unmatched_secondary": unmatched_secondary,
    "fuzzy_candidates": fuzzy_candidates,
    "fuzzy_best": fuzzy_best,
    "hybrid_match": hybrid_match,
    "hybrid_match_gateway": hybrid_match_gateway,
    "recon_results": recon_results,
    "multi_source_results": multi_source_results,
    "greedy_one_to_one": greedy_one_to_one,
    "rule_exact": _rule(rules.exact_match_rule),
    "rule_amount": _rule(rules.amount_tolerance_rule, "discrepancy_type", "discrepancy_amount"),
    "rule_date": _rule(rules.date_tolerance_rule, "discrepancy_type", "date_diff_seconds"),
    "rule_status": _rule(rules.status_ignore_rule, "discrepancy_type", "notes"),
    "rule_reference": _rule(rules.reference_id_rule),
    "rules_tagged": rules_tagged,
    "feed_core": lambda t: t.core,
    "feed_card": lambda t: t.second(),
    "feed_gateway": lambda t: t.second("payment_gateway"),
    "feed_card_raw": lambda t: t.second(raw=True),
    "feed_gateway_raw": lambda t: t.second("payment_gateway", raw=True),
    "feed_telegrams": lambda t: t.telegrams,
    "scan_range": scan_range,
    "multi_source_scan": multi_source_scan,
    "standardized": standardized,
    "normalized": normalized,
    "enriched": enriched,
    "prepared": prepared,
    "tx_json": tx_json,
    "tx_json_decoded": tx_json_decoded,
    "summary": summary,
    "batch_report": batch_report,
    "ts_day": _series("day"),
    "ts_week": _series("week"),
    "ts_month": _series("month"),
    "source_report": source_report,
    "discrepancies": discrepancies,
    "match_rate": match_rate,
    "match_rate_pct": match_rate_pct,
    "batch_totals": batch_totals,
    "page_batches": page_batches,
    "page_results": page_results,
    "page_transactions": page_transactions,
    "batch_summary": batch_summary,
    "incremental_new": incremental_new,
    "category_update": category_update,
    "merge_status": merge_status,
    "replace_batch_row": replace_batch_row,
    "as_of": as_of,
    "commit_log": commit_log,
    "last_commits": last_commits,
    "retained_versions": retained_versions,
    "changes_between": changes_between,
    "created_after": created_after,
    "per_source": lambda t: profile.per_source(t.transactions()),
    "per_day_source": lambda t: profile.per_day_and_source(t.transactions()),
    "per_type": lambda t: profile.per_type(t.transactions(), "core_banking"),
    "type_category": type_category,
    "row_counts": row_counts,
    "distinct_sources": lambda t: profile.distinct_sources(t.transactions()),
    "feed_profile": lambda t: profile.feed_profile(t.transactions()),
    "per_month": lambda t: telegrams.per_month(t.telegrams),
    "month_rows": lambda t: telegrams.in_month(t.telegrams, 2024, 1),
    "minutes_fractional": minutes_fractional,
    "minutes_whole": minutes_whole,
    "minutes_per_source": lambda t: telegrams.handling_per_source(t.telegrams),
    "period_counts": lambda t: telegrams.per_period(t.telegrams),
    "top_sources": lambda t: telegrams.top_sources(t.telegrams),
    "busiest_hour": lambda t: telegrams.busiest_hour(t.telegrams),
    "latest": lambda t: telegrams.latest(t.telegrams),
    "sample_rows": lambda t: telegrams.sample(t.telegrams),
    "cdc_decoded": cdc_decoded,
    "cdc_rejected": cdc_rejected,
    "cdc_latest": cdc_latest,
    "cdc_stream": cdc_stream,
    "cdc_stream_rejected": cdc_stream_rejected,
    "granted_rows": granted_rows,
    "granted_columns": granted_columns,
    "month_orders": month_orders,
    "csv_read": csv_read,
    "csv_inferred": csv_inferred,
    "csv_directory": csv_directory,
    "store_table": store_table,
    "saved_results": saved_results,
    "page_after": page_after,
    "cdc_stream_latest": cdc_stream_latest,
    "cdc_stream_once": cdc_stream_once,
    "as_of_months": as_of_months,
    "store_merged": store_merged,
    "month_rows_stored": month_rows_stored,
    "period_counts_months": lambda t: telegrams.per_period(
        feeds.telegrams_of_months(t.read("events"))),
    "telegram_summary": telegram_summary,
    "csv_good": csv_good,
    "csv_rejected": csv_rejected,
    "csv_new_files": csv_new_files,
    "payload_categories": payload_categories,
}


SKEWED: dict[str, Callable[[Tables], DataFrame]] = {
    "hybrid_match_skewed": hybrid_match,
    "fuzzy_best_skewed": fuzzy_best,
    "greedy_skewed": greedy_one_to_one,
    "rule_amount_skewed": QUERIES["rule_amount"],
    "rule_date_skewed": QUERIES["rule_date"],
}


def queries() -> dict[str, Query]:
    def bind(query: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: plain(query(Tables(spark, sf_dir)))

    def bind_skewed(query: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: plain(query(Tables(spark, sf_dir, skewed=True)))

    return {"flagship": flagship, **{name: bind(query) for name, query in QUERIES.items()},
            **{name: bind_skewed(query) for name, query in SKEWED.items()}}
