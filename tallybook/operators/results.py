"""Reconciliation results: the auditable record of every outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = [
    "reconciliation_id", "batch_id", "primary_transaction_id", "secondary_transaction_id",
    "match_status", "discrepancy_type", "discrepancy_amount", "reconciliation_timestamp", "notes",
]


def result_id(*parts: Column) -> Column:
    """An id that a re-run of the same batch gives again."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def _notes(primary_source: Column, secondary_source: Column) -> Column:
    """Fixed wordings."""
    detail = (
        F.when(F.col("discrepancy_type") == "AMOUNT",
               F.concat(F.lit("Amount discrepancy: "),
                        F.col("discrepancy_amount").cast("string")))
        .when(F.col("discrepancy_type") == "STATUS",
              F.concat(F.lit("Status discrepancy: Primary="), F.col("primary_status"),
                       F.lit(", Secondary="), F.col("secondary_status")))
        .otherwise(F.lit("")))
    both = [primary_source, F.lit(" and "), secondary_source]
    return (
        F.when(F.col("discrepancy_type") == "MISSING_SECONDARY",
               F.concat(F.lit("Transaction in "), primary_source, F.lit(" not found in "),
                        secondary_source))
        .when(F.col("discrepancy_type") == "MISSING_PRIMARY",
              F.concat(F.lit("Transaction in "), secondary_source, F.lit(" not found in "),
                       primary_source))
        .when(F.col("match_status") == "PARTIAL",
              F.concat(F.lit("Partial match between "), *both, F.lit(". "), detail))
        .otherwise(F.concat(F.lit("Exact match between "), *both)))


def _known_by(side: str, missing: str) -> Column:
    """The side's transaction id; a row without one is known by its content, a missing row by
    nothing."""
    content = F.concat_ws("~", "account_id", f"{side}_amount", f"{side}_transaction_date")
    return F.coalesce(f"{side}_transaction_id", F.when(
        F.col("discrepancy_type").eqNullSafe(F.lit(missing)), F.lit("")).otherwise(content))


def reconciliation_results(outcome_rows: DataFrame, batch_id: str | Column, primary_source: str,
                           secondary_source: str | Column, at: Column) -> DataFrame:
    """Outcome rows as rows of the results table. ``at`` is the reconciliation time: one literal
    per run, so that all rows of a run agree and a re-run can repeat it."""
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    second = F.lit(secondary_source) if isinstance(secondary_source, str) else secondary_source
    return outcome_rows.withColumns({
        "batch_id": batch,
        "reconciliation_timestamp": at,
        "notes": _notes(F.lit(primary_source), second),
        "reconciliation_id": result_id(batch, second, _known_by("primary", "MISSING_PRIMARY"),
                                       _known_by("secondary", "MISSING_SECONDARY")),
    }).select(*RESULT_COLUMNS)
