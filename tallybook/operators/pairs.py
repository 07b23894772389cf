"""Joins between a primary and a secondary feed: exact keys, and bands of amount and time."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import (amount_gap, epoch_seconds, match_score, seconds_apart,
                                       within_amount)
from tallybook.operators.skew import without
from tallybook.settings import DEFAULTS

GROUP = ["account_id", "transaction_type"]
EXACT = ["account_id", "transaction_type", "amount", "status"]
ZERO_CELL = -(10 ** 9)
# Cells are a little wider than the band, so that rounding cannot push a partner out of reach.
CELL_MARGIN = 1.001


def side(df: DataFrame, prefix: str, keys: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """The columns matching needs, prefixed, except the join keys."""
    narrow = ["transaction_id", "transaction_date", "amount", "status", *extra]
    return df.select(*keys, *[F.col(c).alias(f"{prefix}_{c}") for c in narrow])


def amount_cell(amount: Column, tolerance: float) -> Column:
    """Logarithmic cell: amounts within the band lie in the same or a neighbouring cell."""
    if tolerance >= 1:  # the band reaches down to zero
        return F.lit(0).cast("long")
    width = -math.log1p(-tolerance) * CELL_MARGIN if tolerance > 0 else 1e-9
    value = amount.cast("double")
    return (F.when(value > 0, F.floor(F.ln(value) / F.lit(width)))
            .when(value == 0, F.lit(ZERO_CELL)).cast("long"))


def time_cell(seconds: Column, tolerance: int) -> Column:
    return F.floor(seconds / F.lit(max(int(tolerance), 1))).cast("long")


def neighbours(cell: Column) -> Column:
    return F.explode(F.sequence(cell - 1, cell + 1))


def exact_pairs(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Every pair that agrees in account, type, amount and status; the date plays no part.

    A plain equi-join: AQE splits a hot key on both sides.
    """
    p, s = (df.select(*EXACT, *[F.col(c).alias(f"{name}_{c}") for c in
                                ("transaction_id", "transaction_date")])
            for df, name in ((primary, "primary"), (secondary, "secondary")))
    both = p.join(s, EXACT)
    return both.select(
        "*", *[F.col(c).alias(f"{name}_{c}") for name in ("primary", "secondary")
               for c in ("amount", "status")], F.lit("MATCHED").alias("match_status"),
        F.lit(None).cast("string").alias("discrepancy_type"),
        F.lit(None).cast("decimal(18,2)").alias("discrepancy_amount")).drop("amount", "status")


def unmatched_rows(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows, with all their columns, that have no exact partner among the others."""
    return without(rows, others, EXACT, "transaction_id")


def band_pairs(primary: DataFrame, secondary: DataFrame, keys: list[str],
               amount_tolerance: Decimal | None = None, seconds_tolerance: int | None = None,
               extra: tuple[str, ...] = ()) -> DataFrame:
    """Pairs equal in ``keys`` and within the given bands; columns are p_* and s_*.

    Each band is joined on cells as well, so that only neighbours are compared, however many rows
    share the keys.
    """
    p, s = side(primary, "p", keys, extra), side(secondary, "s", keys, extra)
    cells, holds = [], F.lit(True)
    if amount_tolerance is not None:
        cells.append("amount_cell")
        p, s = (x.withColumn("amount_cell", amount_cell(F.col(f"{n}_amount"),
                                                        float(amount_tolerance)))
                for x, n in ((p, "p"), (s, "s")))
        if float(amount_tolerance) < 1:
            p = p.withColumn("amount_cell", neighbours(F.col("amount_cell")))
        holds &= within_amount(F.col("p_amount"), F.col("s_amount"), amount_tolerance)
        if seconds_tolerance is None:
            # Many pairs from few rows: spread by cell, where a broadcast would leave them all to
            # the tasks that read the primary feed, however few.
            s = s.hint("merge")
    if seconds_tolerance is not None:
        cells.append("time_cell")
        p, s = (x.withColumn("time_cell", time_cell(epoch_seconds(
            F.col(f"{n}_transaction_date")), seconds_tolerance)) for x, n in ((p, "p"), (s, "s")))
        p = p.withColumn("time_cell", neighbours(F.col("time_cell")))
        holds &= seconds_apart(F.col("p_transaction_date"),
                               F.col("s_transaction_date")) <= seconds_tolerance
    return p.join(s, keys + cells).filter(holds).drop(*cells)


def fuzzy_candidates(primary: DataFrame, secondary: DataFrame,
                     amount_tolerance: Decimal = DEFAULTS.amount_tolerance,
                     date_tolerance_seconds: int = DEFAULTS.date_tolerance_seconds) -> DataFrame:
    """All pairs of the same account and type within both tolerances, with their score."""
    seconds = seconds_apart(F.col("p_transaction_date"), F.col("s_transaction_date"))
    pairs = band_pairs(primary, secondary, GROUP, amount_tolerance, date_tolerance_seconds)
    return pairs.select(
        F.col("p_transaction_id").alias("primary_transaction_id"),
        F.col("s_transaction_id").alias("secondary_transaction_id"), *GROUP,
        amount_gap(F.col("p_amount"), F.col("s_amount")).alias("amount_diff"),
        seconds.alias("date_diff_seconds"),
        match_score(F.col("p_amount"), F.col("s_amount"), seconds).alias("match_score"))
