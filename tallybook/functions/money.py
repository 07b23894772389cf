"""Column expressions for money, time distance and match scores."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.schemas import MONEY
from tallybook.settings import SCORE_DAY_SECONDS


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 (fractions are cut off), for either timestamp type."""
    return F.unix_seconds(ts.cast("timestamp"))


def seconds_apart(a: Column, b: Column) -> Column:
    return F.abs(epoch_seconds(a) - epoch_seconds(b))


def amount_gap(a: Column, b: Column) -> Column:
    return F.abs(a - b).cast(MONEY)


def tolerance_literal(tolerance: Decimal | float | str) -> Column:
    """The tolerance as an exact decimal, so that the edge of the band is sharp."""
    return F.lit(Decimal(str(tolerance))).cast("decimal(10,8)")


def within_amount(primary: Column, secondary: Column, tolerance: Decimal) -> Column:
    """Relative band around the primary amount; negative primaries therefore never match."""
    return F.abs(primary - secondary) <= primary * tolerance_literal(tolerance)


def match_score(primary: Column, secondary: Column, seconds: Column) -> Column:
    """1 for identical amount and time; half a unit is lost per 100 % amount and per day."""
    gap = F.abs(primary - secondary).cast("double")
    ratio = F.when(gap == 0, F.lit(0.0)).otherwise(F.try_divide(gap, primary.cast("double")))
    return F.lit(1.0) - F.lit(0.5) * ratio - F.lit(0.5) * (
        seconds.cast("double") / F.lit(float(SCORE_DAY_SECONDS)))


def sum_or_zero(amount: Column) -> Column:
    return F.sum(F.coalesce(amount, F.lit(Decimal("0.00")).cast(MONEY))).cast("decimal(28,2)")
