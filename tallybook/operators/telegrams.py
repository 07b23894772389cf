"""The telegram analysis pack."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HANDLED = "DateOut is not null and DateIn is not null"


def minutes(fractional: bool = True) -> Column:
    """Handling time in minutes, exact to the microsecond or in whole minutes cut off."""
    micros = (F.unix_micros(F.col("DateOut").cast("timestamp"))
              - F.unix_micros(F.col("DateIn").cast("timestamp")))
    if fractional:
        return micros / F.lit(60000000.0)
    return F.expr("timestampdiff(MINUTE, DateIn, DateOut)").cast("long")


def in_month(telegrams: DataFrame, year: int, month: int) -> DataFrame:
    """A half-open range of time, which prunes files, unlike month(DateIn) = m. On a table with a
    month_in partition column that month is named too, since no engine derives it from the times."""
    after = datetime(year + month // 12, month % 12 + 1, 1)
    rows = telegrams.filter((F.col("DateIn") >= F.lit(datetime(year, month, 1)))
                            & (F.col("DateIn") < F.lit(after)))
    if "month_in" in telegrams.columns:
        rows = rows.filter(F.col("month_in") == f"{year:04d}-{month:02d}")
    return rows


def per_month(telegrams: DataFrame) -> DataFrame:
    return (telegrams.groupBy(F.year("DateIn").alias("year"), F.month("DateIn").alias("month"))
            .agg(F.count("*").alias("count")).orderBy("year", "month"))


def per_period(telegrams: DataFrame) -> DataFrame:
    return (telegrams.groupBy(F.date_format("DateIn", "yyyy-MM").alias("period"))
            .agg(F.count("*").alias("count")).orderBy("period"))


def top_sources(telegrams: DataFrame, n: int = 5) -> DataFrame:
    return (telegrams.groupBy("Source").agg(F.count("*").alias("count"))
            .orderBy(F.col("count").desc(), "Source").limit(n))


def busiest_hour(telegrams: DataFrame) -> DataFrame:
    return (telegrams.groupBy(F.hour("DateIn").alias("hour")).agg(F.count("*").alias("count"))
            .orderBy(F.col("count").desc(), "hour").limit(1))


def handling_minutes(telegrams: DataFrame, fractional: bool = True) -> DataFrame:
    m = minutes(fractional)
    return telegrams.filter(HANDLED).agg(
        F.avg(m).alias("avg_min"), F.min(m).alias("min_min"), F.max(m).alias("max_min"))


def handling_per_source(telegrams: DataFrame) -> DataFrame:
    m = minutes()
    return (telegrams.filter(HANDLED).groupBy("Source").agg(
        F.round(F.avg(m), 2).alias("avg_min"), F.round(F.min(m), 2).alias("min_min"),
        F.round(F.max(m), 2).alias("max_min"), F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "Source"))


def summary(telegrams: DataFrame) -> DataFrame:
    """Counts and handling times in total, per month, per source and per hour, in one pass: part,
    its keys, count, handled, total_micros, min_micros and max_micros. One row a month, source and
    hour leaves a task. All figures can be added up, so summaries of parts of a table can be too.
    An empty table has no rows here."""
    micros = F.when(F.expr(HANDLED), F.unix_micros(F.col("DateOut").cast("timestamp"))
                    - F.unix_micros(F.col("DateIn").cast("timestamp")))
    rows = telegrams.select(
        F.year("DateIn").alias("year"), F.month("DateIn").alias("month"), "Source",
        F.hour("DateIn").alias("hour"), micros.alias("micros"))
    keys = ["year", "month", "Source", "hour"]
    parts = {"total": [], "month": ["year", "month"], "source": ["Source"], "hour": ["hour"]}
    # A bit a key that a part leaves out, the first key's highest.
    named = F.create_map(*[F.lit(x) for name, own in parts.items() for x in (
        sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in own), name)])
    found = rows.groupingSets([[F.col(k) for k in own] for own in parts.values()], *keys).agg(
        F.grouping_id().cast("int").alias("left_out"), F.count("*").alias("count"),
        F.count("micros").alias("handled"),
        F.sum(F.col("micros").cast("decimal(20,0)")).alias("total_micros"),
        F.min("micros").alias("min_micros"), F.max("micros").alias("max_micros"))
    return found.select(F.element_at(named, F.col("left_out")).alias("part"), *keys, "count",
                        "handled", "total_micros", "min_micros", "max_micros")


def summary_minutes() -> tuple[Column, Column, Column]:
    """Mean, least and greatest handling time of a summary's row, in minutes."""
    minute = F.lit(60000000.0)
    mean = F.when(F.col("handled") > 0,
                  F.col("total_micros").cast("double") / F.col("handled") / minute)
    return (mean.alias("avg_min"), (F.col("min_micros") / minute).alias("min_min"),
            (F.col("max_micros") / minute).alias("max_min"))


def summary_reports(found: DataFrame, n: int = 5) -> dict[str, DataFrame]:
    """The reports that a summary holds, as the functions above give them."""
    def part(name: str) -> DataFrame:
        return found.filter(F.col("part") == name)

    total = part("total").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("count", "handled")],
        F.sum("total_micros").alias("total_micros"), F.min("min_micros").alias("min_micros"),
        F.max("max_micros").alias("max_micros"))
    minutes_of = summary_minutes()
    per_source = part("source").filter("handled > 0").select("Source", *minutes_of, "handled")
    return {
        "total": total.select(F.lit("telegrams").alias("table_name"), F.col("count").alias("rows")),
        "per_month": part("month").select("year", "month", "count").orderBy("year", "month"),
        "top_sources": part("source").select("Source", "count").orderBy(
            F.col("count").desc(), "Source").limit(n),
        "handling_minutes": total.select(*minutes_of),
        "busiest_hour": part("hour").select("hour", "count").orderBy(
            F.col("count").desc(), "hour").limit(1),
        "handling_per_source": per_source.select(
            "Source", *[F.round(c, 2).alias(c) for c in ("avg_min", "min_min", "max_min")],
            F.col("handled").alias("count")).orderBy(F.col("count").desc(), "Source"),
    }


def latest(telegrams: DataFrame, n: int = 10) -> DataFrame:
    return (telegrams.filter(HANDLED).select(
        "Id", "DateIn", "Source", "Destination",
        F.round(minutes(), 2).alias("ProcessingTime"))
        .orderBy(F.col("DateIn").desc(), "Id").limit(n))


def sample(telegrams: DataFrame, n: int = 5) -> DataFrame:
    """The n rows of smallest id."""
    return telegrams.orderBy("Id").limit(n)
