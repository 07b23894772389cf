"""Matching of a primary against a secondary feed: exact, fuzzy, or exact and then fuzzy.

``outcomes`` yields one row per pair, per primary without partner and per secondary without
partner. There is one route for groups of any size: exact pairs come from an equi-join on the exact
key, best partners from an equi-join on amount x time cells, and what is left from anti joins.

A record is its id: once a row is paired, no other row of the same id is left over, and the fuzzy
phase gives each primary id one partner. A row without an id is known by its content instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import amount_gap, epoch_seconds
from tallybook.operators.nearest import best_partners
from tallybook.operators.pairs import EXACT, GROUP
from tallybook.session import durable
from tallybook.settings import DEFAULTS, Settings

# What a strategy consists of (exact phase, fuzzy phase).
STRATEGIES = {"exact": (True, False), "fuzzy": (False, True), "hybrid": (True, True)}

NARROW = ["account_id", "transaction_type", "amount", "status", "transaction_id",
          "transaction_date"]
SIDE = ["transaction_id", "amount", "transaction_date", "status"]
MATCH_COLUMNS = [
    "primary_transaction_id", "secondary_transaction_id", "account_id", "primary_amount",
    "secondary_amount", "transaction_type", "primary_transaction_date",
    "secondary_transaction_date", "primary_status", "secondary_status", "match_status",
    "discrepancy_type", "discrepancy_amount",
]


@dataclass(frozen=True)
class MatchSet:
    """Pairs (13 columns) and the rows of either side that found no partner."""

    matched: DataFrame
    unmatched_primary: DataFrame
    unmatched_secondary: DataFrame


def classified(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add status, type and amount of the discrepancy to rows with a primary_* and a
    secondary_* side, one of which may be absent."""
    p_amount, s_amount = F.col("primary_amount"), F.col("secondary_amount")
    same_amount = p_amount == s_amount
    same_status = F.col("primary_status") == F.col("secondary_status")
    no_secondary = F.col("outcome") == "PRIMARY_ONLY"
    no_primary = F.col("outcome") == "SECONDARY_ONLY"
    return rows.withColumns({
        "match_status": F.when(no_secondary | no_primary, "UNMATCHED")
                         .when(same_amount & same_status, "MATCHED").otherwise("PARTIAL"),
        "discrepancy_type": F.when(no_secondary, "MISSING_SECONDARY")
                             .when(no_primary, "MISSING_PRIMARY")
                             .when(~same_amount, "AMOUNT").when(~same_status, "STATUS"),
        "discrepancy_amount": F.when(no_secondary, p_amount).when(no_primary, s_amount)
                               .when(~same_amount, amount_gap(p_amount, s_amount))
                               .cast("decimal(18,2)"),
    }).select(*by, "outcome", *MATCH_COLUMNS)


def _record() -> Column:
    """What a record is known by. It follows from the narrow columns, so it is neither written nor
    shuffled beside them."""
    content = F.concat(F.lit("#"), F.xxhash64(*NARROW).cast("string"))
    return F.coalesce("transaction_id", content).alias("record")


def _keyed(df: DataFrame, by: list[str]) -> DataFrame:
    """The columns that matching needs, and what a record is known by."""
    return df.select(*by, *NARROW, _record())


def _sided(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    return df.select(*by, *GROUP, "record", *[F.col(c).alias(f"{name}_{c}") for c in SIDE])


def _alone(df: DataFrame, name: str, other: str, by: list[str]) -> DataFrame:
    """Rows without a partner, in the outcome layout."""
    types = df.schema
    return _sided(df, name, by).drop("record").withColumns({
        "outcome": F.lit(f"{name.upper()}_ONLY"),
        **{f"{other}_{c}": F.lit(None).cast(types[c].dataType) for c in SIDE},
    })


def _exact(primary: DataFrame, secondary: DataFrame, by: list[str]) -> DataFrame:
    """Every pair that agrees in the exact key."""
    keys = [*by, *EXACT]

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{name}_{c}")
                                  for c in ("transaction_id", "transaction_date")])

    pairs = named(primary, "primary").join(named(secondary, "secondary"), keys)
    return pairs.withColumns({f"{side}_{c}": F.col(c) for side in ("primary", "secondary")
                              for c in ("amount", "status")}).drop("amount", "status")


def _best(primary: DataFrame, secondary: DataFrame, by: list[str],
          settings: Settings) -> DataFrame:
    """The best partner of each primary record, with the records of both sides."""
    keys = [*by, *GROUP]

    def places(name: str) -> list[Column]:
        return [*keys, F.col("amount").alias(f"{name}_amount"),
                epoch_seconds(F.col("transaction_date")).alias(f"{name}_sec")]

    def usable(df: DataFrame) -> DataFrame:
        return df.dropna(subset=[*GROUP, "amount", "transaction_date"])

    # The band of a negative primary is empty.
    able = usable(primary).filter("amount >= 0")
    p_places = able.select(*places("p")).distinct()
    # Every round of the search reads these.
    s_places = durable(usable(secondary).groupBy(*places("s")).agg(
        F.min(F.struct("record", F.col("transaction_id").alias("id"),
                       F.col("transaction_date").alias("date"),
                       F.col("status").alias("status"))).alias("pick")))
    best = best_partners(p_places, s_places, keys, settings.amount_tolerance,
                         settings.date_tolerance_seconds, settings)
    o = F.col("partner")
    hits = _sided(able, "primary", by).withColumns({
        "p_amount": F.col("primary_amount"),
        "p_sec": epoch_seconds(F.col("primary_transaction_date")),
    }).join(best.filter("partner is not null"), [*keys, "p_amount", "p_sec"])
    # Of several rows of a record the one with the best partner counts.
    side = [f"primary_{c}" for c in SIDE]
    one = hits.groupBy(*by, F.col("record").alias("primary_record")).agg(F.min(F.struct(
        o["cost"].alias("cost"), o["pick"]["record"].alias("secondary_record"), *GROUP, *side,
        o["amount"].alias("amount"), o["pick"].alias("pick"))).alias("m"))
    pick = F.col("m.pick")
    return one.select(
        *by, "primary_record", "m.secondary_record", *[f"m.{c}" for c in [*GROUP, *side]],
        pick["id"].alias("secondary_transaction_id"), F.col("m.amount").alias("secondary_amount"),
        pick["date"].alias("secondary_transaction_date"), pick["status"].alias("secondary_status"))


def _written(primary: DataFrame, secondary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides, each written on its own, since several steps read only one of them."""
    return durable(primary), durable(secondary)


def _without_exact(rows: DataFrame, others: DataFrame, by: list[str]) -> DataFrame:
    """Rows, with their record, none of whose record's rows agree in the exact key with a row of the
    other side. The keys tell, so no pair is listed.

    The rows cross the network once, by the exact key; the few that are left are written. A record
    of which fewer rows are left than there are has a paired one: counts by record tell, collapsed
    on the map side, so the paired rows need no second exchange.
    """
    keys, record = [*by, *EXACT], [*by, "record"]
    alone = durable(rows.join(others.select(*keys).distinct(), keys, "left_anti")
                    .select(*rows.columns))

    def counted(df: DataFrame, left: int) -> DataFrame:
        return df.select(*by, _record(), F.lit(1 - left).alias("all"), F.lit(left).alias("left"))

    taken = counted(rows, 0).unionByName(counted(alone, 1)).groupBy(*record).agg(
        F.sum("all").alias("all"), F.sum("left").alias("left")).filter(
        (F.col("left") > 0) & (F.col("left") < F.col("all"))).select(*record)
    return _keyed(alone, by).join(taken, record, "left_anti")


def _left_over(rows: DataFrame, pairs: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Rows none of whose record's rows are paired."""
    taken = pairs.select(*by, F.col(f"{name}_record").alias("record")).distinct()
    return rows.join(taken, [*by, "record"], "left_anti")


def outcomes(primary: DataFrame, secondary: DataFrame, strategy: str = "hybrid",
             settings: Settings = DEFAULTS, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per pair and per row without partner: ``by``, outcome, the 13 match columns.

    ``by`` names columns present on both sides that must agree as well.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy {strategy!r} is none of {sorted(STRATEGIES)}")
    exact, fuzzy = STRATEGIES[strategy]
    by = list(by)
    p, s = (x.select(*by, *NARROW) for x in (primary, secondary))
    found = []
    if exact:
        p, s = _written(p, s)
        found.append(_exact(p, s, by))
        p, s = _without_exact(p, s, by), _without_exact(s, p, by)
    if fuzzy:
        p, s = _written(p, s) if exact else (_keyed(p, by), _keyed(s, by))
        found.append(durable(_best(p, s, by, settings)))
        p, s = (_left_over(x, found[-1], name, by) for x, name in ((p, "primary"),
                                                                   (s, "secondary")))
    pairs = [x.drop("primary_record", "secondary_record").withColumn("outcome", F.lit("PAIR"))
             for x in found]
    return classified(reduce(DataFrame.unionByName, [
        *pairs, _alone(p, "primary", "secondary", by), _alone(s, "secondary", "primary", by)]), by)


def _one_side(rows: DataFrame, outcome: str, side: str, by: list[str]) -> DataFrame:
    return rows.filter(F.col("outcome") == outcome).select(
        F.col(f"{side}_transaction_id").alias("transaction_id"), *by, *GROUP,
        F.col(f"{side}_amount").alias("amount"), F.col(f"{side}_status").alias("status"),
        F.col(f"{side}_transaction_date").alias("transaction_date"))


def match_transactions(primary: DataFrame, secondary: DataFrame, strategy: str = "hybrid",
                       settings: Settings = DEFAULTS) -> MatchSet:
    rows = outcomes(primary, secondary, strategy, settings)
    return MatchSet(
        rows.filter("outcome = 'PAIR'").select(*MATCH_COLUMNS),
        _one_side(rows, "PRIMARY_ONLY", "primary", []),
        _one_side(rows, "SECONDARY_ONLY", "secondary", []))


def match_star(transactions: DataFrame, sources: list[str] | tuple[str, ...],
               strategy: str = "hybrid", settings: Settings = DEFAULTS) -> DataFrame:
    """The first source against each other source, in one job: outcomes with
    ``secondary_source``. Secondaries are not compared with each other."""
    if len(sources) < 2:
        raise ValueError("a star needs a first source and at least one other")
    first, *others = sources
    rows = transactions.select("source_system", *NARROW)
    primary = rows.filter(F.col("source_system") == first).withColumn(
        "secondary_source", F.explode(F.array(*[F.lit(o) for o in others])))
    secondary = rows.filter(F.col("source_system").isin(*others)).withColumn(
        "secondary_source", F.col("source_system"))
    return outcomes(primary, secondary, strategy, settings, by=("secondary_source",))
