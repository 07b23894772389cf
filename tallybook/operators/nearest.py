"""Best partner of each primary, without comparing all pairs of a group.

Rows at the same place (account, type, amount, second) share their best partner, so places are
deduplicated first, on the map side. Partners are looked for in cells of amount and time. Where
cells as wide as the tolerance are crowded, places look in a small radius of seconds first, and the
radius of amount that costs as much; who finds one that nothing outside the radius can beat is
done, the others go on with a radius sixteen times as wide, at last with the full tolerance. The
radii only save comparisons: every place gets the same partner with any of them.
"""

from __future__ import annotations

import math
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import match_score, within_amount
from tallybook.operators.pairs import amount_cell, neighbours, time_cell
from tallybook.session import durable
from tallybook.settings import SCORE_DAY_SECONDS, Settings


def best_partners(primary_places: DataFrame, secondary_places: DataFrame, keys: list[str],
                  amount_tolerance: Decimal, seconds_tolerance: int,
                  settings: Settings) -> DataFrame:
    """One row per primary place: keys, p_amount, p_sec and the struct ``partner`` or null.

    ``secondary_places`` has keys, s_amount, s_sec and ``pick``, a struct that starts with the
    smallest id at that place, which is the tie-break among equal scores.
    """
    place = [*keys, "p_amount", "p_sec"]
    limit = float(amount_tolerance)
    # Beyond the widest reach the tolerances themselves bound the search.
    widest = seconds_tolerance + math.ceil(limit * SCORE_DAY_SECONDS)
    crowd = secondary_places.groupBy(
        *keys, time_cell(F.col("s_sec"), seconds_tolerance),
        amount_cell(F.col("s_amount"), limit)).count().agg(F.max("count")).first()[0] or 0
    radii = [r for r in settings.search_radii if r < widest] if (
        crowd > settings.crowded_cell) else []
    radii.append(None)
    remaining, found = primary_places, []
    for radius in radii:
        reach_seconds = seconds_tolerance if radius is None else min(radius, seconds_tolerance)
        reach_amount = limit if radius is None else min(radius / SCORE_DAY_SECONDS, limit)
        p = (remaining
             .withColumn("t", neighbours(time_cell(F.col("p_sec"), reach_seconds)))
             .withColumn("a", neighbours(amount_cell(F.col("p_amount"), reach_amount))))
        s = (secondary_places
             .withColumn("t", time_cell(F.col("s_sec"), reach_seconds))
             .withColumn("a", amount_cell(F.col("s_amount"), reach_amount)))
        apart = F.abs(F.col("p_sec") - F.col("s_sec"))
        near = (within_amount(F.col("p_amount"), F.col("s_amount"), amount_tolerance)
                & (apart <= seconds_tolerance))
        same_cell = [F.col(f"p.{c}") == F.col(f"s.{c}") for c in [*keys, "t", "a"]]
        hits = p.alias("p").join(
            s.alias("s"), reduce(lambda x, y: x & y, same_cell) & near, "left").select(
            *[F.col(f"p.{c}") for c in place],
            F.when(F.col("pick").isNotNull(), F.struct(
                (-match_score(F.col("p_amount"), F.col("s_amount"), apart)).alias("cost"),
                F.col("pick"), F.col("s_amount").alias("amount"))).alias("hit"))
        nearest = hits.groupBy(*place).agg(F.min("hit").alias("partner"))
        if radius is None:
            found.append(nearest)
            break
        # 1 - score is half a unit per day apart: partners outside the radius cost more.
        reached = (F.col("partner.cost") + 1.0) * 2.0 * SCORE_DAY_SECONDS
        settled = F.coalesce(reached <= radius * (1 - 1e-9), F.lit(False))
        step = durable(nearest.withColumn("settled", settled))
        found.append(step.filter("settled").drop("settled"))
        remaining = step.filter("not settled").select(*place)
        if remaining.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)

