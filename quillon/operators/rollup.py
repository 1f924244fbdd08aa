"""Vote roll-ups along the territory hierarchy, national totals and seats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def roll_up(leaf: DataFrame, parent: DataFrame, key: str, by: list[str], measures: list[str], count: str | None = None) -> DataFrame:
    """Sum measures of leaf rows per parent row.

    The sum by key comes before the join, so the shuffle carries one row per key
    and map task and the join sees one row per key.
    """
    counted = [F.count(F.lit(1)).alias(count)] if count else []
    small = leaf.groupBy(key).agg(*[F.sum(m).alias(m) for m in measures], *counted)
    out = small.join(parent, key)
    return out.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures], *([F.sum(count).alias(count)] if count else []))


def national_totals(leaf: DataFrame, levels: list[str], measures: list[str]) -> DataFrame:
    """Sums at every level of the hierarchy and in all; `level` is the number of territory columns that hold."""
    sums = [F.sum(m).alias(m) for m in measures]
    level = sum(1 - F.grouping(c) for c in levels)
    return leaf.rollup(*levels).agg(level.cast("int").alias("level"), *sums)


def by_leg(leaf: DataFrame, legs: dict[str, tuple[DataFrame, str]], place: str, measures: list[str]) -> DataFrame:
    """(leg, place, measures): leaf rows refer to one of several territories (a parish, a consulate, a circle), each with its own parents.

    `legs` gives for each leg its parents and their key, which leaf has too, null in other legs' rows. Sums by key come before each join.
    """
    out = None
    for leg, (parents, key) in legs.items():
        own = leaf.filter(F.col(key).isNotNull())
        one = roll_up(own.select(key, *measures), parents.select(key, place), key, [place], measures).select(F.lit(leg).alias("leg"), place, *measures)
        out = one if out is None else out.unionByName(one)
    return out


def dhondt(votes: DataFrame, circle: str, choice: str, count: str, seats: int) -> DataFrame:
    """Seats by highest quotients votes/1, votes/2, ...; ties go to more votes, then to the choice's name.

    A choice can't win its k-th seat before its (k-1)-th, so of each circle only its `seats` best
    quotients are needed; Spark keeps no more of them per task than that before the shuffle.
    """
    quotients = votes.filter(F.col(count) > 0).withColumn("divisor", F.explode(F.sequence(F.lit(1), F.lit(seats))))
    order = [F.desc(F.col(count) / F.col("divisor")), F.desc(count), F.col(choice), F.col("divisor")]
    ranked = quotients.withColumn("__r", F.row_number().over(Window.partitionBy(circle).orderBy(*order)))
    return ranked.filter(F.col("__r") <= seats).groupBy(circle, choice).agg(F.count(F.lit(1)).alias("seats"))
