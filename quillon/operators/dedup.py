"""Set operations in row order: first occurrences, known rows, batches, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.session import stored


def first_seen(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Of each key the row that comes first."""
    w = Window.partitionBy(*keys).orderBy(position)
    return rows.withColumn("__r", F.row_number().over(w)).filter("`__r` = 1").drop("__r")


def with_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """rows and those known ones whose key they lack."""
    return rows.unionByName(known.join(rows.select(*keys), keys, "left_anti").select(*rows.columns))


def replaced(column: Column, bad: dict[str, str]) -> Column:
    """Known malformed values as their right ones."""
    out = column
    for a, b in bad.items():
        out = F.when(column == a, F.lit(b)).otherwise(out)
    return out


def tagged_union(parts: dict[str, DataFrame], tag: str = "origin") -> DataFrame:
    """All rows of all parts, with the part's name."""
    out = None
    for name, df in parts.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def numbered(rows: DataFrame, order: list[str], by: list[str] | None = None, out: str = "number") -> DataFrame:
    """rows with `out`: their dense number from 0 in this order, in all or in each group of `by`.

    Rows are dealt by ranges of (by, order), so a group of any size lies in many parts; each part is
    numbered by itself and moved up by the sum of its group's parts before it. Only those sums, a row for each part
    and group, are added up in order.
    """
    by = by or []
    cols = [F.col(f"`{c}`") for c in (*by, *order)]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(rows.repartitionByRange(n, *cols).withColumn("__part", F.spark_partition_id()))
    groups = [f"`{c}`" for c in by]
    inside = placed.withColumn("__in", F.row_number().over(Window.partitionBy("__part", *groups).orderBy(*[F.col(f"`{c}`") for c in order])))
    sizes = placed.groupBy("__part", *groups).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sizes.select(F.col("__part").alias("__p"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    same = F.col("__part") == F.col("__p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    told = inside.join(sums, same).withColumn(out, F.col("__off") + F.col("__in") - 1)
    return told.select(*[F.col(f"`{c}`") for c in rows.columns if c != out], out)


def batches(rows: DataFrame, order: str | list[str], size: int = 8, by: list[str] | None = None) -> DataFrame:
    """rows with `batch`: runs of `size` rows in order, in all or in each group of `by`; all are full but the last."""
    told = numbered(rows, [order] if isinstance(order, str) else order, by, "__number")
    return told.withColumn("batch", F.floor(F.col("__number") / size).cast("long")).drop("__number")


def difference(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct expected keys that are not present."""
    return expected.select(*keys).distinct().join(present.select(*keys).distinct(), keys, "left_anti")
