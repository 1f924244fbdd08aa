"""Idempotent loads: upsert, insert-if-absent, conditional updates, and their file forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (left[k] == right[k])
    return cond


def newest(updates: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the last in order; a row number per key, no window over all rows."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return updates.withColumn("__r", F.row_number().over(w)).filter("`__r` = 1").drop("__r")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """old with new's rows: a matching row takes all of new's values, others are added; null keys are equal.

    Of several new rows of one key one stays, by its content. One shuffle by key: untouched old rows come from an anti-join.
    With an order, the last row of a key stays, old or new (at the same place new); a null is the earliest.
    """
    if order is not None:
        both = old.withColumn("__new", F.lit(0)).unionByName(new.select(*old.columns).withColumn("__new", F.lit(1)))
        w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order), F.desc("__new"))
        return both.withColumn("__r", F.row_number().over(w)).filter("`__r` = 1").drop("__r", "__new")
    new = one_of_key(new.select(*old.columns), keys)
    return _without(old, new, keys).unionByName(new)


def one_of_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key, the same one in every run."""
    w = Window.partitionBy(*keys).orderBy(F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in rows.columns]))
    return rows.withColumn("__r", F.row_number().over(w)).filter("`__r` = 1").drop("__r")


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not among the others', null keys being equal."""
    there = others.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(there[f"__k{i}"])
    return rows.join(there, same, "left_anti")


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """old, and of new the rows of keys that old doesn't have; of rows of one key the first in order (without one, by content)."""
    if order is not None:
        w = Window.partitionBy(*keys).orderBy(order)
        new = new.withColumn("__r", F.row_number().over(w)).filter("`__r` = 1").drop("__r")
    else:
        new = one_of_key(new.select(*old.columns), keys)
    return old.unionByName(_without(new, old, keys).select(*old.columns))


def update_changed(rows: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """rows with updates' value where it differs (null-safely), and `changed`; rows without an update stay."""
    u = updates.select(F.col(key).alias("__k"), F.col(column).alias("__v"), F.lit(True).alias("__has"))
    out = rows.join(u, rows[key] == u["__k"], "left")
    changed = F.coalesce("__has", F.lit(False)) & ~F.col(column).eqNullSafe(F.col("__v"))
    out = out.withColumn("changed", changed)
    return out.withColumn(column, F.when(F.col("changed"), F.col("__v")).otherwise(F.col(column))).drop("__k", "__v", "__has")


def fill_known(rows: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """rows with updates' value where it is known, else their own."""
    u = updates.filter(F.col(column).isNotNull()).select(F.col(key).alias("__k"), F.col(column).alias("__v"))
    return rows.join(u, rows[key] == u["__k"], "left").withColumn(column, F.coalesce("__v", F.col(column))).drop("__k", "__v")


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are not done yet."""
    return rows.join(done.select(*keys), keys, "left_anti")


def by_cache(rows: DataFrame, cache: DataFrame, key: str, result: str) -> DataFrame:
    """rows with cache_state: missing, partial (cached without a result) or complete."""
    c = cache.select(F.col(key).alias("__k"), F.col(result).alias("__v")).groupBy("__k").agg(F.max("__v").alias("__v"))
    out = rows.join(c, rows[key] == c["__k"], "left")
    state = F.when(F.col("__k").isNull(), "missing").when(F.col("__v").isNull(), "partial").otherwise("complete")
    return out.withColumn("cache_state", state).drop("__k", "__v")


def completed(rows: DataFrame, others: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """rows with the named columns of the record of the same key, where there is one; others has a row per key."""
    u = others.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    out = rows.join(u, keys, "left")
    return out.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in rows.columns])


def cached_or(rows: DataFrame, cache: DataFrame, keys: list[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Cached rows as they are for the keys of `rows` that have one, computed ones for the others, told apart by `from_cache`.

    `compute` gets the rows that the cache lacks and returns the cache's columns.
    """
    hits = cache.join(rows.select(*keys).distinct(), keys, "left_semi").select(*cache.columns).withColumn("from_cache", F.lit(True))
    return hits.unionByName(compute(pending(rows, cache, keys)).select(*cache.columns).withColumn("from_cache", F.lit(False)))
