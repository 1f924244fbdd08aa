"""Constraints as violation queries: an empty result means that they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import terms


def not_xor(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Rows that have both or neither of two references."""
    return rows.filter(F.col(a).isNotNull() == F.col(b).isNotNull())


def repeated(rows: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys that occur twice or more (among the rows of a partial constraint), with their count."""
    rows = rows if where is None else rows.filter(where)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def outside(rows: DataFrame, column: str, domain: list[str]) -> DataFrame:
    return rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(domain))


def bad_sub_types(rows: DataFrame) -> DataFrame:
    """Elections whose sub_type their type doesn't allow, or lacks."""
    ok = F.col("sub_type").isNull()
    for kind, allowed in terms.SUB_TYPES.items():
        ok = F.when(F.col("type") == kind, F.coalesce(F.col("sub_type").isin(allowed), F.lit(False))).otherwise(ok)
    return rows.filter(~ok)


def rounds(rows: DataFrame) -> DataFrame:
    """Rounds of presidential elections only; presidential rows without one are marked."""
    is_p = F.col("type") == "presidential"
    out = rows.withColumn("round", F.when(is_p, F.col("round")))
    return out.withColumn("violates", is_p & F.col("round").isNull())


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference has no parent."""
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    return rows.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def require_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(rows.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return rows


def require_count(rows: DataFrame, n: int) -> DataFrame:
    found = rows.count()
    if found != n:
        raise ValueError(f"{found} rows where {n} are expected")
    return rows


def require_fields(rows: DataFrame, field: str, expected: list[str] | None = None) -> DataFrame:
    """rows, or an error that names the expected fields that none of them has."""
    wanted = sorted(set(terms.LINK_FIELDS.values()) if expected is None else expected)
    found = {r[0] for r in rows.filter(F.col(field).isin(wanted)).select(field).distinct().collect()}  # a row per expected field
    missing = [f for f in wanted if f not in found]
    if missing:
        raise ValueError(f"missing fields: {missing}")
    return rows


def normalized_columns(rows: DataFrame) -> DataFrame:
    """Column names trimmed, in lower case, inner white space as one space."""
    return rows.toDF(*[" ".join(c.lower().split()) for c in rows.columns])
