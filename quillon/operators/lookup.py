"""Code lookups: names to statistical codes, and prefix joins on codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import strip

#: Prefixes have so many different lengths at most; codes are short.
PREFIX_LENGTHS = 64


def clean_codes(rows: DataFrame, code: str, name: str, pattern: str, exclude: list[str] | None = None) -> DataFrame:
    """Rows with both values whose code fits the pattern (before trimming) and isn't excluded; both trimmed."""
    out = rows.dropna(subset=[code, name]).filter(F.col(code).rlike(pattern))
    if exclude:
        out = out.filter(~F.col(code).isin(exclude))
    return out.withColumn(code, strip(F.col(code))).withColumn(name, strip(F.col(name)))


def codes_by_name(rows: DataFrame, code: str, name: str, position: str) -> DataFrame:
    """name and its codes in row order; a code listed twice stays twice."""
    grouped = rows.groupBy(name).agg(F.array_sort(F.collect_list(F.struct(position, code))).alias("c"))
    return grouped.select(name, F.transform("c", lambda x: x[code]).alias("codes"))


def unique_codes(rows: DataFrame, code: str, name: str) -> DataFrame:
    """Names with one code row. Counting needs no list of codes."""
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.min(code).alias(code)).filter("n = 1").select(name, code)


def ambiguous_codes(rows: DataFrame, code: str, name: str, position: str) -> DataFrame:
    """Names with two code rows or more, codes in row order."""
    return codes_by_name(rows, code, name, position).filter(F.size("codes") > 1)


def longest_prefix(rows: DataFrame, code: str, prefixes: DataFrame, prefix: str, value: str) -> DataFrame:
    """rows with `value` of the longest prefix that starts their code, null where there is none.

    Each distinct code looks its prefixes up by equality, a prefix for each length that occurs; of a
    prefix listed twice the least value counts, null prefixes and codes match nothing. Spark
    broadcasts the prefixes where they are small.
    """
    table = prefixes.select(F.col(prefix).alias("__p"), F.col(value).alias("__v")).filter("`__p` is not null").groupBy("__p").agg(F.min("__v").alias("__v"))
    lengths = sorted(r[0] for r in table.select(F.length("__p")).distinct().limit(PREFIX_LENGTHS + 1).collect())  # a row for each length
    if len(lengths) > PREFIX_LENGTHS:
        raise ValueError("prefixes of too many lengths")
    starts = F.array_distinct(F.array(*[F.substring(F.col(code), 1, n) for n in lengths])) if lengths else F.array().cast("array<string>")
    asked = rows.select(code).filter(F.col(code).isNotNull()).distinct().withColumn("__p", F.explode(starts))
    best = asked.join(table, "__p").groupBy(code).agg(F.max_by("__v", F.length("__p")).alias(value))
    return rows.join(best, code, "left").select(*rows.columns, value)


def prefix_join(rows: DataFrame, code: str, parents: DataFrame, parent_code: str, length: int = 4) -> DataFrame:
    """Rows with their parent by the first `length` characters of the code; a plain equi-join."""
    return rows.join(parents, F.substring(F.col(code), 1, length) == F.col(parent_code), "left")


def with_fallback(rows: DataFrame, code: str, name: str, parents: DataFrame, parent_code: str, parent_name: str, trusted: list[str], resolve) -> DataFrame:
    """Parents by code prefix, and by name only for misses whose first two digits are not trusted.

    `resolve(rows, name, parents, parent_name)` adds the matching parent_name; only the misses reach it.
    """
    first = prefix_join(rows, code, parents, parent_code)
    hit = first.filter(F.col(parent_code).isNotNull()).withColumn("matched_by", F.lit("code"))
    missed = first.filter(F.col(parent_code).isNull() & ~F.substring(F.col(code), 1, 2).isin(trusted)).select(*rows.columns)
    named = resolve(missed, name, parents, parent_name)
    by_name = named.join(parents, parent_name).withColumn("matched_by", F.lit("name"))
    return hit.unionByName(by_name.select(*hit.columns))
