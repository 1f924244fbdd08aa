"""Stored tables: touched buckets only, one step, counters, rejects, flushes."""

import os

import pytest
from pyspark.sql import functions as F

from quillon.operators import merge
from quillon.sources import readers, sinks, tables
from quillon.streaming import ingest

SCHEMA = "k string, v string, p int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_a_load_rewrites_its_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table = tables.Table(spark, path, ["k"], buckets=8, retain=1)
    many = rows(spark, *[(f"k{i}", "old", i) for i in range(200)])
    assert table.load(many) == {"read": 200, "rejected": 0, "inserted": 200, "updated": 0}
    before = files(path)
    assert len(table.folders()) == 8
    assert table.load(rows(spark, ("k7", "new", 7))) == {"read": 1, "rejected": 0, "inserted": 0, "updated": 1}
    assert len(before & files(path)) == 7  # seven of eight files are as they were, and the old eighth is gone
    again = tables.Table(spark, path)
    assert content(again.read()) == sorted(((f"k{i}", "new" if i == 7 else "old", i) for i in range(200)), key=str)
    assert again.load(rows(spark, ("k7", "late", 7), ("x", "in", 1)), update=False) == {"read": 2, "rejected": 0, "inserted": 1, "updated": 0}
    assert again.read().filter("k IN ('k7', 'x')").count() == 2


def test_keys_are_folded_and_nulls_are_equal(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), ["k"])
    data = rows(spark, (None, "a", 1), (None, "b", 2), ("x", "a", 1), ("x", "c", 3), ("x", "b", 2))
    for _ in range(2):
        table.load(data, order="p")
    assert content(table.read()) == [("x", "c", 3), (None, "b", 2)] or content(table.read()) == [(None, "b", 2), ("x", "c", 3)]
    assert table.load(rows(spark, ("x", "late", 1)), order="p")["updated"] == 0
    old = rows(spark, (None, "o", 0), ("y", "o", 0))
    for how in (merge.upsert, merge.insert_if_absent):
        once = how(old, data, ["k"])
        assert once.count() == 3 and content(how(once, data, ["k"])) == content(once)


def test_readers_see_a_whole_version(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), ["k"], retain=2)
    table.load(rows(spark, ("a", "1", 1)))
    running = table.read()
    other = tables.Table(spark, str(tmp_path / "t"))
    table.load(rows(spark, ("a", "2", 1)))
    assert content(running) == [("a", "1", 1)] and content(table.read(1)) == [("a", "1", 1)] and content(table.read()) == [("a", "2", 1)]
    with pytest.raises(tables.Conflict):  # it began before the second load was committed
        other.load(rows(spark, ("a", "3", 1)))
    assert content(tables.Table(spark, str(tmp_path / "t")).read()) == [("a", "2", 1)]
    with pytest.raises(ValueError):
        tables.Table(spark, str(tmp_path / "t"), ["v"])


def test_failed_loads_change_nothing(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), ["k"])
    table.load(rows(spark, ("a", "1", 1)))
    with pytest.raises(Exception, match="no good"):
        table.load(rows(spark, ("b", "x", 1)).withColumn("v", F.raise_error(F.lit("no good")).cast("string")))
    assert content(tables.Table(spark, str(tmp_path / "t")).read()) == [("a", "1", 1)]


def test_rejects(spark, tmp_path):
    table = tables.Table(spark, str(tmp_path / "t"), ["k"])
    checks = {"named": F.col("v").isNotNull(), "small": F.col("p") < 10}
    told = table.load(rows(spark, ("a", "x", 1), ("b", None, 50), ("c", "y", None), ("a", None, 2)), checks=checks)
    assert told == {"read": 4, "rejected": 3, "check_named": 2, "check_small": 2, "inserted": 1, "updated": 0}
    assert content(table.read()) == [("a", "x", 1)]
    assert sorted((r.k, tuple(r.why)) for r in table.rejected().collect()) == [("a", ("named",)), ("b", ("named", "small")), ("c", ("small",))]
    empty = tables.Table(spark, str(tmp_path / "e"), ["k"])
    assert empty.load(rows(spark).limit(0))["read"] == 0 and empty.read().count() == 0


def test_flush_at_eight_and_the_rest_at_the_end(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(7):
        rows(spark, *[(f"k{i}-{j}", "v", j) for j in range(3)]).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    table = tables.Table(spark, str(tmp_path / "t"), ["k"], buckets=2)
    sink = ingest.load_table(stream, table, str(tmp_path / "cp"))
    assert sink.loads == [9, 9, 3] and table.read().count() == 21
    assert ingest.load_table(stream, table, str(tmp_path / "cp")).loads == []  # nothing new has come


def test_published_versions(spark, tmp_path):
    sinks.publish(rows(spark, ("a", "1", 1)), str(tmp_path), "d")
    first = readers.dataset(spark, str(tmp_path), "d")
    sinks.publish(readers.dataset(spark, str(tmp_path), "d").withColumn("w", F.lit(2)), str(tmp_path), "d")
    assert content(first) == [("a", "1", 1)] and content(readers.dataset(spark, str(tmp_path), "d")) == [("a", "1", 1, 2)]
