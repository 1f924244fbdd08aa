import json

import pytest

from pyspark.sql import functions as F

from quillon.sources import readers, sinks
from quillon.streaming import ingest


def test_json_sources(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"name": "Porto", "ine_prefix": "13"}, {"name": "Madeira", "ine_prefix": "3"}]))
    assert sorted((r.name, r.ine_prefix) for r in readers.reference(spark, str(tmp_path / "d.json")).collect()) == [("Madeira", "3"), ("Porto", "13")]
    (tmp_path / "c.json").write_text(json.dumps({"u1": ["a", "b"], "u2": {"candidate_urls": ["c"], "best_candidate": {"url": "c"}, "crawl_timestamp": "t"}}))
    got = {r.url: (r.candidate_urls, r.best_candidate, r.crawl_timestamp) for r in readers.cache_object(spark, str(tmp_path / "c.json")).collect()}
    assert got == {"u1": (["a", "b"], None, None), "u2": (["c"], {"url": "c"}, "t")}
    (tmp_path / "bad.json").write_text("{not json")
    assert readers.cache_list(spark, str(tmp_path / "missing.json"), "name string").count() == 0
    assert readers.cache_list(spark, str(tmp_path / "bad.json"), "name string").count() == 0


def test_sheets_keep_leading_zeros(spark, tmp_path):
    (tmp_path / "s.csv").write_text("title,\ncode,name\n0101,Águeda\n0102,B\n")
    assert sorted(tuple(r) for r in readers.sheet(spark, str(tmp_path / "s.csv"), "code string, name string", 2).collect()) == [("0101", "Águeda"), ("0102", "B")]


def test_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<a>\n</a>")
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    assert [r.html for r in readers.html_files(spark, str(tmp_path / "a.html")).collect()] == ["<a>\n</a>"]
    assert [(r.filename, r.bytes) for r in readers.binary_files(spark, str(tmp_path)).collect()] == [("b.pdf", 4)]
    names = spark.createDataFrame([('attachment; filename="x y.pdf"', "u"), (None, "http://a/b/c?d=1"), ("filename*=UTF-8''n", "u")], "d string, u string")
    assert [r[0] for r in names.select(readers.download_name(F.col("d"), F.col("u"))).collect()] == ["x y.pdf", "c.pdf", "n.pdf"]


def test_published_and_uploaded(spark, tmp_path):
    rows = spark.createDataFrame([("european", "f1", 1), ("regional", "f2", 2)], "type string, filename string, n int")
    sinks.publish(rows, str(tmp_path), "elections")
    sinks.publish(rows, str(tmp_path), "elections")
    assert readers.dataset(spark, str(tmp_path), "elections").count() == 2
    files = rows.withColumn("content", F.concat(F.lit("bytes of "), F.col("filename")))
    urls = sorted((r.raw_file_url, r.n) for r in sinks.upload(files, str(tmp_path)).collect())
    for (url, n), name in zip(urls, ("european/f1", "regional/f2"), strict=True):
        assert url.startswith(f"{tmp_path}/raw/") and url.endswith(name) and open(url).read() == f"bytes of f{n}"
    with pytest.raises(ValueError):
        sinks.upload(files.unionByName(files), str(tmp_path))
    sinks.write_cache(rows, str(tmp_path / "cache"), "filename")
    sinks.write_cache(rows, str(tmp_path / "cache"), "filename")
    assert spark.read.json(str(tmp_path / "cache")).count() == 2
    sinks.ensure(spark, str(tmp_path / "e"), "a int")
    sinks.ensure(spark, str(tmp_path / "e"), "a int")
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0


def test_stream_loads_match_a_batch_load(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([(i % 7, f"v{i}", i) for i in range(40)], "k int, v string, p int")
    rows.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src)
    ingest.load_stream(stream, str(tmp_path / "t"), ["k"], str(tmp_path / "cp"), "p", update=False).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(7))


def test_stream_load_keeps_the_last_in_order(spark, tmp_path):
    src = str(tmp_path / "in")
    for rows in ([(1, 7), (2, 9)], [(1, None), (None, 4)], [(1, 9), (2, 5)], [(1, 3), (None, 2)]):  # a file each, the last one not the newest
        spark.createDataFrame(rows, "k int, p int").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k int, p int").option("maxFilesPerTrigger", 1).parquet(src)
    ingest.load_stream(stream, str(tmp_path / "t"), ["k"], str(tmp_path / "cp"), "p").awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).na.fill(0, ["k"]).collect()) == [(0, 4), (1, 9), (2, 9)]


def test_stream_quota(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([(i % 2, float(i), i) for i in range(60)], "k int, t double, i int")
    rows.coalesce(1).write.parquet(src)
    out = ingest.quota_stream(spark.readStream.schema(rows.schema).parquet(src), "k", "t", "i", 3, 20.0)
    q = out.writeStream.format("memory").queryName("quota_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    from quillon.operators import stateful

    want = {r.i: r.accepted for r in stateful.quota(rows, "k", "t", "i", 3, 20.0).collect()}
    assert {r.i: r.accepted for r in spark.table("quota_out").collect()} == want
