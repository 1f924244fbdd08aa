"""Registered round trips through the sources and sinks: what was written is what is read, held against the table itself."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillon.migrations import Migrations, Revision
from quillon.operators import merge
from quillon.plans.catalog import query
from quillon.session import scratch, table
from quillon.sources import readers, sinks, tables, workbooks
from quillon.streaming import ingest


@query("sheet_scan", "SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_name AS name FROM part")
def sheet_scan(spark, sf_dir):
    path = scratch(spark, "sheet")
    part = table(spark, sf_dir, "part").select(F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("code"), F.col("p_name").alias("name"))
    # each file is a sheet of its own: a title, a heading, then rows
    lines = part.select(F.to_csv(F.struct("code", "name")).alias("value")).withColumn("k", F.pmod(F.xxhash64("value"), F.lit(4)))
    sheets = lines.groupBy("k").agg(F.array_sort(F.collect_list("value")).alias("rows"))
    sheets.select("k", F.array_join(F.concat(F.array(F.lit("A title"), F.lit("Code,Name")), F.col("rows")), "\n").alias("value")).write.partitionBy("k").text(path)
    return readers.sheet(spark, path, "code string, name string", header_rows=2)


@query("workbook_scan", "SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_name AS name, p_size AS size FROM part")
def workbook_scan(spark, sf_dir):
    root = scratch(spark, "books")
    part = table(spark, sf_dir, "part").select(F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("code"), "p_name", "p_size", F.floor(F.col("p_partkey") / 400).cast("string").alias("file"))

    def book(rows: pd.DataFrame) -> pd.DataFrame:
        cells = [["A title"], ["Size ", "Code", None, "Name"], *[[int(s), c, None, n] for c, n, s in zip(rows["code"], rows["p_name"], rows["p_size"], strict=True)]]
        return pd.DataFrame({"type": ["sheets"], "filename": [f"{rows['file'].iloc[0]}.xlsx"], "content": [workbooks.workbook(cells, "Codes & names")]})

    sinks.upload(part.groupBy("file").applyInPandas(book, "type string, filename string, content binary"), root)  # a file holds 400 rows
    found = workbooks.read(spark, f"{root}/raw", "Code string, Name string, Size int", "Codes & names", skip=1)
    return found.toDF("code", "name", "size")


@query("reference_scan", "SELECT n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS ine_prefix FROM nation")
def reference_scan(spark, sf_dir):
    path = scratch(spark, "reference")
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("ine_prefix"))
    whole = n.agg(F.concat(F.lit("[\n"), F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct("name", "ine_prefix")))), ",\n"), F.lit("\n]")).alias("value"))  # a reference file is one document
    whole.write.text(path)
    return readers.reference(spark, path)


@query("cache_list_scan", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def cache_list_scan(spark, sf_dir):
    path = scratch(spark, "list")
    n = table(spark, sf_dir, "nation")
    n.agg(F.to_json(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))).alias("value")).write.text(path)
    none = readers.cache_list(spark, f"{path}-missing", "id int, name string")
    return readers.cache_list(spark, path, "id int, name string").unionByName(none)


@query("cache_object_scan", "SELECT n_name AS url, CASE WHEN n_nationkey % 2 = 0 THEN 'a,b' ELSE 'c' || n_nationkey END AS candidates, n_nationkey % 2 <> 0 AS has_best FROM nation")
def cache_object_scan(spark, sf_dir):
    path = scratch(spark, "object")
    k = F.col("n_nationkey")
    entry = F.concat(F.lit('{"candidate_urls": ["c'), k.cast("string"), F.lit('"], "best_candidate": {"url": "x"}}'))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit('"'), F.col("n_name"), F.lit('": '), F.when(k % 2 == 0, '["a", "b"]').otherwise(entry)).alias("v"))
    n.agg(F.concat(F.lit("{"), F.array_join(F.collect_list("v"), ","), F.lit("}")).alias("value")).write.text(path)
    found = readers.cache_object(spark, path)
    return found.select("url", F.array_join("candidate_urls", ",").alias("candidates"), F.col("best_candidate").isNotNull().alias("has_best"))


@query("html_file_scan", "SELECT page_id % 8 AS k, COUNT(*) AS pages, CAST(SUM(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1")
def html_file_scan(spark, sf_dir):
    path = scratch(spark, "html")
    p = table(spark, sf_dir, "pages").select((F.col("page_id") % 8).alias("k"), F.regexp_replace("html", "\n", "\x01").alias("html"))
    p.write.partitionBy("k").text(path)
    lines = readers.html_files(spark, path).select(F.regexp_extract("path", "/k=([0-9]+)/", 1).cast("long").alias("k"), F.explode(F.split(F.regexp_replace("html", "\n$", ""), "\n")).alias("x"))
    return lines.groupBy("k").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("x")).alias("chars"))


@query("published_dataset", "SELECT r_regionkey, r_name, 2 AS version FROM region")
def published_dataset(spark, sf_dir):
    root = scratch(spark, "hub")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sinks.ensure(spark, f"{root}/regions", "r_regionkey int, r_name string, version int")
    for version in (1, 2):
        sinks.publish(r.withColumn("version", F.lit(version)), root, "regions")
    return readers.dataset(spark, root, "regions")


@query("raw_upload", "SELECT 't' || (n_nationkey % 3) AS type, n_name || '.pdf' AS filename, CAST(length(n_name) AS BIGINT) AS bytes, n_name AS content FROM nation")
def raw_upload(spark, sf_dir):
    root = scratch(spark, "raw")
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("t"), (F.col("n_nationkey") % 3).cast("string")).alias("type"), F.concat("n_name", F.lit(".pdf")).alias("filename"), F.col("n_name").alias("content"))
    told = sinks.upload(n, root).select("type", "filename", F.regexp_replace("raw_file_url", "^file:/*", "/").alias("url"))
    files = readers.binary_files(spark, f"{root}/raw/*/*").select(F.regexp_replace("path", "^file:/*", "/").alias("url"), "bytes", F.col("content").cast("string").alias("content"))
    return told.join(files, "url").select("type", "filename", "bytes", "content")


@query("keyed_loads", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'newer' ELSE 'old' END AS state FROM customer UNION ALL SELECT -1 - s_suppkey, 'newer' FROM supplier")
def keyed_loads(spark, sf_dir):
    path = f"{scratch(spark, 'table')}/t"
    c, s = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("id"))
    sinks.load(c.withColumn("state", F.lit("old")), path, ["id"])
    new = c.filter("id % 2 = 0").unionByName(s).withColumn("state", F.lit("newer"))
    for _ in range(2):  # a load that is run again changes nothing
        sinks.load(new, path, ["id"])
    sinks.load(c.withColumn("state", F.lit("late")), path, ["id"], update=False)
    return spark.read.parquet(path)


_BUCKETED = """
    WITH valid AS (SELECT c_custkey AS id, c_nationkey AS nation, c_acctbal AS balance FROM customer WHERE c_acctbal >= 0)
    SELECT id, nation, CASE WHEN id % 3 = 0 THEN balance + 1 ELSE balance END AS balance FROM valid
    """


@query("bucketed_loads", _BUCKETED)
def bucketed_loads(spark, sf_dir):
    return _bucketed(spark, sf_dir)[0].read()


@query(
    "load_counters",
    """
    SELECT * FROM (SELECT 1 AS load, COUNT(*) AS n_read, COUNT(*) FILTER (WHERE c_acctbal < 0) AS rejected, COUNT(*) FILTER (WHERE c_acctbal >= 0) AS inserted, 0 AS updated FROM customer
    UNION ALL SELECT 2, COUNT(*), 0, 0, COUNT(*) FROM customer WHERE c_acctbal >= 0 AND c_custkey % 3 = 0
    UNION ALL SELECT 3, COUNT(*), 0, 0, 0 FROM customer WHERE c_acctbal >= 0 AND c_custkey % 3 = 0)
    """,
)
def load_counters(spark, sf_dir):
    told = [(i + 1, t["read"], t["rejected"], t["inserted"], t["updated"]) for i, t in enumerate(_bucketed(spark, sf_dir)[1])]
    return spark.createDataFrame(told, "load int, n_read long, rejected long, inserted long, updated int").withColumn("load", F.col("load").cast("int"))


@query("rejected_rows", "SELECT c_custkey AS id, CASE WHEN c_nationkey < 5 THEN 'balance,nation' ELSE 'balance' END AS why FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'nation' FROM customer WHERE c_acctbal >= 0 AND c_nationkey < 5")
def rejected_rows(spark, sf_dir):
    stored = tables.Table(spark, f"{scratch(spark, 'rejects')}/t", ["id"])
    stored.load(_customers(spark, sf_dir), checks={"balance": F.col("balance") >= 0, "nation": F.col("nation") >= 5})
    return stored.rejected().select("id", F.array_join("why", ",").alias("why"))


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))


def _bucketed(spark, sf_dir):
    """A stored table after three loads, and what each told."""
    stored = tables.Table(spark, f"{scratch(spark, 'buckets')}/t", ["id"], buckets=8)
    rows = _customers(spark, sf_dir)
    more = rows.filter("balance >= 0 AND id % 3 = 0").withColumn("balance", F.col("balance") + 1)
    told = [stored.load(rows, checks={"balance": F.col("balance") >= 0})] + [stored.load(more) for _ in range(2)]
    return stored, told


@query("flushed_stream", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def flushed_stream(spark, sf_dir):
    root = scratch(spark, "flushes")
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    stored = tables.Table(spark, f"{root}/t", ["user_id"], buckets=4)
    ingest.load_table(rows, stored, f"{root}/checkpoint", flush_at=max(8, events.count() // 2), order="event_id")
    return stored.read().select("user_id", "event_id")


@query("migrated_table", "SELECT c_custkey AS customer, c_acctbal AS balance, CASE WHEN c_acctbal < 0 THEN 'owes' ELSE 'has' END AS standing FROM customer")
def migrated_table(spark, sf_dir):
    """A table with rows under two revisions, of which one was undone and applied again."""
    first = Revision("accounts", (), lambda s: s.create("account", "id int, nation int, balance double", ["id"], 4), lambda s: s.drop("account"))
    second = Revision("standing", ("accounts",), lambda s: s.add_column("account", "standing", "string", "CASE WHEN balance < 0 THEN 'owes' ELSE 'has' END"), lambda s: s.drop_column("account", "standing"))
    third = Revision("names", ("standing",), lambda s: (s.rename_column("account", "id", "customer"), s.drop_column("account", "nation")), lambda s: (s.rename_column("account", "customer", "id"), s.add_column("account", "nation", "int")))
    moves = Migrations(spark, scratch(spark, "migrated"), [third, second, first])
    moves.upgrade("accounts")
    moves.store.table("account").load(_customers(spark, sf_dir).select(F.col("id").cast("int").alias("id"), F.col("nation").cast("int").alias("nation"), F.col("balance").cast("double").alias("balance")))
    moves.upgrade()
    moves.downgrade("standing")
    moves.upgrade()
    return moves.store.table("account").read().select("customer", "balance", "standing")


@query("json_cache_file", "SELECT n_name AS url, n_nationkey AS score FROM nation UNION ALL SELECT r_name, 100 + r_regionkey FROM region")
def json_cache_file(spark, sf_dir):
    path = f"{scratch(spark, 'cache')}/c"
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("url"), F.col("n_nationkey").alias("score"))
    sinks.write_cache(n.withColumn("score", F.lit(0)), path, "url")
    sinks.write_cache(n, path, "url")
    sinks.append_cache(table(spark, sf_dir, "region").select(F.col("r_name").alias("url"), (F.lit(100) + F.col("r_regionkey")).cast("int").alias("score")), path)
    return spark.read.schema("url string, score int").json(path)


@query("files_by_place", "SELECT 'sao-' || replace(lower(n_name), '_', '-') AS slug, n_nationkey AS id FROM nation")
def files_by_place(spark, sf_dir):
    path = scratch(spark, "places")
    sinks.by_place(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("São "), F.col("n_name")).alias("place")), path, "place")
    return spark.read.parquet(path).select(F.col("slug").cast("string").alias("slug"), "id")


@query("streamed_load", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def streamed_load(spark, sf_dir):
    root = scratch(spark, "stream")
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    ingest.load_stream(rows, f"{root}/t", ["user_id"], f"{root}/checkpoint", order="event_id").awaitTermination()
    return spark.read.parquet(f"{root}/t").select("user_id", "event_id")


@query("first_arrivals", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def first_arrivals(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    return merge.insert_if_absent(events.limit(0), events, ["user_id"], "event_id")
