"""Further registered queries: predicates and projections on links, names and files, caches, counters and the crawl."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import http as H
from quillon.functions import text as T
from quillon.functions import url as U
from quillon.operators import crawl, dedup, documents, lookup, match, merge, pages, rollup, validate
from quillon.plans import flows
from quillon.plans.catalog import query
from quillon.session import table
from quillon.sources import readers

# --- links ------------------------------------------------------------------------------------------

_URL = "regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/?#]+)', 1) AS host, regexp_extract(url, '://[^/?#]+([^?#]*)', 1) AS path"


@query("root_scope", f"WITH p AS (SELECT page_id, {_URL} FROM pages) SELECT page_id, path = '/en' OR path LIKE '/en/%' AS in_scope, host LIKE 'www.%' AS on_www FROM p")
def root_scope(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    root = F.concat(F.lit("https://"), U.part(F.col("url"), "authority"), F.lit("/en/"))
    elsewhere = F.concat(F.lit("https://www."), F.regexp_replace(U.part(F.col("url"), "authority"), r"^www\.", ""))
    return p.select("page_id", U.in_scope(F.col("url"), root).alias("in_scope"), U.in_scope(F.col("url"), elsewhere).alias("on_www"))


_ENDING = "['', '.pdf', '.HTML', '.docx', '.x', '/pdm/a.pdf', '/plano-diretor.PDF', '.csv'][page_id % 8 + 1]"


@query(
    "file_predicates",
    rf"""
    WITH u AS (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) || {_ENDING} AS u FROM pages), l AS (SELECT page_id, u, lower(regexp_extract(u, '://[^/]+(.*)$', 1)) AS p FROM u)
    SELECT page_id, regexp_matches(p, '\.(pdf|docx|csv)$') AS is_file, contains(string_split(p, '/')[-1], '.') AND NOT regexp_matches(p, '\.html$') AS is_file_loosely,
           p LIKE '%.pdf' AND (p LIKE '%pdm%' OR p LIKE '%plano-diretor%') AS is_plan_file,
           p LIKE '%.pdf' AND (regexp_replace(lower(u), '[^0-9a-z]+', '', 'g') LIKE '%pdm%' OR page_id % 3 = 0) AS is_plan_pdf FROM l
    """,
)
def file_predicates(spark, sf_dir):
    endings = F.array(*map(F.lit, ["", ".pdf", ".HTML", ".docx", ".x", "/pdm/a.pdf", "/plano-diretor.PDF", ".csv"]))
    u = F.concat(F.regexp_extract("url", "^([^?#]*)", 1), F.element_at(endings, (F.col("page_id") % 8 + 1).cast("int")))
    rows = table(spark, sf_dir, "pages").select("page_id", u.alias("u"), F.when(F.col("page_id") % 3 == 0, "Plano Diretor-Municipal").otherwise("other").alias("t"))
    c = F.col("u")
    return rows.select("page_id", pages.is_file(c).alias("is_file"), pages.is_file_loosely(c).alias("is_file_loosely"), pages.is_plan_file(c).alias("is_plan_file"), pages.is_plan_pdf(c, F.col("t")).alias("is_plan_pdf"))


@query(
    "town_hall_links",
    """
    SELECT id, CASE WHEN k IN (0, 1) THEN 'host' ELSE 'text' END AS named_by FROM (SELECT c_custkey AS id, c_custkey % 5 AS k FROM customer) WHERE k IN (0, 1, 3)
    """,
)
def town_hall_links(spark, sf_dir):
    k = F.col("c_custkey") % 5
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (k + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), pick("http://www.cm-a.pt", "https://www.cm-b.pt/x", "https://cm-c.pt", "https://d.pt", "/e").alias("href"), pick("a", "b", "c", "Consultar WEBSITE aqui", "website").alias("text"))
    return pages.named_links(rows).select("id", "named_by")


@query("place_of_host", r"SELECT s_suppkey AS id, 'town' || s_suppkey AS place, 'https://www.x' || s_suppkey AS site FROM supplier")
def place_of_host(spark, sf_dir):
    k = F.col("s_suppkey")
    host = F.concat(F.element_at(F.array(*map(F.lit, ["http://www.cm-town", "https://www.town", "http://town"])), (k % 3 + 1).cast("int")), k.cast("string"), F.lit(".pt/a?b"))
    return table(spark, sf_dir, "supplier").select(k.alias("id"), U.municipality(host).alias("place"), U.with_scheme(F.concat(F.lit("www.x"), k.cast("string"))).alias("site"))


@query(
    "result_links",
    "SELECT o_orderkey AS id, 'AR ' || year(o_orderdate) || '.xls' AS filename, 'parliament' AS type, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderkey % 3 = 0",
)
def result_links(spark, sf_dir):
    k = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    href = F.when(k % 3 == 0, F.concat(F.lit("/f/AR%20"), year, F.lit(".xls?dl=1"))).when(k % 3 == 1, F.concat(F.lit("/f/AR%20"), year, F.lit(".pdf"))).otherwise(F.lit("/f/notes.xlsx"))
    rows = flows.result_files(table(spark, sf_dir, "orders").select(k.alias("id"), href.alias("href")))
    return documents.matched_files(rows, "filename").select("id", "filename", "type", "year")


@query(
    "unmatched_files",
    "SELECT o_orderkey AS id, o_orderkey % 4 <> 0 AS matched, CASE WHEN o_orderkey % 4 = 0 THEN 'unexpected file name: notes.xlsx' END AS error FROM orders",
)
def unmatched_files(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.element_at(F.array(*map(F.lit, ["notes.xlsx", "PE2019.xlsx", "AR_2022.xls", "resultados_eleicoes_CM_2021.xlsx"])), (k % 4 + 1).cast("int"))
    found = documents.name_errors(table(spark, sf_dir, "orders").select(k.alias("id"), name.alias("filename")), "filename")
    return found.select("id", F.col("error").isNull().alias("matched"), "error")


@query("pdf_links", "SELECT page_id AS url, CASE WHEN page_id % 2 = 0 THEN '/doc/' || page_id || '.pdf' END AS pdf_url FROM pages")
def pdf_links(spark, sf_dir):
    k = F.col("page_id").cast("string")
    tag = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<a class="b" title="Documento em formato PDF" href=" /doc/'), k, F.lit('.pdf ">x</a>'))).otherwise(F.lit('<a href="/y.pdf">y</a>'))
    return flows.pdf_link(table(spark, sf_dir, "pages").select(F.col("page_id").alias("url"), F.concat(F.lit("<p>"), tag, F.lit("</p>")).alias("html")))


# --- names, texts, records --------------------------------------------------------------------------


@query("column_names", "SELECT p_partkey AS \"part key\", p_name AS \"name of part\" FROM part")
def column_names(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias(" Part  KEY "), F.col("p_name").alias("Name\tof Part"))
    return validate.require_columns(validate.normalized_columns(rows), ["part key", "name of part"])


@query(
    "prompts_and_delays",
    """
    SELECT event_id, 'Name the ' || event_type || ' election that the results file f' || event_id || '.xlsx belongs to.' AS prompt,
           CASE event_id % 4 WHEN 0 THEN CAST(event_id % 50 AS DOUBLE) WHEN 1 THEN (event_id % 50) + 0.5 END AS told,
           CASE event_id % 4 WHEN 0 THEN CAST(event_id % 50 AS DOUBLE) WHEN 1 THEN (event_id % 50) + 0.5 ELSE least(2.0 ** (event_id % 8), 60.0) END AS wait,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events
    """,
)
def prompts_and_delays(spark, sf_dir):
    k = F.col("event_id")
    delay = F.concat((k % 50).cast("string"), F.element_at(F.array(*map(F.lit, ["s", ".5s", " minutes", ""])), (k % 4 + 1).cast("int")))
    told = T.seconds_of(delay)
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", documents.prompt(F.col("event_type"), F.concat(F.lit("f"), k.cast("string"), F.lit(".xlsx"))).alias("prompt"), told.alias("told"),
        H.wait_seconds(told, (k % 8 + 1).cast("int")).alias("wait"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"),
    )


@query("download_names", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'plan ' || page_id || '.pdf' WHEN 1 THEN page_id || '.PDF' ELSE 'doc' || page_id || '.pdf' END AS name FROM pages")
def download_names(spark, sf_dir):
    k = F.col("page_id").cast("string")
    said = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('attachment; filename="plan '), k, F.lit('.pdf"')))
    url = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("http://a/b/"), k, F.lit(".PDF?x=1"))).otherwise(F.concat(F.lit("http://a/doc"), k))
    return table(spark, sf_dir, "pages").select("page_id", said.alias("d"), url.alias("u")).select("page_id", readers.download_name("d", "u").alias("name"))


@query("city_rows", "SELECT c_custkey AS id, c_name || '|' || CASE WHEN c_custkey % 2 = 0 THEN 'https://www.a' || c_custkey || '.pt' ELSE 'http://b' END || '|' || c_nationkey AS city, c_custkey % 3 <> 0 AS has_content FROM customer")
def city_rows(spark, sf_dir):
    k = F.col("c_custkey")
    site = F.when(k % 2 == 0, F.concat(F.lit("www.a"), k.cast("string"), F.lit(".pt"))).otherwise(F.lit("http://b"))
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.col("c_name").alias("name"), site.alias("website"), F.col("c_nationkey").alias("code"), F.when(k % 3 != 0, F.lit(" x ")).otherwise(F.lit(" ")).alias("content"))
    out = flows.city_rows(rows, ["name", "website", "code"], "website")
    shown = F.concat_ws("|", "city.name", "city.website", "city.code")
    return out.select("id", shown.alias("city"), documents.has_content(F.col("content")).alias("has_content"))


@query(
    "merged_contacts",
    "SELECT n_nationkey AS id, n_name AS name, n_name || '@hall' AS email, CASE WHEN n_nationkey % 4 <> 0 THEN 'p' || n_nationkey END AS president FROM nation WHERE n_nationkey % 3 <> 1",
)
def merged_contacts(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    halls = n.filter("n_nationkey % 3 <> 1").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.concat("n_name", F.lit("@hall")).alias("email"), F.lit(None).cast("string").alias("president"))
    assemblies = n.filter("n_nationkey % 4 <> 0").select(F.col("n_nationkey").alias("id"), F.lit("x").alias("name"), F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("president"))
    return merge.completed(halls, assemblies, ["id"], ["president"])


@query("sorted_values", "SELECT p_brand, array_to_string(list_sort(list_distinct(list(p_type))), ',') AS types FROM part GROUP BY 1")
def sorted_values(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_type")), ",").alias("types"))


@query("zip_by_key", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'n' || o_orderkey END AS name, CASE WHEN o_orderkey % 4 = 0 THEN 'first' END AS round, o_orderkey % 4 <> 0 AS violates FROM orders")
def zip_by_key(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k.alias("id"), F.concat(F.lit("f"), k.cast("string")).alias("filename"), F.lit("presidential").alias("type"), F.lit(None).cast("string").alias("sub_type"))
    said = o.filter("id % 2 = 0").select("filename", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.when(F.col("id") % 4 == 0, "first").alias("round"))
    return flows.structured(o, said).select("id", "name", "round", "violates")


# --- caches, counters, loads --------------------------------------------------------------------------


@query(
    "cache_values",
    """
    SELECT event_id AS url, CASE event_id % 3 WHEN 0 THEN 'a,b' ELSE 'c' || event_id END AS candidates, CASE WHEN event_id % 3 = 2 THEN 'best' || event_id END AS best FROM events
    """,
)
def cache_values(spark, sf_dir):
    k = F.col("event_id").cast("string")
    entry = F.concat(F.lit('{"candidate_urls": ["c'), k, F.lit('"]'), F.when(F.col("event_id") % 3 == 2, F.concat(F.lit(', "best_candidate": {"url": "best'), k, F.lit('"}'))).otherwise(""), F.lit(', "crawl_timestamp": "t"}'))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("url"), F.when(F.col("event_id") % 3 == 0, '["a", "b"]').otherwise(entry).alias("v"))
    found = readers.cache_values(rows, "url", "v")
    return found.select("url", F.array_join("candidate_urls", ",").alias("candidates"), F.try_element_at("best_candidate", F.lit("url")).alias("best"))


@query(
    "cache_or_compute",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'cached' ELSE 'new ' || c_name END AS result, c_custkey % 3 = 0 AS from_cache FROM customer",
)
def cache_or_compute(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    cache = c.filter("id % 3 = 0").select("id", F.lit("cached").alias("result"))
    return merge.cached_or(c, cache, ["id"], lambda rows: rows.select("id", F.concat(F.lit("new "), F.col("name")).alias("result")))


@query(
    "cache_reentry",
    """
    SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'filtered crawled ' || c_custkey WHEN 1 THEN 'filtered kept ' || c_custkey ELSE 'done ' || c_custkey END AS best,
           ['crawled', 'filtered', 'cached'][c_custkey % 3 + 1] AS origin FROM customer
    """,
)
def cache_reentry(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    c = table(spark, sf_dir, "customer")
    cache = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.concat(F.lit("kept "), k).alias("candidates"), F.when(F.col("c_custkey") % 3 == 2, F.concat(F.lit("done "), k)).alias("best"))
    crawl = lambda rows: rows.select("id", F.concat(F.lit("crawled "), F.col("id").cast("string")).alias("candidates"))
    pick = lambda rows: rows.select("id", F.concat(F.lit("filtered "), F.col("candidates")).alias("best"))
    return flows.reentered(c.select(F.col("c_custkey").alias("id")), cache, "id", "candidates", "best", crawl, pick)


@query(
    "candidate_results",
    "SELECT c_custkey AS id, 'u' || c_custkey AS url, CAST(c_custkey % 90 AS VARCHAR) AS pages, CAST(c_custkey % 7 AS VARCHAR) AS score FROM customer WHERE c_custkey % 4 <> 0",
)
def candidate_results(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 4 != 0, F.concat(F.lit("u"), k.cast("string"))).alias("best"), (k % 90).alias("pages"), (k % 7).alias("score"))
    out = documents.candidate_results(rows, "id", "best", ["pages", "score"])
    return out.select("id", "url", out.metadata["pages"].alias("pages"), out.metadata["score"].alias("score"))


@query(
    "regulation_counters",
    """
    WITH f AS (SELECT o_orderkey AS k, 'City ' || (o_custkey % 40) AS city, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE year(o_orderdate) END AS y, o_custkey % 40 < 30 AS known, 'u' || (o_orderkey % 1000) AS url FROM orders),
    n AS (SELECT DISTINCT city, url FROM f WHERE known AND y IS NOT NULL)
    SELECT CAST(COUNT(*) AS BIGINT) AS found, CAST(COUNT(*) FILTER (WHERE known) AS BIGINT) AS matched, CAST(COUNT(*) FILTER (WHERE NOT known) AS BIGINT) AS unmatched,
           CAST(COUNT(*) FILTER (WHERE known AND y IS NULL) AS BIGINT) AS skipped, (SELECT CAST(COUNT(*) AS BIGINT) FROM n) AS persisted FROM f
    """,
)
def regulation_counters(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    year = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("/"), F.year("o_orderdate").cast("string"))).otherwise("")
    found = o.select(F.concat(F.lit("City "), (F.col("o_custkey") % 40).cast("string")).alias("municipality"), F.concat(F.lit("Regulamento n.º 1"), year).alias("name"), F.concat(F.lit("u"), (F.col("o_orderkey") % 1000).cast("string")).alias("dre_url"), F.col("o_orderkey").alias("pos"))
    city = spark.range(30).select(F.concat(F.lit("City "), F.col("id").cast("string")).alias("name"), F.col("id").alias("city_id"))
    told = found.join(city.withColumnRenamed("name", "municipality"), "municipality", "left").withColumn("year", T.year_of(F.col("name")))
    return flows.regulation_counters(told, spark.createDataFrame([], "city_id long, dre_url string"))


@query(
    "parish_upsert",
    """
    SELECT c_custkey AS code, era, CASE WHEN era = '2025' AND c_custkey % 2 = 0 THEN 'new ' || c_name ELSE c_name END AS name FROM customer, (VALUES ('2013'), ('2025')) e(era)
    UNION ALL SELECT s_suppkey, '2026', s_name FROM supplier
    """,
)
def parish_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.explode(F.array(F.lit("2013"), F.lit("2025"))).alias("era"), F.col("c_name").alias("name"))
    new = c.filter("era = '2025' and code % 2 = 0").withColumn("name", F.concat(F.lit("new "), F.col("name")))
    more = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("code"), F.lit("2026").alias("era"), F.col("s_name").alias("name"))
    return merge.upsert(c, new.unionByName(more), ["code", "era"])


@query("required_rows", "SELECT COUNT(*) AS n, 0 AS missing FROM region")
def required_rows(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    whole = validate.require_count(validate.require_columns(r, ["r_regionkey", "r_name"]), r.count())
    fields = spark.createDataFrame([(x, "u") for x in ("president_url", "parliament_url", "town_hall_url", "regional_assembly_url", "european_url")], "field string, url string")
    return whole.agg(F.count(F.lit(1)).alias("n")).withColumn("missing", F.lit(5 - validate.require_fields(fields, "field").count()))


@query(
    "pending_batches",
    """
    WITH p AS (SELECT c_custkey AS city_id, 'u' || c_custkey AS dre_url FROM customer WHERE c_custkey % 3 <> 0)
    SELECT COUNT(*) AS n, true AS at_most_8 FROM p
    """,
)
def pending_batches(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("city_id"), F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("dre_url"), F.when(F.col("c_custkey") % 3 == 0, "x").alias("pdf_url"))
    sizes = flows.pending_pdfs({"urbanization": c.filter("city_id % 2 = 0"), "fees": c.filter("city_id % 2 = 1")}).groupBy("table", "batch").agg(F.count(F.lit(1)).alias("k"))
    return sizes.agg(F.sum("k").alias("n"), (F.max("k") <= 8).alias("at_most_8"))


@query(
    "full_batches",
    """
    WITH p AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'urbanization' ELSE 'fees' END AS "table", c_custkey % 11 AS city_id, 'u' || c_custkey AS dre_url FROM customer WHERE c_custkey % 3 <> 0)
    SELECT "table", city_id, dre_url, (row_number() OVER (PARTITION BY "table" ORDER BY city_id, dre_url) - 1) // 8 AS batch FROM p
    """,
)
def full_batches(spark, sf_dir):
    key = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select((key % 11).alias("city_id"), F.concat(F.lit("u"), key.cast("string")).alias("dre_url"), F.when(key % 3 == 0, "x").alias("pdf_url"), key)
    rows = flows.pending_pdfs({"urbanization": c.filter("c_custkey % 2 = 0"), "fees": c.filter("c_custkey % 2 = 1")})
    return rows.select("table", "city_id", "dre_url", "batch")


@query(
    "territory_legs",
    """
    WITH v AS (SELECT o_orderkey AS id, o_custkey, o_orderkey % 3 AS leg, CAST(round(o_totalprice * 100) AS BIGINT) AS votes FROM orders)
    SELECT leg, place, CAST(SUM(votes) AS BIGINT) AS votes FROM (
        SELECT 'parish' AS leg, n_name AS place, votes FROM v JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE leg = 0
        UNION ALL SELECT 'consulate', r_name, votes FROM v JOIN nation ON o_custkey % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE leg = 1
        UNION ALL SELECT 'circle', 'circle ' || (o_custkey % 22), votes FROM v WHERE leg = 2) GROUP BY 1, 2
    """,
)
def territory_legs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 3).alias("leg"), F.round(F.col("o_totalprice") * 100).cast("long").alias("votes"))
    parish = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("parish_id"), F.col("n_name").alias("place"))
    country = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("long").alias("consulate_id"), F.col("r_name").alias("place"))
    circle = spark.range(22).select(F.col("id").alias("circle_id"), F.concat(F.lit("circle "), F.col("id").cast("string")).alias("place"))
    leaf = o.select(F.when(F.col("leg") == 0, F.col("o_custkey")).alias("parish_id"), F.when(F.col("leg") == 1, F.col("o_custkey") % 25).alias("consulate_id"), F.when(F.col("leg") == 2, F.col("o_custkey") % 22).alias("circle_id"), "votes")
    return rollup.by_leg(leaf, {"parish": (parish, "parish_id"), "consulate": (country, "consulate_id"), "circle": (circle, "circle_id")}, "place", ["votes"])


# --- the crawl ------------------------------------------------------------------------------------------


def _site_graph(spark, sf_dir):
    """(roots, links, valid) of a graph in which a nation's page leads to its suppliers, a supplier's to the next nation, and to parts as documents."""
    s, p, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    name = lambda c, k: F.concat(F.lit(c), k.cast("string"))
    no, yes = F.lit(False), F.lit(True)
    cols = ["src", "pos", "dst", "is_regulation", "is_followed", "is_priority"]
    k = s.count()
    down = s.select(name("n", F.col("s_nationkey")), F.col("s_suppkey").cast("int"), name("s", F.col("s_suppkey")), no, yes, F.col("s_acctbal") > 5000).toDF(*cols)
    on = s.select(name("s", F.col("s_suppkey")), (F.col("s_suppkey") % 7).cast("int"), name("n", (F.col("s_nationkey") + 1) % 25), no, yes, no).toDF(*cols)
    docs = p.filter("p_size > 20").select(name("s", F.col("p_partkey") % k), (F.lit(10) + F.col("p_partkey")).cast("int"), name("p", F.col("p_partkey") % 50), yes, no, no).toDF(*cols)
    valid = p.filter("p_partkey % 50 % 17 = 3").select(name("p", F.col("p_partkey") % 50).alias("dst"))
    roots = n.select(F.col("n_name").alias("site"), name("n", F.col("n_nationkey")).alias("node"))
    return roots, down.unionByName(on).unionByName(docs), valid


@query(
    "bfs_priority",
    """
    WITH RECURSIVE links AS (
        SELECT 'n' || s_nationkey AS src, CAST(s_suppkey AS INTEGER) AS pos, 's' || s_suppkey AS dst, false AS doc, s_acctbal > 5000 AS prio FROM supplier
        UNION ALL SELECT 's' || s_suppkey, CAST(s_suppkey % 7 AS INTEGER), 'n' || ((s_nationkey + 1) % 25), false, false FROM supplier
        UNION ALL SELECT DISTINCT 's' || (p_partkey % (SELECT COUNT(*) FROM supplier)), CAST(10 + p_partkey AS INTEGER), 'p' || (p_partkey % 50), true, false FROM part WHERE p_size > 20),
    valid AS (SELECT DISTINCT 'p' || (p_partkey % 50) AS dst FROM part WHERE p_partkey % 50 % 17 = 3),
    adj AS (SELECT src, list(struct_pack(dst := dst, prio := prio) ORDER BY pos, dst) FILTER (WHERE NOT doc) AS pages, list(dst ORDER BY pos, dst) FILTER (WHERE doc) AS docs FROM links GROUP BY 1),
    s(site, ahead, later, visited, tried, source_url, pdf_url) AS (
        SELECT n_name, CAST([] AS STRUCT(node VARCHAR, depth INTEGER)[]), [struct_pack(node := 'n' || n_nationkey, depth := CAST(0 AS INTEGER))], CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM nation
        UNION ALL
        SELECT site,
            list_filter(list_concat(ahead, CASE WHEN cur.depth < 3 THEN coalesce(list_transform(list_filter(pages, lambda x: x.prio), lambda x: struct_pack(node := x.dst, depth := cur.depth + 1)), []) ELSE [] END), lambda x: NOT list_contains(seen, x.node)),
            list_filter(list_concat(later, CASE WHEN cur.depth < 3 THEN coalesce(list_transform(list_filter(pages, lambda x: NOT x.prio), lambda x: struct_pack(node := x.dst, depth := cur.depth + 1)), []) ELSE [] END), lambda x: NOT list_contains(seen, x.node)),
            seen, list_distinct(list_concat(tried, CASE WHEN hit IS NULL THEN fresh ELSE fresh[:list_position(fresh, hit)] END)), CASE WHEN hit IS NOT NULL THEN cur.node END, hit
        FROM (SELECT *, list_filter(fresh, lambda x: list_contains(ok, x))[1] AS hit FROM (
            SELECT t.*, pages, list_append(visited, cur.node) AS seen, list_filter(coalesce(docs, []), lambda x: NOT list_contains(tried, x)) AS fresh
            FROM (SELECT *, CASE WHEN len(ahead) > 0 THEN ahead[1] ELSE later[1] END AS cur FROM s WHERE pdf_url IS NULL AND len(visited) < 8 AND len(ahead) + len(later) > 0) t LEFT JOIN adj ON src = cur.node), (SELECT list(dst) AS ok FROM valid)))
    SELECT site, CAST(len(visited) AS INTEGER) AS visited, CAST(len(tried) AS INTEGER) AS attempted, source_url, pdf_url FROM s
    QUALIFY row_number() OVER (PARTITION BY site ORDER BY len(visited) DESC) = 1
    """,
)
def bfs_priority(spark, sf_dir):
    return pages.crawl(*_site_graph(spark, sf_dir), depth=3, budget=8)


def _plain_walk(stop: str) -> str:
    """A walk breadth first that keeps all documents, page by page, until `stop`; nothing is shared with the operator."""
    return f"""
    WITH RECURSIVE links AS (
        SELECT 'n' || s_nationkey AS src, CAST(s_suppkey AS INTEGER) AS pos, 's' || s_suppkey AS dst, false AS doc FROM supplier
        UNION ALL SELECT 's' || s_suppkey, CAST(s_suppkey % 7 AS INTEGER), 'n' || ((s_nationkey + 1) % 25), false FROM supplier
        UNION ALL SELECT DISTINCT 's' || (p_partkey % (SELECT COUNT(*) FROM supplier)), CAST(10 + p_partkey AS INTEGER), 'p' || (p_partkey % 50), true FROM part WHERE p_size > 20),
    adj AS (SELECT src, list(dst ORDER BY pos, dst) FILTER (WHERE NOT doc) AS pages, list(dst ORDER BY pos, dst) FILTER (WHERE doc) AS docs FROM links GROUP BY 1),
    s(site, queue, visited, found, quiet) AS (
        SELECT n_name, ['n' || n_nationkey], CAST([] AS VARCHAR[]), CAST([] AS STRUCT(d VARCHAR, p VARCHAR)[]), 0 FROM nation
        UNION ALL
        SELECT site, list_filter(list_concat(queue, coalesce(pages, [])), lambda x: NOT list_contains(seen, x)), seen,
            list_concat(found, list_transform(list_filter(list_distinct(coalesce(docs, [])), lambda x: NOT list_contains(list_transform(found, lambda y: y.d), x)), lambda x: struct_pack(d := x, p := cur))),
            CASE WHEN len(docs) > 0 THEN 0 ELSE quiet + 1 END
        FROM (SELECT t.*, docs, pages, list_append(visited, cur) AS seen FROM (SELECT *, queue[1] AS cur FROM s WHERE len(queue) > 0 AND {stop}) t LEFT JOIN adj ON src = cur)),
    last AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY site ORDER BY len(visited) DESC) = 1)
    """


@query("crawl_candidates", _plain_walk("len(visited) < 20") + "SELECT site, u.p AS source_url, u.d AS pdf_url FROM (SELECT site, unnest(found) AS u FROM last)")
def crawl_candidates(spark, sf_dir):
    roots, links, _ = _site_graph(spark, sf_dir)
    return crawl.crawl(roots, links.withColumn("is_priority", F.lit(False)), None, None, 20, first=False)[1].select("site", "source_url", "pdf_url")


@query("crawl_idle", _plain_walk("len(visited) < 20 AND quiet < 3") + "SELECT site, CAST(len(visited) AS INTEGER) AS visited, CAST(len(found) AS INTEGER) AS attempted FROM last")
def crawl_idle(spark, sf_dir):
    roots, links, _ = _site_graph(spark, sf_dir)
    return crawl.crawl(roots, links.withColumn("is_priority", F.lit(False)), None, None, 20, first=False, idle=3)[0].select("site", "visited", "attempted")


@query("contact_codes", "SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 4, '0') END AS ine_code FROM customer")
def contact_codes(spark, sf_dir):
    # a name for each key, whatever names the table repeats
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat_ws(" ", "c_name", "c_custkey").alias("municipality"))
    sheet = c.filter("id % 10 <> 0").select(F.col("id").alias("pos"), F.concat(F.lpad(F.col("id").cast("string"), 4, "0")).alias("code"), F.col("municipality").alias("name"))
    unique, _ = flows.city_codes(sheet)
    return lookup_names(c, unique).select("id", F.col("code").alias("ine_code"))


def lookup_names(rows, unique):
    """Codes by equal or folded name; no other names are near in these tables."""
    named = match.resolve(match.with_alias(rows, "municipality"), "municipality", unique.withColumn("p", F.col("code")), "name", "p", threshold=1.0)
    return named.join(unique.withColumnRenamed("name", "matched"), "matched", "left")


@query("parish_links", "SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS city, n_name AS city_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def parish_links(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit("01")).alias("code"))
    n = table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("city_code"), F.col("n_name").alias("city_name"))
    linked = lookup.prefix_join(c, "code", n, "city_code").filter("city_code is not null")
    return linked.select("id", F.col("city_code").cast("int").cast("string").alias("city"), "city_name")


@query("fetched_pages", "SELECT c_custkey AS id, html FROM customer LEFT JOIN pages ON page_id = c_custkey")
def fetched_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("url"), "html")
    return readers.fetched(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url")), p).select(F.col("url").alias("id"), "html")


@query("tagged_first_seen", "SELECT name, arg_min(origin, pos) AS origin FROM (SELECT p_name AS name, 'a' AS origin, p_partkey AS pos FROM part UNION ALL SELECT p_name, 'b', p_partkey + 1000000 FROM part) GROUP BY 1")
def tagged_first_seen(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    both = dedup.tagged_union({"a": p, "b": p.withColumn("pos", F.col("pos") + 1_000_000)})
    return dedup.first_seen(both, ["name"], "pos").select("name", "origin")
