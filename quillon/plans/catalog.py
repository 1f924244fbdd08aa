"""The registered queries of the core engine with their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import http as H
from quillon.functions import text as T
from quillon.functions import url as U
from quillon.operators import dedup, documents, lookup, match, merge, pages, rollup, stateful, validate
from quillon.plans import flows
from quillon.session import dealt, scratch, table
from quillon.sources import readers
from quillon.streaming import ingest, limits

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under a name, with SQL for the oracle where there is some."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


@query(
    "rollup_city",
    """
    SELECT n_nationkey AS city_id, n_name AS city, COUNT(*) AS n_results,
           CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS votes
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2
    """,
)
def rollup_city(spark, sf_dir):
    leaf = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("votes"), F.count(F.lit(1)).alias("n"))
    parish = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("city_id"))
    city = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"))
    return rollup.roll_up(leaf.join(parish, "o_custkey"), city, "city_id", ["city_id", "city"], ["votes", "n"]).withColumnRenamed("n", "n_results")


# --- roll-ups ---------------------------------------------------------------------------------

CENTS = "CAST(round({0} * 100) AS BIGINT)"


def _cents(column):
    return F.round(F.col(column) * 100).cast("long")


def _leaf(spark, sf_dir):
    """Leaf results: votes and results by parish (customer), summed before the join, with its city (nation)."""
    leaf = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(_cents("o_totalprice")).alias("votes"), F.count(F.lit(1)).alias("n_results"))
    parish = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("city_id"), "c_mktsegment")
    return leaf.join(parish, "o_custkey")


@query(
    "rollup_district",
    f"""
    SELECT r_regionkey AS district_id, r_name AS district, COUNT(*) AS n_results, CAST(SUM({CENTS.format("o_totalprice")}) AS BIGINT) AS votes
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2
    """,
)
def rollup_district(spark, sf_dir):
    district = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_regionkey").alias("district_id"), F.col("r_name").alias("district"))
    city = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("city_id"), "n_regionkey").join(district, "n_regionkey")
    return rollup.roll_up(_leaf(spark, sf_dir), city, "city_id", ["district_id", "district"], ["votes", "n_results"])


@query(
    "rollup_choice_votes",
    """
    SELECT n_name AS city, p_brand AS choice, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS votes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
    """,
)
def rollup_choice_votes(spark, sf_dir):
    votes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("long").alias("votes"))
    choice = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("choice"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parish = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    city = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    # an order has hardly a part twice: the choice is told first (by a broadcast where parts are few), then votes are summed by order and choice, once
    ballot = votes.join(choice, "p_partkey").groupBy("o_orderkey", "choice").agg(F.sum("votes").alias("votes"))
    leaf = ballot.join(orders, "o_orderkey").groupBy("o_custkey", "choice").agg(F.sum("votes").alias("votes")).join(parish, "o_custkey")
    return leaf.groupBy("n_nationkey", "choice").agg(F.sum("votes").alias("votes")).join(city, "n_nationkey").select("city", "choice", "votes")


@query(
    "national_totals",
    f"""
    WITH leaf AS (
        SELECT r_name AS district, n_name AS city, {CENTS.format("o_totalprice")} AS votes
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'abroad', 'consulates', {CENTS.format("s_acctbal")} FROM supplier)
    SELECT district, city, CAST(SUM(votes) AS BIGINT) AS votes, CAST(2 - grouping(district) - grouping(city) AS INTEGER) AS level FROM leaf GROUP BY ROLLUP (district, city)
    """,
)
def national_totals(spark, sf_dir):
    # the two territory legs: parishes roll up to cities and districts, consulates count in the whole only
    city = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    city = city.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("r_name").alias("district"))
    home = _leaf(spark, sf_dir).groupBy("city_id").agg(F.sum("votes").alias("votes")).join(city, "city_id").select("district", "city", "votes")
    abroad = table(spark, sf_dir, "supplier").select(F.lit("abroad").alias("district"), F.lit("consulates").alias("city"), _cents("s_acctbal").alias("votes"))
    return rollup.national_totals(home.unionByName(abroad), ["district", "city"], ["votes"])


@query(
    "dhondt_seats",
    """
    WITH v AS (SELECT c_nationkey AS circle, c_mktsegment AS choice, COUNT(*) AS votes FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    q AS (SELECT circle, choice, row_number() OVER (PARTITION BY circle ORDER BY votes / d DESC, votes DESC, choice, d) AS r
          FROM v CROSS JOIN (SELECT unnest(range(1, 11)) AS d))
    SELECT circle, choice, COUNT(*) AS seats FROM q WHERE r <= 10 GROUP BY 1, 2
    """,
)
def dhondt_seats(spark, sf_dir):
    votes = _leaf(spark, sf_dir).groupBy(F.col("city_id").alias("circle"), F.col("c_mktsegment").alias("choice")).agg(F.sum("n_results").alias("votes"))
    return rollup.dhondt(votes, "circle", "choice", "votes", 10)


# --- codes and prefixes ---------------------------------------------------------------------------

_CODES = "SELECT p_partkey AS pos, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code, p_name || ' ' || p_brand AS name FROM part"


def _codes(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("pos"), F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("code"), F.concat_ws(" ", "p_name", "p_brand").alias("name"))


@query("unique_codes", f"SELECT name, min(code) AS code FROM ({_CODES}) GROUP BY name HAVING COUNT(*) = 1")
def unique_codes(spark, sf_dir):
    return lookup.unique_codes(_codes(spark, sf_dir), "code", "name")


@query("ambiguous_codes", f"SELECT name, string_agg(code, ',' ORDER BY pos) AS codes FROM ({_CODES}) GROUP BY name HAVING COUNT(*) > 1")
def ambiguous_codes(spark, sf_dir):
    return lookup.ambiguous_codes(_codes(spark, sf_dir), "code", "name", "pos").select("name", F.array_join("codes", ",").alias("codes"))


@query(
    "code_pattern_filter",
    r"""
    SELECT code, trim(name) AS name FROM (
        SELECT CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE '' END || lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 3 = 0 THEN 6 ELSE 4 END, '0') AS code,
               CASE WHEN c_custkey % 11 <> 0 THEN ' ' || c_name || ' ' END AS name FROM customer)
    WHERE name IS NOT NULL AND regexp_full_match(code, '\d{4}') AND code NOT IN ('0100', '0001')
    """,
)
def code_pattern_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    code = F.concat(F.when(F.col("c_custkey") % 7 == 0, " ").otherwise(""), F.when(F.col("c_custkey") % 3 == 0, F.lpad(key, 6, "0")).otherwise(F.lpad(key, 4, "0")))
    rows = rows.select(code.alias("code"), F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("name"))
    return lookup.clean_codes(rows, "code", "name", r"^\d{4}$", ["0100", "0001"])


_PREFIXES = [("0", "north"), ("00", "upper north"), ("1", "centre"), ("12", "coast"), ("123", "cape"), ("3", "islands")]
_PREFIX_SQL = ", ".join(f"('{p}', '{v}')" for p, v in _PREFIXES)


@query(
    "longest_prefix_join",
    f"""
    SELECT code, arg_max(district, length(prefix)) AS district
    FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS code FROM customer) LEFT JOIN (VALUES {_PREFIX_SQL}) p(prefix, district) ON starts_with(code, prefix)
    GROUP BY code
    """,
)
def longest_prefix_join(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 4, "0").alias("code"))
    return lookup.longest_prefix(rows.distinct(), "code", spark.createDataFrame(_PREFIXES, "prefix string, district string"), "prefix", "district")


_PARISHES = """
    (SELECT c_custkey AS id, c_name AS name, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || CASE WHEN c_custkey % 5 = 0 THEN '9' ELSE '0' END || '1' ||
     lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS code FROM customer)"""
_CITIES = "(SELECT n_nationkey AS city_id, n_name AS city, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '01' AS city_code FROM nation)"


def _parishes(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    code = F.concat(two(F.col("c_nationkey")), F.when(F.col("c_custkey") % 5 == 0, "9").otherwise("0"), F.lit("1"), two(F.col("c_custkey") % 100))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), code.alias("code"))


def _cities(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("01")).alias("city_code"))


@query("prefix_city_join", f"SELECT id, code, city_id, city FROM {_PARISHES} LEFT JOIN {_CITIES} ON substr(code, 1, 4) = city_code")
def prefix_city_join(spark, sf_dir):
    return lookup.prefix_join(_parishes(spark, sf_dir), "code", _cities(spark, sf_dir), "city_code").select("id", "code", "city_id", "city")


@query(
    "fallback_join",
    f"""
    WITH p AS (SELECT id, code, 'nation_' || CAST(id % 25 AS VARCHAR) AS name FROM {_PARISHES}), c AS (SELECT * FROM {_CITIES}),
    hit AS (SELECT id, city_id, 'code' AS matched_by FROM p JOIN c ON substr(code, 1, 4) = city_code)
    SELECT * FROM hit UNION ALL
    SELECT id, city_id, 'name' FROM p JOIN c ON upper(name) = city
    WHERE NOT (CAST(substr(code, 1, 2) AS INT) BETWEEN 1 AND 18) AND id NOT IN (SELECT id FROM hit)
    """,
)
def fallback_join(spark, sf_dir):
    parishes = _parishes(spark, sf_dir).withColumn("name", F.concat(F.lit("nation_"), (F.col("id") % 25).cast("string")))
    resolve = lambda rows, name, parents, parent: match.resolve(rows, name, parents, parent, "city_id").filter("matched is not null").withColumnRenamed("matched", parent)
    mainland = [f"{i:02d}" for i in range(1, 19)]
    found = lookup.with_fallback(parishes, "code", "name", _cities(spark, sf_dir), "city_code", "city", mainland, resolve)
    return found.select("id", "city_id", "matched_by")


@query(
    "region_hint_resolve",
    """
    WITH codes(base, codes) AS (VALUES ('Lagoa', ['0806', '4201']), ('Calheta', ['3101', '4501'])),
    hints(hint, prefix) AS (VALUES ('açores', '4'), ('madeira', '31'), ('algarve', '08')),
    names AS (SELECT c_custkey AS id, ['Lagoa (Algarve)', 'Lagoa (Açores)', 'Calheta (Madeira)', 'Calheta (Algarve)', 'Lagoa (Porto)', 'Other (Madeira)'][c_custkey % 6 + 1] AS name FROM customer)
    SELECT id, name, CASE WHEN len(list_filter(codes, lambda c: starts_with(c, prefix))) = 1 THEN list_filter(codes, lambda c: starts_with(c, prefix))[1] END AS code
    FROM names LEFT JOIN codes ON base = regexp_extract(name, '^(.*) \\(', 1) LEFT JOIN hints ON hint = lower(regexp_extract(name, '\\((.*)\\)', 1))
    """.replace("\\\\", "\\"),
)
def region_hint_resolve(spark, sf_dir):
    options = ["Lagoa (Algarve)", "Lagoa (Açores)", "Calheta (Madeira)", "Calheta (Algarve)", "Lagoa (Porto)", "Other (Madeira)"]
    pick = F.element_at(F.array(*map(F.lit, options)), (F.col("c_custkey") % 6 + 1).cast("int"))
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), pick.alias("name"))
    codes = spark.createDataFrame([("Lagoa", ["0806", "4201"]), ("Calheta", ["3101", "4501"])], "base string, codes array<string>")
    return match.region_hint(names, "name", codes, "base", "codes")


# --- names ----------------------------------------------------------------------------------------

_LCS_ROW = """list_transform(range(1, len(flags) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i:
    greatest(prev[i], (CASE WHEN i > 1 THEN prev[i - 1] ELSE 0 END) + flags[i]))))"""
_LCS = f"""list_max(list_reduce(list_prepend(list_transform(string_split(b, ''), lambda d: 0),
    list_transform(string_split(a, ''), lambda c: list_transform(string_split(b, ''), lambda d: CASE WHEN d = c THEN 1 ELSE 0 END))), lambda prev, flags: {_LCS_ROW}))"""


@query(
    "fuzzy_resolve",
    f"""
    WITH cand AS (SELECT p_name AS b, min(p_partkey) AS pos FROM part GROUP BY 1),
    names AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN p_name || 's' ELSE 'x' || p_name || 'yz' END AS a FROM part),
    exact AS (SELECT a, b AS m FROM names JOIN cand ON a = b),
    folded AS (SELECT a, arg_min(b, pos) AS m FROM names JOIN cand ON lower(a) = lower(b) WHERE a NOT IN (SELECT a FROM exact) GROUP BY a),
    r AS (SELECT a, b, pos, 2 * {_LCS} / (length(a) + length(b)) AS ratio FROM names CROSS JOIN cand
          WHERE a NOT IN (SELECT a FROM exact) AND a NOT IN (SELECT a FROM folded)),
    third AS (SELECT a, b AS m FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY ratio DESC, pos) AS k FROM r) WHERE k = 1 AND ratio >= 0.9)
    SELECT a AS name, m AS matched FROM names LEFT JOIN (SELECT * FROM exact UNION ALL SELECT * FROM folded UNION ALL SELECT * FROM third) USING (a)
    """,
)
def fuzzy_resolve(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.col("p_name")).when(k == 1, F.upper("p_name")).when(k == 2, F.concat("p_name", F.lit("s"))).otherwise(F.concat(F.lit("x"), "p_name", F.lit("yz")))
    return match.resolve(part.select(name.alias("name")).distinct(), "name", part, "p_name", "p_partkey")


@query(
    "accent_fold_match",
    """
    SELECT lower(strip_accents(w)) AS folded, COUNT(DISTINCT w) AS spellings, COUNT(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE regexp_full_match(w, '[a-zà-åç-öù-ýÿ]+') GROUP BY 1
    """,
)
def accent_fold_match(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("w")).filter(F.col("w").rlike("^[a-zà-åç-öù-ýÿ]+$"))
    # each spelling once before its form is worked out
    words = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).withColumn("folded", T.fold(F.col("w")))
    return words.groupBy("folded").agg(F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n"))


@query(
    "greedy_match",
    """
    WITH RECURSIVE l AS (SELECT n_regionkey AS d, n_name AS n, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation),
    r AS (SELECT n_regionkey AS d, CASE WHEN n_nationkey % 3 = 0 THEN n_name || 's' ELSE n_name END AS c, n_nationkey AS p FROM nation WHERE n_nationkey % 4 <> 1),
    -- names of this length reach 0.9 only if one is the other with a character more
    cand AS (SELECT l.d, i, c, p, CASE WHEN c = n THEN 3.0 WHEN lower(c) = lower(n) THEN 2.0
             WHEN abs(length(c) - length(n)) = 1 AND len(list_filter(range(1, greatest(length(c), length(n)) + 1), lambda k:
                  CASE WHEN length(c) > length(n) THEN c[:k - 1] || c[k + 1:] = n ELSE n[:k - 1] || n[k + 1:] = c END)) > 0
             THEN 2.0 * least(length(c), length(n)) / (length(c) + length(n)) END AS r FROM l JOIN r ON l.d = r.d),
    alike AS (SELECT l.d, l.i, l.n, (SELECT list(c ORDER BY r DESC, p) FROM cand WHERE cand.d = l.d AND cand.i = l.i AND r >= 0.9) AS c FROM l),
    s(d, i, n, best, taken) AS (
        SELECT DISTINCT d, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST([] AS VARCHAR[]) FROM l
        UNION ALL
        SELECT d, i, n, best, CASE WHEN best IS NULL THEN taken ELSE list_append(taken, best) END FROM (
            SELECT a.d, a.i, a.n, s.taken, list_filter(a.c, lambda x: NOT list_contains(s.taken, x))[1] AS best FROM s JOIN alike a ON a.d = s.d AND a.i = s.i + 1))
    SELECT d AS district, n AS left_name, best AS right_name FROM s WHERE best IS NOT NULL
    """,
)
def greedy_match(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("district"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("pos"))
    other = n.withColumn("name", F.when(F.col("pos") % 3 == 0, F.concat("name", F.lit("s"))).otherwise(F.col("name"))).filter("pos % 4 != 1")
    return match.greedy_pairs(n, other, "district", "name", "pos")


@query(
    "name_aliases",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'Vila da Praia da Vitória' ELSE c_name END AS name FROM customer",
)
def name_aliases(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, "Praia da Vitória").otherwise(F.col("c_name")).alias("name"))
    return match.with_alias(rows, "name")


# --- pending work, unions, first occurrences --------------------------------------------------------

_DONE = "SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"


def _done(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")


@query("pending_anti_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({_DONE})")
def pending_anti_join(spark, sf_dir):
    return merge.pending(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), _done(spark, sf_dir), ["c_custkey"])


@query(
    "cache_three_way",
    """
    WITH c AS (SELECT o_custkey, max(CASE WHEN o_totalprice > 200000 THEN o_totalprice END) AS best FROM orders
               WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY 1)
    SELECT c_custkey, CASE WHEN o_custkey IS NULL THEN 'missing' WHEN best IS NULL THEN 'partial' ELSE 'complete' END AS cache_state
    FROM customer LEFT JOIN c ON c_custkey = o_custkey
    """,
)
def cache_three_way(spark, sf_dir):
    cache = _done(spark, sf_dir).withColumn("best", F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")))
    return merge.by_cache(table(spark, sf_dir, "customer").select("c_custkey"), cache, "c_custkey", "best")


@query(
    "tagged_union_pending",
    """
    SELECT 'town_hall' AS origin, c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'consulate', s_suppkey, s_name FROM supplier WHERE s_acctbal > 0
    """,
)
def tagged_union_pending(spark, sf_dir):
    c = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return dedup.tagged_union({"town_hall": c, "consulate": s})


@query("first_seen_dedup", "SELECT p_name, min(p_partkey) AS p_partkey, arg_min(p_brand, p_partkey) AS p_brand FROM part GROUP BY 1")
def first_seen_dedup(spark, sf_dir):
    return dedup.first_seen(table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand"), ["p_name"], "p_partkey")


@query(
    "known_missing_union",
    """
    WITH k(url, name) AS (VALUES ('https://www.cm-known.pt', 'Known'), ('https://www.cm-other.pt', 'Other')),
    p AS (SELECT url, 'page' AS name FROM pages UNION ALL SELECT 'https://www.cm-known.pt', 'page')
    SELECT * FROM p UNION ALL SELECT * FROM k WHERE url NOT IN (SELECT url FROM p)
    """,
)
def known_missing_union(spark, sf_dir):
    known = spark.createDataFrame([("https://www.cm-known.pt", "Known"), ("https://www.cm-other.pt", "Other")], "url string, name string")
    pages = table(spark, sf_dir, "pages").select("url", F.lit("page").alias("name"))
    pages = pages.unionByName(spark.createDataFrame([("https://Http://www.cm-known.pt", "page")], "url string, name string"))
    pages = pages.withColumn("url", dedup.replaced(F.col("url"), {"https://Http://www.cm-known.pt": "https://www.cm-known.pt"}))
    return dedup.with_known(pages, known, ["url"])


@query("set_difference", "SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal < 2000")
def set_difference(spark, sf_dir):
    present = table(spark, sf_dir, "supplier").filter("s_acctbal < 2000").select(F.col("s_nationkey").alias("n_nationkey"))
    return dedup.difference(table(spark, sf_dir, "nation"), present, ["n_nationkey"])


@query("batches", "SELECT c_nationkey, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 8 AS batch FROM customer")
def batches(spark, sf_dir):
    return dedup.batches(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), "c_custkey", 8, ["c_nationkey"])


# --- loads ----------------------------------------------------------------------------------------

_OLD = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0"
_NEW = "SELECT c_custkey AS id, upper(c_name) AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS balance FROM customer WHERE c_custkey % 2 = 0"


def _old_new(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.filter("c_custkey % 3 <> 0").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    new = c.filter("c_custkey % 2 = 0").selectExpr("c_custkey AS id", "upper(c_name) AS name", "CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS balance")
    return old, new


@query("upsert", f"SELECT * FROM ({_OLD}) WHERE id % 2 <> 0 UNION ALL {_NEW}")
def upsert(spark, sf_dir):
    return merge.upsert(*_old_new(spark, sf_dir), ["id"])


@query("insert_if_absent", f"{_OLD} UNION ALL SELECT * FROM ({_NEW}) WHERE id % 3 = 0")
def insert_if_absent(spark, sf_dir):
    return merge.insert_if_absent(*_old_new(spark, sf_dir), ["id"], "name")


@query(
    "conditional_update",
    f"""
    SELECT o.id, CASE WHEN n.id IS NOT NULL THEN n.balance ELSE o.balance END AS balance, n.id IS NOT NULL AND n.balance IS DISTINCT FROM o.balance AS changed
    FROM ({_OLD}) o LEFT JOIN ({_NEW}) n ON o.id = n.id
    """,
)
def conditional_update(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return merge.update_changed(old.select("id", "balance"), new, "id", "balance")


@query("fill_known", f"SELECT o.id, coalesce(n.balance, o.balance) AS balance FROM ({_OLD}) o LEFT JOIN ({_NEW}) n ON o.id = n.id")
def fill_known(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return merge.fill_known(old.select("id", "balance"), new, "id", "balance")


@query(
    "nested_contacts",
    "SELECT c_custkey AS id, c_name AS municipality, CASE WHEN c_acctbal > 0 THEN 'mail' || c_custkey || '@cm.pt' END AS email, c_mktsegment AS mayor, '2021' AS era FROM customer",
)
def nested_contacts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    hall = F.struct(F.when(F.col("c_acctbal") > 0, F.concat(F.lit("mail"), F.col("c_custkey").cast("string"), F.lit("@cm.pt"))).alias("email"), F.col("c_mktsegment").alias("president"))
    nested = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("municipality"), hall.alias("town_hall"))
    return nested.select("id", "municipality", "town_hall.email", F.col("town_hall.president").alias("mayor"), F.lit("2021").alias("era"))


# --- URLs and pages -------------------------------------------------------------------------------


@query(
    "url_normalize_v1",
    r"""SELECT page_id, regexp_extract(url, '^(https?)', 1) || '://' || lower(regexp_extract(url, '://([^/?#]+)', 1)) || regexp_replace(regexp_extract(url, '://[^/?#]+([^?#]*)', 1), '/+$', '')
        || regexp_extract(url, '(\?[^#]*)', 1) AS url FROM pages""",
)
def url_normalize_v1(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_keep_query(F.col("url")).alias("url"))


@query(
    "url_normalize_v2",
    r"""WITH p AS (SELECT page_id, regexp_extract(url, '^(https?)', 1) || '://' || lower(regexp_extract(url, '://([^/?#]+)', 1)) ||
        regexp_replace(regexp_extract(url, '://[^/?#]+([^?#]*)', 1), '/+$', '') AS base, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages)
        SELECT page_id, base || CASE WHEN q <> '' THEN '?' || array_to_string(list_sort(string_split(q, '&')), '&') ELSE '' END AS url FROM p""",
)
def url_normalize_v2(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.normalize_sorted_query(F.col("url")).alias("url"))


@query("url_normalize_v3", r"SELECT page_id, regexp_replace(string_split(url, '#')[1], '/+$', '') AS url FROM pages")
def url_normalize_v3(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.strip_fragment(F.col("url")).alias("url"))


_ANCHORS = r"""
    (SELECT page_id, url, i - 1 AS pos, regexp_extract(a[i], 'href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_extract(a[i], '>([^<]*)</a>', 1), '&amp;', '&', 'g')) AS text
     FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*>[^<]*</a>') AS a FROM pages)))"""


@query("anchors", f"SELECT page_id, CAST(pos AS INTEGER) AS pos, href, text FROM {_ANCHORS} WHERE href <> ''")
def anchors(spark, sf_dir):
    return pages.anchors(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "pos", "href", "text")


_AWKWARD = (
    "<a href=/x%1$s>one</a><A HREF = \"/y?a=%1$s&amp;b=2\">two &eacute; &lt;b&gt;</A><!-- <a href='/c'>no</a> --><script>var s = '<a href=\"/s\">no</a>';</script>"
    "<a title='a > b' href=\"/z'%1$s\">three</a><a data-href='/no' href='/yes%1$s'>four</a><div><a href='/open%1$s'>fi<b>ve<a href='/next%1$s'>six</a></div>"
    "<textarea><a href='/t'>no</a></textarea><a name=top>seven</a><a href>eight</a><p title=\"<a href='/q'>\">a < b <a href='/last%1$s' href='/twice%1$s'>n<!-- > -->ine<style>x</style></p><a href='/cut"
)


@query(
    "awkward_links",
    """
    SELECT c_custkey AS id, pos, replace(href, '#', CAST(c_custkey AS VARCHAR)) AS href, text FROM customer,
        (VALUES (0, '/x#', 'one'), (1, '/y?a=#&b=2', 'two é <b>'), (2, '/z''#', 'three'), (3, '/yes#', 'four'), (4, '/open#', 'five'), (5, '/next#', 'six'), (8, '/twice#', 'nine')) v(pos, href, text)
    """,
)
def awkward_links(spark, sf_dir):
    html = F.format_string(_AWKWARD, F.col("id").cast("string"))
    keys = dealt(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id")
    return pages.anchors(keys.withColumn("html", html)).select("id", "pos", "href", "text")


@query(
    "nested_rows",
    """
    SELECT s_suppkey AS id, t AS "table", pos, CAST(n AS INTEGER) AS n, replace(texts, '#', CAST(s_suppkey AS VARCHAR)) AS texts FROM supplier,
        (VALUES (0, 0, 0, ''), (0, 1, 3, 'a#|in#er|c'), (1, 0, 2, 'in#|er'), (0, 2, 2, 'd|e#'), (-1, 0, 1, 'f')) v(t, pos, n, texts)
    """,
)
def nested_rows(spark, sf_dir):
    html = "<table><tr><th>h<tr><td>a%1$s<td><table><tbody><tr><td>in%1$s<td>er</table></td><td>c</tr><tr><td>d</td><td><p>e%1$s</table><tr><td>f"
    keys = dealt(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), "id")
    page = keys.withColumn("html", F.format_string(html, F.col("id").cast("string")))
    return pages.table_rows(page, header=0).select("id", "table", "pos", F.size("cells").alias("n"), F.array_join("texts", "|").alias("texts"))


@query(
    "url_join",
    rf"""SELECT page_id, CAST(pos AS INTEGER) AS pos, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href
         ELSE regexp_extract(url, '^([a-z]+://[^?#]*/)', 1) || href END AS target FROM {_ANCHORS} WHERE href <> ''""",
)
def url_join(spark, sf_dir):
    links = pages.anchors(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return links.select("page_id", "pos", U.join(F.col("url"), F.col("href")).alias("target"))


@query("https_upgrade", "SELECT page_id, regexp_replace(url, '^http://', 'https://') AS url FROM pages")
def https_upgrade(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.to_https(F.col("url"), "any_case").alias("url"))


@query(
    "table_rows",
    """
    SELECT n_nationkey AS id, n_name AS municipality, 'P' || n_nationkey AS president, CAST(NULL AS VARCHAR) AS address, '2' || n_nationkey AS phone,
           'm' || n_nationkey || '@cm.pt' AS email, 'https://www.cm-' || n_nationkey || '.pt' AS website FROM nation
    """,
)
def table_rows(spark, sf_dir):
    row = "<tr><td> %s </td><td>P%s</td><td> </td><td>2%s</td><td><a href='mailto:x'>m%s@cm.pt</a><a href='http://www.cm-%s.pt'>site</a></td></tr>"
    k = F.col("n_nationkey").cast("string")
    page = F.concat(F.lit("<div><table><tr><th>Name</th></tr>"), F.format_string(row, "n_name", k, k, k, k), F.lit("</table></div>"))
    html = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), page.alias("html"))
    return pages.contacts(pages.table_rows(html)).drop("pos")


@query(
    "link_classify",
    rf"""
    SELECT page_id, CAST(pos AS INTEGER) AS pos, w LIKE '%the%' AND d AND w LIKE '%and%' AS is_regulation, d AS is_document, w LIKE '%the%' AS is_priority,
           NOT d AND p NOT LIKE '%attion%' AND (w LIKE '%the%' OR w LIKE '%to%') AS is_followed
    FROM (SELECT page_id, pos, lower(strip_accents(href || ' ' || text)) AS w, lower(strip_accents(href)) AS p, regexp_matches(lower(href), '(\.pdf|\.js)$') AS d
          FROM (SELECT page_id, pos, href || CASE WHEN pos % 3 = 0 THEN '.pdf' ELSE '' END AS href, text FROM {_ANCHORS} WHERE href <> ''))
    """,
)
def link_classify(spark, sf_dir):
    links = pages.anchors(table(spark, sf_dir, "pages").select("page_id", "html"))
    links = links.withColumn("href", F.concat("href", F.when(F.col("pos") % 3 == 0, ".pdf").otherwise("")))
    found = pages.classified(links, plan=["the"], nav=["the", "to"], skip=["attion"], regulation="and")
    return found.select("page_id", "pos", "is_regulation", "is_document", "is_priority", "is_followed")


@query(
    "same_host_links",
    rf"""SELECT page_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE href NOT LIKE 'http%' OR regexp_extract(href, '://([^/?#]+)', 1) = regexp_extract(url, '://([^/?#]+)', 1)) AS same_host
         FROM {_ANCHORS} WHERE href <> '' GROUP BY 1""",
)
def same_host_links(spark, sf_dir):
    links = pages.anchors(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    same = U.same_host(U.join(F.col("url"), F.col("href")), F.col("url"))
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("same_host"))


@query(
    "field_map",
    rf"""
    WITH l AS (SELECT page_id, pos, href, string_split(trim(href, '/'), '/') AS s FROM {_ANCHORS} WHERE href <> ''),
    m AS (SELECT page_id, pos, href, CASE WHEN list_contains(s, 'the') THEN 'first' WHEN list_contains(s, 'and') THEN 'second' END AS field FROM l)
    SELECT page_id, field, arg_min(href, pos) AS url FROM m WHERE field IS NOT NULL GROUP BY 1, 2
    """,
)
def field_map(spark, sf_dir):
    links = pages.anchors(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.fields(links, "page_id", "href", "pos", {"the": "first", "and": "second"})


@query(
    "section_carry_forward",
    """
    SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w AS heading,
           CASE WHEN last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w IS NOT NULL THEN
           nullif(last_value(CASE WHEN role = 'user' THEN '-' WHEN role = 'assistant' THEN 'answer' WHEN role = 'system' THEN '-' END IGNORE NULLS) OVER w, '-') END AS section
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
    """,
)
def section_carry_forward(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    head, label = F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role").isin("assistant", "system"), F.col("role"))
    return pages.sections(c, "conv_id", "turn", head, label, {"assistant": "answer"}).select("conv_id", "turn", "heading", "section")


@query(
    "bfs_reach",
    """
    WITH RECURSIVE e AS (SELECT DISTINCT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM lineitem UNION SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem),
    r(node, depth) AS (SELECT 's1', 0 UNION SELECT dst, depth + 1 FROM r JOIN e ON node = src WHERE depth < 2)
    SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1
    """,
)
def bfs_reach(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")).distinct()  # noqa: E741
    edges = l.unionByName(l.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return pages.reach(edges, spark.createDataFrame([("s1",)], "node string"), 2)


# --- documents and files ------------------------------------------------------------------------------

_TERMS = ["the", "de", "ti", "tion"]
_SCORE = " + ".join(f"(length(lower(text)) - length(replace(lower(text), '{t}', ''))) // {len(t)}" for t in _TERMS)


@query("keyword_score", f"SELECT doc_id, CAST({_SCORE} AS BIGINT) AS score, {_SCORE} >= 5 AND n_chars >= 1000 AS looks_like_plan FROM documents")
def keyword_score(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", T.keyword_score(F.col("text"), _TERMS).alias("score"))
    return d.select("doc_id", "score", documents.looks_like_plan(F.col("n_chars"), F.col("score"), 1000, 5).alias("looks_like_plan"))


@query(
    "best_document",
    f"""
    WITH l AS (SELECT source, quantile_cont(n_chars, 0.75) AS lim FROM documents GROUP BY 1),
    s AS (SELECT source, doc_id, CAST({_SCORE} AS BIGINT) AS score FROM documents JOIN l USING (source) WHERE n_chars > lim)
    SELECT source, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0) WHERE k = 1
    """,
)
def best_document(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    return documents.best_documents(d, "source", "n_chars", "text", "doc_id", _TERMS).select("source", "doc_id", "score")


_NAMES = """['PE' || y || '_x.xlsx', 'AR_' || y || '.xls', 'PR ' || y || '_Globais.xlsx', 'resultados_ALRAm' || y || '.xlsx', 'resultados_eleicoes_AUT' || substr(y, 3, 2) || '_CM.xlsx',
    'resultados_eleicoes_AF_' || y || '.xlsx', 'PE_' || y || '.xlsx', 'notes.txt'][o_orderkey % 8 + 1]"""


@query(
    "filename_match",
    f"""
    WITH n AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS VARCHAR) AS y, o_orderkey % 8 AS k FROM orders), f AS (SELECT id, k, y, {_NAMES.replace("o_orderkey", "id")} AS name FROM n)
    SELECT id, name, ['european', 'parliament', 'presidential', 'regional', 'town_hall', 'town_hall'][k + 1] AS type,
           CAST(CASE WHEN k = 4 THEN '20' || substr(y, 3, 2) ELSE y END AS INTEGER) AS year,
           [NULL, NULL, NULL, 'madeira', 'council', 'parish_assembly'][k + 1] AS sub_type FROM f WHERE k < 6
    """,
)
def filename_match(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").cast("string").alias("y"))
    two = F.substring("y", 3, 2)
    lit = F.lit
    names = F.array(
        F.concat(lit("PE"), "y", lit("_x.xlsx")), F.concat(lit("AR_"), "y", lit(".xls")), F.concat(lit("PR "), "y", lit("_Globais.xlsx")), F.concat(lit("resultados_ALRAm"), "y", lit(".xlsx")),
        F.concat(lit("resultados_eleicoes_AUT"), two, lit("_CM.xlsx")), F.concat(lit("resultados_eleicoes_AF_"), "y", lit(".xlsx")), F.concat(lit("PE_"), "y", lit(".xlsx")), lit("notes.txt"),
    )
    rows = o.withColumn("name", F.element_at(names, (F.col("id") % 8 + 1).cast("int"))).drop("y")
    return documents.matched_files(rows, "name")


@query(
    "year_extract",
    r"""SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 3 <> 0 THEN year(o_orderdate) END AS INTEGER) AS year, o_orderkey % 2 = 0 AS is_complete FROM orders""",
)
def year_extract(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    lead = F.when(F.col("o_orderkey") % 2 == 0, " Regulamento n.º ").otherwise("Aviso n.º ")
    name = F.concat(lead, key, F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("/"), F.year("o_orderdate").cast("string"))).otherwise(""), F.lit(", de 12 de outubro"))
    return o.select(F.col("o_orderkey").alias("id"), T.year_of(name).alias("year"), T.is_complete(name).alias("is_complete"))


@query("slugify", r"SELECT p_partkey AS id, trim(regexp_replace(lower(strip_accents('São ' || p_name || ' -- ' || p_brand)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slugify(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), T.slug(F.concat(F.lit("São "), "p_name", F.lit(" -- "), "p_brand")).alias("slug"))


@query("squash_and_host", r"SELECT page_id, lower(regexp_replace(url, '[^0-9a-zA-Z]+', '', 'g')) AS squashed, lower(regexp_extract(url, '://([^/?#]+)', 1)) AS host FROM pages")
def squash_and_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.squash(F.col("url")).alias("squashed"), U.hostname(F.col("url")).alias("host"))


@query(
    "validity_reasons",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'not a pdf url' WHEN doc_id % 7 = 0 THEN 'http status' WHEN n_chars <= 1000 THEN 'too few pages'
       WHEN length(substr(text, 1, 300)) <= 100 THEN 'no text' ELSE 'valid' END AS reason FROM documents""",
)
def validity_reasons(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    url = F.when(F.col("doc_id") % 5 == 0, "x.html").otherwise("x.PDF")
    status = F.when(F.col("doc_id") % 7 == 0, 404).otherwise(200)
    reason = documents.validity(url, status, F.lit("application/pdf"), F.ceil(F.col("n_chars") / 200), F.array(F.substring("text", 1, 300)))
    return d.select("doc_id", reason.alias("reason"))


@query("json_cache_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_cache_parse(spark, sf_dir):
    return readers.cache_entries(table(spark, sf_dir, "events"), "event_id", "props")


# --- limits, constraints ------------------------------------------------------------------------------


def _calls(spark, sf_dir):
    ts = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t")
    return table(spark, sf_dir, "events").select("user_id", "event_id", ts)


_IN_LINE = """c AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)"""


@query(
    "quota_guard",
    f"""
    WITH RECURSIVE {_IN_LINE}, s(user_id, event_id, i, accepted, held) AS (
        SELECT DISTINCT user_id, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BOOLEAN), CAST([] AS DOUBLE[]) FROM c
        UNION ALL
        SELECT user_id, event_id, i, len(h) < 19, CASE WHEN len(h) < 19 THEN list_append(h, t) ELSE h END FROM (
            SELECT c.user_id, c.event_id, c.i, c.t, list_filter(s.held, lambda x: x > c.t - 86400) AS h FROM s JOIN c ON c.user_id = s.user_id AND c.i = s.i + 1))
    SELECT user_id, event_id, accepted FROM s WHERE i > 0
    """,
)
def quota_guard(spark, sf_dir):
    return stateful.quota(_calls(spark, sf_dir), "user_id", "t", "event_id")


@query(
    "rate_limit",
    f"""
    WITH RECURSIVE {_IN_LINE}, s(user_id, event_id, i, starts_at, started) AS (
        SELECT DISTINCT user_id, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS DOUBLE), CAST([] AS DOUBLE[]) FROM c
        UNION ALL
        SELECT user_id, event_id, i, go, list_append(CASE WHEN len(started) = 4 THEN started[2:] ELSE started END, go) FROM (
            SELECT c.user_id, c.event_id, c.i, s.started, greatest(coalesce(s.starts_at, c.t), c.t, CASE WHEN len(s.started) = 4 THEN s.started[1] + 60 ELSE c.t END) AS go
            FROM s JOIN c ON c.user_id = s.user_id AND c.i = s.i + 1))
    SELECT user_id, event_id, starts_at FROM s WHERE i > 0
    """,
)
def rate_limit(spark, sf_dir):
    return stateful.rate_limit(_calls(spark, sf_dir), "user_id", "t", "event_id")


def _streamed(spark, sf_dir, limit, name):
    """The calls of the events table as a stream of two runs, each limited; a call far ahead lets all that waits go."""
    for k, v in limits.STORE.items():
        spark.conf.set(k, v)
    root = scratch(spark, name)
    calls = _calls(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("long")).withColumn("event_id", F.col("event_id").cast("long"))
    middle = calls.agg(F.percentile_approx("t", 0.5)).first()[0]
    end = calls.agg((F.max("t") + 1e7).alias("t")).select(F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("event_id"), "t")
    for part in (calls.filter(F.col("t") < middle), calls.filter(F.col("t") >= middle), end):
        part.write.mode("append").parquet(f"{root}/in")
        told = limit(spark.readStream.schema(calls.schema).parquet(f"{root}/in"), "user_id", "t", "event_id")
        told.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").filter("user_id >= 0")


@query("quota_stream", ORACLES["quota_guard"])
def quota_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, limits.quota, "quota").select(F.col("user_id"), F.col("event_id"), "accepted")


@query("rate_stream", ORACLES["rate_limit"])
def rate_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, limits.rate_limit, "rate").select("user_id", "event_id", "starts_at")


@query(
    "constraint_violations",
    """
    SELECT 'xor' AS rule, COUNT(*) AS violations FROM customer WHERE (c_acctbal > 0) = (c_custkey % 2 = 0)
    UNION ALL SELECT 'unique', COUNT(*) FROM (SELECT p_name, p_brand FROM part GROUP BY 1, 2 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'domain', COUNT(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 'reference', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    """,
)
def constraint_violations(spark, sf_dir):
    c, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    legs = c.select(F.when(F.col("c_acctbal") > 0, 1).alias("a"), F.when(F.col("c_custkey") % 2 == 0, 1).alias("b"))
    found = {
        "xor": validate.not_xor(legs, "a", "b"),
        "unique": validate.repeated(part, ["p_name", "p_brand"]),
        "domain": validate.outside(c, "c_mktsegment", ["BUILDING", "MACHINERY"]),
        "reference": validate.orphans(table(spark, sf_dir, "orders"), "o_custkey", c.filter("c_acctbal > 0"), "c_custkey"),
    }
    out = None
    for name, rows in found.items():
        one = rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "election_rules",
    """
    WITH e AS (SELECT o_orderkey AS id, ['town_hall', 'regional', 'european', 'presidential'][o_orderkey % 4 + 1] AS type,
               [NULL, 'council', 'azores'][o_orderkey % 3 + 1] AS sub_type, CASE WHEN o_orderkey % 5 > 1 THEN 'first' END AS round FROM orders)
    SELECT id, type, sub_type, CASE WHEN type = 'presidential' THEN round END AS round,
           NOT CASE type WHEN 'town_hall' THEN coalesce(sub_type = 'council', false) WHEN 'regional' THEN coalesce(sub_type = 'azores', false) ELSE sub_type IS NULL END AS bad_sub_type,
           type = 'presidential' AND round IS NULL AS violates FROM e
    """,
)
def election_rules(spark, sf_dir):
    k = F.col("o_orderkey")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (k % n + 1).cast("int"))
    e = table(spark, sf_dir, "orders").select(
        k.alias("id"), pick(["town_hall", "regional", "european", "presidential"], 4).alias("type"), pick([None, "council", "azores"], 3).alias("sub_type"), F.when(k % 5 > 1, "first").alias("round")
    )
    bad = validate.bad_sub_types(e).select("id", F.lit(True).alias("bad"))
    return validate.rounds(e).join(bad, "id", "left").withColumn("bad_sub_type", F.coalesce("bad", F.lit(False))).drop("bad")


_LOG = """SELECT event_id, [200, 404, 403, 503, 429][event_id % 5 + 1] AS status, CAST(event_id % 6 + 1 AS INTEGER) AS attempt, props FROM events"""


@query(
    "fetch_outcomes",
    f"""
    SELECT event_id, CASE status WHEN 200 THEN props WHEN 404 THEN '' END AS page,
           CASE WHEN status = 200 THEN 'ok' WHEN status = 403 THEN CASE WHEN attempt <= 3 THEN 'retry' ELSE 'blocked' END ELSE 'failed' END AS outcome,
           CAST(5 * 2 ** (attempt - 1) AS DOUBLE) AS backoff, status = 429 OR status >= 500 AS retryable FROM ({_LOG})
    """,
)
def fetch_outcomes(spark, sf_dir):
    k = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, (200, 404, 403, 503, 429))), (k % 5 + 1).cast("int"))
    log = table(spark, sf_dir, "events").select("event_id", status.alias("status"), (k % 6 + 1).cast("int").alias("attempt"), "props")
    s, a = F.col("status"), F.col("attempt")
    return log.select("event_id", H.page_of(s, F.col("props")).alias("page"), H.outcome(s, a).alias("outcome"), H.backoff_seconds(a).alias("backoff"), H.is_retryable(s).alias("retryable"))


@query(
    "windowed_counts",
    "SELECT date_trunc('hour', ts) AS start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2",
)
def windowed_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    out = ingest.windowed_counts(e, "ts", ["event_type"], "1 hour")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "flow_city_districts",
    """
    WITH c AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS ine_code FROM customer WHERE c_custkey % 9 <> 0),
    r(name, prefix) AS (VALUES ('North', '0'), ('Upper', '00'), ('Cape', '123'))
    SELECT ine_code, arg_max(r.name, length(prefix)) AS district_name FROM c LEFT JOIN r ON starts_with(ine_code, prefix) GROUP BY 1
    """,
)
def flow_city_districts(spark, sf_dir):
    code = F.when(F.col("c_custkey") % 9 != 0, F.lpad(F.col("c_custkey").cast("string"), 4, "0"))
    refs = spark.createDataFrame([("North", "0"), ("Upper", "00"), ("Cape", "123")], "name string, ine_prefix string")
    return flows.with_districts(table(spark, sf_dir, "customer").select(code.alias("ine_code")).distinct(), refs)
