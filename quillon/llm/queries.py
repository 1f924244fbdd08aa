"""Registered queries of the training-data operators: opN_<name> applies operator N to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.llm import langid, licenses, mixing, packing, passages, periods, quality, simhash, suffixes, topk, urls, warc, whitening
from quillon.llm.common import WORD, n_words, shared_folder, written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    found = quality.judged(table(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*first, *[c for c in found.columns if c not in first])


@query("op10_simhash")
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: Bytes of a passage that is reported as repeated, though it stays: below those of fifty common words.
PASSAGE_BYTES = 256


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    found = suffixes.deduplicated(table(spark, sf_dir, "documents"), also=PASSAGE_BYTES)
    bytes_in = lambda c: F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"]), F.lit(0).cast("long"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", bytes_in("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("repeats") > 0).alias("repeats_passage"), bytes_in("repeats").alias("n_passage_bytes"), F.octet_length("kept").cast("long").alias("n_kept"),
    )


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fitted(docs.filter(~langid.held_out()))
    return langid.predicted(docs, model, detail=True).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected", "usualness")


@query("op1_mixing")
def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # the words are counted once; texts stay behind
    light = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("n"), F.xxhash64("text").alias("text")), "sizes")
    plan = mixing.planned(light, size=F.col("n")).drop("n", "text")
    first = plan.withColumn("first_position", F.try_element_at("positions", F.lit(1)))
    out = first.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "first_position")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, F.col("first_position"), F.col("doc_id")).sortWithinPartitions("first_position")


@query("op7_packing")
def op7_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    light = written(docs.select("doc_id", n_words(F.col("text")).alias("n"), F.xxhash64("text").alias("text")), "lengths")
    return packing.packed(light, tokens=F.col("n"))


@query(
    "op5_warc",
    """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
    k AS (SELECT d, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY d)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
           CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < keeper THEN keeper END AS refers_to
    FROM p LEFT JOIN k ON p.d = k.d AND n >= 1000
    """,
)
def op5_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    manifest = warc.archived(warc.typed(pages), shared_folder(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    return warc.read_back(manifest).select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


RULES = [
    urls.rule(v, name)
    for v, name in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
]


@query("op9_url_filters")
def op9_url_filters(spark, sf_dir):
    return urls.judged(table(spark, sf_dir, "pages"), RULES)


@query(
    "op3_topk_search",
    """
    WITH d AS (
        SELECT q.vec_id AS query_id, b.vec_id AS neighbour_id,
               CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (q.embedding[i] > 0) <> (b.embedding[i] > 0) THEN 1 ELSE 0 END)) AS BIGINT) AS distance
        FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id AND q.vec_id % 20 = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, distance FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d)
    WHERE rank <= 10
    """,
)
def op3_topk_search(spark, sf_dir):
    codes = written(table(spark, sf_dir, "embeddings").select("vec_id", topk.code_of(F.col("embedding")).alias("code")), "codes")
    return topk.nearest(codes, codes.filter("vec_id % 20 = 0"))


@query("op2_license_scan")
def op2_license_scan(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents"))


def with_planted_period(text, doc_id):
    """Of every document whose id has a crc32 that ends in 0: its words, repeated with a period from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    # bound as a lambda's variable, words, start and period are found once
    def plan(w):
        a = F.pmod(g, F.greatest(F.size(w), F.lit(1)).cast("long"))
        return F.struct(w.alias("w"), a.alias("a"), (1 + F.floor((F.size(w) - a) / (3 + g % 8))).alias("p"))

    plans = F.transform(F.transform(F.array(F.regexp_extract_all(text, F.lit(f"({WORD})"))), plan), lambda s: F.transform(s["w"], lambda x, i: F.when(i < s["a"], x).otherwise(F.get(s["w"], (s["a"] + (i - s["a"]) % s["p"]).cast("int")))))
    return F.when((h % 10 == 0) & text.isNotNull(), F.array_join(plans[0], " ")).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", with_planted_period(F.col("text"), F.col("doc_id")).alias("text"))
    found = periods.periodic_runs(docs)
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query("op13_quality_classifier")
def op13_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = passages.fitted(docs, labels.filter(~passages.held_out()))
    told = passages.scored(docs, model)
    return told.select("doc_id", passages.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_passages", "top_attention")


# --- parts of operators that SQL can express ------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "quality_base",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
    win AS (SELECT k, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
    twice AS (SELECT k, i FROM (SELECT k, i, COUNT(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
    rep AS (SELECT k, COUNT(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 5)) AS j) GROUP BY 1),
    s AS (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
          list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)
    SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           n_words < 10 OR 100 * coalesce(n, 0) > 20 * n_words AS base_failed FROM s LEFT JOIN rep USING (k)
    """,
)
def quality_base(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@query(
    "url_rules",
    r"""
    WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
    q AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
    rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    fit AS (SELECT page_id, arg_max(struct_pack(n := x.host || x.path, v := verdict), length(x.host || x.path)) AS b
            FROM q JOIN rules x ON (q.host = x.host OR ends_with(q.host, '.' || x.host)) AND starts_with(q.path, x.path) GROUP BY 1)
    SELECT page_id, host, path, b.n AS rule, b.v AS rule_verdict FROM q LEFT JOIN fit USING (page_id)
    """,
)
def url_rules(spark, sf_dir):
    return urls.ruled(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "rule_verdict")


@query(
    "length_histogram",
    f"""
    WITH n AS (SELECT len({_WORDS}) AS n FROM documents), c AS (SELECT n, power(2, floor(log2(greatest(n, 1)))) / 64 AS step FROM n)
    SELECT CAST(CASE WHEN n <= 1024 THEN greatest(n, 1) ELSE ceil(n / step) * step END AS BIGINT) AS length_class, COUNT(*) AS n FROM c GROUP BY 1
    """,
)
def length_histogram(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(packing.length_class(n_words(F.col("text"))).alias("length_class")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "mix_sizes",
    f"""
    WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents)
    SELECT doc_id, size, CAST(SUM(size) OVER (PARTITION BY source) AS BIGINT) AS source_size FROM d
    """,
)
def mix_sizes(spark, sf_dir):
    light = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("n"), F.xxhash64("text").alias("text"))
    return mixing.planned(light, size=F.col("n")).select("doc_id", "size", "source_size")
