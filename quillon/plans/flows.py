"""The engine's flows over tables: territory, plan discovery, election files, regulations.

Each is one plan from source tables to result tables; what the pages, files and models of the outside
world would give comes in as tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon import schemas
from quillon.functions import terms
from quillon.functions import text as T
from quillon.functions import url as U
from quillon.operators import crawl, dedup, documents, html, lookup, match, merge, pages, validate
from quillon.session import stored

MAINLAND = [f"{i:02d}" for i in range(1, 19)]


# --- territory ------------------------------------------------------------------------------------


def contact_rows(page: DataFrame) -> DataFrame:
    """Contacts of a contact page (page_id, html) with their place on it."""
    return pages.contacts(pages.table_rows(page)).filter("municipality is not null")


def city_codes(sheet: DataFrame, code: str = "code", name: str = "name", position: str = "pos") -> tuple[DataFrame, DataFrame]:
    """Names with one city code, and names with several."""
    clean = lookup.clean_codes(sheet, code, name, r"^\d{4}$")
    return lookup.unique_codes(clean, code, name), lookup.ambiguous_codes(clean, code, name, position)


def cities(town_halls: DataFrame, assemblies: DataFrame, sheet: DataFrame) -> DataFrame:
    """(municipality, ine_code, email, website, mayor, assembly_president): halls paired with assemblies one to one, with their code.

    A name with a hint in parentheses is looked up among the ambiguous names, others among the unique ones (aliases first).
    """
    # one block: pairs that can come about are found by joins, not by comparing the block's rows
    one = lambda df: df.select(F.lit(1).alias("b"), F.col("municipality").alias("name"), "pos")
    pairs = match.greedy_pairs(one(town_halls), one(assemblies), "b", "name", "pos")
    both = pairs.join(town_halls.select(F.col("municipality").alias("left_name"), "email", "website", F.col("president").alias("mayor")), "left_name")
    both = both.join(assemblies.select(F.col("municipality").alias("right_name"), F.col("president").alias("assembly_president")), "right_name")
    both = both.select(F.col("left_name").alias("municipality"), "email", "website", "mayor", "assembly_president")
    unique, ambiguous = city_codes(sheet)
    hinted = match.region_hint(both.filter(F.col("municipality").contains("(")), "municipality", ambiguous, "name", "codes").withColumnRenamed("code", "ine_code")
    plain = both.filter(~F.col("municipality").contains("(")).withColumn("asked", F.col("municipality"))
    plain = match.resolve(match.with_alias(plain, "asked"), "asked", unique.withColumn("p", F.col("code")), "name", "p")
    plain = plain.join(unique.select(F.col("name").alias("matched"), F.col("code").alias("ine_code")), "matched", "left")
    cols = ["municipality", "ine_code", "email", "website", "mayor", "assembly_president"]
    return plain.select(*cols).unionByName(hinted.select(*cols))


def with_districts(city: DataFrame, references: DataFrame) -> DataFrame:
    """Cities that have a code, with the district of its longest prefix."""
    return lookup.longest_prefix(city.filter("ine_code is not null"), "ine_code", references.select("ine_prefix", F.col("name").alias("district_name")), "ine_prefix", "district_name")


def city_table(old: DataFrame, found: DataFrame) -> DataFrame:
    """The stored cities with what was found, by code."""
    new = found.select(F.col("municipality").alias("name"), "ine_code", "email", "website")
    return merge.upsert(old, new, ["ine_code"])


def parishes(sheets: dict[str, DataFrame], city: DataFrame, exclude: dict[str, list[str]] | None = None) -> DataFrame:
    """(name, ine_code, era, city_name, city_ine_code) of every era's sheet (pos, code, name), linked by prefix, else by name off the mainland.

    Names with several codes are left out, as they are in unique_codes().
    """
    parts = {}
    known = city.select(F.col("name").alias("city_name"), F.col("ine_code").alias("city_ine_code"))
    known_by = lambda rows, name, parents, parent: match.resolve(rows, name, parents, parent, "city_ine_code").filter("matched is not null").withColumnRenamed("matched", parent)
    for era, sheet in sheets.items():
        if era not in schemas.ERAS:
            raise ValueError(f"unknown era {era}")
        clean = lookup.clean_codes(sheet, "code", "name", r"^\d{6}$", (exclude or {}).get(era))
        unique = lookup.unique_codes(clean, "code", "name").withColumnRenamed("code", "ine_code")
        linked = lookup.with_fallback(unique, "ine_code", "name", known, "city_ine_code", "city_name", MAINLAND, known_by)
        parts[era] = linked.select("name", "ine_code", "city_name", "city_ine_code")
    return dedup.tagged_union(parts, "era")


# --- plan discovery -------------------------------------------------------------------------------


def plan_documents(city: DataFrame, done: DataFrame, page: DataFrame, contents: DataFrame, depth: int = 4, min_pages: int = 10, min_hits: int = 5, budget: int = 5000) -> DataFrame:
    """(city_id, source_url, pdf_url): of each city without a plan the first valid regulation document that its site leads to.

    city (city_id, website), page (url, html) as fetched, contents (url, content, number_of_pages). The crawl
    goes over pages worth following on the same host, those that name the plan first, `budget` pages of a site at most.
    """
    open_ = merge.pending(city.filter("website is not null"), done, ["city_id"])
    fetched = page.select(U.strip_fragment(F.col("url")).alias("url"), "html")
    links = pages.anchors(fetched).withColumn("target", U.strip_fragment(U.join(F.col("url"), F.col("href"))))
    links = pages.classified(links.filter(U.same_host(F.col("target"), F.col("url"))))
    links = links.select(F.col("url").alias("src"), "pos", F.col("target").alias("dst"), "is_regulation", "is_followed", "is_priority")
    hits = T.keyword_score(T.strip_accents(F.lower("content")), terms.CONTENT_WORDS)
    valid = contents.filter(documents.looks_like_plan(F.col("number_of_pages"), hits, min_pages, min_hits)).select(F.col("url").alias("dst"))
    roots = open_.select(F.col("city_id").alias("site"), U.strip_fragment(F.col("website")).alias("node"))
    best = crawl.crawl(roots, links, valid, depth, budget)[0].filter("pdf_url IS NOT NULL")
    return best.select(F.col("site").alias("city_id"), "source_url", "pdf_url")


def plan_candidates(city: DataFrame, page: DataFrame, budget: int = 400) -> DataFrame:
    """(city_id, k, source_url, pdf_url): every plan file that a city's site shows within `budget` pages below its root, breadth first."""
    fetched = page.select(U.normalize_sorted_query(F.col("url")).alias("url"), "html")
    links = pages.anchors(fetched).withColumn("dst", U.normalize_sorted_query(U.join(F.col("url"), F.col("href"))))
    plan = pages.is_plan_pdf(F.col("dst"), F.col("text"))
    links = links.select(F.col("url").alias("src"), "pos", "dst", plan.alias("is_regulation"), (~pages.is_file(F.col("dst"))).alias("is_followed"), F.lit(False).alias("is_priority"))
    roots = city.filter("website is not null").select(F.col("city_id").alias("site"), U.normalize_sorted_query(F.col("website")).alias("node"))
    return crawl.crawl(roots, links, None, None, budget, first=False, scope=U.in_scope)[1].withColumnRenamed("site", "city_id")


def site_files(city: DataFrame, page: DataFrame, known: DataFrame, budget: int = 5000, idle: int = 600) -> DataFrame:
    """(city_id, k, source_url, pdf_url): the plan files that sites show, on the same host; where some are `known` (city_id) already, `idle` pages in a row without any end the crawl."""
    fetched = page.select(U.normalize_keep_query(F.col("url")).alias("url"), "html")
    links = pages.anchors(fetched).withColumn("dst", U.normalize_keep_query(U.join(F.col("url"), F.col("href"))))
    plan, file = pages.is_plan_file(F.col("dst")), pages.is_file_loosely(F.col("dst"))
    links = links.filter(U.same_host(F.col("dst"), F.col("url"))).select(F.col("url").alias("src"), "pos", "dst", plan.alias("is_regulation"), (~file).alias("is_followed"), F.lit(False).alias("is_priority"))
    roots = city.filter("website is not null").select(F.col("city_id").alias("site"), U.normalize_keep_query(F.col("website")).alias("node"))
    old = roots.join(known.select(F.col("city_id").alias("site")).distinct(), "site", "left_semi")
    fresh = roots.join(old.select("site"), "site", "left_anti")
    found = [crawl.crawl(r, links, None, None, budget, first=False, idle=i)[1] for r, i in ((old, idle), (fresh, None))]
    return found[0].unionByName(found[1]).withColumnRenamed("site", "city_id")


# --- election files -------------------------------------------------------------------------------


def election_files(index: DataFrame, listing: DataFrame, base: str, complete: bool = False) -> DataFrame:
    """(type, sub_type, year, url, filename, field) of the result files behind the index page's links.

    index (page_id, html), listing (url, html): the pages that the index links to. With `complete`, an index without one of the five links is an error.
    """
    link = pages.anchors(index).withColumn("k", F.lit(1))
    fields = pages.fields(link, "k", "href", "pos")
    fields = (validate.require_fields(fields, "field") if complete else fields).withColumn("url", U.join(F.lit(base), F.col("url"))).select("field", "url")
    files = pages.anchors(listing.join(F.broadcast(fields), "url"))  # a row for each of five fields
    files = result_files(files)
    return documents.matched_files(files, "filename").select("type", "sub_type", "year", U.join(F.col("url"), F.col("href")).alias("url"), "filename", "field")


def result_files(links: DataFrame, href: str = "href") -> DataFrame:
    """Links to sheets, with their file name; documents.name_errors() tells those of unexpected names."""
    name = U.basename(F.col(href))
    return links.filter(F.lower(U.part(F.col(href), "path")).rlike(r"\.xlsx?$")).withColumn("filename", F.coalesce(F.try_url_decode(name), name))


def city_rows(sheet: DataFrame, fields: list[str], website: str) -> DataFrame:
    """A sheet's rows with `city`: the fields as strings, an address that starts with www. as an https URL."""
    told = [(U.with_scheme(F.col(c)) if c == website else F.col(c).cast("string")).alias(c) for c in fields]
    return sheet.withColumn("city", F.struct(*told))


def reentered(rows: DataFrame, cache: DataFrame, key: str, candidates: str, best: str, crawl: Callable[[DataFrame], DataFrame], pick: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, best, origin): complete cache rows as they are, cached candidates filtered, all others crawled and filtered.

    crawl(rows) gives (key, candidates), pick(rows) gives (key, best); each sees only what it has to work on.
    """
    state = stored(merge.by_cache(rows, cache, key, best).select(key, "cache_state").distinct())
    having = lambda s: state.filter(F.col("cache_state") == s).select(key)
    cached = cache.filter(F.col(best).isNotNull()).join(having("complete"), key, "left_semi").select(key, best)
    kept = cache.filter(F.col(candidates).isNotNull()).join(having("partial"), key, "left_semi").select(key, candidates)
    fresh = crawl(having("missing")).select(key, candidates)
    return dedup.tagged_union({"cached": cached, "filtered": pick(kept).select(key, best), "crawled": pick(fresh).select(key, best)})


def structured(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files with their name and round, joined by file name; rounds of presidential elections only. Rows that break a rule are marked."""
    out = validate.rounds(files.join(metadata.select("filename", "name", "round"), "filename", "left"))
    bad = validate.bad_sub_types(files.select("filename", "type", "sub_type")).select("filename", F.lit(True).alias("__b"))
    return out.join(bad, "filename", "left").withColumn("violates", F.col("violates") | F.coalesce("__b", F.lit(False))).drop("__b")


def metadata(files: DataFrame, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(filename, name, round) by a plugged-in model: `ask` gets (filename, prompt)."""
    return ask(files.select("filename", documents.prompt(F.col("type"), F.col("filename")).alias("prompt")))


# --- regulations ----------------------------------------------------------------------------------


def regulation_rows(page: DataFrame, city: DataFrame) -> DataFrame:
    """(section, city_id, year, name, is_complete, dre_url) of a regulation page, its municipalities resolved to cities; unmatched_regulations() has the others."""
    found = pages.regulations(page, "page_id")
    named = match.resolve(found, "municipality", city.select("name", "city_id"), "name", "city_id")
    out = named.join(city.select(F.col("name").alias("matched"), "city_id"), "matched")
    return out.select("section", "city_id", T.year_of(F.col("name")).alias("year"), "name", T.is_complete(F.col("name")).alias("is_complete"), "dre_url", "page_id", "pos")


def regulation_counters(found: DataFrame, old: DataFrame) -> DataFrame:
    """One row of counts: found, matched to a city, unmatched, skipped (no year) and persisted (new pairs of city and URL).

    found has city_id (null: unmatched), year and dre_url.
    """
    new = found.filter("city_id is not null and year is not null").select("city_id", "dre_url").distinct().join(old.select("city_id", "dre_url"), ["city_id", "dre_url"], "left_anti")
    counts = found.agg(
        F.count(F.lit(1)).alias("found"), F.count_if(F.col("city_id").isNotNull()).alias("matched"), F.count_if(F.col("city_id").isNull()).alias("unmatched"),
        F.count_if(F.col("city_id").isNotNull() & F.col("year").isNull()).alias("skipped"),
    )
    one = new.agg(F.count(F.lit(1)).alias("persisted"))
    return counts.withColumn("k", F.lit(1)).join(one.withColumn("k", F.lit(1)), "k").drop("k")  # two single rows


def unmatched_regulations(page: DataFrame, city: DataFrame) -> DataFrame:
    """(municipality, pos): rows of a regulation page whose municipality is no known city."""
    named = match.resolve(pages.regulations(page, "page_id"), "municipality", city.select("name", "city_id"), "name", "city_id")
    return named.filter("matched is null").select("municipality", "page_id", "pos")


def stored_regulations(old: DataFrame, found: DataFrame) -> DataFrame:
    """old and the found rows with a year whose (city, url) is new, the first on the page of equal ones."""
    new = found.filter("year is not null").withColumn("pdf_url", F.lit(None).cast("string"))
    return merge.insert_if_absent(old, new, ["city_id", "dre_url"], "pos")


def pending_pdfs(tables: dict[str, DataFrame], size: int = 8) -> DataFrame:
    """Rows of all tables without a PDF, in batches of `size` for the resolver inside each table; all are full but the last."""
    rows = dedup.tagged_union({k: v.filter("pdf_url is null").select("city_id", "dre_url") for k, v in tables.items()}, "table")
    return dedup.batches(rows, ["city_id", "dre_url"], size, ["table"])


def pdf_link(page: DataFrame) -> DataFrame:
    """(url, pdf_url) of detail pages: the target of the link titled as PDF."""
    titled = html.links(page.select("url", "html")).filter(F.col("title") == "Documento em formato PDF")
    first = titled.groupBy("url").agg(F.min_by(T.strip(F.col("href")), "pos").alias("pdf_url"))
    return page.select("url").join(first, "url", "left").select("url", F.nullif("pdf_url", F.lit("")).alias("pdf_url"))
