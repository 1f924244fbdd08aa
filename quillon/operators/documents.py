"""Documents: keyword scores, percentile filters, best candidates, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import terms
from quillon.functions.text import keyword_score, strip
from quillon.operators.match import best_of


def above_percentile(rows: DataFrame, by: str, column: str, q: float = 0.75) -> DataFrame:
    """Rows above their group's percentile (linear between values), strictly: a group of one has none."""
    limits = rows.groupBy(by).agg(F.percentile(column, q).alias("limit"))
    return rows.join(limits, by).filter(F.col(column) > F.col("limit"))


def best_documents(docs: DataFrame, site: str, pages: str, text: str, position: str, words: list[str] | None = None) -> DataFrame:
    """Of each site the candidate above the 75th percentile of pages with the highest keyword score."""
    scored = docs.withColumn("score", keyword_score(F.col(text), words or terms.SCORE_TERMS)).drop(text)  # texts stay behind
    return best_of(above_percentile(scored, site, pages), site, "score", position)


def looks_like_plan(pages: Column, hits: Column, min_pages: int = 10, min_hits: int = 5) -> Column:
    return (pages >= min_pages) & (hits >= min_hits)


def validity(url: Column, status: Column, content_type: Column, pages: Column, first_pages: Column) -> Column:
    """The reason that a PDF is not usable, or `valid`; first_pages are the texts of its first three pages."""
    return (
        F.when(~F.lower(url).endswith(".pdf"), "not a pdf url")
        .when(status != 200, "http status")
        .when(~F.lower(content_type).contains("pdf"), "content type")
        .when(pages <= 5, "too few pages")
        .when(~F.exists(F.slice(first_pages, 1, 3), lambda t: F.length(t) > 100), "no text")
        .otherwise("valid")
    )


def matched_files(hrefs: DataFrame, name: str) -> DataFrame:
    """Rows whose file name fits an election type's pattern, with type, sub_type and year."""
    n = F.col(name)
    p = terms.FILE_PATTERNS
    group = lambda k, i: F.regexp_extract(n, p[k], i)
    plain = [k for k in ("european", "parliament", "presidential")]
    kind = F.lit(None).cast("string")
    for k in reversed(p):
        kind = F.when(n.rlike(p[k]), F.lit(k)).otherwise(kind)
    year = F.lit("")
    for k in plain:
        year = F.when(F.col("type") == k, group(k, 1)).otherwise(year)
    year = F.when(F.col("type") == "regional", group("regional", 2)).otherwise(year)
    town = F.when(group("town_hall", 4) != "", group("town_hall", 4)).otherwise(F.concat(F.lit("20"), group("town_hall", 1)))
    year = F.when(F.col("type") == "town_hall", town).otherwise(year)
    coded = lambda code, m: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.lower(code))
    chamber = F.concat(group("town_hall", 2), group("town_hall", 3))
    sub = F.when(F.col("type") == "town_hall", coded(chamber, terms.CHAMBERS)).when(F.col("type") == "regional", coded(group("regional", 1), terms.REGIONS))
    return hrefs.withColumn("type", kind).filter("type is not null").withColumn("year", year.cast("int")).withColumn("sub_type", sub)


def name_errors(files: DataFrame, name: str) -> DataFrame:
    """files with `error`: null where the name fits an election type's pattern, else what is wrong with it."""
    fits = F.lit(False)
    for p in terms.FILE_PATTERNS.values():
        fits = fits | F.col(name).rlike(p)
    return files.withColumn("error", F.when(~F.coalesce(fits, F.lit(False)), F.concat(F.lit("unexpected file name: "), F.coalesce(F.col(name), F.lit("none")))))


def has_content(text: Column) -> Column:
    """Whether a document's text holds anything but white space."""
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))


def candidate_results(rows: DataFrame, key: str, best: str, details: list[str]) -> DataFrame:
    """(key, url, metadata): the rows with a best document, what else is known of it as a map of strings."""
    pairs = [x for d in details for x in (F.lit(d), F.col(d).cast("string"))]
    return rows.filter(F.col(best).isNotNull()).select(key, F.col(best).alias("url"), F.create_map(*pairs).alias("metadata"))


def prompt(election_type: Column, filename: Column) -> Column:
    """The question put to a language model about a file."""
    return F.format_string("Name the %s election that the results file %s belongs to.", election_type, filename)
