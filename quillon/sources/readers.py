"""Sources: reference JSON, caches of both shapes, HTML and binary files, stored datasets, and a page source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.sources import tables
from pyspark.sql.utils import AnalysisException

REFERENCE = "name string, ine_prefix string"
CACHE_ENTRY = "candidate_urls array<string>, best_candidate map<string,string>, crawl_timestamp string, filter_timestamp string"


def reference(spark: SparkSession, path: str, schema: str = REFERENCE) -> DataFrame:
    """A JSON reference table, one document over several lines, codes as strings."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def sheet(spark: SparkSession, path: str, schema: str, header_rows: int = 1) -> DataFrame:
    """Sheets saved as CSV with header_rows rows before the data; an explicit schema keeps leading zeros of codes.

    A sheet is a file of some thousand rows, so it is read whole and its lines are counted; a path may hold many sheets. Rows are lines.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("i", "value"))
    parsed = lines.filter((F.col("i") >= header_rows) & (F.col("value") != "")).select(F.from_csv("value", schema).alias("r"))
    return parsed.select("r.*")


def cache_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A cache that is a JSON list; a missing or broken file is an empty table."""
    try:
        rows = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    names = rows.columns
    return rows.filter(F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull())


def cache_object(spark: SparkSession, path: str) -> DataFrame:
    """(url, candidate_urls, best_candidate, ...) of a cache that is a JSON object; values are entries or, in old files, plain lists."""
    text = spark.read.text(path, wholetext=True)
    each = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("url", "v"))
    return cache_values(each, "url", "v")


def cache_values(rows: DataFrame, key: str, value: str) -> DataFrame:
    entry, old = F.from_json(value, CACHE_ENTRY), F.from_json(value, "array<string>")
    e = rows.select(key, F.when(~F.col(value).startswith("["), entry).alias("e"), F.when(F.col(value).startswith("["), old).alias("o"))
    return e.select(key, F.coalesce("o", "e.candidate_urls").alias("candidate_urls"), "e.best_candidate", "e.crawl_timestamp", "e.filter_timestamp")


def cache_entries(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Numbers of small JSON objects."""
    return rows.select(key, F.from_json(value, "k bigint").alias("e")).select(key, "e.k")


def html_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, html): a row per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def binary_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, filename, bytes, content) of downloaded documents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("bytes"), "content")


def dataset(spark: SparkSession, root: str, config: str) -> DataFrame:
    """A published dataset's table, as its newest manifest has it; plain files where it was never published."""
    path = f"{root.rstrip('/')}/{config}"
    return tables.Table(spark, path).read() if tables.versions(spark, path) else spark.read.parquet(path)


def fetched(urls: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """urls with the html of their page; null where the page was not fetched."""
    return urls.join(pages.select(url, "html"), url, "left")


def download_name(disposition: str, url: str):
    """The name of a download: that of its content-disposition, else the URL's tail, with .pdf at its end."""
    named = F.regexp_extract(disposition, r"filename\*?=(?:UTF-8'')?\"?([^\";]+)\"?", 1)
    tail = F.element_at(F.split(F.regexp_extract(url, r"^[^?#]*", 0), "/"), -1)
    name = F.when(F.coalesce(named, F.lit("")) != "", named).otherwise(tail)
    return F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))
