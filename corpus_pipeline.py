"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Language ID drops documents that it rejects, shingle similarity keeps one document of each group
of near copies, suffix deduplication cuts out strings that occur elsewhere too, mixing repeats and drops
documents to meet the sources' targets, and packing puts what is left into batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import jaccard, langid, mixing, packing, suffixes
from quillon.llm.common import dropped, written

#: SQL can train no model and sort no suffixes; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs under names that no operator uses itself, and which those are."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(n).alias(c) for c, n in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; rejected ones go."""
    rows, c = _plain(docs)
    model = langid.fitted(rows.filter(~langid.held_out(c["doc_id"])), id_col=c["doc_id"], text_col=c["text"], lang_col=c["lang"])
    found = langid.predicted(rows, model, c["doc_id"], c["text"], carry=tuple(c.values()))
    return _named(found.filter(~F.col("rejected")), c)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 of their five-word shingles or more): the one with the smallest doc_id."""
    rows, c = _plain(docs)
    return _named(jaccard.one_of_each(rows, id_col=c["doc_id"], text_col=c["text"]), c)


#: Bytes of a string that counts as repeated: below those of fifty common words, so that a passage of over fifty words is caught.
REPEAT_BYTES = 256


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of REPEAT_BYTES that occur twice or more; a character cut in half goes, as do emptied documents."""
    rows, c = _plain(docs)
    found = suffixes.deduplicated(rows, REPEAT_BYTES, id_col=c["doc_id"], text_col=c["text"], keep=tuple(n for k, n in c.items() if k not in ("doc_id", "text")))
    whole = F.size("spans") == 0
    found = found.withColumnRenamed("repaired", c["text"]).withColumnRenamed("id", c["doc_id"])
    found = found.filter(whole | (F.trim(c["text"]) != ""))
    if "n_chars" in c:
        found = found.withColumn(c["n_chars"], F.when(whole, F.col(c["n_chars"])).otherwise(F.length(c["text"])))
    return _named(found, c)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, in the order of their training positions."""
    rows, c = _plain(docs)
    return _named(mixing.in_order(mixing.planned(rows, id_col=c["doc_id"], text_col=c["text"], source_col=c["source"])), c)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches by length bucket of least padding."""
    return packing.packed(docs, keep=("source",))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("suffix_dedup", suffix_dedup), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        now: list[str] = []
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}", now)
        for path in before:  # what this stage has read
            dropped(spark, path)
        before = now
    return STAGES[-1][1](spark, docs, sf_dir)
