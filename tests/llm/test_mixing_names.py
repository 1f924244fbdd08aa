"""Columns of any name pass through mixing as they are."""

from pyspark.sql import functions as F

from quillon.llm import mixing

NAMES = ["__m", "__h", "__before", "__g", "__t", "__w", "__c", "__off", "__in", "__hi", "c0", "a b.c", "position", "size", "target"]


def test_clashing_names(spark):
    plain = spark.createDataFrame([(i, "w " * (i % 7 + 1), None if i % 5 == 0 else f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    clashing = plain.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in NAMES])
    want = {r.doc_id: (r.source_size, r.target, r.copies, r.taken, r.positions) for r in mixing.planned(plain).collect()}
    rows = mixing.planned(clashing)
    assert rows.columns == ["doc_id", "text", "source", *NAMES[:-2], "size", "source_size", "target", "copies", "taken", "positions"]
    for r in rows.collect():
        assert (r.source_size, r.target, r.copies, r.taken, r.positions) == want[r.doc_id]
        assert [r[n] for n in NAMES[:-2]] == [f"{n}-{r.doc_id}" for n in NAMES[:-2]]
