"""Ids of any characters in archives, long codes, held-out URL thresholds, clashing column names."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillon.llm import jaccard, simhash, topk, urls, warc
from quillon.llm.common import shared_folder

LONG = "text " * 300


def test_page_ids_of_any_characters(spark):
    rows = [("a b", "http://a/%20x y", LONG), ("line\nbreak\r\n", "http://b/%0A\n", LONG), ("none", "", LONG), (None, None, "x"), ("", "http://e", "y"), ("<ü:>%20", "é", None), ("zz", None, LONG)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page: r for r in warc.read_back(warc.archived(warc.typed(pages), shared_folder(spark, "warc-ids")), payloads=True).collect()}
    assert len(got) == len(rows)
    for page, url, html in rows:
        assert got[page].url == url and got[page].payload_bytes == len((html or "").encode())
        assert got[page].refers_to == ("zz" if html == LONG and page != "zz" else None)


@pytest.mark.parametrize("n", [65, 70, 128])
def test_longer_vectors_are_errors(spark, n):
    df = spark.createDataFrame([([1.0] * n,)], "v array<double>")
    with pytest.raises(PySparkException, match="64 components"):
        df.select(topk.code_of(F.col("v"))).collect()


def test_search_by_text_ids(spark):
    rows = [(f"id{i:03}", (i * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63)) for i in range(300)] + [("id000x", (0) - (1 << 63)), (None, 5), ("z", None)]
    base = spark.createDataFrame(rows, "vec_id string, code long")
    got = topk.nearest(base, base.filter("vec_id < 'id020'"), k=4).collect()
    known = [(i, c & (1 << 64) - 1) for i, c in rows if i is not None and c is not None]
    for q, code in known[:20]:
        want = sorted(((code ^ c).bit_count(), i) for i, c in known if i != q)[:4]
        assert [(r.distance, r.neighbour_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want


def test_the_url_threshold_comes_from_held_out_rows(spark):
    rows = [(0.5, 10, True, True), (0.1, 10, False, True), (-0.5, 500, True, False), (-0.9, 500, False, False)]
    scores = spark.createDataFrame(rows, "score double, n long, accepted boolean, held boolean")
    assert 0.1 < urls.threshold(scores) <= 0.5
    assert urls.threshold(scores.filter("not held or accepted")) < -0.4  # held out, a kind is missing: all rows count
    assert urls.threshold(scores.filter("accepted")) == 0


@pytest.mark.parametrize("stage", [simhash.one_of_each, jaccard.one_of_each])
def test_clashing_columns_stay(spark, stage):
    text = "one two three four five six seven eight nine ten"
    rows = [(2, text, 1, "a", 3), (1, text, 4, "b", 6), (None, text, 7, "c", 9), (5, None, 1, "d", 2), (6, "other words stand here for once in a row", 1, "e", 2)]
    docs = spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, __uid int, uid string, row int")
    got = stage(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows[i] for i in (1, 3, 4))
