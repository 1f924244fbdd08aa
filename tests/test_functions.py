import unicodedata
from urllib.parse import urljoin, urlsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillon.functions import text as T
from quillon.functions import url as U
from quillon.functions.similarity import indel_ratio, lcs_length


def column(spark, f, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcáé ", max_size=14), st.text("abcáé ", max_size=14))
def test_lcs_is_that_of_the_table(a, b):
    assert lcs_length(a, b) == table_lcs(a, b)


def test_ratio_of_known_names():
    assert indel_ratio("Praia da Vitória", "Vila da Praia da Vitória") == pytest.approx(0.8)
    assert indel_ratio("Moura", "Mora") == pytest.approx(8 / 9)
    assert indel_ratio("Miranda do Douro", "Miranda do Corvo") == pytest.approx(0.875)
    assert indel_ratio("", "") == 1.0


def test_accents(spark):
    values = ["São João", "Évora", "ß Æ ø ª º", "ñandú", "éx", None, "", "Łódź"]
    plain = lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    assert column(spark, T.strip_accents, values) == [plain(v) for v in values]
    assert column(spark, T.strip_accents_nfkd, values) == [plain(v) for v in values]
    assert column(spark, T.fold, ["STRAßE É"]) == ["strasse e"]


def test_text_functions(spark):
    assert column(spark, T.spaced, ["Plano_Diretor_Municipal.pdf", "a%20b+c//d", "100%", None]) == ["plano diretor municipal pdf", "a b c d", "100%", None]
    assert column(spark, T.slug, ["Vila  Nova - Já", "***", ""]) == ["vila-nova-ja", "city", "city"]
    assert column(spark, T.strip, ["  a\t\n", None]) == ["a", None]
    assert column(spark, T.squash, ["PDM-2 é.pdf"]) == ["pdm2pdf"]
    assert column(spark, T.year_of, ["Aviso n.º 12231/2017, de 12/2019", "none", None]) == [2017, None, None]
    assert column(spark, T.is_complete, [" Regulamento x", "regulamento", "Aviso"]) == [True, False, False]
    assert column(spark, lambda c: T.keyword_score(c, ["aa", "ab"]), ["AAAab", None, ""]) == [3, 0, 0]
    assert column(spark, T.seconds_of, ["12s", "1.5s", "x", "12"]) == [12.0, 1.5, None, None]


URLS = ["http://WWW.Ex.pt:80/a/b/?z=1&a=&a=0#top", "https://u@ex.pt:8443", "https://ex.pt/a//", "http://ex.pt:443/x", "HTTP://ex.pt/p;q?b"]


def test_normal_forms(spark):
    assert column(spark, U.normalize_keep_query, URLS)[:3] == ["http://www.ex.pt:80/a/b?z=1&a=&a=0", "https://u@ex.pt:8443/", "https://ex.pt/a"]
    assert column(spark, U.normalize_sorted_query, URLS) == ["http://www.ex.pt/a/b?a=&a=0&z=1", "https://ex.pt:8443/", "https://ex.pt/a", "http://ex.pt:443/x", "http://ex.pt/p;q?b="]
    assert column(spark, U.strip_fragment, URLS)[0] == "http://WWW.Ex.pt:80/a/b/?z=1&a=&a=0"
    assert column(spark, U.to_https, ["http://a", "HTTP://a", "x http://a"]) == ["https://a", "HTTP://a", "x http://a"]
    assert column(spark, lambda c: U.to_https(c, "everywhere"), ["http://a http://b"]) == ["https://a https://b"]
    assert column(spark, U.municipality, ["https://www.cm-crap.pt/x", "http://www.evora.pt"]) == ["crap", "evora"]


@pytest.mark.parametrize("base", ["http://ex.pt/a/b/c?q=1#f", "https://ex.pt", "http://ex.pt/a/"])
def test_join_follows_the_standard(spark, base):
    hrefs = ["x", "/x/y", "../x", "./x", "?k=2", "#top", "//o.pt/z", "https://o.pt/z", "", "../../../x", "a/../b", "x/.", "mailto:a@b"]
    assert column(spark, lambda c: U.join(F.lit(base), c), hrefs) == [urljoin(base, h) for h in hrefs]


def test_scope(spark):
    root = F.lit("https://ex.pt/top/")
    values = ["https://ex.pt/top", "https://ex.pt/top/a", "https://ex.pt/topper", "http://o.pt/top", "ftp://ex.pt/top/a"]
    assert column(spark, lambda c: U.in_scope(c, root), values) == [True, True, False, False, False]
    assert urlsplit(values[0]).netloc == "ex.pt"
