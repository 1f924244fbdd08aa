"""Folding equals NFKD and casefold, character by character and in texts."""

import random
import unicodedata

from pyspark.sql import functions as F

from quillon.functions import text as T


def bare(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_every_character(spark):
    points = [p for p in (*range(1, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x30000)) if unicodedata.category(chr(p)) != "Cn"]
    runs = ["".join(map(chr, points[i : i + 50])) for i in range(0, len(points), 50)]
    got = spark.createDataFrame([(r,) for r in runs], "t string").select("t", T.strip_accents(F.col("t")).alias("s"), T.fold(F.col("t")).alias("f")).collect()
    for r in got:
        assert r.s == bare(r.t)
        assert r.f == bare(r.t).casefold()


def test_texts(spark):
    rng = random.Random(2)
    texts = ["ﬁlosofia Œuvre Straße ΣΊΣΥΦΟΣ Йод ёж ½ ²", "São João d'Água", "ȩ́", "", None, "İstanbul ǅ ŉ", "".join(chr(rng.randint(32, 0x24F)) for _ in range(4000)), "한글 ＡＢＣ ﷺ"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.strip_accents(F.col("t")), T.fold(F.col("t"))).collect()
    for i, s, f in got:
        t = texts[i]
        if t is None:
            assert s is None and f is None
        elif "한" in t:
            assert s == "한글 " + bare(t[3:]) and f == s.casefold()
        else:
            assert s == bare(t) and f == bare(t).casefold()


def test_joins_over_folded_names(spark):
    from quillon.operators import match

    left = spark.createDataFrame([("ΟΔΟΣ",), ("Fluß",), ("ЙОД",)], "w string")
    right = spark.createDataFrame([("οδος",), ("FLUSS",), ("йод",), ("ﬂuss",)], "o string")
    got = {(r.w, r.o) for r in match.accent_free_matches(left, "w", right, "o").collect()}
    assert got == {("ΟΔΟΣ", "οδος"), ("Fluß", "FLUSS"), ("Fluß", "ﬂuss"), ("ЙОД", "йод")}
