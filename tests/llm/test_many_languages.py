"""Language ID with more languages than the commonest 64."""

import random
from dataclasses import replace

import pytest

from quillon.llm import langid


def many(languages, texts):
    rng = random.Random(9)
    rows = []
    for n in range(languages):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 9)
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(15)]
        rows += [(f"l{n:03}", " ".join(rng.choice(words) for _ in range(40))) for _ in range(texts if n < 70 else texts // 2)]
    return [(i, t, x) for i, (x, t) in enumerate(rows)]


def test_every_labelled_language_is_learned(spark):
    docs = spark.createDataFrame(many(80, 30), "doc_id long, text string, lang string").cache()
    model = langid.fitted(docs)
    assert len(model.langs) == 80
    rare = [r for r in langid.predicted(docs.filter("lang >= 'l070'"), model).join(docs, "doc_id").collect()]
    assert sum(r.lang_pred == r.lang for r in rare) > 0.9 * len(rare) == 0.9 * 150


def test_the_whole_sample_is_bounded(spark):
    docs = spark.createDataFrame(many(80, 30), "doc_id long, text string, lang string")
    sample = langid.sampled(docs, replace(langid.Settings(), max_texts=800), "doc_id", "text", "lang").groupBy("lang").count().collect()
    assert len(sample) >= 78 and 600 < sum(r["count"] for r in sample) < 1000
    with pytest.raises(ValueError):
        langid.sampled(docs, replace(langid.Settings(), max_langs=79), "doc_id", "text", "lang")
