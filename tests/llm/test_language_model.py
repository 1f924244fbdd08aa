"""Language ID against slow twins: subwords of a buffer, scores of whole texts, carried columns."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillon.llm import langid
from quillon.llm.common import text_buffers

SETTINGS = langid.Settings(rows=4096, epochs=4)


def slow_grams(text, rows=4096):
    raw = (text or "").encode()
    code = [b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0 for b in raw]
    out = Counter()
    for k in SETTINGS.grams:
        for i in range(len(code) - k + 1):
            part = code[i : i + k]
            if 0 in part[1:-1] or (k == 2 and not any(part)):
                continue
            h = 0
            for c in part:
                h = (h * 0x01000193 + c) & 0xFFFFFFFF
            h = ((h ^ h >> 15) * (0x85EBCA6B + k * 2)) & 0xFFFFFFFF
            out[(h ^ h >> 13) % rows] += 1
    return out


def some_texts():
    rng = random.Random(4)
    return [None, "", "a", "ab", "é", "A b.C", *["".join(rng.choice("abcXYZ .é\n中9") for _ in range(rng.randint(0, 60))) for _ in range(120)], "long word " * 400]


@pytest.mark.parametrize("piece", [5, 64, 1 << 18])
@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_subwords_of_pieces(piece, limit):
    texts, got = some_texts(), []
    for lo, hi, data, offsets in text_buffers(pa.array(texts), limit):
        found = [Counter() for _ in range(hi - lo)]
        for t0, t1, ids, sizes in langid.gram_pieces(data, offsets, SETTINGS, piece):
            assert len(sizes) == t1 - t0
            for t, part in zip(range(t0, t1), np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                found[t].update(part.tolist())
        got += found
    assert got == [slow_grams(t) for t in texts]


def labelled(spark, n=240):
    rng = random.Random(2)
    words = {"aa": ["la", "casa", "perro", "niño"], "bb": ["the", "house", "dogs", "child"], "cc": ["das", "haus", "hünd", "kind"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randint(3, 60))), x, 1.5, "q") for i in range(n) for x in [rng.choice(list(words))]]
    return spark.createDataFrame([*rows, (n, rows[0][1] * 20000, rows[0][2], None, None), (n, rows[0][1] * 20000, rows[0][2], None, None)], "doc_id long, text string, lang string, score double, rejected string")


@pytest.mark.parametrize("dim", [2, 12])
def test_scores_of_whole_texts(spark, dim):
    docs = labelled(spark)
    model = langid.fitted(docs.filter(~langid.held_out()), langid.Settings(rows=4096, epochs=4, dim=dim))
    got = langid.predicted(docs, model, carry=("text", "score", "rejected"))
    assert got.columns == ["doc_id", "text", "score_in", "rejected_in", "lang_pred", "score", "rejected"]
    rows = got.collect()
    assert len(rows) == 242 and rows[-1] == rows[-2]
    for r in rows:
        ids = slow_grams(r.text[:20000] if len(r.text) < 20000 else r.text[: len(r.text) // 20000] * 40)
        mean = sum(n * model.emb[i].astype(float) for i, n in ids.items()) / sum(ids.values())
        z = (mean @ model.out + model.bias) * model.scale
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r.lang_pred == model.langs[int(p.argmax())] and abs(r.score - p.max()) < 1e-3
        assert r.rejected == (r.score < model.threshold)


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(i, "abc def", x) for i in range(40) for x in ("xx", "yy")], "doc_id long, text string, lang string")
    model = langid.fitted(docs, SETTINGS)
    even = langid.Model(model.langs, model.emb, model.out * 0, model.bias * 0, 1.0, 0.0, SETTINGS)
    assert {(r.lang_pred, r.score) for r in langid.predicted(docs, even).collect()} == {("xx", 0.5)}
