"""Attention over passages: passages and features by hand, gradients by differences, held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_text_stages import TEXTS, WORD, made_texts

from quillon.llm import passages, queries
from quillon.llm.common import text_buffers


def plain_passages(text, words):
    """(bytes, words) of each passage."""
    text = text or ""
    found = [m.start() for m in WORD.finditer(text)]
    cuts = [0, *found[words::words], len(text)]
    return [(text[a:b].encode(), WORD.findall(text[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]


def plain_shares(data):
    out = np.zeros(passages.KINDS**2)
    kinds = [int(passages._KIND[b]) for b in data]
    for a, b in zip(kinds, kinds[1:], strict=False):
        out[a * passages.KINDS + b] += 1
    return np.sqrt(out / max(1, len(data) - 1))


@pytest.mark.parametrize(("limit", "piece"), [(1 << 20, 1 << 20), (50, 7)])
def test_passages_and_features(monkeypatch, limit, piece):
    monkeypatch.setattr(passages, "PIECE", piece)
    texts = [*TEXTS, *made_texts(80, 8)]
    for lo, hi, data, offsets in text_buffers(pa.array(texts), limit):
        at, word, bags, spans = passages.passages(data, offsets, 4)
        shares, info = passages.shares(data, at), passages.measures(data, at, word, spans)
        k = 0
        for t in range(lo, hi):
            seen, pairs, last = set(), set(), None
            for chunk, words in plain_passages(texts[t], 4):
                assert data[at[k] : at[k + 1]].tobytes() == chunk and word[k + 1] - word[k] == len(words)
                assert shares[k] == pytest.approx(plain_shares(chunk), abs=1e-6)
                old = twice = same = 0
                for w in words:
                    old += w in seen
                    same += w == last
                    pair = (last if last is not None else w, w)
                    twice += pair in pairs
                    seen.add(w)
                    pairs.add(pair)
                    last = w
                sizes = [len(w.encode()) for w in words]
                n = max(1, len(words))
                want = [np.log1p(len(words)), len(words) / 64, sum(sizes) / n, (sum(x * x for x in sizes) / n) ** 0.5, same / n, old / n, twice / n, sum(x > 20 for x in sizes) / n, sum(x <= 3 for x in sizes) / n]
                assert info[k] == pytest.approx([*want, np.log1p(len(chunk))], abs=1e-5)
                k += 1
            assert bags[t - lo + 1] == k
        assert k == len(at) - 1


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    w = {n: rng.normal(0, 0.7, s) for n, s in {"w": (6, 4), "b": 4, "v": (4, 3), "u": (4, 3), "a": 3, "c": 4, "d": 1}.items()}
    x, cuts, y, weight = rng.normal(0, 1, (11, 6)), np.array([0, 3, 4, 9]), np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 0.5])

    def loss():
        z = passages._attended(np.tanh(x @ w["w"] + w["b"]), w, cuts)[1] @ w["c"] + w["d"]
        return float((weight * np.logaddexp(0, np.where(y == 1, -z, z))).mean())

    for name, got in passages._gradients(x, cuts, y, weight, w).items():
        for i in np.ndindex(w[name].shape):
            old = w[name][i]
            w[name][i] = old + 1e-6
            up = loss()
            w[name][i] = old - 1e-6
            down = loss()
            w[name][i] = old
            assert got[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeiourstlnmdcp") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))


BAD = [
    lambda rng, n: " | ".join(w for w in prose(rng, n).split()), lambda rng, n: prose(rng, n).upper().replace(" ", "!! "),
    lambda rng, n: " ".join(w for w in prose(rng, n // 8 + 1).split() for _ in range(8)), lambda rng, n: " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(rng, n).split()),
]


def made(rng, i):
    n = rng.choice([30, 80, 300])
    if i % 3:
        return prose(rng, n), 1
    body = rng.choice(BAD)(rng, n)
    return (prose(rng, 40) + "\n" + body if i % 2 else body), 0


def test_held_out_accuracy_and_odd_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, *made(rng, i)) for i in range(900)]
    odd = [(1000, None, None), (1001, "", None), (1002, " \n", None), (None, "a b", None), (1003, "same row", None), (1003, "same row", None), (1004, "x" * 300_000, None)]
    spark.createDataFrame([(i, t, "en", 0.5, 7) for i, t, _ in rows + odd], "doc_id long, text string, quality string, score double, y int").write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, q, 0) for i, _, q in rows] + [(1, 0, 0), (1, 1, 0), (5000, 1, 0), (None, 1, 0), (2, None, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.QUERIES["op13_quality_classifier"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and 0 < r.top_attention <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1003}) == 1
    by = {r.doc_id: r for r in got}
    held = [(by[i].predicted, q) for i, _, q in rows if by[i].held_out]
    assert len(held) > 100 and sum(p == q for p, q in held) >= 0.95 * len(held)


def test_labels_decide_nothing_where_they_are_held_out(spark):
    rng = random.Random(5)
    rows = [(i, *made(rng, i)) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = {r.doc_id for r in docs.filter(passages.held_out()).collect()}
    scores = []
    for flip in (0, 1):
        labels = spark.createDataFrame([(i, 1 - q if flip and i in held else q) for i, _, q in rows], "doc_id long, quality int")
        model = passages.fitted(docs, labels.filter(~passages.held_out()), passages.Settings(epochs=2))
        scores.append(sorted((r.doc_id, r.score) for r in passages.scored(docs, model).collect()))
    assert scores[0] == scores[1]


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in passages.scored(docs, passages.fitted(docs, none)).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in passages.scored(docs, passages.fitted(docs, ones)).collect())
    assert passages.scored(docs.limit(0), passages.fitted(docs.limit(0), none)).collect() == []
