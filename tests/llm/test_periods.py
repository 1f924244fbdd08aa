"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_text_stages import TEXTS, frame, made_texts

from quillon.llm import periods, queries
from quillon.llm.common import text_buffers, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=12):
    """Every maximal stretch of every period, then the smallest period of each stretch."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(1, 5)):
            part = [rng.choice("abcde") for _ in range(rng.randint(1, 9))]
            words += part * rng.randint(1, 6) + part[: rng.randint(0, len(part))]
            words += [rng.choice("abxyz") for _ in range(rng.randint(0, 6))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("least", "limit"), [(12, 1 << 19), (12, 60), (2, 1 << 19), (5, 200)])
def test_runs_are_those_of_the_definition(least, limit, monkeypatch):
    monkeypatch.setattr(periods, "CANDIDATES", 50)
    monkeypatch.setattr(periods, "WORDS_AT_ONCE", 7)
    texts = [*TEXTS, *made_texts(60, 4), *periodic_texts(150, least), "a " * 90, "ab c " * 40]
    for lo, hi, data, offsets in text_buffers(pa.array(texts), limit):
        starts, ends, first = word_spans(data, offsets)
        runs = periods.runs_of(periods.word_names(data, starts, ends), first, least)
        for t in range(lo, hi):
            got = [tuple(r[1:]) for r in runs.tolist() if r[0] == t - lo]
            assert got == plain_runs(WORD.findall(texts[t] or ""), least), texts[t]


def test_long_random_words():
    rng = np.random.default_rng(5)
    words = [str(x) for x in rng.integers(0, 3, 700)] + ["z", "y", "x"] * 60 + [str(x) for x in rng.integers(0, 2, 300)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, first = word_spans(data, np.array([0, len(data)]))
    got = [tuple(r[1:]) for r in periods.runs_of(periods.word_names(data, starts, ends), first, 12).tolist()]
    assert got == plain_runs(words)


def planted(text, doc_id):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query(spark, tmp_path):
    texts = [*TEXTS, *made_texts(40, 4), *periodic_texts(150, 9)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    changed = 0
    for i, t in enumerate(texts):
        words = planted(t, i)
        changed += words != WORD.findall(t or "")
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if not runs else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert changed > 5


def test_odd_tables(spark):
    schema = "doc_id string, text string, id int, runs string, n_words int, collapsed int"
    rows = [("k", "x y " * 9, 1, "r", 2, 3)] * 2 + [(None, None, None, None, None, None), ("e", "", 1, "r", 2, 3)]
    got = periods.periodic_runs(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or "", r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        ("", 0, [], ""), ("e", 0, [], ""), ("k", 18, [(0, 18, 2)], "x y"), ("k", 18, [(0, 18, 2)], "x y"),
    ]
    assert periods.periodic_runs(spark.createDataFrame([], schema)).collect() == []


def test_a_long_text(spark):
    """Ten million bytes: a run over half of the words."""
    docs = spark.range(1).selectExpr("id AS doc_id", "concat('p q ', repeat('one two three ', 400000), array_join(transform(sequence(1L, 800000L), x -> hex(x * x)), ' ')) AS text")
    (r,) = periods.periodic_runs(docs).collect()
    assert r.n_words == 2_000_002 and [tuple(x) for x in r.runs] == [(2, 1_200_000, 3)] and r.collapsed.startswith("p q one two three 1 4 9 10 ")
