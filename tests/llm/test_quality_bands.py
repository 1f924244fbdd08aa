"""Compression bands on encoded data, whole and in stretches."""

import random

import pyarrow.parquet as pq
import pytest

from quillon.llm import quality

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def encoded(rng, size, width):
    text = ""
    while len(text) < size:
        text += "".join(rng.choice(SYMBOLS) for _ in range(width)) + " "
    return text[:size]


def prose(size):
    """Prose of `size` bytes: documents end to end, cut at a character."""
    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist() if t and len(t) > 1500]
    return " ".join(texts).encode()[:size].decode(errors="ignore")


def judged(spark, texts):
    rows = quality.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [(r.band_verdict, r) for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("size", [160, 199, 200, 300, 500, 900, 999])
def test_short_encoded_texts_are_incompressible(spark, size):
    rng = random.Random(size)
    got = judged(spark, [encoded(rng, size, w) for w in (20, 60, 2000) for _ in range(10)])
    assert {v for v, _ in got} == {"incompressible"} and not any(r.kept for _, r in got)


def test_short_prose_stays(spark):
    whole = prose(20000)
    for size, verdict in ((60, "short"), (160, "short"), (199, "short"), (200, "ok"), (300, "ok"), (500, "ok"), (900, "ok")):
        got = judged(spark, [whole[k : k + size].encode()[:size].decode(errors="ignore") for k in range(0, 15000, 1500)])
        assert {v for v, r in got if r.n_bytes >= size} <= {verdict}, size


def test_encoded_stretches_of_long_texts_are_found(spark):
    rng = random.Random(4)
    texts = []
    for size in (32768, 49152, 160000):
        whole = prose(size)
        for share in (0.1, 0.3, 0.45, 0.49):
            if share * size > 2 * 4096 or share >= 0.3:
                n = int(size * share)
                texts += [whole[: size - n] + encoded(rng, n, 60), encoded(rng, n, 60) + whole[: size - n], whole[: size // 3] + encoded(rng, n, 60) + whole[size // 3 :]]
    texts += [prose(4096 * 2 + 2200) + encoded(rng, 4096 - 2200 + 1500, 60)]  # ends in a rest of under half a chunk
    got = judged(spark, texts)
    assert {v for v, _ in got} <= {"chunks", "incompressible"} and not any(r.kept for _, r in got)
    assert got[-1][1].n_chunks == 3
    clean = judged(spark, [prose(n) for n in (5000, 9000, 32768, 49152)])
    assert [v for v, _ in clean] == ["ok"] * 4 and [r.n_chunks for _, r in clean] == [1, 2, 8, 12]


def test_mixed_document_is_rejected_for_its_chunks(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    text = " ".join(rng.choice(words) for _ in range(3000)) + encoded(rng, 7300, 60)
    assert judged(spark, [text])[0][0] == "chunks"
