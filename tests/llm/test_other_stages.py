"""Mixing, packing, archives, URLs, search and the pipeline."""

import hashlib
import io
import itertools
import random
import re
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.llm import mixing, packing, queries, topk, urls, warc
from quillon.llm.common import shared_folder


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, source string, copies string, n_tokens int")


def test_targets_fill_up_to_the_cap():
    assert mixing.filled([100, 100, 100], [1, 2, 3], 300, 3) == pytest.approx([50, 100, 150])
    assert mixing.filled([10, 1000, 1000], [2, 1, 1], 2010, 3) == pytest.approx([30, 990, 990])
    assert mixing.filled([0, 10], [1, 1], 10, 3) == pytest.approx([0, 10])
    assert mixing.filled([], [], 0, 3) == []


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30))), rng.choice(["a", "b", "B", None, "é"])) for i in range(600)]
    rows += [(900, None, "a"), (901, "", None), (5, rows[5][1], rows[5][2]), (None, "u v w", "a")]
    df = docs_of(spark, rows)
    got = mixing.planned(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted(x for x in sizes if x is not None) + [None]
    want = dict(zip(order, mixing.filled([sizes[s] for s in order], [1 + k % 3 for k in range(len(order))], sum(sizes.values()), 3), strict=True))
    taken = Counter()
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size and len(r.positions) == r.copies and list(r.positions) == sorted(r.positions)
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 30 for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.planned(df.repartition(7)).collect()))
    positions = [r.position for r in mixing.in_order(mixing.planned(df), 4).collect()]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    assert mixing.planned(df.limit(0)).count() == 0


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w", s) for s in "ab" for i in range(4000)]
    plan = mixing.in_order(mixing.planned(docs_of(spark, rows), lambda k: [(0.0, 1.0 - k), (1.0, float(k))])).collect()
    for s, f in (("a", lambda t: 2 * t - t * t), ("b", lambda t: t * t)):  # the integrals of 1 - t and t, as parts of the whole
        at = np.sort([r.position for r in plan if r.source == s])
        assert len(at) == 4000
        assert np.abs(f(at) - (np.arange(4000) + 0.5) / 4000).max() < 1e-9


def test_boundaries_are_optimal():
    for seed in range(25):
        rng = np.random.default_rng(seed)
        lengths = sorted(set(rng.integers(1, 60, 8).tolist()))
        bins = [(n, int(rng.integers(1, 9))) for n in lengths]
        k = int(rng.integers(1, 6))
        cost = lambda bs: sum(c * min(b for b in bs if b >= n) for n, c in bins)  # noqa: B023, E731
        best = min(cost((*c, lengths[-1])) for m in range(k) for c in itertools.combinations(lengths[:-1], min(m, len(lengths) - 1)))
        got = packing.boundaries(bins, k)
        assert cost(got) == best and len(got) <= k


def test_packing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 3, 20, 200, 1500]) + rng.randint(0, 3))), "s") for i in range(400)]
    rows += [(900, None, "s"), (3, rows[3][1], "s"), (None, "a b", "s")]
    got = packing.packed(docs_of(spark, rows), budget=1000, buckets=4).collect()
    assert len(got) == len(rows)
    assert len({r.bucket for r in got}) == 4
    batches = Counter((r.bucket, r.batch) for r in got)
    for r in got:
        assert r.padding == r.bucket_tokens - r.n_tokens >= 0
        assert batches[r.bucket, r.batch] * r.bucket_tokens <= max(1000, r.bucket_tokens)
        assert r.slot < batches[r.bucket, r.batch]
    for b in {r.bucket for r in got}:
        room = max(1, 1000 // next(r.bucket_tokens for r in got if r.bucket == b))
        sizes = [n for (x, k), n in sorted(batches.items()) if x == b]
        assert all(n == room for n in sizes[:-1])
    assert sorted(map(str, got)) == sorted(map(str, packing.packed(docs_of(spark, rows).repartition(5), budget=1000, buckets=4).collect()))
    assert packing.packed(docs_of(spark, rows).limit(0)).count() == 0


def test_buckets_of_long_documents_are_nearly_optimal(spark):
    rng = random.Random(7)
    sizes = [rng.randint(1025, 9000) for _ in range(9)] * 2 + [1030, 1031]
    got = packing.packed(spark.createDataFrame([(i, None, n) for i, n in enumerate(sizes)], "doc_id long, text string, n long"), buckets=3, tokens=F.col("n")).collect()
    cost = lambda bs: sum(min(b for b in bs if b >= n) for n in sizes)
    lengths = sorted(set(sizes))
    best = min(cost((*c, lengths[-1])) for m in range(3) for c in itertools.combinations(lengths[:-1], m))
    assert {r.bucket_tokens for r in got} <= set(sizes)  # true lengths, not rounded ones
    assert best <= sum(r.bucket_tokens for r in got) <= best * (1 + 1 / packing.STEPS)


def test_length_classes(spark):
    ns = [0, 1, 1023, 1024, 1025, 1040, 5000, 100_000, 1 << 40]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in ns], "n long").select(packing.length_class(F.col("n"))).collect()]
    assert got[:4] == [1, 1, 1023, 1024] and all(c >= n and c - n <= n / 32 for n, c in zip(ns[4:], got[4:], strict=True))


def test_archives_round_trip(spark):
    long, rng = "päge " * 400, random.Random(6)
    rows = [(1, "http://a/ü b", long), (2, None, long), (7, "http://c", long), (3, "http://d", None), (4, "http://e", ""), (5, "x\ny", "short"), (6, "http://f", "short"), (None, "http://n", long), (8, "http://g", "".join(rng.choice("ab\r\n") for _ in range(3000)))]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    manifest = warc.archived(warc.typed(pages), shared_folder(spark, "warc-test"), roll=2000)
    got = {r.page: r for r in warc.read_back(manifest, payloads=True).collect()}
    assert len(got) == len(rows) == manifest.agg(F.sum("records")).first()[0]
    for page, url, html in rows:
        r = got[None if page is None else str(page)]
        raw = (html or "").encode()
        again = html == long and page != 7
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(raw), hashlib.sha1(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", "7") if again else ("response", None))
        assert bytes(r.payload) == (b"" if again else raw)
    assert warc.read_back(warc.archived(warc.typed(pages.limit(0)), shared_folder(spark, "warc-none"))).count() == 0


@pytest.mark.parametrize("big", [False, True])
def test_zip_directories(monkeypatch, big):
    if big:  # makes zipfile write ZIP64 records for small archives
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    buffer = io.BytesIO()
    data = {"a": b"x" * 500, "dir/ü.txt": b"second" * 40, "c": b"", "d": bytes(range(256)) * 3}
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"PK\x05\x06 in a comment"
        for k, v in data.items():
            with z.open(zipfile.ZipInfo(k), "w", force_zip64=big) as m:
                m.write(v)
        packed = zipfile.ZipInfo("packed")
        packed.compress_type = zipfile.ZIP_DEFLATED
        z.writestr(packed, b"q" * 900)
    members = warc.directory(buffer)
    for k, v in data.items():
        m = warc.stored_member(members, k)
        assert buffer.getvalue()[m.start : m.start + m.size] == v
    with pytest.raises(ValueError, match="compressed"):
        warc.stored_member(members, "packed")
    with pytest.raises(ValueError):
        warc.directory(io.BytesIO(b"nothing here"))


def test_broken_payloads_are_errors():
    raw = warc.record("1", "http://a", "response", hashlib.sha1(b"other").hexdigest(), b"payload", 7, None, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(raw)


URLS = [None, "", "no scheme", "HTTP://Www.Example.COM/en/x?y#z", "http://example.com/en/", "http://example.com/en", "http://notexample.com/en/", "http://a.net/es/1", "http://net/es/", "x://com", "x://com/", "://A.Com//p?q", "http://b.net/fr", "http://u.org/?a=/en/", "http://b.net/fr/é"]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in urls.judged(df, queries.RULES).collect()}
    for i, u in enumerate(URLS):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host) :])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best.name), u
        assert got[i].verdict == (best.verdict if best else got[i].verdict) and got[i].verdict in ("allow", "block")
    assert got[0].verdict == "block" and got[0].score is None
    assert urls.judged(df.limit(0), queries.RULES).count() == 0


def model_ratio(url, counts, totals, order=urls.ORDER):
    """The log ratio of one URL by the definition, from character counts."""
    text, total = urls.START * order + url + urls.END, 0.0
    v = len({g for g in {*counts[0], *counts[1]} if len(g) == 1}) + 1
    for i in range(order, len(text)):
        if not any(counts[s][text[i]] for s in (0, 1)):
            steps = [1.0, 1.0]
        else:
            steps = [(counts[s][text[i]] + 1) / (totals[s] + v) for s in (0, 1)]
        for k in range(1, order + 1):
            gram, context = text[i - k : i + 1], text[i - k : i]
            ahead = [sum(n for g, n in counts[s].items() if len(g) == k + 1 and g[:k] == context) for s in (0, 1)]
            steps = [(counts[s][gram] + urls.BETA * p) / (ahead[s] + urls.BETA) for s, p in zip((0, 1), steps, strict=True)]
        total += np.log(steps[0] / steps[1])
    return total / (len(url) + 1)


def test_url_model_equals_its_definition(spark):
    good, bad = ["good.com/a", "good.com/b", "nice.com/ab"], ["bad.net/x", "bad.net/xx", "ugly.net/x"]
    rows = [(u, 1, True) for u in good] + [(u, 2, False) for u in bad]
    model = urls.trained(spark.createDataFrame(rows, "u string, n long, accepted boolean"))
    counts, totals = (Counter(), Counter()), [0, 0]
    for u, n, ok in rows:
        text = urls.START * urls.ORDER + u + urls.END
        for i in range(urls.ORDER, len(text)):
            totals[0 if ok else 1] += n
            for k in range(urls.ORDER + 1):
                counts[0 if ok else 1][text[i - k : i + 1]] += n
    asked = [*good, *bad, "good.net/a", "ba.com/x"]
    got = {r.u: r.score for r in urls.scored(spark.createDataFrame([(u,) for u in asked], "u string"), model).collect()}
    for u in asked:
        assert got[u] == pytest.approx(model_ratio(u, counts, totals), abs=2e-6), u
    assert min(got[u] for u in good) > 0 > max(got[u] for u in bad)


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = centres[rng.integers(0, 6, 500)] ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64))
    codes[:120] = codes[0]
    codes[400:] = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    rows = [(i, int(c)) for i, c in enumerate(codes.view(np.int64))] + [(3, int(codes.view(np.int64)[3])), (None, 5), (999, None)]
    base = spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, code long, distance string")
    got = topk.nearest(base, base.filter("vec_id % 20 = 0 or vec_id > 480"), 7).collect()
    asked = [i for i in range(500) if i % 20 == 0 or i > 480]
    lists = {}
    for r in sorted(got, key=lambda r: r.rank):
        lists.setdefault(r.query_id, []).append((r.distance, r.neighbour_id))
    for q in asked:
        want = sorted((int(np.bitwise_count(codes[q] ^ codes[i])), i) for i in range(500) if i != q)[:7]
        assert lists[q] == want
    assert topk.nearest(base.limit(0), base).count() == 0
    assert {r.query_id: 0 for r in topk.nearest(base.filter("vec_id < 3"), base.filter("vec_id < 2"), 7).collect()} == {0: 0, 1: 0}


def test_codes(spark):
    df = spark.createDataFrame([([0.5, -1.0, 0.0, 2.0],), ([],), (None,), ([1.0] * 64,)], "v array<float>")
    assert [r[0] for r in df.select(topk.code_of(F.col("v"))).collect()] == [0b1001, 0, None, -1]


def test_registered_queries():
    numbers = sorted(int(m[1]) for k in queries.QUERIES if (m := re.match(r"op(\d+)_", k)))
    assert numbers == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "suffix_dedup", "mixing", "packing"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    d = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, "/root/testdata/sf0.001").cache()
        seen[name] = d.toPandas()
        if name != "packing":
            assert d.columns == docs.columns
    n = docs.count()
    assert len(seen["language_id"]) >= 0.98 * n
    assert seen["near_duplicates"].doc_id.is_unique and len(seen["near_duplicates"]) <= len(seen["language_id"])
    before = seen["near_duplicates"].set_index("doc_id").text
    cut = seen["suffix_dedup"].set_index("doc_id").text
    assert all(len(t) <= len(before[i]) for i, t in cut.items()) and set(cut.index) <= set(before.index)
    assert seen["mixing"].doc_id.value_counts().max() <= 3 and set(seen["mixing"].doc_id) <= set(cut.index)
    assert sorted(seen["packing"].doc_id) == sorted(seen["mixing"].doc_id)
