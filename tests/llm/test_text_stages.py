"""Quality rules, SimHash, suffix deduplication, language ID and licences against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quillon.llm import langid, licenses, quality, simhash, suffixes
from quillon.llm.common import labels_of, running, shared_path, text_buffers
from quillon.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "a", "A b C d", "x y z w v x y z w v", "é\u00a0ü ß\n\nline\nline\n x\u0085y", "same same same same same same", "l\n l\nl\n\nl"]


def made_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abB \n\té#") for _ in range(rng.randint(0, 90))) for _ in range(n)]


def frame(spark, texts, first=0):
    # columns that clash with names used inside are carried nowhere and break nothing
    rows = [(first + i, t, "en", "s", 1, "uid", 2.5, "fp") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size int, uid string, score double, fp string")


def base_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark):
    texts = [*TEXTS, *made_texts(150)]
    got = {r.doc_id: r for r in quality.judged(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        want = base_of(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_compression_bands(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    noise = lambda n: " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) for _ in range(n))
    near = " ".join(f"item {i % 7} of {i % 3}" for i in range(3000))
    got = {r.doc_id: r for r in quality.judged(frame(spark, [prose(800), prose(20), noise(60), near, prose(1500) + noise(120), prose(30000)])).collect()}
    assert [got[i].band_verdict for i in range(6)] == ["ok", "short" if got[1].n_bytes < 200 else "ok", "incompressible", "repetitive", got[4].band_verdict, "ok"]
    assert [got[i].kept for i in (0, 2, 3, 5)] == [True, False, False, True]
    assert got[4].n_bad_chunks > 0 and got[0].n_bad_chunks == 0


def fingerprint(text, k=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("limit", [7, 1 << 20])
def test_fingerprints(limit):
    texts = [*TEXTS, *made_texts(150, 2)]
    got = [x for _, _, d, o in text_buffers(pa.array(texts), limit) for x in simhash.fingerprints_of(d, o, 4).tolist()]
    assert got == [fingerprint(t) for t in texts]


def test_near_duplicates_are_the_components(spark):
    rng = random.Random(5)
    base = " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(120)).split()
    texts = [*TEXTS, *made_texts(30, 3), *[" ".join(w if rng.random() > 0.02 else "zz" for w in base) for _ in range(60)]]
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts, 10)).collect()}
    fps = np.array([fingerprint(t) for t in texts], np.uint64)
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    want = labels_of(len(fps), a, b) + 10
    assert [got[i + 10].component_id for i in range(len(fps))] == want.tolist()
    assert [got[i + 10].fingerprint for i in range(len(fps))] == [f"{int(x):016x}" for x in fps]
    kept = simhash.one_of_each(frame(spark, texts, 10))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.tolist()))
    assert kept.columns == frame(spark, [None]).columns


@pytest.mark.parametrize("tile", [4, 512])
def test_links_join_dense_groups_without_pairs(spark, tile):
    rng = np.random.default_rng(1)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 400:
        x = int(rng.choice(list(fps)))
        for b in rng.integers(0, 64, 3):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 50)}
    fps = np.array(sorted(fps), np.uint64)
    links = simhash.close_links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long"), tile=tile).collect()
    where = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    got = labels_of(len(fps), np.array([where[r.a] for r in links]), np.array([where[r.b] for r in links]))
    assert (got == labels_of(len(fps), a, b)).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 105), (201, 105), (202, 105)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, **dict.fromkeys((105, 200, 201, 202), 105)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def removed_spans(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mark = np.zeros(len(b) + 2, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i + 1] += 1
                mark[i + length + 1] -= 1
        on = np.concatenate(([0], (np.cumsum(mark)[1 : len(b) + 1] > 0).astype(int), [0]))
        out.append(list(zip(np.flatnonzero(np.diff(on) == 1).tolist(), np.flatnonzero(np.diff(on) == -1).tolist(), strict=True)))
    return out


@pytest.mark.parametrize(("length", "also", "seed", "group"), [(40, None, 1, 4096), (64, 48, 2, 16), (64, 40, 3, 4)])
def test_suffix_dedup_equals_brute_force(spark, length, also, seed, group):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcdefgh é\0") for _ in range(n))
    base = [letters(300) for _ in range(5)]
    texts = [None, "", "a" * 500, "ab" * 300, "xyz" * 30, "short"]
    for _ in range(90):
        t = ""
        for _ in range(rng.randint(0, 4)):
            a = rng.randint(0, 250)
            t += rng.choice(base)[a : a + rng.randint(10, 200)] + (letters(rng.randint(1, 60)) if rng.random() < 0.5 else "")
        texts.append(t)
    texts += [texts[-1], texts[-1], texts[-1].upper()]
    docs = frame(spark, texts)
    docs = docs.unionByName(docs.filter(f"doc_id = {len(texts) - 5}")).withColumn("spans", F.lit(1))
    texts.append(texts[-5])
    rows = suffixes.deduplicated(docs, length, keep=("source", "spans"), also=also, group=group).collect()
    assert len(rows) == len(texts)
    got = {r.id: r for r in rows}
    more = removed_spans(texts, also) if also else [None] * len(texts)
    for i, want in enumerate(removed_spans(texts, length)[:-1]):
        assert [(s.a, s.b) for s in got[i].spans] == want, i
        assert (got[i].repeats and [(s.a, s.b) for s in got[i].repeats]) == (more[i] or ([] if also else None)), i
        raw = (texts[i] or "").encode()
        kept = b"".join(raw[a:b] for a, b in zip([0, *[s[1] for s in want]], [*[s[0] for s in want], len(raw)], strict=True))
        assert hashlib.sha256(bytes(got[i].kept)).digest() == hashlib.sha256(kept).digest()
        assert got[i].source == "s" and got[i].spans_in == 1 and got[i].n_bytes == len(raw)
        assert got[i].repaired == (texts[i] if not want else kept.decode(errors="ignore"))


def test_suffix_dedup_of_the_default_length(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = prose(90)
    texts = [prose(60) + " " + shared + " " + prose(60) for _ in range(6)] + [prose(200) for _ in range(10)] + [shared[:399], prose(5)]
    got = {r.id: [(s.a, s.b) for s in r.spans] for r in suffixes.deduplicated(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == removed_spans(texts, 400)


def test_index_levels_grow_geometrically(spark):
    path, sizes = shared_path(spark, "family"), []
    for i in range(5):
        family = suffixes.IndexFamily(spark, path)  # opened again for each batch
        rows = [(h, h, h, i, h, 0) for h in (100 + i, 1, 2 if i == 3 else 50 + i)]
        found = family.add(spark.createDataFrame(rows, "head long, tail long, ctx long, u0 long, u1 long, pos long"))
        assert sorted(r.head for r in found.distinct().collect()) == ([] if i == 0 else [1])
        sizes.append([b - a + 1 for a, b in family.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1]]
    whole = [tuple(r) for r in suffixes.IndexFamily(spark, path).arrays().collect()]
    assert len(whole) == 15 and sorted(r[3] for r in whole if r[0] == 1) == [0, 1, 2, 3, 4] and (102, 102, 102, 2, 102, 0) in whole
    ordered = [tuple(r) for r in family._read(family.levels[0]).collect()]  # files and rows in order: one array
    assert len(ordered) == 12 and ordered == sorted(ordered)
    (files,) = {f.rpartition("/")[0] for f in family._read(family.levels[0]).inputFiles()}
    assert files.endswith("level-000000-000003")
    family.drop()
    assert suffixes.IndexFamily(spark, path).levels == []


def test_anchors_of_pieces(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (5000, 30, 900, 0, 2600)]
    docs = frame(spark, texts)
    whole = suffixes.anchor_table(docs, (64, 90)).collect()
    assert len(whole) > 200
    for piece in (100, 700):
        assert sorted(suffixes.anchor_table(docs, (64, 90), piece=piece).collect()) == sorted(whole)


def test_language_id(spark):
    rng = random.Random(2)
    words = {"aa": ["la", "casa", "perro", "niño"], "bb": ["the", "house", "dogs", "child"], "cc": ["das", "haus", "hünd", "kind"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randint(3, 60))), x) for i in range(240) for x in [rng.choice(list(words))]]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fitted(train.filter(~langid.held_out()), langid.Settings(rows=2048, epochs=4))
    got = langid.predicted(train, model).join(train.select("doc_id", "lang"), "doc_id").filter(langid.held_out()).collect()
    assert len(got) > 40 and sum(r.lang_pred == r.lang for r in got) / len(got) > 0.98
    edge = langid.predicted(frame(spark, [None, "", "123 !?", "\u4e2d\u6587", "la casa perro"]), model).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in edge[:3]] == [True] * 3 and edge[4].lang_pred == "aa"
    assert [r.rejected for r in edge[:3]] == [True] * 3 and not edge[4].rejected
    assert all(0 <= r.score <= 1 for r in edge)
    empty = langid.fitted(train.limit(0))
    assert {r.lang_pred for r in langid.predicted(train, empty).collect()} == {"und"}


def test_licences(spark):
    texts = [
        None, "", "plain words\nand more", "intro\nReleased under the MIT License.\nend", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Flying Teapot Licence of 1907, see the attic.", "The driver showed his license to the officer at the gate.",
        "SPDX-License-Identifier: MIT\n\nLicensed under CC BY 4.0.", "Released under the MIT License.\n" * 50,
    ]
    got = licenses.scanned(frame(spark, texts)).orderBy("doc_id").collect()
    assert [r.license for r in got[:7]] == [None, None, None, "MIT", "Apache-2.0", "CC-BY-NC", "GPL-3.0"]
    assert got[7].license in (None, "unknown") and got[8].license is None
    assert got[9].licenses == "CC-BY,MIT" and got[10].n_license_paragraphs == 50
    assert licenses.scanned(frame(spark, texts).limit(0)).count() == 0
    plan = licenses.scanned(frame(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_running_sums(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), i % 30, rng.randint(0, 5)) for i in range(200)]
    df = running(spark.createDataFrame(rows, "g string, k int, n long"), ["g"], [F.col("k"), F.col("n")], "n", "before", cells=4).collect()
    for g in "ab":
        part = sorted((r.before, r.n) for r in df if r.g == g)
        at = 0
        for before, n in part:
            assert before == at or n == 0
            at = max(at, before + n)
        assert at == sum(r[2] for r in rows if r[0] == g)


def test_empty_tables(spark):
    none = frame(spark, [None]).limit(0)
    assert quality.judged(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert suffixes.deduplicated(none).count() == 0
