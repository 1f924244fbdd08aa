"""Candidates of the fuzzy join are few and whole; greedy pairing equals the serial walk, long chains too."""

import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.similarity import indel_ratio
from quillon.operators import match


def names(rng, n, alphabet, longest):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))) for _ in range(n)]


def spoiled(rng, name, alphabet):
    i = rng.randint(0, len(name))
    return rng.choice([name[:i] + rng.choice(alphabet) + name[i:], name[:i] + name[i + 1 :], name, name[::-1]]) or "x"


@pytest.mark.parametrize(("threshold", "alphabet", "longest"), [(0.9, "ab", 14), (0.9, "abcdef ", 25), (0.8, "abc", 16), (0.6, "abcd", 9)])
def test_no_pair_is_lost(spark, threshold, alphabet, longest):
    rng = random.Random(int(threshold * 100) + longest)
    known = sorted({*names(rng, 150, alphabet, longest)})
    asked = sorted({spoiled(rng, rng.choice(known), alphabet) for _ in range(120)} | set(names(rng, 30, alphabet, longest)))
    low = threshold / (2 - threshold)
    pairs = match.near_pairs(spark.createDataFrame([(n,) for n in asked], "n string"), spark.createDataFrame([(c, i) for i, c in enumerate(known)], "c string, p int"), threshold, low)
    got = {(r.n, r.c) for r in pairs.collect() if indel_ratio(r.n, r.c) >= threshold}
    assert got == {(n, c) for n in asked for c in known if indel_ratio(n, c) >= threshold}


def test_fewer_candidates_than_shared_bigrams(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet").select(F.col("p_name").alias("c"), F.col("p_partkey").alias("p")).dropDuplicates(["c"])
    asked = part.filter("p % 5 = 0").select(F.concat("c", F.lit("s")).alias("n"))
    all_ = asked.withColumn("g", F.explode(match._grams("n"))).join(part.withColumn("g", F.explode(match._grams("c"))), "g").count()
    few = match.gram_candidates(asked, part, 0.9).count()
    assert few < all_ / 5


def test_equality_alone_compares_no_pairs(spark):
    known = spark.createDataFrame([(f"Name#{i:05}", i) for i in range(0, 60, 2)] + [("Évora", 61)], "c string, p int")
    asked = spark.createDataFrame([(f"Name#{i:05}",) for i in range(60)] + [("EVORA",), (None,)], "n string")
    found = match.resolve(asked, "n", known, "c", "p", threshold=1.0)
    assert "name_ratio" not in (plan := found._jdf.queryExecution().toString()) and "ArrowEvalPython" not in plan
    got = {r.n: r.matched for r in found.collect()}
    assert got == {**{f"Name#{i:05}": None if i % 2 else f"Name#{i:05}" for i in range(60)}, "EVORA": "Évora", None: None}


def serial(pairs):
    taken, out = set(), set()
    lefts = sorted({(lp, n, b) for b, n, lp, *_ in pairs})
    for lp, n, b in lefts:
        for _, _, c in sorted((-r, rp, c) for b2, n2, lp2, c, rp, r in pairs if (b2, n2, lp2) == (b, n, lp)):
            if (b, c) not in taken:
                taken.add((b, c))
                out.add((b, n, c))
                break
    return out


SCHEMA = "b int, n string, lp int, c string, rp int, r double"


@pytest.mark.parametrize(("seed", "enough"), [(1, 0.1), (2, 0.0), (3, 2.0)])
def test_first_come_equals_the_walk(spark, seed, enough):
    rng = random.Random(seed)
    pairs = sorted({(b, f"l{i}", i // 2, f"r{j}", j, 0.0) for b in (1, 2) for i in range(30) for j in rng.sample(range(25), rng.randint(0, 5))})
    pairs = [(*p[:5], rng.choice([0.9, 0.95, 1.0])) for p in pairs]
    got = match.first_come(spark.createDataFrame(pairs, SCHEMA), enough).collect()
    assert sorted(map(tuple, got)) == sorted(serial(pairs))


def test_a_chain_of_ten_thousand(spark):
    n = 10_000  # each wants what the one before it gets
    pairs = [(1, f"l{i}", i, f"r{j}", j, r) for i in range(n) for j, r in ((i - 1, 0.99), (i, 0.95)) if j >= 0]
    got = match.first_come(spark.createDataFrame(pairs, SCHEMA)).collect()
    assert {(r.n, r.c) for r in got} == {(f"l{i}", f"r{i}") for i in range(n)}


def test_groups_of_links(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 900) if i % 100 != 99] + [(2000 + rng.randint(0, 60), 2000 + rng.randint(0, 60)) for _ in range(40)] + [(5000, 5000)]
    got = {r.node: r.group for r in match.linked_groups(spark.createDataFrame(links, "u long, v long")).collect()}
    label = {x: x for e in links for x in e}
    for _ in range(len(label)):
        before = dict(label)
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
        if label == before:
            break
    assert got == label
