"""The pipeline's near-duplicate stage against brute force."""

import random
import re

import pytest

import corpus_pipeline
from quillon.llm import jaccard


def brute_keepers(texts, words=5, least=0.8):
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if (not sets[i] and not sets[j]) or len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) > 0]
    root = list(range(len(sets)))
    for _ in sets:
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    return sorted(set(root))


def edited_copies():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [None, "", "one two", "ONE two", "one two three"]
    for copies, edits in ((12, 1), (12, 2), (4, 3), (4, 5), (3, 12)):
        base = [word() for _ in range(150)]
        texts.append(" ".join(base))
        texts += [" ".join(word() if i in at else w for i, w in enumerate(base)) for at in (set(rng.sample(range(150), edits)) for _ in range(copies))]
    return texts + [" ".join(word() for _ in range(40)) for _ in range(20)]


@pytest.mark.parametrize("tile", [4, 512])
def test_edited_copies_go_as_in_brute_force(spark, tile):
    texts = edited_copies()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard.one_of_each(df, tile=tile).collect()) == brute_keepers(texts)


def test_pipeline_drops_edited_copies(spark):
    texts = edited_copies()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == brute_keepers(texts)


def test_a_pair_that_bands_lose_is_found_by_blocks(spark):
    words = [f"w256269x{i}" for i in range(40)]
    pair = [" ".join(words), " ".join(words[:36] + [f"v256269x{i}" for i in range(4)])]  # 32 of 40 shingles
    df = spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string")
    found = jaccard.sketched(df, 5, "doc_id", "text").collect()
    assert not set(found[0]["keys"]) & set(found[1]["keys"]) and ((found[0].fp ^ found[1].fp) % (1 << 64)).bit_count() <= 4
    assert [r.doc_id for r in jaccard.one_of_each(df).collect()] == brute_keepers(pair) == [0]
