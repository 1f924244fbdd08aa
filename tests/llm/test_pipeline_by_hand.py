"""The pipeline's stages against plain Python on documents with planted near copies and repeated passages."""

import random
import re

from pyspark.sql import functions as F
from test_text_stages import removed_spans

import corpus_pipeline
from quillon.llm import mixing

WORDS = {
    "en": "the of and to in that is was for with river house stone garden window letter morning winter market bridge".split(),
    "es": "el la de que los una por con para sobre río casa piedra jardín ventana carta mañana invierno mercado puente".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + (str(rng.randint(0, 999)) if rng.random() < 0.3 else "") for _ in range(n))


def planted(seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "es"])
        rows.append([i, prose(rng, lang, rng.randint(60, 160)), lang, rng.choice(["a", "b", None])])
    for i in range(60, 70):  # copies with one word in some thirty replaced, and exact ones
        words = rows[i - 60][1].split()
        for _ in range(len(words) // 60 if i % 2 else 0):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 99999)}"
        rows.append([i, " ".join(words), rows[i - 60][2], "a"])
    passage = prose(rng, "en", 56)
    for i in range(70, 76):
        rows.append([i, f"{prose(rng, 'en', 70)} {passage} {prose(rng, 'en', 70)}", "en", "b"])
    rows += [[80, None, "en", "a"], [81, "", "es", "b"], [82, "1234 5678", "en", "a"], [83, passage, "en", None], [75, rows[-1][1], "en", "b"]]
    return [tuple([*r, len(r[1] or "")]) for r in rows]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def one_of_each(rows):
    """The first row of each group that pairs of a similarity of 0.8 or more join."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (both and both >= 0.8 * len(sets[i] | sets[j])) or (not sets[i] and not sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    best = {}
    for r, g in zip(rows, group, strict=True):
        if g not in best or r[0] < best[g][0]:
            best[g] = r
    return sorted(best.values())


def cut(rows):
    out = []
    for r, spans in zip(rows, removed_spans([r[1] for r in rows], corpus_pipeline.REPEAT_BYTES), strict=True):
        raw = (r[1] or "").encode()
        left = b"".join(raw[a:b] for a, b in zip([0, *[s[1] for s in spans]], [*[s[0] for s in spans], len(raw)], strict=True)).decode(errors="ignore")
        if not spans:
            out.append(r)
        elif left.strip(" "):
            out.append((r[0], left, *r[2:4], len(left)))
    return sorted(out)


def test_stages_equal_plain_versions(spark):
    rows = planted()
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    docs = spark.createDataFrame(rows, schema)
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language_id"](spark, docs, "")
    assert told.columns == docs.columns
    kept = [tuple(r) for r in told.collect()]
    clean = [r for r in rows if r[1] and re.search("[a-z]", r[1])]
    assert set(kept) <= set(rows) and len(set(clean) - set(kept)) <= 0.05 * len(clean) and not {80, 81, 82} & {r[0] for r in kept}
    single = [tuple(r) for r in stages["near_duplicates"](spark, docs, "").collect()]
    assert sorted(single, key=str) == sorted(one_of_each(rows), key=str)
    assert len(single) < len(rows) - 8
    short = [tuple(r) for r in stages["suffix_dedup"](spark, docs, "").collect()]
    assert sorted(short, key=str) == sorted([*cut(rows)], key=str)
    assert {r[0] for r in rows if 70 <= r[0] < 76} - {r[0] for r in short if r in rows} == set(range(70, 76))  # the planted passage is cut
    mixed = stages["mixing"](spark, docs, "")
    counts = {tuple(r)[:5]: r.n for r in mixed.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = {tuple(r)[:5]: r.n for r in mixing.planned(docs).filter("copies > 0").groupBy(*docs.columns).agg(F.sum("copies").alias("n")).collect()}
    assert counts == plan
    packed = stages["packing"](spark, docs, "").collect()
    assert len(packed) == len(rows)
    assert all(r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for r in packed for t in [next(x[1] for x in rows if x[0] == r.doc_id)])


def test_run_is_its_stages_in_turn(spark, tmp_path):
    rows = planted(4)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if i < 4:
            docs.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect())) != []
