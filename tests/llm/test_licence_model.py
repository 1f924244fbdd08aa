"""The licence classifier against a slow twin, and its recall on wrapped and altered notices that training never saw."""

import math
import random
import re
import textwrap

import pytest

from quillon.llm import licenses

SHELLS = [lambda x: "\n".join(x), lambda x: "/*\n" + "\n".join(f" * {y}" for y in x) + "\n */", lambda x: "\n".join(f"# {y}" for y in x), lambda x: "\r\n".join(f"// {y}" for y in x)]


def told(words, model):
    """(family, score, template_fit) of a paragraph by the definition."""
    grams = licenses.grams_of(words)
    weights = {}
    for g, c, w in model.weights:
        weights.setdefault(g, {})[c] = w
    z = {c: b + round(sum(weights.get(g, {}).get(c, 0.0) for g in grams) / math.sqrt(len(grams)), 9) for c, b in model.bias}
    top = max(z, key=lambda c: (z[c], c))
    score = 1 / sum(math.exp(x - z[top]) for x in z.values())
    pairs = set(zip(words, words[1:], strict=False))
    fits = [0.0]
    for t in licenses.TEMPLATES.get(top, []):
        wanted = set(zip(licenses.tokens_of(t), licenses.tokens_of(t)[1:], strict=False))
        fits.append(len(pairs & wanted) / len(wanted))
    if top == licenses.NONE:
        return None
    return (top if score >= model.threshold and max(fits) >= model.settings.confirm else licenses.UNKNOWN), round(score, 6), round(max(fits), 6)


def altered(text, rng):
    words = text.split()
    return " ".join(w if rng.random() > 0.06 or len(words) < 8 else rng.choice(["", "xx", w + "s"]) for w in words)


def notices(seed):
    rng = random.Random(seed)
    for family, texts in licenses.HELD_OUT.items():
        for t in texts:
            for width in (40, 62, 76):
                yield family, rng.choice(SHELLS)(textwrap.wrap(altered(t, rng), width))


def test_classes_equal_the_definition(spark):
    model = licenses.trained()
    rng = random.Random(3)
    texts = [body for _, body in notices(1)] + licenses.OTHERS + ["", "license", "The License\n\n\nunder the MIT license\nno more", None, *[" ".join(rng.choice(sorted(licenses.FREQUENT) + model.telling()) for _ in range(12)) for _ in range(40)]]
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    got = {(r.id, r.par, r["last"]): (r.family, r.score, r.template_fit) for r in licenses.classified(docs, model).collect()}
    want = {}
    for i, t in enumerate(texts):
        lines = re.split(r"\r?\n", t or "")
        for par, line in enumerate(lines):
            if not set(licenses.tokens_of(line)) & set(model.telling()):
                continue
            clean = [re.sub(licenses.MARKS, "", x) for x in lines[par : par + licenses.JOINED[-1]]]
            stop = next((k for k, x in enumerate(clean) if not x or len(x) > licenses.WRAPPED), len(clean))
            for n in {min(n, max(stop, 1)) for n in licenses.JOINED}:
                words = licenses.tokens_of(" ".join(clean[:n]))
                if words and (found := told(words, model)):
                    want[i, par, par + n - 1] = found
    assert set(got) == set(want) and len(want) > 100
    for k, (family, score, fit) in want.items():
        assert got[k][0] == family and abs(got[k][1] - score) < 2e-6 and abs(got[k][2] - fit) < 2e-6


def test_paragraphs_without_a_telling_word_are_none():
    model = licenses.trained()
    telling, words = set(model.telling()), sorted({w for g, _, _ in model.weights for w in g.split()})
    rest = [w for w in words if w not in telling]
    rng = random.Random(5)
    assert all(told([rng.choice(rest) for _ in range(rng.randint(1, 30))], model) is None for _ in range(400))


def test_no_held_out_notice_is_a_training_one():
    seen = {" ".join(licenses.tokens_of(t)) for texts in licenses.TEMPLATES.values() for t in texts}
    assert not seen & {" ".join(licenses.tokens_of(t)) for texts in licenses.HELD_OUT.values() for t in texts}


def test_recall_of_held_out_notices(spark):
    rows = [(f, f"Some story about a river.\n\n{body}\n\nThe boats went home.\n") for seed in range(4) for f, body in notices(seed)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scanned(docs).collect()}
    hits = sum(got[i] == f for i, (f, _) in enumerate(rows))
    wrong = [(f, got[i]) for i, (f, _) in enumerate(rows) if got[i] not in (f, licenses.UNKNOWN, None)]
    assert hits >= 0.9 * len(rows) and len(wrong) <= 0.02 * len(rows), (hits, len(rows), wrong)


@pytest.mark.parametrize("text", [*licenses.OTHERS, "The license of the boat was public.\nThe library has a copy of the terms."])
def test_prose_names_no_family(spark, text):
    (row,) = licenses.scanned(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.license in (None, "unknown")


def test_ties_repeats_and_nulls(spark):
    both = "Released under the MIT License.\n\nReleased under the MIT License."
    rows = [(1, both), (1, both), (None, both), (2, None), (3, ""), (4, "\n \n")]
    got = licenses.scanned(spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, license string, family string")).collect()
    assert sorted((r.doc_id or 0, r.license, r.n_license_paragraphs) for r in got if r.license) == [(0, "MIT", 2), (1, "MIT", 2), (1, "MIT", 2)]
    assert len(got) == 6 and all(r.n_license_paragraphs == 0 for r in got if not r.license)
