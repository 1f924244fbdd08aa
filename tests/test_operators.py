import random

import pytest
from pyspark.sql import functions as F

from quillon.functions.similarity import indel_ratio
from quillon.functions.text import fold
from quillon.operators import dedup, documents, lookup, match, merge, pages, rollup, stateful, validate


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_resolve_is_the_three_tier_rule(spark):
    rng = random.Random(4)
    known = ["Vila Nova", "Évora", "Mora", "Moura", "Porto Moniz", "Santa Cruz das Flores", "Miranda do Corvo", "Lagoa", "lagoa"]
    known += ["".join(rng.choice("abcde ") for _ in range(rng.randint(3, 24))).strip() or "q" for _ in range(40)]
    names = [*known[:6], "evora", "MOURA", "Porto Monis", "Santa Cruz da Flores", "Vila Praia", "x", "", "LAGOA"]
    for k in known:
        i = rng.randrange(len(k))
        names += [k[:i] + k[i + 1 :], k[:i] + "z" + k[i:]]
    cand = spark.createDataFrame(list(enumerate(known)), "p int, c string")
    asked = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "n string")
    got = {r.n: r.matched for r in match.resolve(asked, "n", cand, "c", "p").collect()}
    folded = {r.c: r.f for r in spark.createDataFrame([(x,) for x in {*names, *known}], "c string").select("c", fold(F.col("c")).alias("f")).collect()}
    for n in dict.fromkeys(names):
        want = n if n in known else next((c for c in known if folded[c] == folded[n]), None)
        if want is None:
            best = max(known, key=lambda c: (indel_ratio(n, c), -known.index(c)))
            want = best if indel_ratio(n, best) >= 0.9 else None
        assert got[n] == want, n


def test_region_hints(spark):
    codes = spark.createDataFrame([("Lagoa", ["0806", "4201"]), ("Two", ["4201", "4301"])], "b string, c array<string>")
    names = spark.createDataFrame([("Lagoa (Algarve)",), ("Lagoa ( Açores )",), ("Two (Açores)",), ("Lagoa",), (None,)], "n string")
    got = {r.n: r.code for r in match.region_hint(names, "n", codes, "b", "c").collect()}
    assert got == {"Lagoa (Algarve)": "0806", "Lagoa ( Açores )": "4201", "Two (Açores)": None, "Lagoa": None, None: None}


def test_greedy_pairs_use_each_side_once(spark):
    left = spark.createDataFrame([(1, "Porto", 0), (1, "Portos", 1), (1, "Braga", 2), (2, "Faro", 0)], "d int, n string, p int")
    right = spark.createDataFrame([(1, "Porto", 0), (1, "Portoz", 1), (1, "Bragas", 2)], "d int, n string, p int")
    assert rows_of(match.greedy_pairs(left, right, "d", "n", "p", 0.8)) == [(1, "Braga", "Bragas"), (1, "Porto", "Porto"), (1, "Portos", "Portoz")]


def test_lookup(spark):
    rows = spark.createDataFrame([(0, "0101", "A"), (1, "0102", "B"), (2, "0103", "A"), (3, " 0104", "C"), (4, "0105", None), (5, "0102", "B"), (6, "9999", "D ")], "p int, code string, name string")
    clean = lookup.clean_codes(rows, "code", "name", r"^\d{4}$", ["9999"])
    assert rows_of(lookup.unique_codes(clean, "code", "name")) == []
    assert rows_of(lookup.codes_by_name(clean, "code", "name", "p")) == [("A", ["0101", "0103"]), ("B", ["0102", "0102"])]
    refs = spark.createDataFrame([("3", "Madeira"), ("31", "Funchal"), ("13", "Porto")], "p string, d string")
    codes = spark.createDataFrame([("3101",), ("3201",), ("1301",), ("9",), (None,)], "c string")
    assert {r.c: r.d for r in lookup.longest_prefix(codes, "c", refs, "p", "d").collect()} == {"3101": "Funchal", "3201": "Madeira", "1301": "Porto", "9": None, None: None}


def test_dhondt_and_rollups(spark):
    votes = spark.createDataFrame([(1, "A", 340000), (1, "B", 280000), (1, "C", 160000), (1, "D", 60000), (1, "E", 0), (2, "A", 10), (2, "B", 10)], "c int, p string, v long")
    got = rows_of(rollup.dhondt(votes, "c", "p", "v", 7))
    assert got == [(1, "A", 3), (1, "B", 3), (1, "C", 1), (2, "A", 4), (2, "B", 3)]
    totals = rollup.national_totals(spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "c", 4)], "d string, c string, v long"), ["d", "c"], ["v"])
    assert {(r.d, r.c): (r.level, r.v) for r in totals.collect()}[(None, None)] == (0, 7)


def test_loads_are_idempotent(spark, tmp_path):
    from quillon.sources import sinks

    path = str(tmp_path / "t")
    new = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "k int, v string, p int")
    assert sinks.load(new, path, ["k"], "p") == 2
    assert sinks.load(new, path, ["k"], "p") == 0
    assert rows_of(spark.read.parquet(path), "k", "v") == [(1, "c"), (2, "b")]
    more = spark.createDataFrame([(2, "z", 0), (3, "y", 1)], "k int, v string, p int")
    assert sinks.load(more, path, ["k"], "p", update=False) == 1
    assert rows_of(spark.read.parquet(path), "k", "v") == [(1, "c"), (2, "b"), (3, "y")]


def test_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    assert [(r.k, r.v, r.changed) for r in merge.update_changed(old, new, "k", "v").orderBy("k").collect()] == [(1, "a", False), (2, "b", True), (3, None, True)]
    assert [(r.k, r.v) for r in merge.fill_known(old, new, "k", "v").orderBy("k").collect()] == [(1, "a"), (2, "b"), (3, "c")]
    cache = spark.createDataFrame([(1, "x"), (2, None)], "k int, r string")
    assert [r.cache_state for r in merge.by_cache(old, cache, "k", "r").orderBy("k").collect()] == ["complete", "partial", "missing"]


def test_dedup(spark):
    rows = spark.createDataFrame([("u", 1), ("v", 0), ("u", 0)], "u string, p int")
    assert rows_of(dedup.first_seen(rows, ["u"], "p")) == [("u", 0), ("v", 0)]
    assert rows_of(dedup.batches(rows, "p", 1, ["u"]), "u", "p", "batch") == [("u", 0, 0), ("u", 1, 1), ("v", 0, 0)]
    known = spark.createDataFrame([("u", 9), ("w", 9)], "u string, p int")
    assert ("w", 9) in rows_of(dedup.with_known(rows, known, ["u"])) and ("u", 9) not in rows_of(dedup.with_known(rows, known, ["u"]))


REGULATIONS = """<h2> Faro </h2><p><a href="early">no section</a></p><p><strong>Regulamento Municipal da Urbanização e da Edificação</strong></p>
<p><a href=" u1 ">Regulamento 1/2017</a> <a href="u2">Aviso 3/2018</a></p><p><strong>Regulamento de Taxas e Cauções por Operações Urbanísticas</strong></p><p><a href="t1">Taxas</a></p>
<p><strong>Other</strong></p><p><a href="none">x</a></p><h2>Lagos</h2><p><a href="lost">y</a></p>"""


def test_regulation_sections(spark):
    page = spark.createDataFrame([(1, REGULATIONS)], "id int, html string")
    got = pages.regulations(page, "id").orderBy("pos", "dre_url").select("municipality", "section", "name", "dre_url").collect()
    assert [tuple(r) for r in got] == [("Faro", "urbanization", "Regulamento 1/2017", "u1"), ("Faro", "urbanization", "Aviso 3/2018", "u2"), ("Faro", "fees", "Taxas", "t1")]


def test_link_classes(spark):
    data = [
        (0, "/docs/Plano_Diretor_Municipal.pdf", "Regulamento"), (1, "/download/1/2/3", "PDM regulamento"), (2, "/urbanismo", "Ver"), (3, "/noticias/pdm", "PDM"), (4, "/x.zip", "pdm"), (5, "/contactos", None),
    ]
    got = pages.classified(spark.createDataFrame(data, "i int, href string, text string")).orderBy("i").collect()
    assert [r.is_regulation for r in got] == [True, True, False, False, False, False]
    assert [r.is_priority for r in got] == [True, True, False, True, True, False]
    assert [r.is_followed for r in got] == [False, False, True, False, False, False]
    f = spark.createDataFrame([("http://a/x.php",), ("http://a/x.7z",), ("http://a/dir",), ("http://a/plano_diretor.PDF",)], "u string")
    assert [tuple(r) for r in f.select(pages.is_file(F.col("u")), pages.is_file_loosely(F.col("u")), pages.is_plan_file(F.col("u")), pages.is_plan_pdf(F.col("u"), F.lit("P D M"))).collect()] == [
        (False, False, False, False), (True, True, False, False), (False, False, False, False), (True, True, True, True),
    ]


def test_fields_take_the_first_link(spark):
    links = spark.createDataFrame([(1, 0, "/x/AssembleiaRepublica/?a=1"), (1, 1, "/AssembleiaRepublica"), (1, 2, "Regionais/"), (1, 3, "/xRegionais")], "id int, pos int, href string")
    assert rows_of(pages.fields(links, "id", "href", "pos")) == [(1, "parliament_url", "/x/AssembleiaRepublica/?a=1"), (1, "regional_assembly_url", "Regionais/")]


def test_reach_stops_at_its_depth(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    edges = spark.createDataFrame([(i, (i + 1) % 12) for i in range(12)] + [(0, 5), (5, 0)], "src int, dst int")
    got = dict(rows_of(pages.reach(edges, spark.createDataFrame([(0,)], "node int"), 5)))
    assert got == {0: 0, 1: 1, 5: 1, 2: 2, 6: 2, 3: 3, 7: 3, 4: 4, 8: 4, 9: 5}


def test_documents(spark):
    d = spark.createDataFrame([("a", 0, 10, "pdm"), ("b", 1, 10, "x"), ("b", 2, 20, "zonamento"), ("b", 3, 30, "solo urbano zonamento")], "s string, p int, n int, t string")
    assert rows_of(documents.best_documents(d, "s", "n", "t", "p"), "s", "p", "score") == [("b", 3, 2)]
    assert rows_of(documents.above_percentile(d, "s", "n"), "p") == [(3,)]
    names = ["resultados_eleicoes_AUT25_CM.xlsx", "resultados_eleicoes_CM_2021.xlsx", "PR_2026_Globais.xlsx", "PE2024x.xlsx", "PE_2024.xlsx", "AC1975.xls", "resultados alraa2020.xlsx"]
    got = documents.matched_files(spark.createDataFrame([(n,) for n in names], "f string"), "f").collect()
    assert [(r.type, r.year, r.sub_type) for r in got] == [
        ("town_hall", 2025, "council"), ("town_hall", 2021, "council"), ("presidential", 2026, None), ("european", 2024, None), ("parliament", 1975, None), ("regional", 2020, "azores"),
    ]


def test_limits_follow_a_plain_loop(spark):
    rng = random.Random(2)
    calls = [(k, float(rng.randint(0, 300)), i) for i, k in enumerate(rng.choices([1, 2, 3], k=120))]
    df = spark.createDataFrame(calls, "k int, t double, i int")
    quota, starts = {}, {}
    for k in (1, 2, 3):
        kept, begun, now = [], [], -1e9
        for _, t, i in sorted((c for c in calls if c[0] == k), key=lambda c: (c[1], c[2])):
            quota[i] = sum(x > t - 60 for x in kept) < 4
            kept += [t] * quota[i]
            now = max(now, t, begun[-4] + 60 if len(begun) >= 4 else t)
            begun.append(now)
            starts[i] = now
    assert {r.i: r.accepted for r in stateful.quota(df, "k", "t", "i", 4, 60.0).collect()} == quota
    assert {r.i: r.starts_at for r in stateful.rate_limit(df, "k", "t", "i", 4, 60.0).collect()} == pytest.approx(starts)


def test_validation(spark):
    e = spark.createDataFrame([("town_hall", None, None), ("european", "council", "first"), ("regional", "azores", None), ("presidential", None, None)], "type string, sub_type string, round string")
    assert rows_of(validate.bad_sub_types(e).select("type")) == [("european",), ("town_hall",)]
    assert {r.type: (r.round, r.violates) for r in validate.rounds(e).collect()} == {"town_hall": (None, False), "european": (None, False), "regional": (None, False), "presidential": (None, True)}
    with pytest.raises(ValueError):
        validate.require_columns(e, ["type", "name"])
    with pytest.raises(ValueError):
        validate.require_count(e, 308)
    assert validate.normalized_columns(e.withColumnRenamed("type", " Cod.  INE ")).columns[0] == "cod. ine"
    assert rows_of(validate.repeated(e.unionByName(e), ["type"]).select("n")) == [(2,)] * 4


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k int, n string, p int")
    assert match.resolve(none, "n", none, "n", "p").count() == 0
    assert lookup.codes_by_name(none.withColumnRenamed("n", "name").withColumn("code", F.lit("1")), "code", "name", "p").count() == 0
    assert dedup.first_seen(none, ["k"], "p").count() == 0
    assert pages.anchors(none.withColumn("html", F.lit(""))).count() == 0


def test_null_names_and_prefixes_match_nothing(spark):
    left = spark.createDataFrame([(1, "Lisboa", 0), (1, None, 1), (1, "Évora", 2), (2, "Faro", 3)], "b int, `a name` string, p int")
    right = spark.createDataFrame([(1, "Evora", 0), (1, None, 1), (1, "Lisboas", 2), (2, None, 3)], "b int, `a name` string, p int")
    assert sorted(tuple(r) for r in match.greedy_pairs(left, right, "b", "a name", "p").collect()) == [(1, "Lisboa", "Lisboas"), (1, "Évora", "Evora")]
    rows = spark.createDataFrame([("1234",), (None,), ("99",), ("1234",)], "code string")
    refs = spark.createDataFrame([("12", "a"), (None, "n"), ("123", "c"), ("123", "b")], "p string, v string")
    assert sorted(str(r.v) for r in lookup.longest_prefix(rows, "code", refs, "p", "v").collect()) == ["None", "None", "b", "b"]


def test_greedy_pairs_equal_a_walk(spark):
    rng = random.Random(4)
    names = ["".join(rng.choice("abc") for _ in range(rng.randint(9, 12))) for _ in range(25)]
    spoiled = [n[:i] + rng.choice("abc") + n[i:] if rng.random() < 0.6 else n for n in names for i in [rng.randint(0, len(n))]] + names[:4]
    left = [(0, n, i) for i, n in enumerate(names)]
    right = [(0, n, i) for i, n in enumerate(rng.sample(spoiled, len(spoiled)))]
    free, want = dict.fromkeys(n for _, n, _ in right), []
    for _, n, _ in left:
        best = n if n in free else max(free, key=lambda c: indel_ratio(n, c), default=None)
        if best is not None and indel_ratio(n, best) >= 0.9:
            del free[best]
            want.append((0, n, best))
    schema = "b int, name string, p int"
    got = match.greedy_pairs(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "b", "name", "p")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)



def walk(root, links, valid, depth, budget, width):
    """One site's crawl, page by page."""
    ahead, later, seen, tried = [], [(root, 0)], [], []
    while (ahead or later) and len(seen) < budget:
        batch = []
        while (ahead or later) and len(batch) < width and len(seen) < budget:
            node, d = ahead.pop(0) if ahead else later.pop(0)
            if node not in seen:
                seen.append(node)
                batch.append((node, d))
        for node, d in batch:
            for _, dst, document, followed, priority in sorted(x[1:] for x in links if x[0] == node):
                if document:
                    if dst not in tried:
                        tried.append(dst)
                        if dst in valid:
                            return len(seen), len(tried), node, dst
                elif d < depth and dst not in seen and followed:
                    (ahead if priority else later).append((dst, d + 1))
    return len(seen), len(tried), None, None


@pytest.mark.parametrize(("width", "seed"), [(1, 1), (2, 2)])
def test_crawl_equals_a_walk(spark, width, seed):
    rng = random.Random(seed)
    links = []
    for site in "abc":
        for n in range(9):
            for pos in range(5):
                document = rng.random() < 0.2
                dst = f"{site}-doc{rng.randint(0, 6)}" if document else f"{site}{rng.randint(0, 8)}"
                links.append((f"{site}{n}", pos, dst, document, rng.random() < 0.8, rng.random() < 0.4))
    valid = ["a-doc5", "b-doc1"]
    roots = [(s, f"{s}0") for s in "abc"]
    got = pages.crawl(
        spark.createDataFrame(roots, "site string, node string"), spark.createDataFrame(links, "src string, pos int, dst string, is_regulation boolean, is_followed boolean, is_priority boolean"),
        spark.createDataFrame([(v,) for v in valid], "dst string"), depth=3, budget=6, width=width,
    )
    assert {r.site: tuple(r)[1:] for r in got.collect()} == {s: walk(r, links, valid, 3, 6, width) for s, r in roots}
