from quillon import schemas
from quillon.plans import flows


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def row(name, president, mail, site):
    return f"<tr><td>{name}</td><td>{president}</td><td>Rua</td><td>21</td><td><a href='m'>{mail}</a><a href='{site}'>w</a></td></tr>"


def page(spark, *rows):
    return spark.createDataFrame([(1, "<table><tr><th>x</th></tr>" + "".join(rows) + "</table>")], "page_id int, html string")


def test_territory(spark):
    halls = flows.contact_rows(page(spark, row("Évora", "A", "e@x", "http://www.cm-evora.pt"), row("Lagoa (Açores)", "B", "", ""), row("Praia da Vitória", "C", "p@x", ""), row("Nowhere", "D", "", "")))
    assemblies = flows.contact_rows(page(spark, row("Evora", "A2", "", ""), row("Lagoa (Açores)", "B2", "", ""), row("Praia da Vitória", "C2", "", ""), row("Elsewhere Town", "E2", "", "")))
    sheet = spark.createDataFrame([(0, "0705", "Évora"), (1, "0806", "Lagoa"), (2, "4201", "Lagoa"), (3, "4302", "Vila da Praia da Vitória"), (4, "00", "Portugal")], "pos int, code string, name string")
    found = flows.cities(halls, assemblies, sheet)
    assert got(found, "municipality", "ine_code", "assembly_president") == [("Lagoa (Açores)", "4201", "B2"), ("Praia da Vitória", "4302", "C2"), ("Évora", "0705", "A2")]
    refs = spark.createDataFrame([("Évora", "07"), ("Açores", "4")], "name string, ine_prefix string")
    assert got(flows.with_districts(found, refs), "ine_code", "district_name") == [("0705", "Évora"), ("4201", "Açores"), ("4302", "Açores")]
    old = spark.createDataFrame([("Old", "0705", "o", None), ("Kept", "0101", None, None)], "name string, ine_code string, email string, website string")
    assert ("Évora", "0705", "e@x", "https://www.cm-evora.pt") in got(flows.city_table(old, found).fillna(""), "name", "ine_code", "email", "website")
    city = spark.createDataFrame([("Évora", "0705"), ("Lagoa", "4201"), ("Velas", "4500")], "name string, ine_code string")
    sheets = {"pre_2013": spark.createDataFrame([(0, "070501", "Sé"), (1, "190001", "Velas"), (2, "089901", "Lost"), (3, "500000", "Portugal"), (4, "070502", "Twice"), (5, "070503", "Twice")], "pos int, code string, name string")}
    links = flows.parishes(sheets, city, {"pre_2013": ["500000"]})
    assert got(links, "name", "city_ine_code", "era") == [("Sé", "0705", "pre_2013"), ("Velas", "4500", "pre_2013")]


def test_plan_discovery(spark):
    city = spark.createDataFrame([(1, "https://www.cm-a.pt/"), (2, "https://www.cm-b.pt"), (3, None)], "city_id int, website string")
    html = {
        "https://www.cm-a.pt/": '<a href="/urbanismo#x">Urbanismo</a><a href="/noticias/pdm">PDM</a><a href="https://other.pt/pdm">PDM</a>',
        "https://www.cm-a.pt/urbanismo": '<a href="pdm.html">PDM</a><a href="/pdm_regulamento_short.pdf">x</a>',
        "https://www.cm-a.pt/pdm.html": '<a href="/docs/Plano_Diretor_Municipal_regulamento.pdf">Ver</a>',
        "https://www.cm-b.pt": '<a href="/pdm/regulamento/download/1">PDM</a>',
    }
    fetched = spark.createDataFrame(list(html.items()), "url string, html string")
    body = "solo plano ordenamento território urbanístico"
    contents = spark.createDataFrame(
        [("https://www.cm-a.pt/docs/Plano_Diretor_Municipal_regulamento.pdf", body, 40), ("https://www.cm-a.pt/pdm_regulamento_short.pdf", body, 3), ("https://www.cm-b.pt/pdm/regulamento/download/1", body, 20)], "url string, content string, number_of_pages int"
    )
    none = spark.createDataFrame([], "city_id int")
    want = [(1, "https://www.cm-a.pt/pdm.html", "https://www.cm-a.pt/docs/Plano_Diretor_Municipal_regulamento.pdf"), (2, "https://www.cm-b.pt", "https://www.cm-b.pt/pdm/regulamento/download/1")]
    found = flows.plan_documents(city, none, fetched, contents)
    assert got(found, "city_id", "source_url", "pdf_url") == want
    assert got(flows.plan_documents(city, found.select("city_id"), fetched, contents), "city_id") == []


def test_election_files(spark):
    index = spark.createDataFrame([(1, '<a href="/eleicoes/AutarquiasLocais/">a</a><a href="/eleicoes/PresidenciaRepublica">b</a><a href="/x">c</a>')], "page_id int, html string")
    listing = spark.createDataFrame(
        [("https://mai.pt/eleicoes/AutarquiasLocais/", '<a href="f/resultados_eleicoes_AUT25_CM.xlsx">x</a><a href="notes.pdf">n</a>'), ("https://mai.pt/eleicoes/PresidenciaRepublica", '<a href="/f/PR_2026_Globais.xlsx">x</a>')],
        "url string, html string",
    )
    files = flows.election_files(index, listing, "https://mai.pt/")
    assert got(files.fillna(""), "type", "sub_type", "year", "url") == [
        ("presidential", "", 2026, "https://mai.pt/f/PR_2026_Globais.xlsx"), ("town_hall", "council", 2025, "https://mai.pt/eleicoes/AutarquiasLocais/f/resultados_eleicoes_AUT25_CM.xlsx"),
    ]
    told = flows.metadata(files, lambda p: p.selectExpr("filename", "concat('name of ', filename) AS name", "'first' AS round"))
    assert got(flows.structured(files, told).fillna(""), "type", "round", "violates") == [("presidential", "first", False), ("town_hall", "", False)]


def test_regulations(spark):
    html = """<h2>Evora</h2><p><strong>Regulamento Municipal da Urbanização e da Edificação</strong></p><p><a href="u1">Regulamento 1/2017</a><a href="u1">Aviso 2/2018</a><a href="u2">no year</a></p><h2>Unknown Place</h2>
    <p><strong>Regulamento de Taxas e Cauções por Operações Urbanísticas</strong></p><p><a href="t">Aviso 1/2020</a></p>"""
    city = spark.createDataFrame([(7, "Évora"), (8, "Faro")], "city_id int, name string")
    found = flows.regulation_rows(spark.createDataFrame([(1, html)], "page_id int, html string"), city)
    assert got(found.filter("year is not null"), "section", "city_id", "year", "dre_url") == [("urbanization", 7, 2017, "u1"), ("urbanization", 7, 2018, "u1")]
    old = spark.createDataFrame([], "city_id int, year int, name string, is_complete boolean, dre_url string, pdf_url string")
    stored = flows.stored_regulations(old, found)
    assert stored.count() == 1 and flows.stored_regulations(stored, found).count() == 1
    assert got(flows.pending_pdfs({"rmue": stored, "fee_regulation": old}), "table", "dre_url", "batch") == [("rmue", "u1", 0)]
    detail = spark.createDataFrame([("u1", '<a class="x" title="Documento em formato PDF" href=" f.pdf ">P</a>'), ("u2", "<a href='x'>y</a>")], "url string, html string")
    assert sorted(((r.url, r.pdf_url) for r in flows.pdf_link(detail).collect())) == [("u1", "f.pdf"), ("u2", None)]


def test_schemas(spark):
    assert len(schemas.GEO) == 9
    for t in schemas.TABLES.values():
        df = spark.createDataFrame([], t.frame_ddl())
        for key in t.unique:
            assert set(key) <= set(df.columns), t.name
        for column in [*(t.xor or ()), *(c for c, _ in t.enums)]:
            assert column in df.columns
