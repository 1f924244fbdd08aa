"""Texts in no known language are rejected, known ones stay."""

import base64
import random

import pyarrow as pa
import pytest

from quillon.llm import langid
from quillon.llm.common import text_buffers

# One sentence in languages that training never saw.
STRANGERS = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "pt": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade.",
    "sv": "Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete och bör handla gentemot varandra i en anda av broderskap.",
    "cs": "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "c": "static int parse_header(const char *buf, size_t len) { for (size_t i = 0; i < len; ++i) { if (buf[i] == ':') return (int)i; } return -1; } struct node *next = NULL;",
    "base64": base64.b64encode(random.Random(1).randbytes(120)).decode(),
    "letters": "zzqx qqk xvw jjk pqz vvx kkz qwx zxj bvq",
}


@pytest.fixture(scope="module")
def known(spark):
    """Documents of the test tables in their four languages, and a model of those that are not held out."""
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path).select("doc_id", "text", "lang")
    return docs, langid.fitted(docs.filter(~langid.held_out()))


def test_strangers_are_rejected(spark, known):
    _, model = known
    rows = [*STRANGERS.items(), *[(f"{k}-long", (v + " ") * 40) for k, v in STRANGERS.items()]]
    got = {r.k: r for r in langid.predicted(spark.createDataFrame(rows, "k string, text string"), model, "k", detail=True).collect()}
    kept = sorted(k for k, r in got.items() if not r.rejected)
    assert len(kept) <= 2, [(k, got[k].lang_pred, got[k].usualness) for k in kept]
    assert sum(got[k].rejected for k in ("pl", "fi", "it", "sv", "cs", "tr", "ja", "ru")) == 8


def test_known_texts_stay(known):
    docs, model = known
    got = langid.predicted(docs.filter(langid.held_out()).filter("lang IS NOT NULL AND text RLIKE '[a-z]'"), model, carry=("lang",)).collect()
    assert len(got) > 250 and sum(r.rejected for r in got) <= 0.01 * len(got)


def test_usualness_equals_its_definition(spark, known):
    docs, model = known
    rows = docs.orderBy("doc_id").limit(30).collect()
    got = {r.doc_id: r for r in langid.predicted(docs, model, detail=True).collect()}
    for r in rows:
        for _, _, data, offsets in text_buffers(pa.array([r.text])):
            ids, counts, _ = langid.gram_counts(data, offsets, model.settings)
        if len(ids):
            row = model.usual[model.langs.index(got[r.doc_id].lang_pred)]
            assert got[r.doc_id].usualness == pytest.approx(float((row[ids] * counts).sum() / counts.sum()), rel=1e-5)


def test_shuffled_words_keep_their_letters():
    text = "Ein  Wort\nund noch eines, überall"
    assert [sorted(w) for w in langid.shuffled(text, 3).split()] == [sorted(w) for w in text.split()]
    assert langid.shuffled(text, 3) == langid.shuffled(text, 3) != text


def test_few_documents_lose_few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    got = langid.predicted(docs, langid.fitted(docs.filter(~langid.held_out()))).collect()
    assert len(got) >= 200 and sum(r.rejected for r in got) <= 0.02 * len(got)
