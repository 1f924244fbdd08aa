"""Long texts go through in pieces and give what they give whole."""

import random

import pyarrow as pa
import pytest
from test_text_stages import TEXTS, fingerprint, made_texts

from quillon.llm import simhash
from quillon.llm.common import BATCH_BYTES, byte_batches, text_buffers


@pytest.mark.parametrize("piece", [1, 3, 50])
def test_fingerprints_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    texts = [*TEXTS, *made_texts(60, 6)]
    got = [x for _, _, d, o in text_buffers(pa.array(texts), 1 << 20) for x in simhash.fingerprints_of(d, o, 4).tolist()]
    assert got == [fingerprint(t) for t in texts]


def test_a_text_of_50_mb(spark):
    rng = random.Random(1)
    part = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(9000))
    docs = spark.createDataFrame([(1, part), (2, part)], "doc_id long, text string").selectExpr("doc_id", "repeat(concat(text, ' '), cast(50000000 / length(text) as int)) text")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == 2 and got[0].fingerprint == got[1].fingerprint and {r.component_id for r in got} == {1}


def test_batches_by_bytes(spark):
    byte_batches(spark)
    docs = spark.range(4000, numPartitions=1).selectExpr("repeat('x', 10000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 2 * BATCH_BYTES
