import math

import duckdb
import pytest
from pyspark.sql import functions as F

from quillon.plans import catalog, catalog_io, catalog_rules  # noqa: F401  the latter two register their queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_oracle(spark, name):
    df = catalog.QUERIES[name](spark, DIR)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLES:
        assert rows
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    cur = con.execute(catalog.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = [cols.index(c) for c in df.columns]
    want = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    assert sorted(tuple(map(plain, r)) for r in rows) == sorted(want)


@pytest.mark.parametrize("name", ["awkward_links", "nested_rows"])
def test_pages_made_from_keys_are_read_by_several_tasks(spark, name):
    assert catalog.QUERIES[name](spark, DIR).select(F.spark_partition_id().alias("p")).distinct().count() > 1  # the table is one split
