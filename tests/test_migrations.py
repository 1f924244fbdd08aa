"""Revisions in order, applied, undone, taken up again, and chains that are broken; dense numbers over skewed groups."""

import random

import pytest

from quillon import migrations, schemas
from quillon.migrations import BrokenChain, Migrations, Revision
from quillon.operators import dedup

NOTHING = lambda store: None


def revision(name, *after, up=NOTHING, down=NOTHING):
    return Revision(name, after, up, down)


def test_order_and_broken_chains():
    names = lambda rs: [r.name for r in migrations.ordered(rs)]
    assert names([revision("d", "b", "c"), revision("c", "a"), revision("b", "a"), revision("a")]) == ["a", "b", "c", "d"]
    for broken, what in (
        ([revision("a", "x")], "unknown"), ([revision("a", "b"), revision("b", "a")], "circle"), ([revision("a"), revision("a")], "twice"), ([revision("a"), revision("b", "a"), revision("c", "a")], "several ends"),
    ):
        with pytest.raises(BrokenChain, match=what):
            migrations.ordered(broken)


def test_up_and_down_with_rows(spark, tmp_path):
    tries = []

    def failing(store):
        tries.append(1)
        store.add_column("t", "n", "int", "length(v)")
        if len(tries) == 1:
            raise RuntimeError("broke off")

    chain = [
        revision("one", up=lambda s: s.create("t", "k string, v string", ["k"], 2), down=lambda s: s.drop("t")), revision("two", "one", up=failing, down=lambda s: s.drop_column("t", "n")),
        revision("three", "two", up=lambda s: s.rename_column("t", "k", "key"), down=lambda s: s.rename_column("t", "key", "k")),
    ]
    moves = Migrations(spark, str(tmp_path), chain)
    assert moves.applied() == [] and moves.upgrade("one") == ["one"]
    moves.store.table("t").load(spark.createDataFrame([("a", "xx"), ("b", None)], "k string, v string"))
    with pytest.raises(RuntimeError):
        moves.upgrade()
    assert Migrations(spark, str(tmp_path), chain).applied() == ["one"]
    assert Migrations(spark, str(tmp_path), chain).upgrade() == ["two", "three"]  # what was done of it is not done twice
    moves = Migrations(spark, str(tmp_path), chain)
    table = moves.store.table("t")
    assert table.keys == ["key"] and sorted(map(tuple, table.read().collect())) == [("a", "xx", 2), ("b", None, None)]
    table.load(spark.createDataFrame([("a", "yyy", 3)], "key string, v string, n int"))
    assert moves.downgrade("one") == ["three", "two"] and moves.applied() == ["one"]
    assert sorted(map(tuple, moves.store.table("t").read().collect())) == [("a", "yyy"), ("b", None)]
    assert moves.downgrade() == ["one"] and not moves.store.has("t")
    with pytest.raises(BrokenChain, match="unknown"):
        moves.upgrade("nine")
    moves.upgrade("one")
    with pytest.raises(BrokenChain, match="applied, but unknown"):
        Migrations(spark, str(tmp_path), [revision("other")]).upgrade()


def test_the_tables_of_the_schema(spark, tmp_path):
    moves = Migrations(spark, str(tmp_path))
    assert moves.upgrade("places") == ["places"]
    assert all(moves.store.has(n) for n in schemas.GEO) and moves.store.table("city").read().columns[:3] == ["id", "name", "ine_code"]
    assert [r.name for r in moves.revisions][0] == "places" and [r.name for r in moves.revisions][-1] == "all-elections"


@pytest.mark.parametrize("by", [None, ["g"]])
def test_dense_numbers(spark, by):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", None, "b"]), rng.randint(0, 10**6)) for _ in range(700)]
    got = dedup.numbered(spark.createDataFrame(rows, "g string, v int"), ["v"], by).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g if by else 0, []).append((r.number, r.v))
    for pairs in groups.values():
        assert [n for n, _ in sorted(pairs)] == list(range(len(pairs))) and [v for _, v in sorted(pairs)] == sorted(v for _, v in pairs)
    assert dedup.numbered(spark.createDataFrame([], "g string, v int"), ["v"], by).count() == 0
