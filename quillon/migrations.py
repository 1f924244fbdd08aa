"""Migrations of stored tables: a graph of revisions, applied and undone in order, with a version row for each.

A revision names those it builds on. Upgrading applies what is missing up to the wanted revision, parents first;
downgrading undoes what builds on it, the last first. Each step changes tables by one swap of their manifests and then its
version row, so a run that broke off goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import schemas
from quillon.sources.tables import Table, _fs, versions


class BrokenChain(ValueError):
    """Revisions that can't be put in order."""


class Store:
    """The tables below a folder, as migrations change them. A step that was done already is left as it is."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/{name}")

    def has(self, name: str) -> bool:
        return bool(versions(self.spark, f"{self.root}/{name}"))

    def create(self, name: str, schema: str, keys: list[str], buckets: int = 16) -> None:
        if not self.has(name):
            Table(self.spark, f"{self.root}/{name}", keys, buckets).load(self.spark.createDataFrame([], schema))

    def drop(self, name: str) -> None:
        p, fs = _fs(self.spark, f"{self.root}/{name}")
        fs.delete(p, True)

    def change(self, name: str, change: Callable[[DataFrame], DataFrame], note: str) -> None:
        self.table(name).rewritten(change, note)

    def add_column(self, name: str, column: str, kind: str, value: str = "NULL") -> None:
        """A column with the value of an SQL expression over the row."""
        if column not in self.table(name).schema.names:
            self.change(name, lambda d: d.withColumn(column, F.expr(value).cast(kind)), f"add {column}")

    def drop_column(self, name: str, column: str) -> None:
        if column in self.table(name).schema.names:
            self.change(name, lambda d: d.drop(column), f"drop {column}")

    def rename_column(self, name: str, old: str, new: str) -> None:
        """Another name for a column, be it a key or not."""
        table = self.table(name)
        if old in table.schema.names:
            table.rewritten(lambda d: d.withColumnRenamed(old, new), f"rename {old}", [new if k == old else k for k in table.keys])


@dataclass(frozen=True)
class Revision:
    """after: the revisions that it builds on; up and down change a store."""

    name: str
    after: tuple[str, ...]
    up: Callable[[Store], None]
    down: Callable[[Store], None]


def ordered(revisions: list[Revision]) -> list[Revision]:
    """Revisions with parents before children, else by name. Names used twice, unknown parents, circles and more than one end are errors."""
    by = {r.name: r for r in revisions}
    if len(by) < len(revisions):
        raise BrokenChain("a revision's name is used twice")
    lost = sorted({a for r in revisions for a in r.after} - set(by))
    if lost:
        raise BrokenChain(f"unknown revisions: {lost}")
    sorter = TopologicalSorter({r.name: r.after for r in revisions})
    try:
        sorter.prepare()
    except CycleError as e:
        raise BrokenChain(f"revisions in a circle: {e.args[1]}") from e
    ends = sorted(set(by) - {a for r in revisions for a in r.after})
    if len(ends) > 1:
        raise BrokenChain(f"several ends: {ends}")
    out: list[Revision] = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        out += [by[n] for n in ready]
        sorter.done(*ready)
    return out


class Migrations:
    def __init__(self, spark: SparkSession, root: str, revisions: list[Revision] | None = None):
        self.store, self.revisions = Store(spark, root), ordered(REVISIONS if revisions is None else revisions)
        self.versions = Table(spark, f"{self.store.root}/.versions", ["name"], 1)

    def applied(self) -> list[str]:
        """What is applied, in order."""
        there = {r["name"] for r in self.versions.read().filter("applied").collect()} if self.versions.version else set()
        unknown = sorted(there - {r.name for r in self.revisions})
        if unknown:
            raise BrokenChain(f"applied, but unknown: {unknown}")
        return [r.name for r in self.revisions if r.name in there]

    def _note(self, name: str, applied: bool) -> None:
        self.versions.load(self.store.spark.createDataFrame([(name, applied)], "name string, applied boolean"))

    def _needed(self, target: str) -> set[str]:
        by, needed, open_ = {r.name: r for r in self.revisions}, set(), [target]
        if target not in by:
            raise BrokenChain(f"unknown revision: {target}")
        while open_:
            n = open_.pop()
            if n not in needed:
                needed.add(n)
                open_ += by[n].after
        return needed

    def upgrade(self, target: str | None = None) -> list[str]:
        """Apply what is missing up to `target` (the end, without one); what was applied."""
        needed = self._needed(target) if target else {r.name for r in self.revisions}
        there, done = set(self.applied()), []
        for r in self.revisions:
            if r.name in needed and r.name not in there:
                r.up(self.store)
                self._note(r.name, True)
                done.append(r.name)
        return done

    def downgrade(self, target: str | None = None) -> list[str]:
        """Undo what `target` doesn't need (all, without one), the last first; what was undone."""
        needed = self._needed(target) if target else set()
        there, done = self.applied(), []
        for r in reversed(self.revisions):
            if r.name in there and r.name not in needed:
                r.down(self.store)
                self._note(r.name, False)
                done.append(r.name)
        return done


def _of(name: str, after: tuple[str, ...], tables: dict[str, schemas.Table]) -> Revision:
    """A revision that creates tables, keyed by their id."""

    def up(store: Store) -> None:
        for t in tables.values():
            store.create(t.name, t.frame_ddl(), ["id"])

    def down(store: Store) -> None:
        for t in reversed(list(tables.values())):
            store.drop(t.name)

    return Revision(name, after, up, down)


#: The tables of schemas.py: places first, then each family of elections, then the end where they meet.
REVISIONS = [
    _of("places", (), schemas.GEO), *[_of(f"elections-{f.name}", ("places",), schemas.star(f)) for f in schemas.FAMILIES],
    Revision("all-elections", tuple(f"elections-{f.name}" for f in schemas.FAMILIES), lambda store: None, lambda store: None),
]
