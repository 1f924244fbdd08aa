"""Table schemas as DDL, with their keys: territory, documents, and the election star by rule."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    unique: tuple[tuple[str, ...], ...] = ()
    xor: tuple[str, str] | None = None
    enums: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def frame_ddl(self) -> str:
        """The schema for DataFrames, which know no VARCHAR; the ddl itself is for CREATE TABLE, where Spark checks lengths on write."""
        return re.sub(r"VARCHAR\(\d+\)", "STRING", self.ddl)


ERAS = ("pre_2013", "post_2013", "post_2021")
MEASURES = ("registered_voters", "voters", "blank_votes", "null_votes", "valid_votes")
_MEASURED = ", ".join(f"{m} INT" for m in MEASURES)
_DOCUMENT = "id INT, city_id INT, year INT, name VARCHAR(255), is_complete BOOLEAN, dre_url VARCHAR(2048), pdf_url VARCHAR(2048)"

GEO = {
    t.name: t
    for t in (
        Table("district", "id INT, name VARCHAR(255), wikipedia_url VARCHAR(2048)", (("name",),)),
        Table("city", "id INT, name VARCHAR(255), ine_code VARCHAR(10), email VARCHAR(255), website VARCHAR(2048), district_id INT", (("ine_code",),)),
        Table("parish", "id INT, name VARCHAR(255), wikipedia_url VARCHAR(2048), ine_code VARCHAR(10), era STRING, city_id INT", (("ine_code", "era"),), None, (("era", ERAS),)),
        Table("country", "id INT, name VARCHAR(255), electoral_circle_id INT", (("name",),)),
        Table("consulate", "id INT, name VARCHAR(255), code VARCHAR(10), country_id INT", (("code",),)),
        Table("electoral_circle", "id INT, name VARCHAR(255), district_id INT", (("name",), ("district_id",))),
        Table("pdm", "id INT, city_id INT, source_url VARCHAR(2048), pdf_url VARCHAR(2048)", (("city_id",),)),
        Table("rmue", _DOCUMENT, (("city_id", "dre_url"),)),
        Table("fee_regulation", _DOCUMENT, (("city_id", "dre_url"),)),
    )
}


@dataclass(frozen=True)
class Family:
    name: str
    choice: str
    leaf: tuple[str, ...]
    header: str = ""
    enums: tuple[tuple[str, tuple[str, ...]], ...] = ()
    districts: bool = False
    scope: tuple[str, str] | None = None


FAMILIES = (
    Family("european", "party", ("parish_id", "consulate_id"), districts=True),
    Family("parliament", "party", ("parish_id", "consulate_id"), districts=True),
    Family("presidential", "candidate", ("parish_id", "consulate_id"), ", round STRING", (("round", ("first", "second")),), districts=True),
    Family("regional", "party", ("parish_id",), ", sub_type STRING", (("sub_type", ("madeira", "azores")),)),
    Family("town_hall", "list", ("parish_id",), ", sub_type STRING", (("sub_type", ("council", "assembly", "parish_assembly")),), scope=("city_id", "parish_id")),
)


def star(f: Family) -> dict[str, Table]:
    """The tables of one election family: header, choices, leaf results and roll-ups, each with votes by choice."""
    e, c = f"{f.name}_election", f.choice
    leaf = ", ".join(f"{x} INT" for x in f.leaf)
    scope = ", city_id INT, parish_id INT" if f.scope else ""
    tables = [
        Table(e, f"id INT, name VARCHAR(255), date DATE, url VARCHAR(2048), filename VARCHAR(255){f.header}", (), None, f.enums),
        Table(f"{e}_{c}", f"id INT, election_id INT, name VARCHAR(255){scope}", (("election_id", "name", *(f.scope or ())),), f.scope),
        Table(f"{e}_result", f"id INT, election_id INT, {leaf}, {_MEASURED}", tuple(("election_id", x) for x in f.leaf), f.leaf if len(f.leaf) == 2 else None),
        Table(f"{e}_{c}_result", f"id INT, result_id INT, {c}_id INT, votes INT", (("result_id", f"{c}_id"),)),
    ]
    for level in ("city", "district")[: 1 + f.districts]:
        tables.append(Table(f"{e}_{level}_result", f"id INT, election_id INT, {level}_id INT, {_MEASURED}", (("election_id", f"{level}_id"),)))
        tables.append(Table(f"{e}_{level}_{c}_result", f"id INT, {level}_result_id INT, {c}_id INT, votes INT", ((f"{level}_result_id", f"{c}_id"),)))
    if f.name in ("parliament", "regional", "town_hall"):
        tables.append(Table(f"{e}_seat", f"id INT, {c}_id INT, seats INT{', electoral_circle_id INT' if f.name == 'parliament' else scope}", ((f"{c}_id", *(("electoral_circle_id",) if f.name == "parliament" else f.scope or ())),), f.scope))
    return {t.name: t for t in tables}


ELECTIONS = {k: v for f in FAMILIES for k, v in star(f).items()}
TABLES = GEO | ELECTIONS
