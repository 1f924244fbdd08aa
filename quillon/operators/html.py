"""HTML as it is found: a tokenizer and an open-element stack over Arrow batches.

A page is read once, from left to right. The tokenizer knows tags with quoted, unquoted and bare
attributes, comments, declarations, and elements whose content is raw (script, style) or holds
entities but no tags (title, textarea). The stack closes what a tag closes by implication
(a link by the next link, a cell by the next cell, a paragraph by a block) and keeps tables apart, so a
nested table ends no outer row. Entities are those of the HTML standard, from Python's own table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
TEXT_ONLY = RAW | {"title", "textarea"}
_CELL, _ROW, _PART = frozenset(("td", "th")), frozenset(("tr",)), frozenset(("tbody", "thead", "tfoot"))
_TABLE = frozenset(("table",))
_SCOPE = _TABLE | _CELL | {"caption"}
_BLOCKS = "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
#: What a start tag closes if it is open, down to the nearest of the others.
_CLOSES: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    **dict.fromkeys(_BLOCKS, (frozenset(("p",)), _SCOPE | {"button", "object"})), **dict.fromkeys(_CELL, (_CELL, _TABLE | _ROW)), **dict.fromkeys(_PART, (_PART | _ROW | _CELL, _TABLE)),
    "tr": (_ROW | _CELL, _TABLE), "a": (frozenset(("a",)), _SCOPE | {"button", "object"}), "li": (frozenset(("li",)), _SCOPE | {"ul", "ol", "menu"}),
    "dt": (frozenset(("dt", "dd")), _SCOPE | {"dl"}), "dd": (frozenset(("dt", "dd")), _SCOPE | {"dl"}), "option": (frozenset(("option",)), _SCOPE | {"select", "datalist"}),
}
_MARKUP = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|(!--)|[!?/])")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"'][^\s>]*)?))?")
_TAG_END = re.compile(r"[\s/]*>")
_COMMENT_END = re.compile(r"--!?>")


class Element:
    """node: its number among all elements of the page; parents: the wanted elements around it, outermost first."""

    __slots__ = ("attrs", "first", "inner", "last", "node", "parents", "start", "tag")

    def __init__(self, node: int, tag: str, attrs: dict[str, str], parents: list[Element], start: int, first: int):
        self.node, self.tag, self.attrs, self.parents, self.start, self.first = node, tag, attrs, parents, start, first
        self.inner, self.last = (start, start), first


def _tag(html: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a start tag from behind its name on, and where the tag ends; -1 if it never does. Of one name the last counts."""
    attrs: dict[str, str] = {}
    if html.startswith(">", at):
        return attrs, at + 1
    while True:
        if end := _TAG_END.match(html, at):
            return attrs, end.end()
        found = _ATTRIBUTE.match(html, at)
        if not found:
            return attrs, -1
        value = next((v for v in found.groups()[1:] if v is not None), "")
        attrs[found[1].lower()] = unescape(value) if "&" in value else value
        at = found.end()


def parsed(html: str, wanted: frozenset[str]) -> tuple[list[Element], list[str]]:
    """The wanted elements in document order, and the page's strings, of which each element has a slice."""
    found: list[Element] = []
    strings: list[str] = []
    stack: list[tuple[str, Element | None]] = []
    around: list[Element] = []
    open_: dict[str, int] = {}
    node = at = 0

    def close(down_to: int, here: int) -> None:
        while len(stack) > down_to:
            name, element = stack.pop()
            open_[name] -= 1
            if element is not None:
                element.inner, element.last = (element.start, here), len(strings)
                around.pop()

    def depth(names: frozenset[str], borders: frozenset[str], outermost: bool) -> int:
        """Where the stack holds one of the names above the nearest border; -1 if it doesn't."""
        best = -1
        if not any(open_.get(n) for n in names):
            return best
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                best = i
                if not outermost:
                    break
            elif stack[i][0] in borders:
                break
        return best

    def text(a: int, b: int) -> None:
        if b > a:
            piece = html[a:b]
            strings.append(unescape(piece) if "&" in piece else piece)

    while True:
        mark = _MARKUP.search(html, at)
        if not mark:
            text(at, len(html))
            break
        text(at, mark.start())
        name = mark[2]
        if name is None:
            if mark[3]:
                end = mark.end() + 1 if html.startswith(">", mark.end()) else mark.end() + 2 if html.startswith("->", mark.end()) else -1
                if end < 0:
                    stop = _COMMENT_END.search(html, mark.end())
                    end = stop.end() if stop else len(html)
                at = end
            else:
                stop = html.find(">", mark.end())
                at = len(html) if stop < 0 else stop + 1
            continue
        name = name.lower()
        if mark[1]:
            _, end = _tag(html, mark.end())
            if end < 0:
                break
            if open_.get(name):
                borders = _TABLE if name in _CELL or name in _ROW or name in _PART else frozenset() if name == "table" else _SCOPE
                if (i := depth(frozenset((name,)), borders, False)) >= 0:
                    close(i, mark.start())
            at = end
            continue
        attrs, end = _tag(html, mark.end())
        if end < 0:  # the page ends inside a tag, which then is none
            break
        if name in _CLOSES and (i := depth(*_CLOSES[name], True)) >= 0:
            close(i, mark.start())
        element = None
        if name in wanted:
            element = Element(node, name, attrs, list(around), end, len(strings))
            found.append(element)
        node += 1
        at = end
        if name in TEXT_ONLY:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, end)
            at = stop.start() if stop else len(html)
            if name not in RAW:
                text(end, at)
        elif name in VOID:
            continue
        stack.append((name, element))
        open_[name] = open_.get(name, 0) + 1
        if element is not None:
            around.append(element)
    close(0, len(html))
    return found, strings


def _extracted(pages: DataFrame, html: str, rows: Callable[[str], list[tuple]], fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """The other columns of pages with each row that rows(html) gives; of equal names the new ones stay."""
    names = [n for n, _, _ in fields]
    kept = [c for c in pages.columns if c != html and c not in names]
    source = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{html}`").alias("html")).filter("html IS NOT NULL")

    put = [*source.columns[:-1], *[f"n{k}" for k in range(len(fields))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                which, out = [], []
                for i, page in enumerate(part.column(len(kept))):
                    got = rows(page.as_py())
                    which += [i] * len(got)
                    out += got
                columns = [pa.array([r[k] for r in out], kind) for k, (_, _, kind) in enumerate(fields)]
                index = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(i).take(index) for i in range(len(kept))], *columns], put)

    kinds = [f"c{i} {source.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(kept))] + [f"n{k} {sql}" for k, (_, sql, _) in enumerate(fields)]
    return source.mapInArrow(run, ", ".join(kinds)).toDF(*kept, *names)


_PARENT = pa.struct([("node", pa.int32()), ("tag", pa.string())])
_LINK = pa.struct([("href", pa.string()), ("text", pa.string())])


def elements(pages: DataFrame, tags: tuple[str, ...], html: str = "html") -> DataFrame:
    """A row for each element of these tags: node (its number among the page's elements), tag, parents (the elements of these tags around it, outermost first), attrs, text and inner (its HTML).

    text joins all strings inside but those of scripts and styles. Elements left open end with what holds
    them. Null pages have none.
    """
    wanted = frozenset(tags)

    def rows(page: str) -> list[tuple]:
        found, strings = parsed(page, wanted)
        return [(e.node, e.tag, [{"node": p.node, "tag": p.tag} for p in e.parents], list(e.attrs.items()), "".join(strings[e.first : e.last]), page[slice(*e.inner)]) for e in found]

    kinds = [
        ("node", "int", pa.int32()), ("tag", "string", pa.string()), ("parents", "array<struct<node: int, tag: string>>", pa.list_(_PARENT)),
        ("attrs", "map<string, string>", pa.map_(pa.string(), pa.string())), ("text", "string", pa.string()), ("inner", "string", pa.string()),
    ]
    return _extracted(pages, html, rows, kinds)


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each link: pos (among the page's a elements), href, text and title, as they stand."""

    def rows(page: str) -> list[tuple]:
        found, strings = parsed(page, frozenset(("a",)))
        return [(k, e.attrs["href"], "".join(strings[e.first : e.last]), e.attrs.get("title")) for k, e in enumerate(found) if "href" in e.attrs]

    return _extracted(pages, html, rows, [("pos", "int", pa.int32()), ("href", "string", pa.string()), ("text", "string", pa.string()), ("title", "string", pa.string())])


def cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row for each table row: table (its number on the page), pos (of the row in its table), cells (inner HTML of its own td), texts and links of each.

    Rows outside any table belong to table -1. A nested table's rows are rows of that table, not of the one around it.
    """

    def rows(page: str) -> list[tuple]:
        found, strings = parsed(page, frozenset(("table", "tr", "td", "a")))
        tables = {e.node: k for k, e in enumerate(e for e in found if e.tag == "table")}
        number: dict[int, int] = {}
        out: dict[int, tuple] = {}
        inside: dict[int, list[dict]] = {}
        for e in found:
            near = next((p for p in reversed(e.parents) if p.tag != "a"), None)
            if e.tag == "tr":
                table = tables[near.node] if near is not None and near.tag == "table" else -1
                out[e.node] = (table, number.setdefault(table, 0), [], [], [])
                number[table] += 1
            elif e.tag == "td" and near is not None and near.tag == "tr":
                _, _, inner, texts, links = out[near.node]
                inner.append(page[slice(*e.inner)])
                texts.append("".join(strings[e.first : e.last]))
                links.append(inside.setdefault(e.node, []))
            elif e.tag == "a":
                for p in e.parents:
                    if p.tag == "td" and p.node in inside:
                        inside[p.node].append({"href": e.attrs.get("href"), "text": "".join(strings[e.first : e.last])})
        return list(out.values())

    kinds = [
        ("table", "int", pa.int32()), ("pos", "int", pa.int32()), ("cells", "array<string>", pa.list_(pa.string())), ("texts", "array<string>", pa.list_(pa.string())),
        ("links", "array<array<struct<href: string, text: string>>>", pa.list_(pa.list_(_LINK))),
    ]
    return _extracted(pages, html, rows, kinds)
