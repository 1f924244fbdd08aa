"""The tokenizer against another parser, and the stack on awkward pages."""

import random
from html.parser import HTMLParser

import pytest

from quillon.operators import html as H
from quillon.operators import pages


class Events(HTMLParser):
    """Start tags as the standard library's parser sees them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags = []

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, {k: v or "" for k, v in attrs}))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)


def made(rng):
    value = lambda: "".join(rng.choice(["a", "/", "?", "&amp;", "=", "é", "-", "1", " &lt; "]) for _ in range(rng.randint(1, 5)))
    attribute = lambda: rng.choice([f'href="{value()}>"', f"href='{value()}\"'", f"href=x{rng.randint(0, 9)}", "checked", "DATA-href = 'n'", f'title="{value()}"'])
    piece = lambda: rng.choice(
        [
            f"<a {attribute()} {attribute()}>", "</a>", "<br/>", "<p>", "</p>", "text & more", "a < b", "<td>", "</td>", "<tr>", "</tr>", "<table>", "</table>", "<!-- <a href=n> -->", "<!doctype html>",
            "<script>'<a href=n>' < 1</script>", "<style>a > b {}</style>", "<b>", "</b>", "<li>", "<A\nHREF=y>", "</ a>", "<img src=x>", "&eacute;", "\n",
        ]
    )
    return "".join(piece() for _ in range(rng.randint(0, 40)))


def test_start_tags_equal_another_parser():
    rng = random.Random(7)
    for _ in range(1500):
        page = made(rng)
        events = Events()
        events.feed(page)
        events.close()
        tags = frozenset(t for t, _ in events.tags)
        assert [(e.tag, e.attrs) for e in H.parsed(page, tags)[0]] == events.tags, page


@pytest.mark.parametrize(
    ("page", "tag", "want"),
    [
        ("<p>a<p>b</p>c", "p", ["a", "b"]), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "li", ["ab", "b", "c"]), ("<a>x<table><tr><td></a>y</table>z</a>w", "a", ["xyz"]),
        ("<td>a</td></tr>b", "td", ["a"]), ("<a href=x>a<script>no</script>b", "a", ["ab"]), ("<title><b>x</b> &amp;</title>", "title", ["<b>x</b> &"]), ("<p>a</div>b<div>c</p>d</div>", "p", ["ab"]),
        ("<!-->a<p>b<!--->c</p><!--x--!>d<p>e<!-- never", "p", ["bc", "e"]), ("", "p", []), ("<p", "p", []), ("<dl><dt>a<dd>b<dt>c</dl>", "dd", ["b"]), ("<select><option>a<option>b</select>", "option", ["a", "b"]),
    ],
)
def test_what_closes_what(page, tag, want):
    found, strings = H.parsed(page, frozenset((tag,)))
    assert ["".join(strings[e.first : e.last]) for e in found] == want


def test_elements_know_what_holds_them(spark):
    page = "<table id=t><tr><td>a<table><tr><td>b</table><td>c</table>"
    rows = H.elements(spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string"), ("table", "td")).orderBy("node").collect()
    assert [(r.id, r.tag, r.text, r.inner, [(p.node, p.tag) for p in r.parents]) for r in rows] == [
        (1, "table", "abc", page[12:-8], []), (1, "td", "ab", "a<table><tr><td>b</table>", [(0, "table")]), (1, "table", "b", "<tr><td>b", [(0, "table"), (2, "td")]),
        (1, "td", "b", "b", [(0, "table"), (2, "td"), (3, "table")]), (1, "td", "c", "c", [(0, "table")]),
    ]
    assert rows[0].attrs == {"id": "t"}


def test_names_that_clash(spark):
    rows = pages.anchors(spark.createDataFrame([(1, "<a href=x>y</a>", "old", "c")], "id int, html string, text string, `a.b` string")).collect()
    assert [r.asDict() for r in rows] == [{"id": 1, "a.b": "c", "pos": 0, "href": "x", "text": "y"}]


def test_a_deep_and_long_page():
    page = "<div>" * 30_000 + "<a href=x>y</a>" + "</span></p>" * 30_000 + "<a href='" + "z" * 1_000_000
    assert [e.attrs for e in H.parsed(page, frozenset(("a",)))[0]] == [{"href": "x"}]
