"""Pages: anchors, table rows, sections, link classes, fields and crawls over a link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions import terms
from quillon.functions import url as U
from quillon.functions.text import contains_any, spaced, squash, strip
from quillon.operators import crawl as walks
from quillon.operators import html as H
from quillon.session import stored

def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per link of a page: pos (from 0, among all a elements), href and text, in document order."""
    found = H.links(pages, html).drop("title")
    return found.withColumns({"href": strip(F.col("href")), "text": strip(F.col("text"))}).filter("href != ''")


def table_rows(pages: DataFrame, html: str = "html", header: int = 1) -> DataFrame:
    """A row per table row after each table's header: table, pos, its cells' HTML, their texts and links."""
    return H.cells(pages, html).filter(F.col("pos") >= header)


def contacts(rows: DataFrame) -> DataFrame:
    """Five cells of table_rows() as six fields: the last cell's first link's text is the e-mail, its second link's target the website."""
    filled = lambda c: F.nullif(strip(c), F.lit(""))
    cell = lambda i: filled(F.try_element_at("texts", F.lit(i)))
    found = F.try_element_at("links", F.lit(5))
    mail, site = filled(F.try_element_at(found, F.lit(1))["text"]), filled(F.try_element_at(found, F.lit(2))["href"])
    return rows.select(
        *[c for c in rows.columns if c not in ("table", "cells", "texts", "links")], cell(1).alias("municipality"), cell(2).alias("president"), cell(3).alias("address"), cell(4).alias("phone"), mail.alias("email"), U.to_https(site).alias("website")
    )


def sections(elements: DataFrame, by: str, pos: str, heading: Column, label: Column, labels: dict[str, str]) -> DataFrame:
    """elements with the heading they stand under, and its section: the last label since that heading, null where not known.

    `heading` and `label` are null in elements that are none. Elements before the first heading have neither.
    """
    w = Window.partitionBy(by).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    known = F.lit("-")
    for k, v in labels.items():
        known = F.when(label == k, F.lit(v)).otherwise(known)
    # a heading closes the section, an unknown label opens none
    mark = F.when(heading.isNotNull(), F.lit("-")).when(label.isNotNull(), known)
    out = elements.withColumn("heading", F.last(heading, ignorenulls=True).over(w)).withColumn("__s", F.last(mark, ignorenulls=True).over(w))
    return out.withColumn("section", F.when(F.col("heading").isNotNull() & (F.col("__s") != "-"), F.col("__s"))).drop("__s")


def regulations(pages: DataFrame, by: str, html: str = "html") -> DataFrame:
    """(by, municipality, section, name, dre_url, pos) of the links under known labels of a regulation page.

    A heading names the municipality, a paragraph with strong text is a label, the links of the paragraphs after it belong to it.
    """
    each = H.elements(pages.select(by, html), ("h2", "p", "strong", "a"), html).withColumn("text", strip(F.col("text")))
    part = F.when(F.col("tag").isin("h2", "p"), F.col("node")).otherwise(F.try_element_at(F.filter("parents", lambda x: x["tag"] == "p"), F.lit(1))["node"])
    each = each.withColumn("part", part).filter("part IS NOT NULL")
    paragraph = Window.partitionBy(by, "part").orderBy("node").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_strong = F.first(F.when(F.col("tag") == "strong", F.col("text")), ignorenulls=True).over(paragraph)
    each = each.withColumn("strong", first_strong)
    head, label = F.when(F.col("tag") == "h2", F.col("text")), F.when(F.col("tag") == "p", F.col("strong"))
    told = sections(each, by, "node", head, label, {terms.URBANIZATION_LABEL: "urbanization", terms.FEES_LABEL: "fees"})
    links = told.filter("tag = 'a' AND strong IS NULL AND section IS NOT NULL").withColumn("dre_url", strip(F.col("attrs")["href"])).filter("dre_url != ''")
    return links.select(by, F.col("heading").alias("municipality"), "section", F.col("text").alias("name"), "dre_url", F.col("part").alias("pos"))


def is_document(href: Column) -> Column:
    """A file by its ending, or behind a download route."""
    path = F.lower(U.part(href, "path"))
    ends = F.lit(False)
    for e in terms.DOCUMENT_ENDINGS:
        ends = ends | path.endswith(e)
    return ends | F.array_contains(F.split(path, "/"), "download")


def is_file(url: Column) -> Column:
    """A file by the longer list of endings."""
    path = F.lower(U.part(url, "path"))
    return F.exists(F.array(*map(F.lit, terms.FILE_ENDINGS)), lambda e: path.endswith(e))


def is_file_loosely(url: Column) -> Column:
    """A last path segment with a dot that is no page's ending."""
    path = F.lower(U.part(url, "path"))
    page = F.exists(F.array(*map(F.lit, terms.PAGE_ENDINGS)), lambda e: path.endswith(e))
    return F.element_at(F.split(path, "/"), -1).contains(".") & ~page


def is_plan_file(url: Column) -> Column:
    path = F.lower(U.part(url, "path"))
    return path.endswith(".pdf") & contains_any(path, terms.PLAN_PATH_WORDS)


def is_plan_pdf(url: Column, text: Column) -> Column:
    return F.lower(url).endswith(".pdf") & (contains_any(squash(url), terms.SQUASHED_PLAN_WORDS) | contains_any(squash(text), terms.SQUASHED_PLAN_WORDS))


def classified(links: DataFrame, href: str = "href", text: str = "text", plan: list[str] | None = None, nav: list[str] | None = None, skip: list[str] | None = None, regulation: str = terms.REGULATION_WORD) -> DataFrame:
    """links with is_document, is_regulation, is_priority and is_followed."""
    plan, nav, skip = plan or terms.PLAN_WORDS, nav or terms.NAVIGATION_WORDS, skip or terms.SKIPPED_PATHS
    words = spaced(F.concat(F.col(href), F.lit(" "), F.coalesce(F.col(text), F.lit(""))))
    path = spaced(U.part(F.col(href), "path"))
    out = links.withColumn("__w", words).withColumn("is_document", is_document(F.col(href)))
    named = contains_any(F.col("__w"), plan)
    return (
        out.withColumn("is_regulation", F.col("is_document") & named & F.col("__w").contains(regulation))
        .withColumn("is_priority", named)
        .withColumn("is_followed", ~F.col("is_document") & ~contains_any(path, skip) & contains_any(F.col("__w"), nav))
        .drop("__w")
    )


def fields(links: DataFrame, by: str, href: str, pos: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """(by, field, url): of each field the first link with the field's keyword as a path segment."""
    mapping = mapping or terms.LINK_FIELDS
    segments = F.split(F.regexp_replace(F.substring_index(F.col(href), "?", 1), "^/+|/+$", ""), "/")
    field = F.lit(None).cast("string")
    for k, v in reversed(list(mapping.items())):
        field = F.when(F.array_contains(segments, k), F.lit(v)).otherwise(field)
    named = links.withColumn("field", field).filter("field is not null")
    return named.groupBy(by, "field").agg(F.min_by(href, pos).alias("url"))


def reach(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """(node, depth) of what the roots reach over (src, dst) links in at most `depth` steps, at the least depth.

    A level is a join of the frontier with the links and an anti-join with what was visited; both
    shuffle by node. Each frontier is kept in the checkpoint folder: the visited set is a union of
    those, so plans don't grow with the depth and a lost executor costs one reread. An empty
    frontier ends the walk. The links are stored once, not made anew for each level.
    """
    edges = stored(edges)
    seen = frontier = stored(roots.select(F.col("node"), F.lit(0).alias("depth")).distinct())
    for d in range(1, depth + 1):
        step = frontier.select(F.col("node").alias("src")).join(edges, "src").select(F.col("dst").alias("node")).distinct()
        frontier = stored(step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(d)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def crawl(roots: DataFrame, links: DataFrame, valid: DataFrame, depth: int, budget: int, width: int = 1) -> DataFrame:
    """(site, visited, attempted, source_url, pdf_url): of each site the first valid document of a crawl with a page budget; see crawl.crawl()."""
    return walks.crawl(roots, links, valid, depth, budget, width)[0]


def named_links(links: DataFrame, href: str = "href", text: str = "text") -> DataFrame:
    """Links to town halls: by their address, or by a text that asks to see the website."""
    by_host = F.col(href).startswith("http://www.cm-") | F.col(href).startswith("https://www.cm-")
    by_text = F.lower(F.col(text)).contains("consultar website")
    return links.filter(by_host | by_text).withColumn("named_by", F.when(by_host, "host").otherwise("text"))


def first_document(visited: DataFrame, links: DataFrame, site: str, by: str = "node") -> DataFrame:
    """Of each site the document that a crawl meets first: by depth, priority pages first, then page and position."""
    found = visited.join(links.filter("is_regulation"), visited[by] == links["src"])
    w = Window.partitionBy(site).orderBy("depth", F.desc("is_priority"), "src", "pos")
    return found.withColumn("__r", F.row_number().over(w)).filter("`__r` = 1").drop("__r")
