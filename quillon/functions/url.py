"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def part(url: Column, name: str) -> Column:
    """scheme (lower case), authority, path, query or fragment; empty where missing."""
    i = ("scheme", "authority", "path", "query", "fragment").index(name) + 1
    out = F.regexp_extract(url, PARTS, i)
    return F.lower(out) if name == "scheme" else out


def hostname(url: Column) -> Column:
    """The host in lower case, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(part(url, "authority"), "^.*@", ""), r":\d*$", ""))


def port(url: Column) -> Column:
    return F.regexp_extract(part(url, "authority"), r":(\d+)$", 1)


def _path(url: Column) -> Column:
    p = part(url, "path")
    p = F.when(p == "", "/").otherwise(p)
    return F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))


def normalize_keep_query(url: Column) -> Column:
    """Scheme and authority in lower case, no slash at the end of the path, no fragment; the query as it is."""
    q = part(url, "query")
    out = F.concat(part(url, "scheme"), F.lit("://"), F.lower(part(url, "authority")), _path(url))
    return F.concat(out, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def normalize_sorted_query(url: Column) -> Column:
    """As above, also without user and default port, the query's parameters sorted (blank values kept)."""
    scheme, p = part(url, "scheme"), port(url)
    default = ((scheme == "http") & (p == "80")) | ((scheme == "https") & (p == "443")) | (p == "")
    host = F.concat(hostname(url), F.when(default, "").otherwise(F.concat(F.lit(":"), p)))
    pairs = F.filter(F.split(part(url, "query"), "&"), lambda x: x != "")
    named = F.array_sort(F.transform(pairs, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.substr(x, F.length(F.substring_index(x, "=", 1)) + 2).alias("v"))))
    q = F.array_join(F.transform(named, lambda x: F.concat(x["k"], F.lit("="), x["v"])), "&")
    return F.concat(scheme, F.lit("://"), host, _path(url), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def strip_fragment(url: Column) -> Column:
    """Cut at the first #, without slashes at the end; the rest as it is."""
    return F.regexp_replace(F.substring_index(url, "#", 1), "/+$", "")


def join(base: Column, href: Column) -> Column:
    """The URL that a link on a page leads to (RFC 3986 resolution)."""
    root = F.concat(part(base, "scheme"), F.lit("://"), part(base, "authority"))
    path = F.when(part(base, "path") == "", "/").otherwise(part(base, "path"))
    folder = F.regexp_replace(path, "[^/]*$", "")
    tail = F.regexp_extract(href, r"([?#].*)?$", 1)
    own = part(href, "path")
    merged = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    q = F.when(part(base, "query") != "", F.concat(F.lit("?"), part(base, "query"))).otherwise("")
    return (
        F.when(F.coalesce(href, F.lit("")) == "", base)
        .when(part(href, "scheme") != "", href)
        .when(href.startswith("//"), F.concat(part(base, "scheme"), F.lit(":"), href))
        .when(href.startswith("#"), F.concat(root, part(base, "path"), q, href))
        .when(href.startswith("?"), F.concat(root, part(base, "path"), href))
        .otherwise(F.concat(root, without_dots(merged), tail))
    )


def without_dots(path: Column) -> Column:
    """A path from / with its . and .. segments worked off."""
    segments = F.slice(F.split(path, "/"), 2, 1 << 20)
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda a, s: F.when(s == ".", a).when(s == "..", F.when(F.size(a) > 0, F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)).otherwise(F.concat(a, F.array(s))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))


def same_host(url: Column, other: Column) -> Column:
    return part(url, "scheme").isin("http", "https") & (part(url, "authority") == part(other, "authority"))


def in_scope(url: Column, root: Column) -> Column:
    """Same authority as the root, and its path or below it."""
    top = F.regexp_replace(part(root, "path"), "/+$", "")
    path = _path(url)
    below = (top == "") | (path == top) | path.startswith(F.concat(top, F.lit("/")))
    return part(url, "scheme").isin("http", "https") & (part(url, "authority") == part(root, "authority")) & below


def to_https(url: Column, how: str = "prefix") -> Column:
    """http:// as https://: at the start, at the start in any case, or everywhere."""
    if how == "everywhere":
        return F.replace(url, F.lit("http://"), F.lit("https://"))
    return F.regexp_replace(url, "(?i)^http://" if how == "any_case" else "^http://", "https://")


def with_scheme(url: Column) -> Column:
    return F.when(url.startswith("www."), F.concat(F.lit("https://"), url)).otherwise(url)


def municipality(url: Column) -> Column:
    """The place's name in a town hall's host."""
    return F.regexp_replace(F.regexp_replace(hostname(url), r"^www\.(cm-)?", ""), r"\.pt$", "")


def basename(url: Column) -> Column:
    return F.element_at(F.split(part(url, "path"), "/"), -1)
