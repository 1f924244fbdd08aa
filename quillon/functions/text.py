"""Text functions as column expressions: accents, slugs, trimming, keyword counts."""

import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


class _Letters:
    """A rule for single characters as column expressions: those that become one character or none by one
    translation, those that become several by a lookup that only texts with such a character pay for.

    Hangul syllables stay whole: NFKD would take each apart, in either text that is compared alike.
    """

    def __init__(self, rule: Callable[[str], str]):
        made = {c: rule(c) for c in map(chr, (*range(0x80 if rule("A") == "A" else 0x41, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x110000)))}
        changed = {c: t for c, t in made.items() if t != c}
        one = {c: t for c, t in changed.items() if len(t) == 1}
        self.old = "".join([*one, *[c for c, t in changed.items() if not t]])
        self.new = "".join(one.values())
        self.several = {c: t for c, t in changed.items() if len(t) > 1}
        points = sorted(map(ord, self.several))
        known = set(points)
        edges = [(p, p - 1 not in known, p + 1 not in known) for p in points]
        firsts, lasts = [p for p, a, _ in edges if a], [p for p, _, b in edges if b]
        self.pattern = "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(firsts, lasts, strict=True)) + "]"

        self.lowers = rule("A") == "a"

    def of(self, text: Column) -> Column:
        plain = lambda t: F.octet_length(t) == F.length(t)  # noqa: E731  ASCII only
        several = F.create_map(*[F.lit(x) for pair in self.several.items() for x in pair])
        spelled = lambda t: F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(several, c), c)), "")
        single = F.translate(text, self.old, self.new)
        # bound as a lambda's variable, the translation is made once
        rest = F.transform(F.array(single), lambda t: F.when(plain(t) | ~t.rlike(self.pattern), t).otherwise(spelled(t)))
        return F.when(plain(text), F.lower(text) if self.lowers else text).otherwise(rest[0])


def _bare(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


@cache
def _letters(folded: bool) -> _Letters:
    return _Letters((lambda c: _bare(c).casefold()) if folded else _bare)


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks, in any script (Hangul syllables stay whole)."""
    return _letters(False).of(text)


def strip_accents_nfkd(text: Column) -> Column:
    """The same with Hangul syllables taken apart, in Arrow batches."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _bare(t))

    return pandas_udf(run, "string")(text)


def fold(text: Column) -> Column:
    """Accent- and case-insensitive form: strip_accents() in full case folding, so ligatures, sharp s and final sigma count as what they stand for."""
    return _letters(True).of(text)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squash(text: Column) -> Column:
    """ASCII letters and digits only, in lower case: the form that keywords are matched in."""
    return F.lower(F.regexp_replace(text, "[^0-9a-zA-Z]+", ""))


def spaced(text: Column) -> Column:
    """Link text or path as words: percent-decoded, folded, separators as single spaces."""
    plain = F.coalesce(F.try_url_decode(text), text)
    return strip(F.regexp_replace(F.regexp_replace(fold(plain), r"[_\-+./]", " "), r"(?U)\s+", " "))


def slug(text: Column, default: str = "city") -> Column:
    """Lower-case ASCII words joined by hyphens; nothing left gives the default."""
    out = F.regexp_replace(F.regexp_replace(F.lower(strip_accents(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(out == "", F.lit(default)).otherwise(out)


def occurrences(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of a term, from the left."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("long")


def keyword_score(text: Column, terms: list[str]) -> Column:
    """The sum of occurrences of all terms in the lower-cased text; nested terms count each on its own."""
    low = F.lower(text)
    total = F.lit(0).cast("long")
    for t in terms:
        total = total + occurrences(low, t)
    return F.coalesce(total, F.lit(0).cast("long"))


def contains_any(text: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | text.contains(t)
    return out


def year_of(name: Column) -> Column:
    """The first four digits after a slash, as a number; null where there are none."""
    found = F.regexp_extract(name, r"/(\d{4})", 1)
    return F.when(found != "", found.cast("int"))


def is_complete(name: Column) -> Column:
    return strip(name).startswith("Regulamento")


def seconds_of(delay: Column) -> Column:
    """`12s` as 12.0; other forms give null."""
    return F.try_to_number(F.regexp_extract(delay, r"^(\d+(?:\.\d+)?)s$", 1), F.lit("999999999.999")).cast("double")
