"""Matching names: exact, folded, fuzzy, ambiguous and one-to-one."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.similarity import name_ratio
from quillon.functions.terms import NAME_ALIASES, REGION_PREFIXES
from quillon.functions.text import fold, strip
from quillon.session import stored


def resolve(names: DataFrame, name: str, candidates: DataFrame, candidate: str, position: str, threshold: float = 0.9) -> DataFrame:
    """names with `matched`: the equal candidate, else the first one equal when folded, else the one of
    the highest indel ratio if that reaches the threshold (ties: the first), else null.

    Each distinct name is resolved once. The first two tiers are equi-joins. For the third, a pair
    with ratio >= t has lengths within a factor t / (2 - t) of each other and shares a number of bigrams that follows from
    its lengths, so candidates are found by their rarest bigrams; names so short that it is none meet by length alone.
    A ratio of 1 is equality, which the first tier has settled: a threshold of 1 needs no third.
    """
    asked = names.select(F.col(name).alias("n")).filter("n is not null").distinct()
    known = candidates.select(F.col(candidate).alias("c"), F.col(position).alias("p")).filter("c is not null").groupBy("c").agg(F.min("p").alias("p"))
    folded = known.groupBy(fold(F.col("c")).alias("f")).agg(F.min_by("c", "p").alias("m2"))
    told = asked.join(known.select(F.col("c").alias("n"), F.col("c").alias("m1")), "n", "left").withColumn("f", fold(F.col("n"))).join(folded, "f", "left")
    told = told.select("n", F.coalesce("m1", "m2").alias("m"))
    if threshold >= 1:
        return names.join(told.select(F.col("n").alias(name), F.col("m").alias("matched")), name, "left")
    low = threshold / (2 - threshold)
    close = near_pairs(told.filter("m is null").select("n"), known, threshold, low).withColumn("r", name_ratio("n", "c")).filter(F.col("r") >= threshold)
    third = close.groupBy("n").agg(F.min_by("c", F.struct(-F.col("r"), "p")).alias("m3"))
    found = told.join(third, "n", "left").select(F.col("n").alias(name), F.coalesce("m", "m3").alias("matched"))
    return names.join(found, name, "left")


def _grams(s: str):
    """The bigrams of a column of names, the k-th of a kind told from the others; a single character counts as one."""
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1))), lambda i: F.substr(F.col(s), i, F.lit(2)))
    return F.transform(pieces, lambda g, i: F.concat(g, F.size(F.filter(F.slice(pieces, 1, i + 1), lambda h: h == g)).cast("string")))


def _least_shared(a, b, threshold: float):
    """Bigrams that two names of a ratio of `threshold` share at least: each of the (1 - ratio) * (a + b) characters to delete spoils two of the longer one."""
    return F.greatest(F.length(a), F.length(b)) - 1 - 2 * (1 - threshold) * (F.length(a) + F.length(b))


def gram_candidates(asked: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(n, c, p) rows, some repeated, that hold every pair whose names share as many bigrams as the threshold asks for.

    A prefix filter: bigrams are put in order of rarity; two names that share k of them share one of
    their size - k + 1 rarest. k is least for names of equal length, so only that many bigrams of each name are joined. Where
    they meet, what is left behind the meeting points must suffice for the rest of k.
    """
    each = asked.select(F.explode(_grams("n")).alias("g")).unionByName(known.select(F.explode(_grams("c")).alias("g")))
    often = stored(each.groupBy("g").agg(F.count(F.lit(1)).alias("f")))

    def prefixes(names: DataFrame, s: str, i: str, *more: str) -> DataFrame:
        rows = names.withColumn("g", F.explode(_grams(s))).join(often, "g")
        rows = rows.groupBy(s, *more).agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("a"))  # a name's bigrams
        size = F.length(s) - F.ceil(_least_shared(s, s, threshold) - 1e-9).cast("int")
        rows = rows.select(s, *more, F.posexplode(F.slice("a", 1, F.least(F.size("a"), F.greatest(size, F.lit(1))))).alias(i, "x"))
        return rows.select(s, *more, i, F.col("x.g").alias("g"))

    low = threshold / (2 - threshold)
    met = prefixes(asked, "n", "i").join(prefixes(known, "c", "j", "p"), "g")
    met = met.filter((F.length("c") >= F.length("n") * low - 1e-9) & (F.length("c") * low <= F.length("n") + 1e-9))
    rest = F.least(F.length("n") - 1 - F.col("i"), F.length("c") - 1 - F.col("j"))
    return met.filter(rest >= _least_shared("n", "c", threshold) - 1e-9).select("n", "c", "p")


def near_pairs(asked: DataFrame, known: DataFrame, threshold: float, low: float) -> DataFrame:
    """Distinct (n, c, p) that contain all pairs whose indel ratio can reach the threshold.

    Candidates are found by their rarest bigrams and stay if they share as many as the threshold asks for (see
    gram_candidates). Names for which that is none (and their candidates) are paired by length.
    """
    safe = _least_shared("n", "n", threshold) > 1e-9
    pairs = gram_candidates(asked.filter(safe), known, threshold).groupBy("n", "c").agg(F.min("p").alias("p"))
    by_gram = pairs.filter(F.size(F.array_intersect(_grams("n"), _grams("c"))) >= _least_shared("n", "c", threshold) - 1e-9)
    span = F.sequence(F.ceil(F.length("n") * low - 1e-9).cast("int"), F.floor(F.length("n") / low + 1e-9).cast("int"))
    by_length = asked.filter(~safe).withColumn("l", F.explode(span)).join(known.withColumn("l", F.length("c")), "l").select("n", "c", "p")
    return by_gram.unionByName(by_length)


def with_alias(names: DataFrame, name: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """Names that another source spells differently, in that source's spelling."""
    out = F.col(name)
    for a, b in (NAME_ALIASES if aliases is None else aliases).items():
        out = F.when(F.col(name) == a, F.lit(b)).otherwise(out)
    return names.withColumn(name, out)


def region_hint(names: DataFrame, name: str, ambiguous: DataFrame, ambiguous_name: str, codes: str, hints: dict[str, str] | None = None) -> DataFrame:
    """`Base (Hint)` names with `code`: the one code of Base that the hint's prefix starts, null where none or several do."""
    hints = REGION_PREFIXES if hints is None else hints
    base = strip(F.regexp_extract(F.col(name), r"(?s)^(.*)\(", 1))
    hint = F.lower(strip(F.regexp_replace(F.regexp_extract(F.col(name), r"(?s)^.*\((.*)$", 1), r"\)+$", "")))
    prefix = F.lit(None).cast("string")
    for k, v in hints.items():
        prefix = F.when(hint == k, F.lit(v)).otherwise(prefix)
    asked = names.withColumn("__b", base).withColumn("__p", prefix)
    known = ambiguous.select(F.col(ambiguous_name).alias("__b"), F.col(codes).alias("__c"))
    fitting = F.filter("__c", lambda c: c.startswith(F.col("__p")))
    out = asked.join(known, "__b", "left").withColumn("code", F.when(F.size(fitting) == 1, fitting[0]))
    return out.select(*names.columns, "code")


def greedy_pairs(left: DataFrame, right: DataFrame, block: str, name: str, position: str, threshold: float = 0.9) -> DataFrame:
    """(block, left_name, right_name): in order of position, each left row takes the best right name of its block that is still free.

    Best is the equal name, else the first one equal when folded, else the one of the highest ratio (ties: the first) if it
    reaches the threshold. Null names take part in nothing; of equal names on the right the first counts.
    See first_come() for how the turns are taken.
    """
    mine = left.select(F.col(block).alias("b"), F.col(name).alias("n"), F.col(position).alias("lp")).filter("n is not null")
    free = right.select(F.col(block).alias("b"), F.col(name).alias("c"), F.col(position).alias("rp")).filter("c is not null").groupBy("b", "c").agg(F.min("rp").alias("rp"))
    low = threshold / (2 - threshold)
    names = near_pairs(mine.select("n").distinct(), free.select("c").distinct().withColumn("p", F.lit(0)), threshold, low).select("n", "c").distinct()
    close = names.withColumn("r", name_ratio("n", "c")).filter(F.col("r") >= threshold)
    pairs = mine.join(close, "n").join(free, ["b", "c"]).select("b", "n", "lp", "c", "rp", "r")
    alike = mine.withColumn("f", fold(F.col("n"))).join(free.withColumn("f", fold(F.col("c"))), ["b", "f"]).select("b", "n", "lp", "c", "rp", F.when(F.col("n") == F.col("c"), 3.0).otherwise(2.0).alias("r"))
    pairs = pairs.unionByName(alike).groupBy("b", "n", "lp", "c", "rp").agg(F.max("r").alias("r"))
    return first_come(pairs).select(F.col("b").alias(block), F.col("n").alias("left_name"), F.col("c").alias("right_name"))


def first_come(pairs: DataFrame, enough: float = 0.1) -> DataFrame:
    """(b, n, c) of the serial walk over pairs (b, n, lp, c, rp, r): by lp, then n, each left takes its best right (highest r, then rp, c) that is free.

    Rounds of mutual choice: a left and a right settle where the right is the left's best and the left
    the first of all that would take it; no turn of the walk can come between them. All such pairs settle at once and
    leave. When a round settles less than `enough` of the lefts, what is left hangs together in long chains: it is
    walked in order by connected group, a batch at a time, and only the taken rights of one group are held.
    """
    pairs = stored(pairs)
    out: list[DataFrame] = []
    while True:
        best = pairs.groupBy("b", "n", "lp").agg(F.min_by("c", F.struct(-F.col("r"), "rp", "c")).alias("c"))
        first = pairs.groupBy("b", "c").agg(F.min(F.struct("lp", "n")).alias("first"))
        told = stored(best.join(first, ["b", "c"]).select("b", "n", "lp", "c", (F.col("first.lp").eqNullSafe(F.col("lp")) & (F.col("first.n") == F.col("n"))).alias("settles")))
        sizes = told.agg(F.count(F.lit(1)).alias("n"), F.count_if("settles").alias("s")).first()
        if not sizes["n"]:
            break
        settled = told.filter("settles")
        out.append(settled.select("b", "n", "c"))
        pairs = pairs.join(settled.select("b", "n", "lp"), ["b", "n", "lp"], "left_anti").join(settled.select("b", "c"), ["b", "c"], "left_anti")
        pairs = stored(pairs.select("b", "n", "lp", "c", "rp", "r"))
        if sizes["s"] < enough * sizes["n"]:
            out.append(_walked(pairs))
            break
    every = out[0] if out else pairs.select("b", "n", "c")
    for rows in out[1:]:
        every = every.unionByName(rows)
    return every


def _walked(pairs: DataFrame) -> DataFrame:
    """(b, n, c) of the walk, by connected group."""
    side = lambda kind, *c: F.xxhash64(F.lit(kind), "b", *c)
    group = linked_groups(pairs.select(side("l", "n", "lp").alias("u"), side("r", "c").alias("v")))
    rows = pairs.withColumn("node", side("l", "n", "lp")).join(group, "node").withColumn("turn", side("l", "n", "lp")).withColumn("what", side("r", "c"))
    rows = rows.repartition("group").sortWithinPartitions("group", "lp", "n", F.desc("r"), "rp", "c").select("group", "turn", "what", "b", "n", "c")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, turn, served, taken = None, None, False, set()
        for batch in batches:
            chosen = []
            for i, (g, t, w) in enumerate(zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)):
                if g != group:
                    group, turn, taken = g, None, set()
                if t != turn:
                    turn, served = t, False
                if not served and w not in taken:
                    taken.add(w)
                    served = True
                    chosen.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(chosen, pa.int64())) for k in (3, 4, 5)], ["b", "n", "c"])

    kind = lambda c: rows.schema[c].dataType.simpleString()
    return rows.mapInArrow(walk, f"b {kind('b')}, n {kind('n')}, c {kind('c')}")


def linked_groups(links: DataFrame) -> DataFrame:
    """(node, group) of the nodes of (u, v) links: the least node that each can reach.

    Each node's neighbours above it are linked to its least neighbour, then those below it, in turns until nothing
    changes; a chain of any length takes a number of turns like its logarithm.
    """
    star = lambda e: e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    nodes = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).distinct()
    edges, mark = stored(star(links)), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(star(both.join(least, "u").filter("v > u").select("v", F.col("m").alias("x")).toDF("u", "v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stored(star(small.select("v", "m").toDF("u", "v").unionByName(least.select("u", F.col("m").alias("v")))))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("group")), "node", "left").select("node", F.coalesce("group", "node").alias("group"))


def accent_free_matches(words: DataFrame, word: str, known: DataFrame, other: str) -> DataFrame:
    """Rows of both sides that are equal but for accents and case."""
    return words.withColumn("folded", fold(F.col(word))).join(known.withColumn("folded", fold(F.col(other))), "folded")


def best_of(rows: DataFrame, by: str, score: str, position: str) -> DataFrame:
    """Of each group the first row of the highest score above 0; groups without one are left out. One partial maximum a group."""
    best = rows.filter(F.col(score) > 0).groupBy(by).agg(F.min_by(F.struct("*"), F.struct((-F.col(score)).alias("s"), F.col(position).alias("p"))).alias("b"))
    return best.select(*[F.col("b").getField(c).alias(c) for c in rows.columns])
