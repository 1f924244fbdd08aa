"""URL rules, and a character language-model ratio for the URLs that no rule fits.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, are counted over
the URLs that rules decide. P_k(c | last k characters) = (n(context, c) + BETA * P_(k-1)) /
(n(context) + BETA), so a longer context speaks as far as it was seen. The log ratio of the two
models is a sum of one value for each character and order; a URL's score is that sum by its
length. A fifth of the decided URLs is kept from the counts; the threshold is the score that best
parts the two kinds of these. DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import dropped, written

ORDER = 3
BETA = 2.0
BINS_PER_NAT = 64
HELD_OUT = 5  # one in so many decided URLs is kept for the threshold
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    host, slash, rest = name.partition("/")
    return Rule(verdict, host, slash + rest)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path after the first ://, both empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(urls: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """urls with host, path, rule and rule_verdict: the longest rule whose host is the URL's or above it and whose path starts it."""
    host, path = host_and_path(F.col(url_col))
    out = urls.withColumn("host", host).withColumn("path", path)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return out.withColumn("rule", name).withColumn("rule_verdict", verdict)


def grams(urls: DataFrame) -> DataFrame:
    """urls' columns and `g`, each character of `u` with 0 to ORDER characters before it."""
    padded = F.concat(F.lit(START * ORDER), F.col("u"), F.lit(END))
    ends = urls.withColumn("__p", padded).withColumn("__e", F.explode(F.expr(f"sequence({ORDER + 1}, length(`__p`))")))
    each = F.explode(F.array(*[F.expr(f"substr(`__p`, `__e` - {k}, {k + 1})") for k in range(ORDER + 1)]))
    return ends.select(*urls.columns, each.alias("g"))


def trained(labelled: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """(g, value) from (u, n, accepted): what each seen gram adds to the log ratio.

    A gram's value holds its own step over the shorter context, and what it changes as the context
    of the next character (the mass that the longer context takes from its shorter one). Grams no
    model has seen add nothing.
    """
    side = lambda c: F.sum(F.when(F.col("accepted") == c, F.col("n")).otherwise(0)).cast("double")
    counts = written(grams(labelled).groupBy("g").agg(side(True).alias("na"), side(False).alias("nr")), "grams", scratch)
    known = counts.withColumn("k", F.length("g") - 1)
    totals = known.filter("k = 0").agg(F.sum("na").alias("ta"), F.sum("nr").alias("tr"), F.count(F.lit(1)).alias("v")).first()  # one row
    ta, tr, v = float(totals["ta"] or 0), float(totals["tr"] or 0), float(totals["v"] or 0) + 1
    low = known.filter("k = 0").select("g", ((F.col("na") + 1) / (ta + v)).alias("pa"), ((F.col("nr") + 1) / (tr + v)).alias("pr"))
    values = low.select("g", F.log(F.col("pa") / F.col("pr")).alias("x"))
    for k in range(1, ORDER + 1):
        here = known.filter(F.col("k") == k).select("g", "na", "nr", F.expr("substr(g, 2)").alias("s"), F.expr(f"substr(g, 1, {k})").alias("c"))
        context = here.groupBy("c").agg(F.sum("na").alias("ca"), F.sum("nr").alias("cr"))
        left = F.log((F.col("cr") + BETA) / (F.col("ca") + BETA))  # an unseen next character falls back with BETA / (n + BETA)
        here = here.join(low.select(F.col("g").alias("s"), F.col("pa").alias("la"), F.col("pr").alias("lr")), "s").join(context, "c")
        here = here.withColumn("pa", (F.col("na") + BETA * F.col("la")) / (F.col("ca") + BETA)).withColumn("pr", (F.col("nr") + BETA * F.col("lr")) / (F.col("cr") + BETA))
        step = F.log(F.col("pa") / F.col("la")) - F.log(F.col("pr") / F.col("lr")) - left
        values = values.unionByName(here.select("g", step.alias("x")))
        values = values.unionByName(context.select(F.col("c").alias("g"), left.alias("x")))
        low = written(here.select("g", "pa", "pr"), "order", scratch)
    return written(values.groupBy("g").agg(F.sum("x").alias("value")), "url-model", scratch)


def scored(urls: DataFrame, model: DataFrame) -> DataFrame:
    """(u, score) of distinct URLs u: the log ratio by the number of characters."""
    # a URL's first characters stand after START, whose contexts are no grams of it
    first = model.filter(F.col("g").isin([START * k for k in range(1, ORDER + 1)])).agg(F.sum("value").alias("s")).first()["s"] or 0.0
    found = grams(urls.select("u")).join(model, "g", "left").groupBy("u").agg(F.sum(F.coalesce("value", F.lit(0.0))).alias("s"))
    # sums of doubles depend on their order: rounding makes reruns agree
    return found.select("u", F.round((F.col("s") + first) / (F.length("u") + 1), 6).alias("score"))


def threshold(scores: DataFrame) -> float:
    """The score that best parts accepted from rejected, each kind counting alike, from a histogram of (score, n, accepted, held).

    Only rows that are held out count, unless these lack a kind.
    """
    bins = F.floor(F.least(F.greatest(F.col("score"), F.lit(-16.0)), F.lit(16.0)) * BINS_PER_NAT).cast("int")
    found = scores.groupBy(bins.alias("b"), "held").agg(F.sum(F.expr("if(accepted, n, 0)")).alias("a"), F.sum(F.expr("if(accepted, 0, n)")).alias("r")).collect()  # 64 * BINS_PER_NAT rows at most
    rows = [x for x in found if x["held"]]
    if not sum(x["a"] for x in rows) or not sum(x["r"] for x in rows):
        rows = found
    a, r = sum(x["a"] for x in rows), sum(x["r"] for x in rows)
    if not a or not r:
        return 0.0
    both: dict[int, list[int]] = {}
    for x in rows:
        at = both.setdefault(x["b"], [0, 0])
        at[0], at[1] = at[0] + x["a"], at[1] + x["r"]
    best, below_a, below_r, cuts = -1.0, 0, 0, [0]
    for bin_, (in_a, in_r) in sorted(both.items()):
        below_a, below_r = below_a + in_a, below_r + in_r
        gain = below_r / r - below_a / a
        if gain > best + 1e-12:
            best, cuts = gain, [bin_ + 1]
        elif gain > best - 1e-12:
            cuts.append(bin_ + 1)
    return sum(cuts) / len(cuts) / BINS_PER_NAT


def judged(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id_col, host, path, rule, verdict (allow or block) and score of each row.

    A URL that is null or has no :// has no characters to judge: it is blocked, its score null.
    The threshold comes from a fifth of the decided URLs, by hash, that the models never see; where
    a kind is missing there, from all decided ones, and with no decided URL of one kind it is 0. Scores at the threshold
    are allowed. Equal URLs are scored once; repeated rows stay. Extra columns are not read.
    """
    rows = ruled(pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("url")), rules)
    at = F.instr("url", "://")
    rows = rows.withColumn("u", F.when(at > 0, F.lower(F.substr("url", at + 3))))
    distinct = rows.filter("u is not null").groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.max("rule_verdict").alias("v"))
    distinct = written(distinct, "urls")
    decided = distinct.filter("v is not null").select("u", "n", (F.col("v") == "allow").alias("accepted"))
    kept_out = F.pmod(F.xxhash64("u"), F.lit(HELD_OUT)) == 0
    # the histogram of all decided URLs holds that of the ones kept out
    scratch: list[str] = []
    scores = written(scored(distinct, trained(decided.filter(~kept_out), scratch)), "scores")
    cut = threshold(decided.join(scores, "u").withColumn("held", kept_out))
    for path in scratch:
        dropped(pages.sparkSession, path)
    out = rows.join(scores, "u", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return out.select(F.col("__id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
