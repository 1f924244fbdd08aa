"""Mixing sources to target weights along a curriculum.

A source's schedule gives its weight at each moment t of training, from 0 to 1. Its integral is
the source's demand for words; a document's place in its source's stream (in a seeded hash
order, passes one after another) is put through the inverse of that cumulative demand, which
gives the moment at which it is trained on. Documents are range-sorted by that position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import n_words, running

Schedule = list[tuple[float, float]]
MAX_SOURCES = 100_000


def ramp(weight: float, tilt: float) -> Schedule:
    """A weight that goes from weight * (1 - tilt) to weight * (1 + tilt); its mean is weight."""
    return [(0.0, weight * (1 - tilt)), (1.0, weight * (1 + tilt))]


def curriculum(k: int) -> Schedule:
    """Weights 1, 2, 3, repeating; every second source is used more as time goes on, the others less."""
    return ramp(1 + k % 3, 0.5 if k % 2 else -0.5)


def integral(schedule: Schedule) -> list[float]:
    """Cumulative weight at the schedule's knots."""
    out = [0.0]
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        if t1 < t0 or min(w0, w1) < 0:
            raise ValueError("a schedule's moments ascend and its weights are not negative")
        out.append(out[-1] + (t1 - t0) * (w0 + w1) / 2)
    return out


def filled(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of total by weight; none above most times its size, the excess going to the others by weight."""
    target, free = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0 and weights[i] > 0]
    left = float(total)
    while free:
        per = left / sum(weights[i] for i in free)
        over = [i for i in free if per * weights[i] > most * sizes[i]]
        if not over:
            for i in free:
                target[i] = per * weights[i]
            break
        for i in over:
            target[i] = most * float(sizes[i])
            left -= target[i]
        free = [i for i in free if i not in set(over)]
    return target


def planned(
    docs: DataFrame, schedule: Callable[[int], Schedule] = curriculum, share: float = 1.0, most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """docs with size (words), source_size, target, copies, taken (words) and positions (one for each copy, ascending).

    size defaults to the words of the text. schedule(k) is that of the k-th source by code point, a null source being last. Sources share
    `share` of all words; targets stop at `most` times a source's size. All documents are taken
    floor(target / source_size) times, those before the remaining share of the source's hash order
    once more: a source's sum misses its target by at most half a document. Null and empty texts
    have size 0 and are never taken; equal rows are taken each on their own; a source without words has target 0.
    Columns that docs has under the new names are replaced; all others come out as they went in, whatever they are called.
    """
    new = ["size", "source_size", "target", "copies", "taken", "positions"]
    kept = [c for c in docs.columns if c not in new]
    text = F.col(f"`{text_col}`")
    # docs' columns go by under names of their own, so none meets those used here
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], (n_words(text) if size is None else size.cast("long")).alias("size"), F.col(f"`{id_col}`").cast("string").alias("__i"),
        F.xxhash64(text).alias("__x"), F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("-")).alias("__g"),
    )
    sums = rows.groupBy("__g").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()  # a row per source
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sums = sorted(((r["__g"], r["n"]) for r in sums), key=lambda r: (r[0] == "-", r[0]))
    schedules = [schedule(k) for k in range(len(sums))]
    areas = [integral(s) for s in schedules]
    targets = filled([n for _, n in sums], [a[-1] for a in areas], share * sum(n for _, n in sums), most)
    plan = [(g, n, x, [t for t, _ in s], [w for _, w in s], a) for (g, n), x, s, a in zip(sums, targets, schedules, areas, strict=True)]
    plan = docs.sparkSession.createDataFrame(plan, "`__g` string, source_size long, target double, `__t` array<double>, `__w` array<double>, `__c` array<double>")
    order = [F.col("__i"), F.col("__x"), F.col("size")]
    rows = running(rows, ["__g"], order, "size", "__before").join(F.broadcast(plan), "__g")  # at most MAX_SOURCES rows

    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - full * F.col("source_size")
    middle = F.col("__before") + F.col("size") / 2
    copies = F.when(F.col("size") > 0, full + F.when(middle < rest, 1).otherwise(0)).otherwise(0)
    rows = rows.withColumn("copies", copies.cast("long")).withColumn("__m", middle).withColumn("taken", F.col("copies") * F.col("size"))
    passes = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("positions", F.transform(passes, lambda j: moment((j * F.col("source_size") + F.col("__m")) / F.col("target"))))
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *new)


def moment(part: Column) -> Column:
    """When a source's cumulative demand (knots __t, weights __w, integral __c) reaches this part of the whole."""
    y = F.least(part, F.lit(1.0)) * F.element_at("__c", -1)
    k = F.least(F.greatest(F.size(F.filter("__c", lambda c: c <= y)), F.lit(1)), F.size("__c") - 1)
    t0, t1, w0, w1 = (F.element_at(c, k + i) for c in ("__t", "__w") for i in (0, 1))
    area = F.greatest(y - F.element_at("__c", k), F.lit(0.0))
    slope = F.when(t1 > t0, (w1 - w0) / (t1 - t0)).otherwise(0.0)
    root = w0 + F.sqrt(F.greatest(w0 * w0 + 2 * slope * area, F.lit(0.0)))
    return F.least(t0 + F.when(root > 0, 2 * area / root).otherwise(0.0), t1)


def in_order(plan: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row for each copy of planned()'s rows, range-sorted by its position."""
    n = partitions or int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = plan.withColumn("position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange(n, "position").sortWithinPartitions("position")
