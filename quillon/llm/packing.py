"""Packing into length buckets of least padding.

The lengths' histogram is small whatever the corpus; dynamic programming over it finds the
bucket boundaries with the least padding in all. Inside a bucket, documents are ranked in a
seeded order and batches of the token budget are cut from the ranks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import n_words, running

EXACT = 1024
STEPS = 64


def length_class(n: Column) -> Column:
    """The histogram's bins: a length up to EXACT is its own, longer ones round up by 1/STEPS of their power of two at most."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - int(np.log2(STEPS)))
    return F.when(n <= EXACT, F.greatest(n, F.lit(1))).otherwise(F.ceil(n / step) * step).cast("long")


def boundaries(bins: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper lengths of at most `buckets` buckets over (length, count) bins, with the least sum of padded lengths.

    best[j] after k rounds: the least sum for the first j bins in k buckets. The fewest buckets win ties.
    """
    bins = sorted(bins)
    if not bins:
        return []
    upper = np.array([b[0] for b in bins], float)
    count = np.concatenate(([0.0], np.cumsum([b[1] for b in bins], dtype=float)))
    n = len(bins)
    best = np.concatenate(([0.0], upper * count[1:]))
    cut = [np.zeros(n + 1, int)]
    for _ in range(1, min(buckets, n)):
        new, at = best.copy(), np.arange(n + 1)
        at[:] = -1
        for j in range(1, n + 1):
            sums = best[:j] + upper[j - 1] * (count[j] - count[:j])
            i = int(np.argmin(sums))
            if sums[i] < new[j]:
                new[j], at[j] = sums[i], i
        best = new
        cut.append(at)
    out, j = [], n
    for at in reversed(cut):
        if j == 0:
            break
        if at[j] < 0:
            continue  # this round did not help here
        out.append(int(upper[j - 1]))
        j = int(at[j])
    return out[::-1]


def packed(
    docs: DataFrame, budget: int = 65_536, buckets: int = 16, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """id_col, n_tokens, bucket, bucket_tokens, batch, slot and padding of each row.

    n_tokens is `tokens` or the words of the text (null: 0). A batch of a bucket holds
    budget // bucket_tokens rows, one at least: a longer document fills a batch on its own. Lengths over EXACT share
    a bin with others within 1/STEPS, so the sum of padded lengths is within 1/STEPS of the least there is. Only
    the last batch of a bucket may be short. Rows of no tokens go to the shortest bucket; equal
    rows have a slot each. Extra columns of docs are read only if in `keep`.
    """
    rows = docs.select(*dict.fromkeys([id_col, *keep]), F.coalesce(n_words(F.col(text_col)) if tokens is None else tokens.cast("long"), F.lit(0).cast("long")).alias("n_tokens"), F.xxhash64(text_col).alias("__x"))
    bins = rows.groupBy(length_class(F.col("n_tokens")).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.max("n_tokens").alias("longest")).collect()  # EXACT + STEPS * 53 rows at most
    # a bin ends at the longest length that it really has
    upper = boundaries([(max(r["longest"], 1), r["n"]) for r in bins], buckets)
    bucket, limit = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k, u in reversed(list(enumerate(upper))):
        inside = F.col("n_tokens") <= u
        bucket, limit = F.when(inside, F.lit(k)).otherwise(bucket), F.when(inside, F.lit(u).cast("long")).otherwise(limit)
    rows = rows.withColumn("bucket", F.coalesce(bucket, F.lit(0))).withColumn("bucket_tokens", F.coalesce(limit, F.lit(1).cast("long"))).withColumn("__one", F.lit(1).cast("long"))
    rows = running(rows, ["bucket"], [F.col(id_col).cast("string"), F.col("__x")], "__one", "__rank")
    room = F.greatest(F.expr(f"{budget} div bucket_tokens"), F.lit(1).cast("long"))
    rows = rows.withColumn("__room", room)
    return rows.select(
        id_col, *[c for c in keep if c != id_col], "n_tokens", "bucket", "bucket_tokens",
        F.expr("`__rank` div `__room`").alias("batch"), (F.col("__rank") % F.col("__room")).alias("slot"), (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
    )
