"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments. Codes at a distance under segments * (r + 1) have a segment
within r bits of the query's, so once all segments were searched to radius r, every code up to
distance segments * r + segments - 1 was seen. The radius grows until the k-th verified distance
is covered by that. Codes are sharded; each shard builds its segment tables once and answers all
queries, and the shards' lists are merged. Equal codes are one entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import stored

SEGMENTS, BITS = 4, 16
SHARD, QUERIES, LEAST_SHARDS = 1 << 18, 256, 16
_MASKS: dict[int, np.ndarray] = {}


def masks(r: int) -> np.ndarray:
    """All segment values with r bits set."""
    if r not in _MASKS:
        _MASKS[r] = np.array([sum(1 << b for b in c) for c in combinations(range(BITS), r)], np.int64)
    return _MASKS[r]


def code_of(vector: Column) -> Column:
    """Bit i is set where component i is positive; more than 64 components are an error. Null vectors give null, null components 0."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) > 64, F.raise_error(F.lit("a code holds 64 components at most")).cast("long")).otherwise(code)


class SegmentIndex:
    """Segment tables of a set of codes."""

    def __init__(self, codes: np.ndarray, order_by: np.ndarray):
        rank = np.argsort(order_by, kind="stable")
        self.codes, self.tie = codes[rank], order_by[rank]  # ties in distance go by position
        self.values, self.rows, self.starts = [], [], []
        for s in range(SEGMENTS):
            v = ((self.codes >> np.uint64(s * BITS)) & np.uint64(0xFFFF)).astype(np.int64)
            rows = np.argsort(v, kind="stable")
            values, first = np.unique(v[rows], return_index=True)
            self.values.append(values)
            self.rows.append(rows)
            self.starts.append(np.append(first, len(rows)))

    def _bucket(self, s: int, query_segments: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, bucket) pairs of segment s at radius r: by listing values, or by looking at those there are if that is less."""
        values = self.values[s]
        if comb(BITS, r) <= len(values):
            want = query_segments[:, None] ^ masks(r)[None, :]
            at = np.minimum(np.searchsorted(values, want), len(values) - 1)
            q, m = np.nonzero(values[at] == want)
            return q, at[q, m]
        return np.nonzero(np.bitwise_count(query_segments[:, None] ^ values[None, :]) == r)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, position, distance) of the k nearest codes of each query, ties by position."""
        n = len(self.codes)
        found: list[np.ndarray] = []
        held = np.zeros(0, np.int64)  # query * 65 * n + distance * n + position: sorts as wanted
        active = np.arange(len(queries))
        span = 65 * n
        for r in range(BITS + 1):
            fresh = []
            for s in range(SEGMENTS):
                part = ((queries[active] >> np.uint64(s * BITS)) & np.uint64(0xFFFF)).astype(np.int64)
                q, b = self._bucket(s, part, r)
                first, size = self.starts[s][b], self.starts[s][b + 1] - self.starts[s][b]
                at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
                row, q = self.rows[s][at], active[np.repeat(q, size)]
                fresh.append(q * span + np.bitwise_count(queries[q] ^ self.codes[row]).astype(np.int64) * n + row)
            held = np.unique(np.concatenate([held, *fresh]))
            q = held // span
            first = np.searchsorted(q, active)
            place = np.arange(len(held)) - np.searchsorted(q, q)
            held = held[place < k]
            q = held // span
            first, count = np.searchsorted(q, active), np.searchsorted(q, active, side="right") - np.searchsorted(q, active)
            last = np.where(count > 0, held[np.minimum(first + np.maximum(count, 1) - 1, max(len(held) - 1, 0))] % span // n, 65) if len(held) else np.full(len(active), 65)
            done = ((count >= min(k, n)) & (last <= SEGMENTS * r + SEGMENTS - 1)) | (r == BITS)
            over = np.isin(q, active[done])
            found.append(held[over])
            held, active = held[~over], active[~done]
            if not len(active):
                break
        out = np.concatenate(found) if found else np.zeros(0, np.int64)
        return out // span, out % n, out % span // n


def nearest(base: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", code_col: str = "code") -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k rows of base nearest to each query but itself, ties to smaller ids.

    base and queries have ids and codes. Null ids and null codes are left out; rows of equal id and
    code count once. A query gets all neighbours there are if those are fewer than k.
    """
    base = base.select(F.col(id_col).alias("id"), F.col(code_col).alias("code")).dropna().distinct()
    asked = queries.select(F.col(id_col).alias("query_id"), F.col(code_col).alias("code")).dropna().distinct()
    # of equal codes only the k + 1 smallest ids can be in a list; the limit per code comes before the shuffle
    w = Window.partitionBy("code").orderBy("id")
    entries = stored(base.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).drop("r"))
    codes = stored(entries.groupBy("code").agg(F.min("id").alias("least")))
    wanted = stored(asked.select("code").distinct())
    n = codes.count()
    shards = max(LEAST_SHARDS, -(-n // SHARD))
    order = codes.schema["least"].dataType.simpleString()
    # a shard's codes come first, its index is built once, and then all queries go by
    left = codes.select(F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), "code", "least")
    right = wanted.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks"), "code", F.lit(None).cast(order).alias("least"))
    rows = left.unionByName(right).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    names = ["query", "code", "least", "distance"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            shard, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1]), [True])))
            for lo, hi in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                code = batch.column(2).to_numpy()[lo:hi].view(np.uint64)
                if shard[lo] != at:
                    at, held, index = shard[lo], [], None
                if not asks[lo]:
                    held.append((code, batch.column(3).slice(lo, hi - lo).to_numpy(zero_copy_only=False)))
                    continue
                if not held:
                    continue
                index = index or SegmentIndex(*[np.concatenate(x) for x in zip(*held, strict=True)])
                for some in np.array_split(code, -(-len(code) // QUERIES)):
                    q, where, d = index.search(some, k + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(some[q].view(np.int64)), pa.array(index.codes[where].view(np.int64)), pa.array(index.tie[where], kind), pa.array(d)], names)

    kind = pa.string() if order == "string" else {"bigint": pa.int64(), "int": pa.int32()}.get(order)
    lists = rows.mapInArrow(search, f"query long, code long, least {order}, distance long")
    w = Window.partitionBy("query").orderBy("distance", "least")
    lists = lists.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).select("query", "code", "distance")
    named = lists.join(entries, "code")
    w = Window.partitionBy("query").orderBy("distance", "id")
    named = stored(named.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1).select(F.col("query").alias("code"), "distance", F.col("id").alias("neighbour_id")))
    pairs = asked.join(named, "code").filter("neighbour_id != query_id")
    w = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")
