"""Operators whose decision on a row depends on earlier decisions: rate limits and quotas.

A key's rows come sorted and in batches; from batch to batch only the key's last few times are
held, so memory is bounded however many rows a key has.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _in_order(calls: DataFrame, key: str, ts: str, call_id: str, decider: Callable[[], Callable[[float], object]], out: str, kind: str) -> DataFrame:
    """(key, call_id, out): out is what a key's decider, made anew for each key, says to its times in order of (ts, call_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, decide = (), None
        for batch in batches:
            found = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if decide is None or k != held:
                    held, decide = k, decider()
                found.append(decide(float("nan") if t is None else t))
            said = pa.array(found, pa.bool_() if kind == "boolean" else pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), said], [key, call_id, out])

    types = {c: calls.schema[c].dataType.simpleString() for c in (key, call_id)}
    rows = calls.select(key, ts, call_id).repartition(F.col(key))
    rows = rows.sortWithinPartitions(F.col(key), F.col(ts).asc_nulls_last(), F.col(call_id).asc_nulls_last())
    return rows.mapInArrow(run, f"{key} {types[key]}, {call_id} {types[call_id]}, {out} {kind}")


def quota(calls: DataFrame, key: str, ts: str, call_id: str, most: int = 19, period: float = 86_400.0) -> DataFrame:
    """(key, call_id, accepted): a call is rejected while `most` accepted ones lie less than `period` seconds back.

    A key's calls are worked off in order of (ts, call_id); whether one is accepted depends on the
    last `most` accepted ones. ts in seconds.
    """

    def decider() -> Callable[[float], bool]:
        held: deque[float] = deque(maxlen=most)

        def decide(t: float) -> bool:
            while held and held[0] <= t - period:
                held.popleft()
            accepted = len(held) < most
            if accepted:
                held.append(t)
            return accepted

        return decide

    return _in_order(calls, key, ts, call_id, decider, "accepted", "boolean")


def rate_limit(calls: DataFrame, key: str, ts: str, call_id: str, most: int = 4, period: float = 60.0) -> DataFrame:
    """(key, call_id, starts_at): when each call starts if at most `most` may start in `period` seconds; they wait in line."""

    def decider() -> Callable[[float], float]:
        started: deque[float] = deque(maxlen=most)
        now = float("-inf")

        def decide(t: float) -> float:
            nonlocal now
            now = max(now, t)
            if len(started) == most:
                now = max(now, started[0] + period)
            started.append(now)
            return now

        return decide

    return _in_order(calls, key, ts, call_id, decider, "starts_at", "double")
