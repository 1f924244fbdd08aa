"""Rate limits and quotas on streams: state with timers for each caller.

Time is the stream's own: the watermark. A call that has to wait is held in its key's state and comes out when
the watermark passes its start; a key whose last call lies a period back loses its state by a timer, so
state is bounded by the callers of one period. Within a micro-batch a key's calls are taken in order of (ts,
call_id); across batches in order of arrival.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

#: The state store that timers need; to be set before a stream starts.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Limits(StatefulProcessor):
    """What both have in common: the times held for a key, the calls that wait, by the time they are due, and one timer.

    The timer stands at the first due call, or where none waits at the end of the period. Whenever a key is taken up, all that
    the watermark has passed comes out at once, so a key costs one call of either kind a micro-batch however many wait.
    """

    def __init__(self, most: int, period: float, out: str, call: str, kind: str):
        self.most, self.period, self.out, self.call, self.kind = most, period, out, call, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", f"times array<double>, timer bigint, calls array<{self.call}>, said array<{self.kind}>, due array<bigint>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        now, before = timerValues.getCurrentWatermarkInMs(), self.held.get()
        times, timer, *waiting = (list(before[0]), before[1], *map(list, before[2:])) if before else ([], None, [], [], [])
        done = []
        for r in sorted(rows, key=lambda r: (r[1], r[2])):
            said, due = self.decided(times, float(r[1]))
            if due is None:
                done.append((r[2], said))
            else:
                for held, x in zip(waiting, (r[2], said, self.due(due)), strict=True):
                    held.append(x)
        yield from self.told(key, done)
        yield from self.released(key, now, times, timer, waiting)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        before = self.held.get()
        if before:
            yield from self.released(key, max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()), list(before[0]), None, [list(x) for x in before[2:]])

    def released(self, key: tuple, now: int, times: list[float], timer: int | None, waiting: list[list]) -> Iterator[Row]:
        """The calls due by now; the state keeps the others, and the timer moves."""
        calls, said, due = waiting
        n = bisect_right(due, now)  # starts only grow, so calls wait in the order in which they are due
        after = due[n] if n < len(due) else self.due(times[-1] + self.period) + 1 if times else now
        if timer is not None and timer != after:
            self.handle.deleteTimer(timer)
        if after <= now:
            self.held.clear()
        else:
            if timer != after:
                self.handle.registerTimer(after)
            self.held.update((times, after, calls[n:], said[n:], due[n:]))
        yield from self.told(key, zip(calls[:n], said[:n], strict=True))

    def told(self, key: tuple, calls: Iterable[tuple]) -> Iterator[Row]:
        for i, said in calls:
            yield Row(k=key[0], i=i, said=said)

    def due(self, seconds: float) -> int:
        return int(-(-seconds * 1000 // 1))

    def close(self) -> None:
        pass


class _Quota(_Limits):
    def decided(self, times: list[float], t: float) -> tuple[bool, None]:
        times[:] = [x for x in times if x > t - self.period]
        if len(times) >= self.most:
            return False, None
        times.append(t)
        return True, None


class _Rate(_Limits):
    def decided(self, times: list[float], t: float) -> tuple[float, float]:
        start = max(t, times[-1]) if times else t
        if len(times) == self.most:
            start = max(start, times[0] + self.period)
            del times[0]
        times.append(start)
        return start, start


def _limited(calls: DataFrame, key: str, ts: str, call_id: str, processor: type[_Limits], out: str, kind: str, most: int, period: float, late: str) -> DataFrame:
    types = {c: calls.schema[c].dataType.simpleString() for c in (key, call_id)}
    source = calls.select(F.col(key).alias("k"), F.col(ts).cast("double").alias("t"), F.col(call_id).alias("i"), F.timestamp_seconds(F.col(ts)).alias("at")).filter("k IS NOT NULL AND t IS NOT NULL")
    schema = StructType.fromDDL(f"k {types[key]}, i {types[call_id]}, said {kind}")
    rows = source.withWatermark("at", late).groupBy("k")
    made = rows.transformWithState(processor(most, period, out, types[call_id], kind), schema, "Append", "EventTime")
    return made.toDF(key, call_id, out)


def quota(calls: DataFrame, key: str, ts: str, call_id: str, most: int = 19, period: float = 86_400.0, late: str = "0 seconds") -> DataFrame:
    """(key, call_id, accepted) of a stream of calls, as operators.stateful.quota says it; ts in seconds. Calls with a null key or time are left out."""
    return _limited(calls, key, ts, call_id, _Quota, "accepted", "boolean", most, period, late)


def rate_limit(calls: DataFrame, key: str, ts: str, call_id: str, most: int = 4, period: float = 60.0, late: str = "0 seconds") -> DataFrame:
    """(key, call_id, starts_at) of a stream of calls, each at the time when it may start: `most` at most start in `period` seconds, the others wait in line."""
    return _limited(calls, key, ts, call_id, _Rate, "starts_at", "double", most, period, late)
