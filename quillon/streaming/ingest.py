"""Incremental ingest as Structured Streaming: micro-batched loads, first-seen rows, call quotas."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from quillon.sources import sinks
from quillon.sources.tables import Table


def load_stream(rows: DataFrame, path: str, keys: list[str], checkpoint: str, order: str | None = None, update: bool = True) -> StreamingQuery:
    """Load each micro-batch into a stored table, until what is available has been read.

    A batch that is run again after a failure changes nothing, as loads are keyed.
    """

    def load(batch: DataFrame, _: int) -> None:
        sinks.load(batch, path, keys, order, update, count=False)

    return rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Flushes:
    """A stream's sink that gathers rows and loads them into a stored table once `flush_at` are waiting; finish() loads the rest.

    Waiting rows lie below the checkpoint folder, a folder for each micro-batch, so none is lost with the driver. A batch
    that is run again writes its own folder again, and loads are keyed: nothing comes twice.
    """

    def __init__(self, table: Table, folder: str, flush_at: int = 8, order: str | None = None, update: bool = True):
        self.table, self.folder, self.flush_at, self.order, self.update = table, folder.rstrip("/"), flush_at, order, update
        self.loads: list[int] = []

    def __call__(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch={number}")
        waiting = self._waiting(batch.schema)
        if waiting is not None and waiting.count() >= self.flush_at:
            self._flush(waiting)

    def _waiting(self, schema: StructType) -> DataFrame | None:
        spark = self.table.spark
        return spark.read.schema(schema).parquet(self.folder) if sinks.exists(spark, self.folder) else None

    def _flush(self, waiting: DataFrame) -> None:
        self.loads.append(self.table.load(waiting, self.order, self.update)["read"])
        path, fs = sinks._fs(self.table.spark, self.folder)
        if not fs.delete(path, True):
            raise OSError(f"{self.folder} can't be cleared")

    def finish(self, schema: StructType) -> None:
        waiting = self._waiting(schema)
        if waiting is not None:
            self._flush(waiting)


def load_table(rows: DataFrame, table: Table, checkpoint: str, flush_at: int = 8, order: str | None = None, update: bool = True) -> Flushes:
    """Load what a stream has into a stored table, `flush_at` rows or more at a time and the remainder at the end."""
    sink = Flushes(table, f"{checkpoint}/waiting", flush_at, order, update)
    rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/stream").trigger(availableNow=True).start().awaitTermination()
    sink.finish(rows.schema)
    return sink


def first_seen(rows: DataFrame, keys: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Rows whose keys have not come before, within the watermark."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(rows: DataFrame, ts: str, by: list[str], width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Counts in tumbling windows; rows later than the watermark are left out."""
    out = rows.withWatermark(ts, late).groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), *by, "n")


def quota_stream(calls: DataFrame, key: str, ts: str, call_id: str, most: int = 19, period: float = 86_400.0) -> DataFrame:
    """The quota operator on a stream: a key's state is its accepted calls of the last period, `most` at most."""
    types = {c: calls.schema[c].dataType.simpleString() for c in (key, call_id)}

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(parts)).sort_values([ts, call_id])
        accepted = []
        for t in rows[ts]:
            held = [h for h in held if h > t - period]
            accepted.append(len(held) < most)
            if accepted[-1]:
                held.append(float(t))
        state.update((held,))
        yield pd.DataFrame({key: rows[key], call_id: rows[call_id], "accepted": accepted})

    out = f"{key} {types[key]}, {call_id} {types[call_id]}, accepted boolean"
    return calls.select(key, ts, call_id).groupBy(key).applyInPandasWithState(run, out, "held array<double>", "append", GroupStateTimeout.NoTimeout)
