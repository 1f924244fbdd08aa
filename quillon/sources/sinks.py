"""Sinks: published datasets, raw files in one commit, keyed table loads by snapshot swap, caches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.text import slug
from quillon.operators import merge
from quillon.sources import tables


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def publish(rows: DataFrame, root: str, config: str) -> str:
    """Replace a dataset's table. Its new files are complete before a new manifest names them, by one rename: readers (readers.dataset) see the old rows or the new ones."""
    spark, path, load = rows.sparkSession, f"{root.rstrip('/')}/{config}", uuid.uuid4().hex
    rows.write.parquet(f"{path}/data/{load}/bucket=0")
    found = tables.versions(spark, path)
    tables.commit(spark, path, (found[-1] if found else 0) + 1, {"keys": [], "buckets": 1, "folders": {"0": f"data/{load}/bucket=0"}, "schema": json.loads(rows.schema.json()), "load": load})
    tables.Table(spark, path)._vacuum()
    return path


def ensure(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table where there is none."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def replace(rows: DataFrame, path: str) -> None:
    """Write beside the table, then swap: rows may be made from the table itself. A failed job leaves the table as it was."""
    spark = rows.sparkSession
    new = f"{path}.new-{uuid.uuid4().hex}"
    rows.write.parquet(new)
    _swapped(spark, new, path)


def _swapped(spark: SparkSession, new: str, path: str) -> None:
    """Put a complete table in another one's place by renames; if the second fails, the old table goes back."""
    target, fs = _fs(spark, path)
    fresh, old = _fs(spark, new)[0], _fs(spark, f"{path}.old-{uuid.uuid4().hex}")[0]
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{path} can't be moved")
    if not fs.rename(fresh, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{path} can't be replaced")
    fs.delete(old, True)


def load(new: DataFrame, path: str, keys: list[str], order: str | None = None, update: bool = True, count: bool = True) -> int | None:
    """Upsert (or insert where absent) into a stored table; returns the rows that are new in it, if they are to be counted.

    With an order, what comes late replaces no stored row that is later in it. Loading the same rows again changes nothing.
    """
    spark = new.sparkSession
    if order is not None:
        new = merge.newest(new, keys, order)
    if not exists(spark, path):
        new.write.parquet(path)
        return spark.read.parquet(path).count() if count else None
    old = spark.read.parquet(path)
    before = old.count() if count else 0
    replace(merge.upsert(old, new, keys, order if order in old.columns else None) if update else merge.insert_if_absent(old, new, keys, order), path)
    return spark.read.parquet(path).count() - before if count else None


def upload(files: DataFrame, root: str, kind: str = "type", name: str = "filename", content: str = "content") -> DataFrame:
    """Write each row's bytes as a file raw/<type>/<filename>; the rows, without the bytes, with the URL that the file has then.

    Tasks write below a folder of the attempt; once all are written, that folder becomes raw/<upload>, by one rename: all or none.
    """
    spark = files.sparkSession
    base, fresh = root.rstrip("/"), uuid.uuid4().hex
    staged, index = f"{base}/.raw-{fresh}", f"{base}/.index-{fresh}"
    columns = [c for c in files.columns if c != content]
    rows = files.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.concat_ws("/", F.col(kind), F.col(name)).alias("path"), F.col(content).cast("binary").alias("content"))
    put = rows.columns[:-1]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                system, at = pyarrow.fs.FileSystem.from_uri(f"{staged}/{place}" if ":" in staged else f"file://{staged}/{place}")
                system.create_dir(at.rpartition("/")[0])
                own = f"{at}.{uuid.uuid4().hex}"  # an attempt's own file until it is whole
                with system.open_output_stream(own) as out:
                    out.write(data.as_py() or b"")
                system.move(own, at)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in put], put)

    # the rows are made once: what the tasks wrote is the index
    rows.mapInArrow(write, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])).write.parquet(index)
    told = spark.read.parquet(index)
    fs = _fs(spark, base)[1]
    if told.groupBy("path").count().filter("count > 1").limit(1).count():
        for p in (staged, index):
            fs.delete(_fs(spark, p)[0], True)
        raise ValueError("two files of one type have the same name")
    fs.mkdirs(_fs(spark, f"{base}/raw")[0])
    target = _fs(spark, f"{base}/raw/{fresh}")[0]
    if fs.exists(_fs(spark, staged)[0]) and not fs.rename(_fs(spark, staged)[0], target):
        raise OSError(f"{staged} can't become {base}/raw/{fresh}")
    return told.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], F.concat(F.lit(f"{base}/raw/{fresh}/"), F.col("path")).alias("raw_file_url"))


def by_place(files: DataFrame, root: str, place: str) -> None:
    """Candidate files below the slug of their place."""
    files.withColumn("slug", slug(F.col(place))).write.partitionBy("slug").mode("append").parquet(root)


def append_cache(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_cache(rows: DataFrame, path: str, key: str) -> None:
    """Replace a JSON cache, keys in order, by swap."""
    spark = rows.sparkSession
    new = f"{path}.new-{uuid.uuid4().hex}"
    rows.repartitionByRange(key).sortWithinPartitions(key).write.json(new)
    _swapped(spark, new, path)
