"""What the operators share: stored intermediate tables, distributed ranks, Arrow text buffers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 512 << 10
BATCH_BYTES = 4 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where that is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
        if not root:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir is unset: executors need a folder that they share")
            root = f"file://{tempfile.mkdtemp(prefix='quillon-')}"
            sc.setCheckpointDir(root)
    return root if ":" in root else f"file://{root}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """The same, created."""
    path = shared_path(spark, name)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def stored(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the shared folder, so a lost executor costs a reread only."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """As stored(), but as Parquet, which keeps columns apart and is smaller; the path goes to `scratch` for a later dropped()."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if scratch is not None:
        scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_batches(spark: SparkSession) -> None:
    """Where the session sets no limit itself, Arrow batches hold BATCH_BYTES or one row, so rows of long texts don't come by the thousand."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def n_words(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, group: list[str], order: list[Column], size: str, out: str, cells: int = 64) -> DataFrame:
    """Add `out`: the sum of `size` over the rows of the same group that come before this one.

    The order inside a group is a hash of `order`, then `order` itself. A group of any size is
    split into cells x cells parts by that hash; sums of parts are added up over two short
    windows, so no task holds more than one part's rows and no window more than `cells` sums.
    Rows that are equal in group, order and size are interchangeable. Group columns hold no nulls.
    """
    hashed = df.withColumn("__h", F.xxhash64(*order))
    parts = hashed.withColumn("__hi", F.pmod(F.shiftrightunsigned("__h", 40), F.lit(cells)).cast("int")).withColumn(
        "__lo", F.pmod(F.shiftrightunsigned("__h", 20), F.lit(cells)).cast("int")
    )
    sums = parts.groupBy(*group, "__hi", "__lo").agg(F.sum(size).alias("__n"))

    def before(by: list[str], o: str) -> Column:
        return F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    his = sums.groupBy(*group, "__hi").agg(F.sum("__n").alias("__n")).select(*group, "__hi", before(group, "__hi").alias("__a"))
    los = sums.select(*group, "__hi", "__lo", before([*group, "__hi"], "__lo").alias("__b"))
    offsets = los.join(his, [*group, "__hi"]).select(*group, "__hi", "__lo", (F.col("__a") + F.col("__b")).alias("__off"))
    w = Window.partitionBy(*group, "__hi", "__lo").orderBy("__h", *order).rowsBetween(Window.unboundedPreceding, -1)
    inside = parts.withColumn("__in", F.coalesce(F.sum(size).over(w), F.lit(0)))
    found = inside.join(offsets, [*group, "__hi", "__lo"]).withColumn(out, F.col("__off") + F.col("__in"))
    return found.select(*df.columns, out)


def text_buffers(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about `limit` bytes; nulls are empty.

    A longer text makes a run of its own: texts are never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows, so that what a step makes of one stays small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


_LOWER_CODE = np.arange(256, dtype=np.uint8)  # letters in lower case, other ASCII as 0
_LOWER_CODE[65:91] += 32
_LOWER_CODE[[*range(65), *range(91, 97), *range(123, 128)]] = 0
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240117).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * _C1
    x = x ^ (x >> np.uint64(33))
    x = x * _C2
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, np.uint64(base))
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


class SpanHash:
    """64-bit hashes of any byte spans of one buffer, from one pass over it."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * powers(_BASE, n), out=self.sums[1:])
        self.back = powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of every text, and for each text the index of its first word (one more at the end)."""
    n = len(data)
    word = ~_SPACE[data]
    before = np.empty(n, bool)
    before[1:] = word[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    if n:
        before[0] = False
    before[firsts] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, bool)
    if n:
        after[:-1] = word[1:]
        after[-1] = False
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over each text's bytes."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def again(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.concatenate(([True], twice[1:] != twice[:-1]))]
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b: the smallest node of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs: it does so once the driver has collected their plans."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
