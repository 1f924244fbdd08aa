"""Exact substring deduplication with a logarithmic family of sparse suffix arrays.

A byte is removed where a `length`-byte string covers it that starts anywhere else too.

Indexed are not all suffixes but those at anchors: the positions that have the least hash of
their next 8 bytes in some window of about half the string's length. Which ones those are
depends on the windows' bytes alone, so every repeated string holds an anchor, with its next
CORE bytes, at the same place in all its copies. A suffix's key is its first 8 bytes and a hash
of its CORE bytes; its context is what any repeated string around the anchor can hold.

1. Each batch of documents gets a suffix array: the documents and positions of its suffixes in the
   order of their keys, over all its files. It is merge-joined with the existing levels for keys
   that both have. Before the next batch comes, levels that cover equally many batches are merged
   into one array, so there are log2(batches) levels; a family can be left and opened again.
2. Equal contexts cover all of them. Where a key has different contexts, their bytes are cut
   from the texts and brought together by key. Sorted by the bytes to the right of the core,
   and by those to the left, neighbours' common lengths tell which contexts agree on how much:
   a string around an anchor is given by its bytes left of it (delta), and contexts agree for a
   delta that are in one run of either order.
3. A key with more contexts than a task should hold is settled by hashes: ranges of delta are
   bisected; contexts equal over all that the strings of a range take are merged and settled,
   ranges in which two or more contexts stay that agree on what all its strings take are cut up.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon.llm.common import SLICE_BYTES, SpanHash, byte_batches, dropped, mixed, released, row_slices, shared_path, text_buffers, written

GRAM = 8
SPLIT = 12
GROUP = 1 << 13
KEY, DOC = ["head", "tail"], ["u0", "u1"]


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Positions of the anchors of a buffer of texts."""
    n, window = len(data), length // 2 - 1
    if n < length:
        return np.zeros(0, np.int64)
    gram = np.zeros(n, np.uint64)
    padded = np.concatenate((data, np.zeros(GRAM, np.uint8))).astype(np.uint64)
    for k in range(GRAM):
        gram |= padded[k : n + k] << np.uint64(8 * k)
    rank = (mixed(gram) & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)  # ties: the first
    whole = np.full(-(-n // window) * window, np.iinfo(np.uint64).max)
    whole[:n] = rank
    blocks = whole.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - window + 1], ahead[window - 1 : n])
    # a string starts where its text has `length` bytes left
    inside = np.zeros(n + 1, np.int64)
    fits = offsets[1:] - offsets[:-1] >= length
    np.add.at(inside, offsets[:-1][fits], 1)
    np.add.at(inside, offsets[1:][fits] - length + 1, -1)
    least = least[: len(inside)][np.cumsum(inside)[: len(least)] > 0]
    least = least[np.concatenate(([True], least[1:] != least[:-1]))] if len(least) else least
    return np.unique((least & np.uint64(0xFFFFFFFF)).astype(np.int64))


def _cut(data: np.ndarray, offsets: np.ndarray, edge: int, piece: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, int]]:
    """(bytes, offsets, bytes before, from, to) of a buffer; a single long text comes in pieces with `edge` bytes around from..to."""
    if len(offsets) > 2 or len(data) <= 2 * piece:
        yield data, offsets, 0, 0, len(data)
        return
    for lo in range(0, len(data), piece):
        a, b = max(lo - edge, 0), min(lo + piece + edge, len(data))
        yield data[a:b], np.array([0, b - a]), a, lo - a, min(lo + piece, len(data)) - a


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with u0 and u1, 128 bits that are equal for rows of equal id and text only."""
    i, t = F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")
    return docs.select(F.xxhash64(i, t).alias("u0"), F.xxhash64(F.lit(1), t, i).alias("u1"), t.alias("text"))


def anchor_table(docs: DataFrame, lengths: tuple[int, ...], id_col: str = "doc_id", text_col: str = "text", piece: int = SLICE_BYTES) -> DataFrame:
    """(u0, u1, pos, head, tail, ctx) of each anchor of the shortest length; contexts are those of the longest."""
    short, most = min(lengths), max(lengths)
    window, core = short // 2 - 1, short - (short // 2 - 1)
    names = ["u0", "u1", "pos", "head", "tail", "ctx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for lo, _, whole, bounds in text_buffers(batch.column(2), piece):
                total = np.diff(bounds)
                for data, offsets, before, first, last in _cut(whole, bounds, most + 2 * short, piece):
                    at = anchors_of(data, offsets, short)
                    at = at[(at >= first) & (at < last)]
                    owner = np.searchsorted(offsets, at, side="right") - 1
                    pos, size = at - offsets[owner] + before, total[owner]
                    spans = SpanHash(data)
                    head = np.zeros(len(at), np.uint64)
                    for k in range(8):
                        head = (head << np.uint64(8)) | data[at + k].astype(np.uint64)
                    left, right = np.minimum(pos, window), np.minimum(size - pos, most)
                    ctx = mixed(spans.of(at - left, at + right) + mixed((left * (most + 1) + right).astype(np.uint64)))
                    tail = spans.of(at, at + core)
                    longs = [ids[0][lo + owner], ids[1][lo + owner], pos, (head ^ np.uint64(1 << 63)).view(np.int64), tail.view(np.int64), ctx.view(np.int64)]  # heads order as their bytes
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64, copy=False)) for x in longs], names)

    byte_batches(docs.sparkSession)
    return _identified(docs, id_col, text_col).mapInArrow(run, ", ".join(f"{c} long" for c in names))


class IndexFamily:
    """Levels of merged suffix arrays below a path; add() takes a batch in and says which of its keys match.

    A level's folder is named by the batches it covers. A merged level is complete before those
    that it replaces go, and opening drops what a broken run left over.
    """

    COLUMNS = ("head", "tail", "ctx", "u0", "u1", "pos")
    SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or shared_path(spark, "family")
        self.levels: list[tuple[int, int]] = []  # first and last batch, oldest first
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(self.path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(root):
            for entry in files.listStatus(root):
                if not (m := re.fullmatch(r"level-(\d+)-(\d+)", entry.getPath().getName())):
                    continue
                if files.exists(hadoop(f"{self.path}/{m[0]}/_SUCCESS")):
                    self.levels.append((int(m[1]), int(m[2])))
                else:
                    files.delete(entry.getPath(), True)
            inner = [x for x in self.levels if any(x != y and y[0] <= x[0] and x[1] <= y[1] for y in self.levels)]
            for x in inner:
                dropped(spark, self._name(x))
            self.levels = sorted(x for x in self.levels if x not in inner)

    def _name(self, level: tuple[int, int]) -> str:
        return f"{self.path}/level-{level[0]:06}-{level[1]:06}"

    def _write(self, suffixes: DataFrame, level: tuple[int, int]) -> None:
        # a range holds rows of one suffix apart by document, so a suffix that very many share is no task of its own
        ordered = suffixes.select(*self.COLUMNS).repartitionByRange("head", "tail", "ctx", "u0").sortWithinPartitions("head", "tail", "ctx", "u0", "u1", "pos")
        ordered.write.option("compression", "zstd").parquet(self._name(level))
        self.levels.append(level)

    def _read(self, level: tuple[int, int]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self._name(level))

    def arrays(self) -> DataFrame:
        """The rows of all levels."""
        out = self._read(self.levels[0]) if self.levels else self.spark.createDataFrame([], self.SCHEMA)
        for level in self.levels[1:]:
            out = out.unionByName(self._read(level))
        return out

    def _merge(self) -> None:
        """Merge the newest levels while they are of one size."""
        size = lambda x: x[1] - x[0] + 1
        while len(self.levels) > 1 and size(self.levels[-1]) == size(self.levels[-2]):
            b, a = self.levels.pop(), self.levels.pop()
            self._write(self._read(a).unionByName(self._read(b)), (a[0], b[1]))
            dropped(self.spark, self._name(a))
            dropped(self.spark, self._name(b))

    def add(self, suffixes: DataFrame) -> DataFrame:
        """(head, tail) of the batch's keys that occur twice or more in it, or in a level too; keys may repeat."""
        self._merge()
        at = self.levels[-1][1] + 1 if self.levels else 0
        older = list(self.levels)
        self._write(suffixes, (at, at))
        batch = self._read((at, at)).select(*KEY)
        found = batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*KEY)
        for level in older:
            found = found.unionByName(batch.join(self._read(level).select(*KEY), KEY, "left_semi"))
        return found

    def drop(self) -> None:
        dropped(self.spark, self.path)
        self.levels = []


def _spans(pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of byte ranges as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pieces):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


_RANGE = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _contexts(rows: DataFrame, open_: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """The bytes of the contexts in open_ (u0, u1, pos, head, tail, many, classes): left of the anchor, backwards, and right of the core."""
    short, most = min(lengths), max(lengths)
    window, core = short // 2 - 1, short - (short // 2 - 1)
    wanted = open_.groupBy(*DOC).agg(F.collect_list(F.struct("pos", "head", "tail", "many", "classes")).alias("at"))
    wanted = rows.join(wanted, DOC).select("u0", "u1", "text", "at")
    names = ["u0", "u1", "pos", "head", "tail", "many", "classes", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 64):
            lists = batch.column(3)
            flat, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(batch.num_rows), per)
            texts = [(x.as_py() or "").encode() for x in batch.column(2)]
            pos = flat.field("pos").to_numpy()
            left = [texts[d][max(p - window, 0) : p][::-1] for d, p in zip(doc.tolist(), pos.tolist(), strict=True)]
            right = [texts[d][p + core : p + most] for d, p in zip(doc.tolist(), pos.tolist(), strict=True)]
            ids = [pa.array(batch.column(i).to_numpy()[doc]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, flat.field("pos"), *[flat.field(c) for c in ("head", "tail", "many", "classes")], pa.array(left, pa.binary()), pa.array(right, pa.binary())], names)

    return wanted.mapInArrow(run, "u0 long, u1 long, pos long, head long, tail long, many boolean, classes long, left binary, right binary")


def _padded(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows of a matrix, padded with zeros, and their lengths."""
    size = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    data = np.frombuffer(column.buffers()[2], np.uint8)[start : start + size.sum()] if column.buffers()[2] else np.zeros(0, np.uint8)
    out = np.zeros((len(column), width), np.uint8)
    out[np.arange(width)[None, :] < size[:, None]] = data
    return out, size.astype(np.int64)


def _in_order(group: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by group and string, the length that each has in common with the one before (-1: another group), and the most that it shares with a neighbour."""
    m, width = strings.shape
    keyed = np.concatenate((group.astype(">u8").view(np.uint8).reshape(m, 8), strings, np.ones((m, 1), np.uint8)), axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{width + 9}").ravel(), kind="stable")
    rows, same = strings[order], np.full(m, -1)
    apart = rows[1:] != rows[:-1]
    same[1:] = np.where(apart.any(axis=1), apart.argmax(axis=1) if width else 0, width)
    same[1:][group[order][1:] != group[order][:-1]] = -1
    most = np.empty(m, np.int64)
    most[order] = np.maximum(same, np.append(same[1:], -1))
    return order, same, most


def agreeing(group: np.ndarray, left: pa.Array, right: pa.Array, length: int, window: int, core: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, least and greatest delta) of the contexts that agree with another one of their group on a string of `length` bytes.

    left (backwards) and right are the bytes around the core; a string has delta bytes of left,
    the core, and the rest of right.
    """
    lefts, nl = _padded(left, window)
    rights, nr = _padded(right, most - core)
    lorder, lsame, lmost = _in_order(group, lefts)
    rorder, rsame, rmost = _in_order(group, rights)
    lo, hi = np.maximum(length - core - np.minimum(rmost, nr), 0), np.minimum(np.minimum(lmost, nl), window)
    m = len(group)
    first, last = np.full(m, -1), np.full(m, -1)
    lclass, rclass = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(window + 1):
        some = np.flatnonzero((lo <= d) & (d <= hi) & (lmost >= 0))
        if len(some) < 2:
            continue
        lclass[lorder] = np.cumsum(lsame < d)
        rclass[rorder] = np.cumsum(rsame < length - core - d)
        both = lclass[some] * (m + 1) + rclass[some]
        rank = np.argsort(both, kind="stable")
        equal = both[rank][1:] == both[rank][:-1]
        hit = np.zeros(len(some), bool)
        hit[rank[1:][equal]] = True
        hit[rank[:-1][equal]] = True
        found = some[hit]
        last[found] = d
        first[found] = np.where(first[found] < 0, d, first[found])
    at = np.flatnonzero(first >= 0)
    return at, first[at], last[at]


def _solved(contexts: DataFrame, lengths: tuple[int, ...], group: int) -> DataFrame:
    """(u0, u1, length, a, b): byte ranges that different contexts of a key have in common; keys are sorted and whole in a partition."""
    short, most = min(lengths), max(lengths)
    window, core = short // 2 - 1, short - (short // 2 - 1)
    names = ["u0", "u1", "length", "a", "b"]

    def settled(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        ids = [rows.column(c).to_numpy() for c in ("head", "tail", "u0", "u1", "pos")]
        order = np.lexsort(ids[::-1])  # a row that was there twice is one context
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([x[order][1:] != x[order][:-1] for x in ids], axis=0)
        rows = rows.take(pa.array(order[fresh])).combine_chunks()
        head, tail, u0, u1, pos = (x[order][fresh] for x in ids)
        new = np.ones(len(head), np.int64)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        one = rows.to_batches()[0]
        alone = ~one.column(names_in.index("many")).to_numpy(zero_copy_only=False)
        for length in lengths:
            at, least, greatest = agreeing(np.cumsum(new), one.column(names_in.index("left")), one.column(names_in.index("right")), length, window, core, most)
            wanted = alone[at]  # those that occur as a whole more than once are covered anyhow
            at, least, greatest = at[wanted], least[wanted], greatest[wanted]
            found = [u0[at], u1[at], np.full(len(at), length), pos[at] - greatest, pos[at] - least + length]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found], names)

    names_in = contexts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in row_slices(batches, group):
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held.num_rows < group:
                continue
            head, tail = held.column("head").to_numpy(), held.column("tail").to_numpy()
            more = np.flatnonzero((head != head[-1]) | (tail != tail[-1]))
            whole = int(more[-1]) + 1 if len(more) else 0  # the last key may go on
            if whole:
                yield from settled(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from settled(held)

    return contexts.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _bisected(contexts: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """What _solved() returns, for keys of any number of contexts, in as many rounds as halving by SPLIT takes.

    Rounds pass on hashes and context numbers only; the bytes stay in one stored table.
    """
    short = min(lengths)
    window, core = short // 2 - 1, short - (short // 2 - 1)
    spark = contexts.sparkSession
    kept: list[str] = []
    contexts = contexts.dropDuplicates(["u0", "u1", "pos"]).withColumn("cid", F.monotonically_increasing_id())
    contexts = written(contexts.select("cid", "u0", "u1", "pos", "head", "tail", "many", "left", "right"), "contexts", kept)
    code = window + 1  # a range d0..d1 of deltas of the i-th length is told as (i * code + d0) * code + d1
    nodes = contexts.select("cid", F.array(*[F.lit(i * code * code + window).cast("int") for i in range(len(lengths))]).alias("ranges"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda *x: hashlib.blake2b(b"".join(x), digest_size=16).digest()
        for batch in row_slices(batches):
            out: dict[str, list] = {"cid": [], "range": [], "need": [], "full": []}
            for cid, head, tail, left, right, ranges in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n = len(left)
                for r in ranges:
                    i, d0, d1 = r // (code * code), r // code % code, r % code
                    after = lengths[i] - core
                    step = -(-(d1 - d0 + 1) // SPLIT)
                    for a in range(d0, d1 + 1, step):
                        b = min(a + step - 1, d1)
                        if a > n or after - b > len(right):
                            continue
                        most_l, most_r = min(b, n), min(after - a, len(right))
                        out["cid"].append(cid)
                        out["range"].append((i * code + a) * code + b)
                        out["need"].append(digest(b"%d %d %d %d %d:" % (head, tail, i, a, b), left[:a], right[: after - b]))
                        out["full"].append(digest(b"%d %d %d %d %d %d %d:" % (head, tail, i, a, b, most_l, most_r), left[:most_l], right[:most_r]))
            kinds = {"cid": pa.int64(), "range": pa.int32(), "need": pa.binary(), "full": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in out.items()], list(out))

    width, covers = window + 1, None
    while True:
        width, scratch = -(-width // SPLIT), []
        rows = contexts.join(nodes, "cid").select("cid", "head", "tail", "left", "right", "ranges")
        parts = written(rows.mapInArrow(split, "cid long, range int, need binary, full binary"), "parts", scratch)
        # contexts equal over the range: they cover it, and the first of them stands for all
        classes = written(parts.groupBy("full").agg(F.count(F.lit(1)).alias("same"), F.min("cid").alias("cid"), F.min("need").alias("need"), F.min("range").alias("range")), "classes", scratch)
        cover = written(parts.join(classes.filter("same > 1").select("full"), "full", "left_semi").select("cid", "range"), "covers", kept)
        covers = cover if covers is None else covers.unionByName(cover)
        if width == 1:
            kept += scratch
            break  # the ranges are single deltas: agreeing contexts are equal
        # what others take part of goes on: two or more classes that agree on what all the range's strings take
        needs = classes.groupBy("need").agg(F.min("full").alias("f0"), F.max("full").alias("f1")).filter("f0 != f1").select("need")
        needs = written(needs, "needs", scratch)
        nodes = written(classes.join(needs, "need", "left_semi").groupBy("cid").agg(F.collect_list("range").alias("ranges")), "nodes", kept)
        for path in scratch:
            dropped(spark, path)
    # a context's strings all hold its anchor: what they cover is one run
    d0, d1, length = F.expr(f"range div {code} % {code}"), F.col("range") % code, F.element_at(F.array(*map(F.lit, lengths)), (F.expr(f"range div {code * code}") + 1).cast("int"))
    covers = covers.groupBy("cid", length.alias("length")).agg(F.min(d0).alias("d0"), F.max(d1).alias("d1"))
    told = contexts.filter("not many").select("u0", "u1", "pos", F.length("left").alias("l"), F.length("right").alias("r"), "cid").join(covers, "cid")
    length = F.col("length")
    after = length - core
    a, b = F.col("pos") - F.least("d1", "l"), F.col("pos") - F.greatest("d0", after - F.col("r")) + length
    found = told.select("u0", "u1", length.cast("long").alias("length"), a.cast("long").alias("a"), b.cast("long").alias("b")).filter("b - a >= length").distinct()
    found = written(found, "agreeing")
    for path in kept:
        dropped(spark, path)
    released(spark)
    return found


def deduplicated(
    docs: DataFrame, length: int = 400, batches: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), also: int | None = None, group: int = GROUP,
) -> DataFrame:
    """id, n_bytes, kept (bytes), repaired, spans (removed runs as a, b), repeats and the `keep` columns of every row of docs.

    repaired is kept as text, without the parts of characters that a run cut in half; null for a
    null text. repeats are the runs covered by strings of `also` bytes that start elsewhere too; they stay
    (null without `also`).

    Null texts count as empty; texts shorter than `length` bytes stay whole; equal rows each keep
    their row, and lose all their bytes if long enough. Texts of any length are read whole. Columns of docs that are not kept are not
    read; a kept column that is called as a result ends in `_in`. Keys of up to `group` contexts are settled in one task.
    """
    lengths = tuple(sorted({length, also or length}))
    if lengths[0] < 32:
        raise ValueError("lengths must be 32 at least")
    spark = docs.sparkSession
    scratch: list[str] = []
    staged = shared_path(spark, "anchors")
    anchors = anchor_table(docs, lengths, id_col, text_col).withColumn("batch", F.pmod("u0", F.lit(batches)).cast("int"))
    anchors.write.partitionBy("batch").option("compression", "zstd").parquet(staged)
    anchors = spark.read.schema(f"{IndexFamily.SCHEMA}, batch int").parquet(staged)
    family, matched = IndexFamily(spark), None
    for i in range(batches):
        found = written(family.add(anchors.filter(F.col("batch") == i)), "matched", scratch)
        dropped(spark, f"{staged}/batch={i}")  # its suffixes are in the family now
        released(spark)
        matched = found if matched is None else matched.unionByName(found)
    # sides with a row per key are tables of their own: a join of two plain shuffles is one that Spark can split at hot keys
    keys = written(matched.distinct(), "keys", scratch)
    occurrences = written(family.arrays().join(keys, KEY, "left_semi"), "occurrences", scratch)
    family.drop()
    dropped(spark, staged)
    released(spark)
    # of the suffixes with one context any stands for all; its columns are of one row
    classes = occurrences.groupBy("head", "tail", "ctx").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("u0", "u1", "pos")])
    classes = written(classes, "classes", scratch)
    several = written(classes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1"), "several", scratch)
    equal = written(classes.filter("n > 1").select("head", "tail", "ctx"), "equal", scratch)
    later: list[str] = []
    whole = written(occurrences.join(equal, ["head", "tail", "ctx"], "left_semi").groupBy(*DOC).agg(F.collect_set("pos").alias("whole")), "whole", later)
    open_ = classes.join(several, KEY).select("u0", "u1", "pos", "head", "tail", (F.col("n") > 1).alias("many"), "classes")
    rows = _identified(docs, id_col, text_col)
    contexts = written(_contexts(rows, open_, lengths), "contexts", later)
    for path in scratch:
        dropped(spark, path)
    released(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = contexts.filter(F.col("classes") <= group).repartition(n, *KEY).sortWithinPartitions(*KEY)
    found = written(_solved(small, lengths, group), "agreeing", later)
    large = contexts.filter(F.col("classes") > group)
    if large.limit(1).count():
        found = found.unionByName(_bisected(large, lengths))
    marks = found.groupBy(*DOC).agg(F.collect_set(F.struct("length", "a", "b")).alias("parts"))
    marks = written(marks.join(whole, DOC, "full").select("u0", "u1", "whole", "parts"), "marks")
    for path in later:
        dropped(spark, path)
    released(spark)
    return _finished(docs, marks, lengths, length, also, id_col, text_col, keep)


def _finished(docs: DataFrame, marks: DataFrame, lengths: tuple[int, ...], length: int, also: int | None, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """The texts without what the marks cover."""
    window, most = min(lengths) // 2 - 1, max(lengths)
    results = ("id", "n_bytes", "kept", "repaired", "spans", "repeats")
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rest = F.struct(*[F.col(f"`{c}`").alias(f"k{j}") for j, c in enumerate(keep)]) if keep else F.lit(None).cast("string")
    rows = docs.select(i.alias("id"), F.xxhash64(i.cast("string"), t).alias("u0"), F.xxhash64(F.lit(1), t, i.cast("string")).alias("u1"), t.alias("text"), rest.alias("rest"))
    rows = rows.join(marks, DOC, "left").select("id", "rest", "text", "whole", "parts")
    ranges = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("repaired", T.StringType()), T.StructField("spans", ranges), T.StructField("repeats", ranges)])

    def covered(n: int, whole: list[int], parts: list[dict], size: int) -> list[tuple[int, int]]:
        pieces = [(x["a"], x["b"]) for x in parts if x["length"] == size]
        for p in whole:  # an anchor whose whole context occurs elsewhere too
            left, least = min(p, window), max(size - min(n - p, most), 0)
            if least <= left:
                pieces.append((p - left, p - least + size))
        return _spans(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 256):
            sizes, kept, repaired, spans, repeats = [], [], [], [], []
            for text, whole, parts in zip(batch.column("text"), batch.column("whole"), batch.column("parts"), strict=True):
                whole, parts, raw = whole.as_py() or [], parts.as_py() or [], text.as_py()
                data = (raw or "").encode()
                cut = covered(len(data), whole, parts, length) if whole or parts else []
                left = _kept(data, cut) if cut else data
                sizes.append(len(data))
                kept.append(left)
                repaired.append(raw if not cut else left.decode(errors="ignore"))
                spans.append([{"a": a, "b": b} for a, b in cut])
                repeats.append(None if also is None else [{"a": a, "b": b} for a, b in covered(len(data), whole, parts, also)])
            out = [pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(repaired, pa.string()), pa.array(spans, pa.list_(_RANGE)), pa.array(repeats, pa.list_(_RANGE))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *out], schema.names)

    out = rows.mapInArrow(run, schema)
    return out.select(*results, *[F.col(f"rest.k{j}").alias(f"{c}_in" if c in results else c) for j, c in enumerate(keep)])
