"""SimHash near-duplicates by pigeonhole blocks.

Fingerprints within `distance` bits that are cut into `blocks` blocks agree on at least
blocks - distance of them, so close pairs share a key made of that many blocks. Equal
fingerprints are merged first; keys with many fingerprints are tiled, so that a task holds
two tiles at most, and a task hands on one link per fingerprint (a spanning forest of its
close pairs), never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import _SPACE, byte_batches, dropped, labels_of, text_buffers, word_spans, written
from quillon.llm.components import components

SEED = 42
TILE = 512
PIECE = 1 << 16
# Keys of two of six blocks have 21 bits: few fingerprints of 10**9 share one by chance. Beyond, take 8 blocks (70 keys of 32 bits).
BLOCKS = 6
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles_of(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text of a buffer, in order, and how many each text has."""
    texts = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    lengths = ends - starts
    keep = ~_SPACE[data]
    after = ends[ends < len(data)]
    keep[after] |= _SPACE[data[after]]  # one separator after a word, if its text goes on
    owner = np.repeat(np.arange(texts), np.diff(first))
    lead = after[np.isin(after, offsets)]  # white space that opens the next text separates nothing
    keep[lead[_SPACE[data[lead]]]] = False
    flat = _LOWER[data]
    flat[_SPACE[data]] = 32
    flat = flat[keep].tobytes()
    at = np.cumsum(keep)[starts] - 1
    count = np.diff(first)
    shingles = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    begin = np.repeat(first[:-1], shingles) + (np.arange(shingles.sum()) - np.repeat(np.cumsum(shingles) - shingles, shingles))
    last = np.minimum(begin + words, first[1:][owner[begin]]) - 1
    digest = xxhash.xxh64_intdigest
    s, e = at[begin], at[last] + lengths[last]
    hashes = np.empty(len(s), np.uint64)
    for lo in range(0, len(s), PIECE):
        part = slice(lo, lo + PIECE)
        hashes[part] = np.fromiter((digest(flat[x:y], SEED) for x, y in zip(s[part].tolist(), e[part].tolist(), strict=True)), np.uint64, len(s[part]))
    return hashes, shingles


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    """The 64-bit SimHash of each text of a buffer over its word shingles."""
    return majority_of(*shingles_of(data, offsets, words))


def majority_of(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The bits set in over half the hashes of each text, whose numbers of hashes are `shingles`."""
    out = np.zeros(len(shingles), np.uint64)
    if not len(hashes):
        return out
    some = np.flatnonzero(shingles)
    ends = np.cumsum(shingles)[some]
    set_in = np.zeros((len(some), 64), np.int64)
    for lo in range(0, len(hashes), PIECE):
        bits = np.unpackbits(hashes[lo : lo + PIECE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        a, b = int(np.searchsorted(ends, lo, side="right")), int(np.searchsorted(ends, lo + len(bits))) + 1  # texts with shingles in the piece
        set_in[a:b] += np.add.reduceat(bits, np.maximum(ends[a:b] - shingles[some[a:b]] - lo, 0), axis=0, dtype=np.int64)
    major = (2 * set_in > shingles[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(major, axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8").ravel()
    return out


def fingerprinted(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, uid and fp (the fingerprint's bits as a signed long) of each row; no words: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_buffers(batch.column(2)):
                fp = fingerprints_of(data, offsets, words).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(fp)], ["id", "uid", "fp"])

    byte_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), uid_of(id_col, text_col).alias("uid"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, uid struct<u0:long,u1:long>, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """The bits of each key: all choices of blocks - distance of the blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(masks, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def close_links(fps: DataFrame, distance: int = 4, blocks: int = BLOCKS, tile: int = TILE, scratch: list[str] | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join the same ones as all pairs within `distance` bits do."""
    if blocks <= distance:
        raise ValueError("blocks must be more than distance")
    masks = block_masks(blocks, distance)
    keys = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for i, m in enumerate(masks)])
    rows = fps.select("fp", F.explode(keys).alias("k")).select(F.xxhash64("k.m", "k.v").alias("key"), "fp")
    # a row per key, as a table of its own: Spark can split the other side at a hot key
    sizes = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "block-keys", scratch)
    rows = rows.join(sizes, "key")
    # tiles of a large key: each fingerprint belongs to one and meets the others in the cells (i, j)
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    rows = rows.withColumn("tiles", tiles).withColumn("own", own)
    rows = rows.select("fp", "key", "own", F.explode(cells).alias("c")).select("fp", F.xxhash64("key", "c.i", "c.j").alias("cell"))
    n = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.repartition(n, "cell").sortWithinPartitions("cell")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cell, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            cell = np.concatenate((held_cell, batch.column(1).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((held_fp, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            whole = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0  # the last cell may go on
            held_cell, held_fp = cell[whole:], fp[whole:]
            yield from forest(cell[:whole], fp[:whole])
        yield from forest(held_cell, held_fp)

    def forest(cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(cell) < 2:
            return
        cuts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        a, b = [], []
        sizes = np.diff(cuts)
        big = sizes > 64
        left = np.repeat(sizes, sizes) - (np.arange(len(cell)) - np.repeat(cuts[:-1], sizes))
        small = np.where(np.repeat(big, sizes), 0, left)
        active = np.flatnonzero(small > 1)
        step = 1
        while len(active):
            near = np.bitwise_count(fp[active] ^ fp[active + step]) <= distance
            a.append(active[near])
            b.append(active[near] + step)
            step += 1
            active = active[small[active] > step]
        for g in np.flatnonzero(big).tolist():
            todo = np.arange(cuts[g], cuts[g + 1])
            while len(todo):
                front, todo = todo[:1], todo[1:]
                while len(front) and len(todo):
                    x, front = front[0], front[1:]
                    near = np.bitwise_count(fp[todo] ^ fp[x]) <= distance
                    b.append(todo[near])
                    a.append(np.full(int(near.sum()), x))
                    front, todo = np.concatenate((front, todo[near])), todo[~near]
        a, b = np.concatenate(a) if a else np.zeros(0, int), np.concatenate(b) if b else np.zeros(0, int)
        if not len(a):
            return
        values, at = np.unique(fp[np.concatenate((a, b))], return_inverse=True)
        root = labels_of(len(values), at[: len(a)], at[len(a) :])
        moved = np.flatnonzero(root != np.arange(len(values)))
        yield pa.RecordBatch.from_arrays([pa.array(values[moved].view(np.int64)), pa.array(values[root[moved]].view(np.int64))], ["a", "b"])

    return rows.mapInArrow(link, "a long, b long")


def uid_of(id_col: str, text_col: str) -> Column:
    """128 bits that are equal for rows of equal id and text only."""
    i, t = F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")
    return F.struct(F.xxhash64(i, t).alias("u0"), F.xxhash64(F.lit(1), t, i).alias("u1"))


def grouped(docs: DataFrame, words: int = 4, distance: int = 4, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, uid, fp, root (the component's least fingerprint) and component_id of each row."""
    spark, scratch = docs.sparkSession, []
    rows = written(fingerprinted(docs, words, id_col, text_col), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct", scratch)
    roots = components(close_links(fps.select("fp"), distance, blocks, scratch=scratch), "a", "b").withColumnRenamed("node", "fp")
    linked = written(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "linked", scratch)
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "least", scratch)
    named = written(linked.join(least, "root").select("fp", "root", "component_id"), "components")
    for path in scratch:
        dropped(spark, path)
    return rows.join(named, "fp")


def near_duplicates(
    docs: DataFrame, words: int = 4, distance: int = 4, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id_col, fingerprint (16 hex digits) and component_id (smallest id reachable over close fingerprints) of each row.

    Null, empty and blank texts have fingerprint 0 and link like others. Rows with equal ids
    each keep a row; a null id is never a component's id unless all its ids are null. Extra
    columns of docs are not read.
    """
    out = grouped(docs, words, distance, blocks, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 4, distance: int = 4, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of the smallest id of each component, with docs' columns; a null id stands last, and of equal rows one stays."""
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "uid")).alias("first")
    return chosen(docs, grouped(docs, words, distance, blocks, id_col, text_col).groupBy("root").agg(first).select("first.uid"), id_col, text_col)


def chosen(docs: DataFrame, uids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs, one of equal ones each, whose uid_of is in uids; columns of docs may have any names."""
    inner = docs.select(uid_of(id_col, text_col).alias("uid"), F.struct("*").alias("row"))
    rows = inner.join(uids, "uid", "left_semi").dropDuplicates(["uid"])
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
