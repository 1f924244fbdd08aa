"""Near-duplicates by the Jaccard similarity of word shingles: SimHash and MinHash candidates, exact check.

Pigeonhole blocks of SimHash fingerprints name all sets within four bits as candidates, bands of minima of hashed shingles
those further apart; what either links is one cluster. Each
distinct shingle set goes to its cluster once (to the cells of its tile, where the cluster is
large), where sets are compared exactly; a task hands on a spanning forest of the close pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import byte_batches, dropped, labels_of, mixed, text_buffers, written
from quillon.llm.components import components
from quillon.llm.simhash import chosen, majority_of, shingles_of, uid_of
from quillon.llm.simhash import close_links as near_fingerprints

# 28 bands of 6 minima: a pair of similarity 0.8 shares a band with probability 0.9998, one of 0.5 with 0.36, one of 0.3 with 0.02.
BANDS, ROWS = 28, 6
TILE = 512
_RNG = np.random.default_rng(42)
_FLIP = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text of a buffer, ascending, and how many each text has."""
    hashes, sizes = shingles_of(data, offsets, words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(sizes))


def set_ids(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty one."""
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = mixed(np.add.reduceat(mixed(hashes), (np.cumsum(sizes) - sizes)[some]) + sizes[some].astype(np.uint64))
    return out


def bands_of(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """BANDS keys of each set that is not empty, a row a set."""
    cuts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(cuts), BANDS), np.uint64)
    if len(cuts):
        for band in range(BANDS):
            key = np.full(len(cuts), np.uint64(band))
            for k in range(band * ROWS, band * ROWS + ROWS):
                x = (hashes ^ _FLIP[k]) * _ODD[k]
                key = mixed(key * np.uint64(0x100000001B3) + np.minimum.reduceat((x ^ (x >> np.uint64(32))) * _ODD[k - 1], cuts))
            out[:, band] = key
    return out


def sketched(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """id, uid, sid and fp (id and SimHash of its shingle set) and keys (of its bands; none without words) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_buffers(batch.column(2)):
                hashes, sizes = sets_of(data, offsets, words)
                ends = np.concatenate(([0], np.cumsum((sizes > 0) * BANDS))).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands_of(hashes, sizes).ravel().view(np.int64)))
                sid = pa.array(set_ids(hashes, sizes).view(np.int64))
                fp = pa.array(majority_of(hashes, sizes).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), sid, fp, keys], ["id", "uid", "sid", "fp", "keys"])

    source = docs.select(F.col(id_col).alias("id"), uid_of(id_col, text_col).alias("uid"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, uid struct<u0:long,u1:long>, sid long, fp long, keys array<long>")


def block_links(sets: DataFrame, scratch: list[str]) -> DataFrame:
    """(sid, head) links that join all sets (sid, fp) whose fingerprints, by pigeonhole blocks, lie within four bits of each other."""
    fps = written(sets.groupBy("fp").agg(F.min("sid").alias("head")), "fingerprints", scratch)
    close = near_fingerprints(fps.select("fp"), scratch=scratch)
    a, b = fps.select(F.col("fp").alias("a"), F.col("head").alias("sid")), fps.select(F.col("fp").alias("b"), "head")
    return close.join(a, "a").join(b, "b").select("sid", "head").unionByName(sets.join(fps, "fp").filter("sid != head").select("sid", "head"))


def forest(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between the sets that join the same ones as all pairs with a similarity of at least `least` do."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    _, first, count = np.unique(values, return_index=True, return_counts=True)
    # the sets that hold each shingle lie side by side
    runs = [[] for _ in sets]
    for f, c in zip(first[count > 1].tolist(), count[count > 1].tolist(), strict=True):
        for o in owner[f : f + c].tolist():
            runs[o].append((f, f + c))
    left = np.ones(len(sets), bool)
    a, b = [], []
    for start in range(len(sets)):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            x = front.pop()
            if not runs[x]:
                continue
            shared = np.bincount(np.concatenate([owner[f:t] for f, t in runs[x]]), minlength=len(sets))
            near = np.flatnonzero(left & (shared >= least * (sizes + sizes[x] - shared) - 1e-9) & (shared > 0))
            left[near] = False
            front += near.tolist()
            a += [x] * len(near)
            b += near.tolist()
    return np.array(a, int), np.array(b, int)


def close_links(members: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between sets of one cell; members are cell, sid and shingles, cells sorted and whole in a partition."""

    def linked(sid: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(sid) > 1:
            a, b = forest(sets, least)
            if len(a):
                root = labels_of(len(sid), a, b)
                moved = np.flatnonzero(root != np.arange(len(sid)))
                ids = np.array(sid, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sid, sets = None, [], []
        for batch in batches:
            for c, s, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if c != cell:
                    yield from linked(sid, sets)
                    cell, sid, sets = c, [], []
                sid.append(s)
                sets.append(np.frombuffer(raw.as_py(), np.uint64))
        yield from linked(sid, sets)

    return members.mapInArrow(run, "a long, b long")


def with_sets(docs: DataFrame, words: int) -> DataFrame:
    """The columns of docs, whose last one is a text, with the text's shingle set as bytes in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_buffers(batch.column(batch.num_columns - 1)):
                hashes, sizes = sets_of(data, offsets, words)
                cuts = np.concatenate(([0], np.cumsum(sizes))).tolist()
                sets = pa.array([hashes[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)], sets], [*names, "shingles"])

    names = docs.columns[:-1]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(run, f"{fields}, shingles binary")


def one_of_each(docs: DataFrame, words: int = 5, least: float = 0.8, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of the smallest id of each group that pairs of a similarity of at least `least` join, with docs' columns.

    Texts of fewer words are one shingle, texts without words are alike; a null id stands last, and of equal rows one stays.
    """
    spark, scratch = docs.sparkSession, []
    byte_batches(spark)
    rows = written(sketched(docs, words, id_col, text_col), "sketches", scratch)
    keyed = written(rows.select("sid", F.explode("keys").alias("key")).distinct(), "keyed", scratch)
    # sides with a row per key are tables of their own: a join of two plain shuffles is one that Spark can split at hot keys
    heads = written(keyed.groupBy("key").agg(F.min("sid").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "heads", scratch)
    sets = written(rows.filter(F.size("keys") > 0).select("sid", "fp").distinct(), "sets", scratch)
    stars = keyed.join(heads, "key").filter("sid != head").select("sid", "head").unionByName(block_links(sets, scratch)).distinct()
    clusters = written(components(stars, "sid", "head").withColumnRenamed("node", "sid").withColumnRenamed("root", "cluster"), "clusters", scratch)
    sizes = written(clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")), "sizes", scratch)
    # a text for each set of a cluster
    tiled = written(clusters.join(sizes, "cluster"), "tiled", scratch)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "uid")).alias("first")
    firsts = written(rows.groupBy("sid").agg(first), "firsts", scratch)  # copies are gone before sets are joined
    picked = firsts.select("sid", "first.uid").join(tiled, "sid")
    texts = docs.select(uid_of(id_col, text_col).alias("uid"), F.col(f"`{text_col}`").alias("text"))
    members = with_sets(texts.join(picked, "uid").select("sid", "cluster", "tiles", "text"), words).withColumn("own", F.pmod(F.xxhash64("sid"), "tiles").cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    members = members.select("cluster", "sid", "shingles", F.explode(cells).alias("c")).select(F.xxhash64("cluster", "c.i", "c.j").alias("cell"), "sid", "shingles")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    links = close_links(members.repartition(n, "cell").sortWithinPartitions("cell"), least)
    roots = components(links, "a", "b").withColumnRenamed("node", "sid")
    keepers = firsts.join(roots, "sid", "left").groupBy(F.coalesce("root", "sid").alias("root")).agg(F.min("first").alias("first")).select("first.uid")
    keepers = written(keepers, "keepers")
    for path in scratch:
        dropped(spark, path)
    return chosen(docs, keepers, id_col, text_col)
