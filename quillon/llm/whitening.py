"""Whitening of embeddings: principal components by LOBPCG over distributed block products.

No covariance matrix is formed. A block of directions B is multiplied with the covariance V of the
centred rows as sum of (x - mean) ((x - mean) B) / n: each task keeps one block, blocks are summed row by row in a
shuffle, and a block (dimensions x directions) is all that reaches the driver. There, Rayleigh-Ritz over the iterate, its
residuals and the previous directions gives the next iterate, until residuals, taken with a fresh product, are
certified to be at rounding level.

Entries become integers on a fixed grid, so counts and sums are exact, and n * x - sum is the centred
entry before any rounding: large common offsets cost no digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import byte_batches, written

OFFSET = 1_000_000
SCALE = 64


@dataclass(frozen=True)
class Settings:
    """components: returned at most; guard: further directions of the block, which speed up the last ones.

    tolerance: largest residual norm of a certified component, as a share of the largest eigenvalue;
    rounds: products at most, more are an error.
    """

    components: int = 32
    guard: int = 8
    tolerance: float = 1e-13
    rounds: int = 500
    seed: int = 11


def on_grid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): floor(SCALE * entry) + OFFSET as longs, for the rows whose vector is neither null nor holds a null, a NaN or an infinity.

    An entry whose x would be no long counts as infinite.
    """
    v = F.transform(F.col(f"`{vec_col}`").cast("array<double>"), lambda c: c * SCALE)
    fine = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 61)))
    source = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter(fine)
    return source.select("id", F.transform("v", lambda c: F.floor(c) + F.lit(OFFSET).cast("long")).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def block_sum(rows: DataFrame, dims: int, shape: tuple[int, int], block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of block(x) over all rows, x being some rows of the grid; `shape` tells its size.

    Tasks add up their own rows; their blocks are summed by row in a shuffle.
    """
    height, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += block(_matrix(batch.column(0), dims))
        cuts = pa.array(np.arange(0, height * width + 1, width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height)), pa.ListArray.from_arrays(cuts, pa.array(total.ravel()))], ["i", "v"])

    parts = rows.select("x").mapInArrow(run, "i long, v array<double>")
    sums = parts.groupBy("i").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(width)]).alias("v")).collect()
    out = np.zeros(shape)
    for r in sums:
        out[r["i"]] = r["v"]
    return out


def _orthonormal(block: np.ndarray, against: np.ndarray | None = None) -> np.ndarray:
    """A basis of the block's part that is orthogonal to `against`; directions of rounding size are left out."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        if against is not None and against.shape[1]:
            block = block - against @ (against.T @ block)
        if not block.shape[1]:
            return block
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10]
    return block


def lobpcg(product: Callable[[np.ndarray], np.ndarray], dims: int, settings: Settings) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Largest eigenvalues, falling, their unit eigenvectors, the largest residual as a share of the first eigenvalue, and the number of products.

    product(B) is V B for a symmetric V of no negative eigenvalue. As many components as asked for,
    fewer where the dimensions or the rank are fewer.
    """
    k = min(settings.components, dims)
    size = min(dims, k + settings.guard)
    x = np.linalg.qr(np.random.default_rng(settings.seed).standard_normal((dims, size)))[0]
    ax, rounds, fresh = product(x), 1, True
    p = ap = np.zeros((dims, 0))
    least, since = np.inf, 0
    while True:
        x, change = np.linalg.qr(x)
        ax = np.linalg.solve(change.T, ax.T).T
        gram = x.T @ ax
        value, turn = np.linalg.eigh((gram + gram.T) / 2)
        order = np.argsort(-value)
        value, x, ax = value[order], x @ turn[:, order], ax @ turn[:, order]
        top = float(value[0])
        if top <= 0:
            return value[:0], x[:, :0], 0.0, rounds
        residual = ax - x * value
        norms = np.linalg.norm(residual, axis=0) / top
        worst = float(norms[:k].max())
        least, since = (worst, 0) if worst < 0.9 * least else (least, since + 1)
        r = _orthonormal(residual[:, norms > settings.tolerance / 10], x)
        # done, or nothing but rounding is left to remove
        if worst <= settings.tolerance or (worst <= 100 * settings.tolerance and (since > 20 or not r.shape[1])):
            if fresh:
                break
            ax, fresh = product(x), True  # certified by a product, not by what updates have left
            rounds += 1
            p = ap = np.zeros((dims, 0))
            continue
        if rounds >= settings.rounds or not r.shape[1]:
            raise RuntimeError(f"residual {worst:.1e} after {rounds} products")
        ar = product(r)
        rounds += 1
        basis, image = np.hstack((x, r)), np.hstack((ax, ar))
        if p.shape[1]:
            # previous directions, scaled and made orthogonal with the same steps as their images
            scale = np.linalg.norm(p, axis=0)
            p, ap = p[:, scale > 0] / scale[scale > 0], ap[:, scale > 0] / scale[scale > 0]
            for _ in range(2):
                along = basis.T @ p
                p, ap = p - basis @ along, ap - image @ along
                _, s, w = np.linalg.svd(p, full_matrices=False)
                p, ap = (p @ w.T)[:, s > 1e-4] / s[s > 1e-4], (ap @ w.T)[:, s > 1e-4] / s[s > 1e-4]
            basis, image = np.hstack((basis, p)), np.hstack((image, ap))
        gram = basis.T @ image
        value, turn = np.linalg.eigh((gram + gram.T) / 2)
        turn = turn[:, np.argsort(-value)[:size]]
        step = turn.copy()
        step[:size] = 0
        p, ap = basis @ step, image @ step
        x, ax, fresh = basis @ turn, image @ turn, False
    good = value[:k] > top * dims * np.finfo(float).eps * 16
    return value[:k][good], x[:, :k][:, good], worst, rounds


def whitened(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: id_col, component, n, deviation, whitened, explained, identity_error, residual.

    Vectors that are null or hold a null or non-finite entry are dropped, as are those of another length than the
    commonest (of equally common lengths the longest counts). Components are numbered from 1 by falling
    eigenvalue; those without variance are left out, so no or equal vectors give no rows. Equal rows
    each keep theirs. deviation is exact; where it is no long (n times the spread near 2**31), that is an
    error. Other columns are not read.
    """
    spark = vectors.sparkSession
    byte_batches(spark)
    grid = written(on_grid(vectors, id_col, vec_col), "grid")
    lengths = grid.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    fields = "component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    kind = grid.schema["id"].dataType.simpleString()
    dims, n = (lengths[0]["d"], lengths[0]["n"]) if lengths else (0, 0)
    if not dims:
        return spark.createDataFrame([], f"id {kind}, {fields}").withColumnRenamed("id", id_col)
    grid = grid.filter(F.size("x") == dims)

    sums_of = grid.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()
    exact = [0] * dims
    for r in sums_of:
        exact[r["i"]] = int(r["s"])
    # n * x - s = n * (x - whole) - rest, where rest lies in 0..n-1: exact in 64 bits as long as the result is
    whole = np.array([s // n for s in exact], np.int64)
    rest = np.array([s % n for s in exact], np.int64)

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - rest / n

    total = float(block_sum(grid, dims, (1, 1), lambda x: np.array([[np.square(centred(x)).sum()]]))[0, 0]) / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)

        return block_sum(grid, dims, block.shape, part) / n

    value, vector, residual, _ = lobpcg(product, dims, settings)
    k = len(value)
    if not k:
        return spark.createDataFrame([], f"id {kind}, {fields}").withColumnRenamed("id", id_col)
    axes = vector / np.sqrt(value)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ axes
        return np.vstack((w.T @ w, w.sum(axis=0)))

    seen = block_sum(grid, dims, (k + 1, k), moments) / n
    error = float(np.abs(seen[:k] - np.outer(seen[k], seen[k]) - np.eye(k)).max())
    explained = value / total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 1024):
                batch = big.slice(lo, 1024)
                rows = batch.num_rows
                x = _matrix(batch.column(1), dims)
                wide = np.abs(centred(x)).max(initial=0.0) * n
                if wide * wide * dims < 2.0**62:
                    far = n * (x - whole) - rest
                    deviation = np.square(far).sum(axis=1)
                else:
                    sums = [sum((n * (int(a) - int(b)) - int(c)) ** 2 for a, b, c in zip(row, whole, rest, strict=True)) for row in x]
                    deviation = np.array(sums, dtype=object)
                    if max(sums) >= 1 << 63:
                        raise OverflowError("a deviation is no long: too many or too wide vectors")
                    deviation = deviation.astype(np.int64)
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)), pa.array(np.repeat(deviation, k)),
                        pa.array((centred(x) @ axes).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error)), pa.array(np.full(rows * k, residual)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"],
                )

    return grid.select("id", "x").mapInArrow(run, f"id {kind}, {fields}").withColumnRenamed("id", id_col)
