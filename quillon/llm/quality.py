"""Quality rules: word and line statistics, and compression bands.

A text's zstandard ratio (compressed / raw bytes) tells repetitive text (low) from
incompressible text such as encoded data (high). What is usual depends on the length, so
each length class has its own band; ratios of fixed chunks find bad stretches that a long
document's whole ratio hides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import _SPACE, SpanHash, again, byte_batches, mixed, per_text, text_buffers, word_spans

SYMBOLS = b"#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Bands:
    """Limits of the zstandard ratio.

    whole: (shortest length in bytes, lowest, highest ratio) of length classes in ascending
    order; limits below 1000 bytes lie between the highest ratio of prose and the lowest of base64
    of that length (below 130 bytes the two overlap). Texts under short_bytes are `short` unless
    they are incompressible. Chunks of chunk_bytes (a rest
    under half as long belongs to the chunk before it) must lie in chunk_band but for a share of
    max_bad_chunks, of which fewer than bad_run in a row. Encoded data (base64) lies at 0.75 and above, prose of 1000 bytes below 0.65.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        *((130, 0.0, 0.95), (160, 0.0, 0.93), (200, 0.15, 0.885), (250, 0.15, 0.86), (300, 0.15, 0.83), (350, 0.15, 0.81)),
        *((400, 0.15, 0.79), (500, 0.15, 0.77), (600, 0.15, 0.75), (800, 0.15, 0.72)),
        *((1000, 0.11, 0.70), (4000, 0.10, 0.66), (16000, 0.08, 0.64)),
    )
    short_bytes: int = 200
    chunk_bytes: int = 4096
    chunk_band: tuple[float, float] = (0.08, 0.62)
    max_bad_chunks: float = 0.1
    bad_run: int = 2
    level: int = 3


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, whole_ratio double, n_chunks long, n_bad_chunks long, bad_run long"
)


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Word and line statistics of every text of a buffer."""
    starts, ends, first = word_spans(data, offsets)
    texts = len(offsets) - 1
    word = ~_SPACE[data]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    hashes = SpanHash(data)
    words = np.diff(first)

    # windows of five words that are found again in the same text
    h = hashes.of(starts, ends)
    repeat = np.zeros(texts, np.int64)
    if len(h) >= WINDOW:
        window = np.zeros(len(h) - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            window = window * np.uint64(0x100000001B3) + h[k : len(h) - WINDOW + 1 + k]
        owner = np.repeat(np.arange(texts, dtype=np.uint64), words)
        inside = owner[: len(window)] == owner[WINDOW - 1 :]
        at = np.flatnonzero(inside)
        found = at[again(mixed(window[at]) + mixed(owner[at] + np.uint64(1)))]
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, found, 1)
        np.add.at(edge, found + WINDOW, -1)
        covered = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
        repeat = covered[first[1:]] - covered[first[:-1]]

    # lines with a word that equal an earlier line of the same text
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))  # a break at a text's end opens no line with words
    owner = np.searchsorted(offsets[1:], line_starts, side="right")
    own_break = owner < texts
    line_starts, owner = line_starts[own_break], owner[own_break]
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, line_starts)]
    line_ends = np.minimum(next_break, offsets[1:][owner])
    wordy = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, owner = line_starts[wordy], line_ends[wordy], owner[wordy]
    pairs = np.stack((owner.astype(np.uint64), hashes.of(line_starts, line_ends)), axis=1)
    dup = np.bincount(owner, minlength=texts)
    if len(pairs):
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        fresh = np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))
        dup = dup - np.bincount(pairs[fresh, 0].astype(np.int64), minlength=texts)
    return {
        "n_words": words.astype(np.int64),
        "word_chars": per_text(word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(symbol[data], offsets),
        "n_dup_lines": dup.astype(np.int64),
        "n_repeat_words": repeat.astype(np.int64),
    }


def ratios(data: np.ndarray, offsets: np.ndarray, bands: Bands) -> dict[str, np.ndarray]:
    """Compression figures of every text of a buffer."""
    squeeze = zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress
    view = memoryview(data)
    low, high = bands.chunk_band
    n, whole, chunks, bad, runs = [], [], [], [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        n.append(b - a)
        whole.append(len(squeeze(view[a:b])) / (b - a) if b > a else None)
        k = wrong = run = longest = 0
        if b - a > bands.chunk_bytes:
            starts = list(range(a, b, bands.chunk_bytes))
            if 2 * (b - starts[-1]) < bands.chunk_bytes:
                starts.pop()
            for c, d in zip(starts, [*starts[1:], b], strict=True):
                k += 1
                run = 0 if low <= len(squeeze(view[c:d])) / (d - c) <= high else run + 1
                wrong += run > 0
                longest = max(longest, run)
        chunks.append(k)
        bad.append(wrong)
        runs.append(longest)
    return {"n_bytes": n, "whole_ratio": whole, "n_chunks": chunks, "n_bad_chunks": bad, "bad_run": runs}


def measured(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and the statistics of each text. Null and empty texts have zeros and a null ratio; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, data, offsets in text_buffers(texts):
                found = statistics(data, offsets) | ratios(data, offsets, bands)
                found = {k: pa.array(v, pa.float64() if k == "whole_ratio" else pa.int64()) for k, v in found.items()}
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *found.values()], [id_col, *found])

    source = docs.select(id_col, text_col)
    return source.mapInArrow(run, f"{id_col} {source.schema[id_col].dataType.simpleString()}, {SCHEMA}")


def judged(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and verdicts of each row of docs.

    base_failed: under 10 words, or over a fifth of the words in repeated five-word windows.
    band_verdict: short, ok, repetitive, incompressible or chunks. kept: neither failed.
    Null and empty texts fail the base. Extra columns of docs are not read.
    """
    byte_batches(docs.sparkSession)
    out = measured(docs, bands, id_col, text_col)
    r, n = F.col("whole_ratio"), F.col("n_bytes")
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for size, a, b in bands.whole:
        low, high = F.when(n >= size, F.lit(a)).otherwise(low), F.when(n >= size, F.lit(b)).otherwise(high)
    band = (
        F.when(r > high, "incompressible")
        .when(n < bands.short_bytes, "short")
        .when(r < low, "repetitive")
        .when((F.col("n_bad_chunks") > bands.max_bad_chunks * F.col("n_chunks")) | (F.col("bad_run") >= bands.bad_run), "chunks")
        .otherwise("ok")
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("band_verdict", band)
    return out.withColumn("kept", ~F.col("base_failed") & F.col("band_verdict").isin("short", "ok")).drop("bad_run")
