"""Periodic runs of words: Karp-Miller-Rosenberg names, extensions by descending name levels.

A run is a stretch of consecutive words in which words `period` apart are equal, that is at least two
periods (and `least` words) long and that no neighbouring word extends. Level k names every 2**k words
of a text by the pair of names of its halves, so equal names are equal words: nothing is hashed and no
suffix is sorted. How far two places agree is read from the names by descending levels, ahead and back.

Words that agree with those a period later form a stretch of at least max(period, least - period)
words, so a grid of that step meets every run; a grid point is kept only where a name of half that
length agrees on one of its sides. Names that don't recur inside their text are dropped from level to level, so
plain prose costs about two sorts of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import _SPACE, byte_batches, text_buffers, word_spans

CANDIDATES = 1 << 20
WORDS_AT_ONCE = 1 << 17


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words."""
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    letters = np.ascontiguousarray(data[~_SPACE[data]])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def power_names(names: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Level k holds, for each word, the name of the 2**k words from there, -1 where they don't recur in their text.

    names: of the words; first: index of each text's first word, and their number. Texts have names of
    their own, so nothing agrees across a border. Each level has one more entry, -1. Levels end where nothing recurs.
    """
    n = len(names)
    at = np.arange(n)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = owner * (int(names.max(initial=0)) + 1) + names
    levels: list[np.ndarray] = []
    while len(at):
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        again = counts > 1
        fresh = (np.cumsum(again) - 1).astype(np.int32)
        kept = again[inverse]
        level = np.full(n + 1, -1, np.int32)
        level[at[kept]] = fresh[inverse[kept]]
        if not kept.any():
            break
        step = 1 << len(levels)
        levels.append(level)
        at = at[kept]
        at = at[at + step < n]
        at = at[level[at + step] >= 0]
        key = level[at].astype(np.int64) * (int(again.sum()) + 1) + level[at + step]
    return levels


def ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from i on equal those from j on."""
    i, j, n = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        name = levels[k][i]
        step = ((name >= 0) & (name == levels[k][j])).astype(np.int64) << k
        i += step
        j += step
        n += step
    return n


def behind(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words up to i, itself included, equal those up to j; i < j."""
    n = np.zeros(len(i), np.int64)
    none = len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        a, b = i - n - (1 << k) + 1, j - n - (1 << k) + 1
        a = np.where(a < 0, none, a)
        name = levels[k][a]
        n += ((name >= 0) & (name == levels[k][np.where(a == none, none, b)])).astype(np.int64) << k
    return n


def _grids(text: np.ndarray, period: np.ndarray, words: np.ndarray, step: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place in the text) of grid points for pairs of text and period, about CANDIDATES at a time."""
    points = -(-(words - period) // step)
    sums = np.cumsum(points)
    lo = 0
    while lo < len(points):
        hi = max(lo + 1, int(np.searchsorted(sums, (sums[lo - 1] if lo else 0) + CANDIDATES, side="right")))
        n = points[lo:hi]
        which = np.repeat(np.arange(lo, hi), n)
        place = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * step[which]
        yield text[which], period[which], place
        lo = hi


def runs_of(names: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """All runs of the texts: rows of text, start in its text, length, smallest period, in that order."""
    levels = power_names(names, first)
    none = np.zeros((0, 4), np.int64)
    words = np.diff(first)
    if not levels:
        return none
    # the highest level at which each text has a name bounds its periods
    top = np.full(len(words), -1)
    for k, level in enumerate(levels):
        seen = np.concatenate(([0], np.cumsum(level[:-1] >= 0)))
        top[seen[first[1:]] > seen[first[:-1]]] = k
    most = np.where(top < 0, 0, np.minimum(words // 2, (2 << np.maximum(top, 0)) - 1))
    found = [none]
    longest = int(most.max(initial=0))
    for k in range(len(levels)):
        periods = np.arange(1, longest + 1)
        step = np.maximum(periods, least - periods)
        side = (step + 2) // 2  # the longer side of a grid point, itself included, has as many words
        chosen = (side >= 1 << k) & ((side < 2 << k) | (k == len(levels) - 1))
        periods, step = periods[chosen], step[chosen]
        for p_lo in range(0, len(periods), 1 << 20):
            p, s = periods[p_lo : p_lo + (1 << 20)], step[p_lo : p_lo + (1 << 20)]
            texts = np.flatnonzero(most >= p[0]) if len(p) else np.zeros(0, int)
            size = np.minimum(np.searchsorted(p, most[texts], side="right"), len(p))
            text = np.repeat(texts, size)
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            for t, q, place in _grids(text, p[at], words[text], s[at]):
                i = first[t] + place
                name, left = levels[k][i], np.maximum(i - (1 << k) + 1, 0)
                agree = (name >= 0) & (name == levels[k][i + q])
                name = levels[k][left]
                agree |= (name >= 0) & (name == levels[k][left + q]) & (i - left == (1 << k) - 1)
                i, q, t = i[agree], q[agree], t[agree]
                back = behind(levels, i, i + q)
                length = back - 1 + ahead(levels, i, i + q) + q
                good = length >= np.maximum(least, 2 * q)
                rows = np.stack((t, i - back + 1 - first[t], length, q), axis=1)[good]
                found.append(np.unique(rows, axis=0) if len(rows) else rows)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # a stretch that has a period has its multiples too: the smallest stays
    if len(rows):
        rows = rows[np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def kept_words(runs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run contains after its first period."""
    edge = np.zeros(int(first[-1]) + 1, np.int64)
    start = first[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, start + runs[:, 3], 1)
    np.add.at(edge, start + runs[:, 2], -1)
    return np.cumsum(edge)[:-1] == 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts' words, one space between; first: as in power_names."""
    sizes = ends - starts + 1
    sizes[first[:-1][first[:-1] < len(sizes)]] -= 1  # no space before a text's first word
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    out = np.full(int(bounds[-1]), 32, np.uint8)
    for lo in range(0, len(starts), WORDS_AT_ONCE):
        a, b, z = starts[lo : lo + WORDS_AT_ONCE], ends[lo : lo + WORDS_AT_ONCE], bounds[lo + 1 : lo + 1 + WORDS_AT_ONCE]
        n = b - a
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(z - n, n) + inside] = data[np.repeat(a, n) + inside]
    return out, bounds[first]


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, runs (start, length, period: in words, by start, then period) and collapsed of every row.

    collapsed holds the words outside runs and each run's first period, with a space between. A null or empty
    text has no words, no runs and an empty collapsed text; equal rows each keep a row; texts are read whole,
    whatever their length; other columns of docs are not read.
    """
    byte_batches(docs.sparkSession)
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_buffers(batch.column(1)):
                starts, ends, first = word_spans(data, offsets)
                runs = runs_of(word_names(data, starts, ends), first, least)
                stay = kept_words(runs, first)
                at = np.concatenate(([0], np.cumsum(stay)))[first]
                text, cuts = joined(data, starts[stay], ends[stay], at)
                each = np.searchsorted(runs[:, 0], np.arange(hi - lo + 1)).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(item))
                whole = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(np.ascontiguousarray(cuts)), pa.py_buffer(text)).cast(pa.string())
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(each), structs), whole]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, {fields}").withColumnRenamed("id", id_col)
