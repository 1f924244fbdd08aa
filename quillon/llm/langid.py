"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its subwords (byte 2- to 4-grams over words with
their edges marked), hashed to a fixed number of rows. Embeddings and softmax are trained by
stochastic gradient descent in numpy on a bounded, stratified sample; as both are linear, they
fold into one table of a row per hash and a column per language, so prediction is a mean of
table rows.

Softmax scores say which known language is the likeliest, not whether it is any of them. Rejection looks at how
usual a text's subwords are in the language told: their mean log frequency there. Its threshold is calibrated on
known texts that training never saw and on strangers made from them, words whose letters are shuffled.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import _LOWER_CODE, byte_batches, row_slices, text_buffers

UNKNOWN = "und"
PIECE = 1 << 18


@dataclass(frozen=True)
class Settings:
    """rows: hash rows. per_lang: training texts of a language, about, at most, fewer where
    all languages would have more than max_texts together; max_langs: more labels are an error. epochs: passes over the sample, more where those make fewer than least_steps steps.

    reject_rate: share of correctly told calibration texts that either rejection threshold (of the score, of
    usualness) may cost; floor: frequency of subwords that a language's sample lacks; spread: standard deviations below
    the mean usualness of known texts that are surely kept.
    """

    rows: int = 1 << 14
    dim: int = 12
    grams: tuple[int, ...] = (2, 3, 4)
    per_lang: int = 600
    max_texts: int = 38_400
    max_langs: int = 1024
    epochs: int = 6
    least_steps: int = 600
    batch: int = 16
    rate: float = 0.5
    calibration: float = 0.2
    reject_rate: float = 0.001
    floor: float = 1e-6
    spread: float = 4.0
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """langs, embeddings (a row a hash), softmax (a column a language) and bias; scale: inverse temperature.

    usual: log frequency of each hash in each language (a row a language); texts whose mean lies under `least` are strangers.
    """

    langs: tuple[str, ...]
    emb: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    scale: float
    threshold: float
    settings: Settings
    usual: np.ndarray | None = None
    least: float = -np.inf


def gram_pieces(data: np.ndarray, offsets: np.ndarray, settings: Settings, piece: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, text after the last, hash rows, rows of each text) of the subwords of a buffer of texts.

    Letters are lower-cased where they are ASCII; other ASCII bytes than letters part words and
    count as one mark, which a gram may hold at its ends only. Subwords are taken by where they
    begin, `piece` bytes at a time, so a text of any length needs the same memory.
    """
    n, longest = len(data), max(settings.grams)
    for lo in range(0, n, piece):
        hi = min(lo + piece, n)
        code = _LOWER_CODE[data[lo : hi + longest - 1]].astype(np.uint32)
        letter = code != 0
        t0, t1 = int(np.searchsorted(offsets, lo, side="right")) - 1, int(np.searchsorted(offsets, hi, side="left"))
        bounds, ends = np.clip(offsets[t0 : t1 + 1], lo, hi) - lo, offsets[t0 + 1 : t1 + 1] - lo
        for k in settings.grams:
            m = min(hi - lo, len(code) - k + 1)
            if m <= 0:
                continue
            h, ok = np.zeros(m, np.uint32), np.ones(m, bool)
            for j in range(k):
                h = h * np.uint32(0x01000193) + code[j : m + j]
                if 0 < j < k - 1:
                    ok &= letter[j : m + j]
            if k == 2:
                ok &= letter[:m] | letter[1 : m + 1]
            for j in range(1, k):  # a gram ends with its text
                over = ends - j
                ok[over[(over >= 0) & (over < m)]] = False
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + k * 2)
            seen = np.zeros(m + 1, np.int64)
            np.cumsum(ok, out=seen[1:])
            yield t0, t1, ((h ^ (h >> np.uint32(13))) % np.uint32(settings.rows))[ok].astype(np.int64), np.diff(seen[np.minimum(bounds, m)])


def gram_counts(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending by text: the distinct hash rows of each text, how often each occurs there, and how many rows each text has."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for t0, t1, ids, sizes in gram_pieces(data, offsets, settings):
        k, c = np.unique(np.repeat(np.arange(t0, t1), sizes) * settings.rows + ids, return_counts=True)
        keys.append(k)
        counts.append(c)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(at, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)
    return key % settings.rows, count, np.bincount(key // settings.rows, minlength=len(offsets) - 1)


def sampled(docs: DataFrame, settings: Settings, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """About per_lang rows of each language (all where there are fewer): those whose hash lies in the share that this is of them.

    With many languages, max_texts is shared out evenly instead, so that each is learned and the sample stays bounded.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h")
    )
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(settings.max_langs + 1).collect()
    if len(sizes) > settings.max_langs:
        raise ValueError(f"more than {settings.max_langs} languages")
    parts = 1 << 30
    each = min(settings.per_lang, settings.max_texts // max(1, len(sizes)))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(parts, parts * each // r["n"])) for r in sizes], "lang string, most long")
    return known.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(parts)) < F.col("most")).drop("most")


def shuffled(text: str, seed: int) -> str:
    """The text with each word's characters in another order."""
    rng = random.Random(seed)
    return " ".join("".join(rng.sample(w, len(w))) for w in text.split())


def counted(texts: DataFrame, settings: Settings) -> DataFrame:
    """(lang, h, ids, counts): the distinct hash rows of each text and how often each occurs; lang is null for the strangers made from one in 1 / calibration texts."""
    share = round(1 / settings.calibration)

    def with_strangers(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, h, text = batch.columns
        made = [i for i, x in enumerate(h.to_pylist()) if x % share == 0]
        strange = [shuffled(text[i].as_py(), h[i].as_py()) for i in made]
        columns = [pa.concat_arrays([lang, pa.nulls(len(made), lang.type)]), pa.concat_arrays([h, h.take(pa.array(made, pa.int64()))]), pa.concat_arrays([text, pa.array(strange, text.type)])]
        return pa.RecordBatch.from_arrays(columns, ["lang", "h", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(with_strangers, row_slices(batches, 64)):
            for lo, hi, data, offsets in text_buffers(batch.column(2), PIECE):
                rows, counts, sizes = gram_counts(data, offsets, settings)
                cuts = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (rows, counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *lists], ["lang", "h", "ids", "counts"])

    return texts.select("lang", "h", "text").mapInArrow(run, "lang string, h long, ids array<int>, counts array<int>")


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def trained(rows: list[tuple[str, int, np.ndarray, np.ndarray]], settings: Settings, strangers: list[tuple[np.ndarray, np.ndarray]] | None = None) -> Model:
    """Fit embeddings and softmax by SGD on (lang, hash, ids, counts), then calibrate.

    A share of the rows (by their hash) is kept from the SGD: the temperature that makes their
    scores most likely, and the rejection thresholds, come from it. strangers are (ids, counts) of texts in no known language.
    """
    rows = sorted(rows, key=lambda r: r[1])
    sizes: dict[str, int] = {}
    for r in rows:
        sizes[r[0]] = sizes.get(r[0], 0) + 1
    langs = tuple(sorted(sizes))
    index = {x: i for i, x in enumerate(langs)}
    rows = [r for r in rows if r[0] in index and len(r[2])]
    rng = np.random.default_rng(settings.seed)
    emb = rng.normal(0, 1 / settings.dim, (settings.rows, settings.dim)).astype(np.float32)
    out = np.zeros((settings.dim, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    held = [i for i in range(len(rows)) if i % round(1 / settings.calibration) == 0]
    fit = [i for i in range(len(rows)) if i % round(1 / settings.calibration)] or held
    y = np.array([index[r[0]] for r in rows], int)
    weight = [(r[3] / r[3].sum()).astype(np.float32) for r in rows]
    # small samples go by more often
    epochs = max(settings.epochs, -(-settings.least_steps * settings.batch // max(1, len(fit))))
    steps, total = 0, epochs * max(1, len(fit))
    for _ in range(epochs):
        order = rng.permutation(fit)
        for lo in range(0, len(order), settings.batch):
            part = order[lo : lo + settings.batch]
            rate = settings.rate * (1 - steps / total)
            steps += len(part)
            means = np.stack([weight[i] @ emb[rows[i][2]] for i in part])
            err = softmax(means @ out + bias)
            err[np.arange(len(part)), y[part]] -= 1
            back = err @ out.T
            out -= rate * means.T @ err / len(part) * 4
            bias -= rate * err.mean(axis=0) * 0.1
            for i, g in zip(part, back, strict=True):
                emb[rows[i][2]] -= (rate * 40 * weight[i])[:, None] * g[None, :]
    if not len(langs):
        return Model((), emb, out, bias, 1.0, 0.0, settings, np.zeros((0, settings.rows), np.float32), -np.inf)
    check = held or fit
    raw = np.stack([weight[i] @ emb[rows[i][2]] for i in check]) @ out + bias
    best = min((float(-np.log(np.clip(softmax(raw * s)[np.arange(len(check)), y[check]], 1e-12, 1)).mean()), s) for s in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0))
    p = softmax(raw * best[1])
    told = p.argmax(axis=1)
    right = told == y[check]
    scores = np.sort(p.max(axis=1)[right])
    rare = int(len(scores) * settings.reject_rate)  # too few texts show no such rare score: then none is rejected by its score
    threshold = float(scores[rare]) * 0.9 if rare else 0.0

    usual = np.zeros((len(langs), settings.rows))
    for i in fit:
        usual[y[i], rows[i][2]] += weight[i]
    usual = np.log(usual / np.maximum(usual.sum(axis=1, keepdims=True), 1e-12) + settings.floor).astype(np.float32)
    known = np.sort([float(weight[i] @ usual[k, rows[i][2]]) for i, k, ok in zip(check, told, right, strict=True) if ok])
    strange = []
    for ids, counts in strangers or []:
        if len(ids):
            share = counts / counts.sum()
            strange.append(float(share @ usual[(share @ emb[ids] @ out + bias).argmax(), ids]))
    # half-way between the rarest of known texts and common strangers; no higher than the texts that it may cost. Few
    # texts show no rare one, so the rarest lie `spread` deviations below the mean at least
    least = -np.inf
    if len(known):
        low = min(float(known[int(len(known) * settings.reject_rate)]), float(np.mean(known) - settings.spread * np.std(known)))
        least = min(low, (low + float(np.median(strange))) / 2) if strange else low
    return Model(langs, emb, out, bias, best[1], threshold, settings, usual, least)


def fitted(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on the labelled rows of docs: per_lang texts of a language at most, whole ones, reach the driver as counts."""
    byte_batches(docs.sparkSession)
    sample = counted(sampled(docs, settings, id_col, text_col, lang_col), settings)
    rows = [(r["lang"], r["h"], np.asarray(r["ids"], np.int64), np.asarray(r["counts"], np.float32)) for r in sample.toLocalIterator()]
    strangers = [r[2:] for r in sorted((r for r in rows if r[0] is None), key=lambda r: r[1])]
    return trained([r for r in rows if r[0] is not None], settings, strangers)


def predicted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), detail: bool = False) -> DataFrame:
    """id_col, the carried columns, lang_pred, score and rejected (and usualness, with `detail`) of every row.

    lang_pred is `und` with score 0 where the text is null or has no letter (or nothing was
    learned); rejected is true there and where the score or usualness (mean log frequency of the text's subwords in
    lang_pred; null for `und`) lies below its calibrated threshold.
    Of languages with equal scores the first by name is told; equal rows each keep a row. Texts of
    any length are read whole. A carried column that is called as a result ends in `_in`.
    """
    byte_batches(docs.sparkSession)
    kept = list(dict.fromkeys([id_col, *carry]))
    sent = list(dict.fromkeys([*kept, text_col]))  # each text goes to Python once
    letters = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(sent)], letters.alias("letters"))
    # as both are linear, the narrower of languages and dimensions is summed
    folded = len(model.langs) <= model.settings.dim
    sums_of = model.emb @ model.out if folded else model.emb
    table = docs.sparkSession.sparkContext.broadcast((np.ascontiguousarray(sums_of.T), None if folded else model.out, model.bias, model.langs, model.usual))  # rows x (dim + langs) floats at most
    settings, scale, text_at, width = model.settings, model.scale, sent.index(text_col), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, out, bias, langs, usual = table.value
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in batches:
            letters = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in text_buffers(batch.column(text_at), PIECE):
                sums, sizes = np.zeros((hi - lo, len(weights))), np.zeros(hi - lo, np.int64)
                for t0, t1, ids, n in gram_pieces(data, offsets, settings):
                    some = np.flatnonzero(n)
                    if len(some):
                        cuts = (np.cumsum(n) - n)[some]
                        for c, row in enumerate(weights):
                            sums[t0 + some, c] += np.add.reduceat(row[ids], cuts)
                        sizes[t0:t1] += n
                known = np.flatnonzero(letters[lo:hi] & (sizes > 0) & (len(langs) > 0))
                best, score = np.full(hi - lo, len(langs)), np.zeros(hi - lo)
                if len(known):
                    means = sums[known] / sizes[known][:, None]
                    p = softmax(((means if out is None else means @ out) + bias) * scale)
                    best[known], score[known] = p.argmax(axis=1), p.max(axis=1)
                rare, row = np.zeros(hi - lo), np.minimum(best, len(langs) - 1)
                for t0, t1, ids, n in gram_pieces(data, offsets, settings) if len(known) and usual is not None else ():
                    some = np.flatnonzero(n)
                    if len(some):
                        rare[t0 + some] += np.add.reduceat(usual[np.repeat(row[t0:t1], n), ids], (np.cumsum(n) - n)[some])
                rare = pa.array(rare / np.maximum(sizes, 1), mask=(best == len(langs)) | (usual is None))
                rest = [batch.column(i).slice(lo, hi - lo) for i in range(width)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(names[best], pa.string()), pa.array(score), rare], [*names_in, "lang_pred", "score", "usualness"])

    names_in = source.columns[:width]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:width])
    told = source.mapInArrow(run, f"{fields}, lang_pred string, score double, usualness double")
    back = [F.col(f"c{i}").alias(f"{c}_in" if c in ("lang_pred", "score", "usualness", "rejected") else c) for i, c in enumerate(kept)]
    strange = (F.col("score") < model.threshold) | F.coalesce(F.col("usualness") < float(model.least), F.lit(False))
    return told.select(*back, "lang_pred", "score", ((F.col("lang_pred") == UNKNOWN) | strange).alias("rejected"), *["usualness"] * detail)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
