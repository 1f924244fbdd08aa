"""Quality classifier: attention-based multiple-instance learning over the passages of a text.

Labels are known for documents only. A text is a bag of passages (runs of `words` words). Every
passage is encoded as tanh(features W + b), where features are shares of pairs of neighbouring
character kinds and measures of repetition; gated attention, softmax over the passages of
w (tanh(V h) * sigmoid(U h)), says how much each passage counts, and a logistic score is taken of
the weighted passage representation. All of it is learned together from the labels by Adam in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import byte_batches, text_buffers, word_spans
from quillon.llm.periods import word_names

SLICE = 1 << 18
PIECE = 1 << 20
#: Kinds of bytes: lower-case vowels and consonants, capitals, digits, blanks, line breaks, letters outside ASCII (first and further bytes), other marks one by one.
_KIND = np.zeros(256, np.int64)
_KIND[list(b"bcdfghjklmnpqrstvwxyz")] = 1
_KIND[list(b"aeiou")] = 2
_KIND[65:91] = 3
_KIND[48:58] = 4
_KIND[[32, 9, 11, 12]] = 5
_KIND[[10, 13]] = 6
_KIND[128:192] = 7
_KIND[192:] = 8
_MARKS = [b for b in range(33, 127) if _KIND[b] == 0]
_KIND[_MARKS] = 9 + np.arange(len(_MARKS))
KINDS = 9 + len(_MARKS)
MEASURES = 10
FEATURES = KINDS * KINDS + MEASURES


@dataclass(frozen=True)
class Settings:
    """words: of a passage; width: of its encoding; attention: of the gates.

    per_label: labelled documents of either label that are learned from, about, at most, chosen by
    their hash (the one bounded sample); per_text: passages of a learned text at most, spread evenly over it
    (scores read all). calibration: share of the sample that only sets the temperature.
    """

    words: int = 64
    width: int = 16
    attention: int = 8
    per_label: int = 1200
    per_text: int = 24
    epochs: int = 30
    batch: int = 64
    rate: float = 0.01
    decay: float = 1e-4
    calibration: float = 0.2
    seed: int = 3


@dataclass(frozen=True)
class Model:
    """The learned arrays and the mean and spread of the measures; `scale` is the inverse temperature, `shift` moves all scores (0 but where a label is missing)."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    spread: np.ndarray
    scale: float
    shift: float
    settings: Settings


def passages(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Start byte of every passage (and the end of the last), its first word (and one more), each text's first passage (and one more), and the words.

    A text without a word is one passage without words, so each text has at least one.
    """
    starts, ends, first = word_spans(data, offsets)
    n = np.diff(first)
    count = np.maximum(1, -(-n // words))
    bags = np.concatenate(([0], np.cumsum(count)))
    text = np.repeat(np.arange(len(n)), count)
    inside = np.arange(bags[-1]) - bags[text]
    word = np.append(first[text] + inside * words, first[-1])
    at = np.where(inside == 0, offsets[text], starts[np.minimum(word[:-1], max(0, len(starts) - 1))] if len(starts) else 0)
    return np.append(at, len(data)), word, bags, (starts, ends, first)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float32)


def measures(data: np.ndarray, at: np.ndarray, word: np.ndarray, spans: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """MEASURES numbers for each passage: size, word lengths, and shares of words and word pairs that came before in the text."""
    starts, ends, first = spans
    n = np.diff(word).astype(np.float32)
    some = np.maximum(n, 1)
    size = (ends - starts).astype(np.float64)
    name = word_names(data, starts, ends)
    owner, most = np.repeat(np.arange(len(first) - 1), np.diff(first)), int(name.max(initial=0)) + 1
    key = owner * most + name
    opens = np.zeros(len(key), bool)
    opens[first[:-1][first[:-1] < len(key)]] = True
    before = np.concatenate((name[:1], name[:-1]))
    same = (name == before) & ~opens
    seen = []
    for k in (key, key * most + np.where(opens, name, before)):  # words, and pairs with the word before
        later = np.ones(len(k), bool)
        later[np.unique(k, return_index=True)[1]] = False
        seen.append(_sums(later, word) / some)
    length = _sums(size, word) / some
    columns = [
        np.log1p(n), np.minimum(n / 64, 1), length, np.sqrt(_sums(size * size, word) / some), _sums(same, word) / some, *seen,
        _sums(size > 20, word) / some, _sums(size <= 3, word) / some, np.log1p(np.diff(at)),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def shares(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Square roots of the shares that each pair of kinds of neighbouring bytes has in a passage, a column for each pair."""
    n, wide = len(at) - 1, KINDS * KINDS
    counts = np.zeros(n * wide, np.int64)
    for lo in range(0, len(data) - 1, PIECE):
        hi = min(lo + PIECE, len(data) - 1)
        kind = _KIND[data[lo : hi + 1]]
        cell = np.repeat(np.arange(n) * wide, np.diff(np.clip(at, lo, hi))) + kind[:-1] * KINDS + kind[1:]
        inside = np.ones(hi - lo, bool)
        last = at[1:] - 1 - lo  # pairs that would leave their passage
        inside[last[(last >= 0) & (last < hi - lo)]] = False
        counts += np.bincount(cell[inside], minlength=n * wide)
    return np.sqrt(counts.reshape(n, wide) / np.maximum(np.diff(at) - 1, 1)[:, None]).astype(np.float32)


def sampled(docs: DataFrame, labels: DataFrame, settings: Settings, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(label, h, text) of about per_label documents of either label. Documents whose labels disagree, or that have none, are left out."""
    told = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y")).filter(F.col("y").isin(0.0, 1.0) & F.col("id").isNotNull())
    told = told.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").select("id", F.col("y").cast("int").alias("y"))
    h = F.xxhash64(F.col("id").cast("string"))
    sizes = {r["y"]: r["n"] for r in told.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = 1 << 30
    most = F.lit(parts)
    for y, n in sizes.items():
        most = F.when(F.col("y") == y, F.lit(min(parts, parts * settings.per_label // n))).otherwise(most)
    chosen = told.filter(F.pmod(h, F.lit(parts)) < most)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select(  # per_label rows of either label, about
        "y", F.xxhash64(F.col("id").cast("string"), F.col("text")).alias("h"), "text"
    )


def bags_of(texts: DataFrame, settings: Settings) -> DataFrame:
    """(y, h, x): the features of each text's passages, 16-bit floats row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_buffers(batch.column(2), SLICE):
                at, word, bags, spans = passages(data, offsets, settings.words)
                info = measures(data, at, word, spans)
                rows = []
                for t in range(hi - lo):
                    n = bags[t + 1] - bags[t]
                    pick = bags[t] + np.unique(np.linspace(0, n - 1, min(n, settings.per_text)).astype(np.int64))
                    x = [np.concatenate((shares(data[at[i] : at[i + 1]], np.array([0, at[i + 1] - at[i]]))[0], info[i])) for i in pick]
                    rows.append(np.stack(x).astype(np.float16).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(rows, pa.binary())], ["y", "h", "x"])

    return texts.select("y", "h", "text").mapInArrow(run, "y int, h long, x binary")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _attended(h: np.ndarray, w: dict[str, np.ndarray], cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weights of the passages within their bags, the bags' representations, and what the way back needs. cuts: each bag's first passage."""
    t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    logit = (t * g) @ w["a"]
    sizes = np.diff(np.append(cuts, len(h)))
    e = np.exp(logit - np.repeat(np.maximum.reduceat(logit, cuts), sizes))
    share = e / np.repeat(np.add.reduceat(e, cuts), sizes)
    return share, np.add.reduceat(share[:, None] * h, cuts, axis=0), t, g, sizes


def _gradients(x: np.ndarray, cuts: np.ndarray, y: np.ndarray, weight: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["w"] + w["b"])
    share, z, t, g, sizes = _attended(h, w, cuts)
    err = (_sigmoid(z @ w["c"] + w["d"]) - y) * weight / len(y)
    dz = np.repeat(err[:, None] * w["c"], sizes, axis=0)
    dshare = (dz * h).sum(axis=1)
    dlogit = share * (dshare - np.repeat(np.add.reduceat(share * dshare, cuts), sizes))
    dt, dg = dlogit[:, None] * w["a"] * g * (1 - t * t), dlogit[:, None] * w["a"] * t * g * (1 - g)
    dh = (share[:, None] * dz + dt @ w["v"].T + dg @ w["u"].T) * (1 - h * h)
    return {"w": x.T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ dlogit, "c": z.T @ err, "d": np.array([err.sum()])}


def trained(rows: list[tuple[int, int, np.ndarray]], settings: Settings) -> Model:
    """Fit on (label, hash, features of the passages), then calibrate on rows that the fit never saw. Without both labels, all score by their share."""
    rows = sorted(rows, key=lambda r: r[1])
    rng = np.random.default_rng(settings.seed)
    m, k, a = FEATURES, settings.width, settings.attention
    w = {
        "w": rng.normal(0, 0.3, (m, k)), "b": np.zeros(k), "v": rng.normal(0, 0.5, (k, a)), "u": rng.normal(0, 0.5, (k, a)),
        "a": rng.normal(0, 0.5, a), "c": rng.normal(0, 0.3, k), "d": np.zeros(1),
    }
    w = {name: v.astype(np.float32) for name, v in w.items()}
    y = np.array([r[0] for r in rows], np.float32)
    if not 0 < y.sum() < len(y):
        rate = float(y.mean()) if len(y) else 0.5
        w["c"][:] = 0
        return Model(w, np.zeros(MEASURES, np.float32), np.ones(MEASURES, np.float32), 1.0, float(np.clip(np.log((rate + 1e-3) / (1 - rate + 1e-3)), -6, 6)), settings)
    every = np.concatenate([r[2][:, -MEASURES:] for r in rows]).astype(np.float32)
    mean, spread = every.mean(axis=0), every.std(axis=0) + 1e-3

    def inputs(part: list[int] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.concatenate([rows[i][2] for i in part]).astype(np.float32)
        x[:, -MEASURES:] = (x[:, -MEASURES:] - mean) / spread
        sizes = np.array([len(rows[i][2]) for i in part])
        return x, np.cumsum(sizes) - sizes

    held = [i for i in range(len(rows)) if i % round(1 / settings.calibration) == 0]
    fit = [i for i in range(len(rows)) if i % round(1 / settings.calibration)]
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    one, two = {n: np.zeros_like(v) for n, v in w.items()}, {n: np.zeros_like(v) for n, v in w.items()}
    step, last = 0, settings.epochs * -(-len(fit) // settings.batch)
    for _ in range(settings.epochs):
        order = rng.permutation(fit)
        for lo in range(0, len(order), settings.batch):
            part = order[lo : lo + settings.batch]
            grads = _gradients(*inputs(part), y[part], balance[part], w)
            step += 1
            rate = settings.rate * (1 - (step - 1) / last)
            for n, g in grads.items():
                one[n] += 0.1 * (g - one[n])
                two[n] += 0.001 * (g * g - two[n])
                w[n] -= (rate * (one[n] / (1 - 0.9**step) / (np.sqrt(two[n] / (1 - 0.999**step)) + 1e-8) + settings.decay * w[n])).astype(np.float32)
    check = held or fit
    raw = np.empty(len(check), np.float32)
    for lo in range(0, len(check), settings.batch):
        x, cuts = inputs(check[lo : lo + settings.batch])
        raw[lo : lo + settings.batch] = _attended(np.tanh(x @ w["w"] + w["b"]), w, cuts)[1] @ w["c"] + w["d"]
    # the temperature under which the held rows are likeliest, of a balanced prior
    loss = lambda s: float((balance[check] * np.logaddexp(0, np.where(y[check] == 1, -raw, raw) * s)).mean())
    return Model(w, mean, spread, min((loss(s), s) for s in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0))[1], 0.0, settings)


def fitted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Train on labelled rows of docs: per_label texts of either label reach the driver, as features of per_text passages at most."""
    byte_batches(docs.sparkSession)
    rows = bags_of(sampled(docs, labels, settings, id_col, text_col, label_col), settings)
    return trained([(r["y"], r["h"], np.frombuffer(r["x"], np.float16).reshape(-1, FEATURES)) for r in rows.toLocalIterator()], settings)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score (0 to 1, higher: label 1 is likelier), n_passages, and the largest attention that a passage has, of every row.

    A null, empty or blank text is one passage without words and has a score like any other. Equal texts
    have equal scores, equal rows each keep a row. Texts of any length are read whole. Other columns are not read.
    """
    byte_batches(docs.sparkSession)
    told = docs.sparkSession.sparkContext.broadcast(model)  # some 30,000 floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = told.value
        w, settings = model.weights, model.settings
        for batch in batches:
            for lo, hi, data, offsets in text_buffers(batch.column(1), SLICE):
                at, word, bags, spans = passages(data, offsets, settings.words)
                info = (measures(data, at, word, spans) - model.mean) / model.spread
                h = np.empty((len(at) - 1, settings.width), np.float32)
                for p in range(0, len(h), 256):  # some passages at a time: a text of any length needs the same memory here
                    q = min(p + 256, len(h))
                    x = np.concatenate((shares(data[at[p] : at[q]], at[p : q + 1] - at[p]), info[p:q]), axis=1)
                    h[p:q] = np.tanh(x @ w["w"] + w["b"])
                share, z, *_ = _attended(h, w, bags[:-1])
                score = _sigmoid((z @ w["c"] + w["d"]) * model.scale + model.shift).astype(float)
                top = np.maximum.reduceat(share, bags[:-1]).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score), pa.array(np.diff(bags)), pa.array(top)], ["id", "score", "n_passages", "top_attention"])

    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, score double, n_passages long, top_attention double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
