"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded into
a fixed vector; a gated attention layer, learned from document labels alone,
weighs the passages, and the weighted mean is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 64
SHAPES = 32
# Bound on the labelled documents a model is fitted on.
FIT_DOCUMENTS = 4000
FIT_CHARS = 1 << 17
THRESHOLD = 0.3
FOLDS = 5
_KNOWN = 500_000
_WORD_STATS = 10
WIDTH = SHAPES + _WORD_STATS + 5


class Words(dict):
    """Row of each word in a growing table of word statistics."""

    def __init__(self):
        super().__init__()
        self.stats = np.zeros((1 << 15, _WORD_STATS), np.float32)
        self.shape = np.zeros(1 << 15, np.int64)

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.shape):
            self.stats = np.concatenate([self.stats, np.zeros_like(self.stats)])
            self.shape = np.concatenate([self.shape, np.zeros_like(self.shape)])
        n = len(word)
        letters = sum(map(str.isalpha, word))
        digits = sum(map(str.isdigit, word))
        upper = sum(map(str.isupper, word))
        marks = n - letters - digits
        self.stats[row] = (
            min(n, 40) / 10, letters / n, digits / n, marks / n, upper / max(1, letters), letters == 0,
            word[0].isupper() and upper == 1, word[-1] in ".?!", marks > 1, n > 25,
        )
        # The shape keeps marks as they are and folds runs of letters and digits.
        shape, last = [], ""
        for c in word[:64]:
            kind = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
            if kind != last:
                shape.append(kind)
            last = kind
        code = 0
        for c in "".join(shape):
            code = (code * 131 + ord(c)) % 1_000_003
        self.shape[row] = code % SHAPES
        self[word] = row
        return row


def passages(text: str | None, known: Words) -> np.ndarray:
    """One row per passage of 64 words; an empty text has one row of zeros."""
    text = text or ""
    words = text.split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    n = len(words)
    rows = np.fromiter(map(known.__getitem__, words), np.int64, n)
    starts = np.arange(0, n, PASSAGE)
    sizes = np.minimum(PASSAGE, n - starts)
    place = np.arange(n) // PASSAGE
    out = np.zeros((len(starts), WIDTH), np.float32)
    shapes = np.bincount(place * SHAPES + known.shape[rows], minlength=len(starts) * SHAPES)
    out[:, :SHAPES] = shapes.reshape(-1, SHAPES) / sizes[:, None]
    at = SHAPES + _WORD_STATS
    out[:, SHAPES:at] = np.add.reduceat(known.stats[rows], starts, axis=0) / sizes[:, None]
    again = np.concatenate([[0.0], rows[1:] == rows[:-1]])
    out[:, at] = np.add.reduceat(again, starts) / sizes
    # Words equal to an earlier one of the same passage.
    order = np.lexsort((rows, place))
    repeats = np.concatenate([[0.0], (rows[order][1:] == rows[order][:-1]) & (place[order][1:] == place[order][:-1])])
    out[:, at + 1] = np.add.reduceat(repeats[np.argsort(order, kind="stable")], starts) / sizes
    _, uses = np.unique(rows, return_counts=True)
    lines = text.count("\n") + 1
    out[:, at + 2] = uses.max() / n
    out[:, at + 3] = np.log1p(n) / 8
    out[:, at + 4] = np.log1p(n / lines) / 5
    if len(known) > _KNOWN:
        known.clear()
    return out


@dataclass
class Model:
    """Encoder layer, gated attention and score; ``mean`` and ``scale`` standardise passages."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _forward(self.weights, np.clip((rows - self.mean) / self.scale, -8, 8), starts)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    lengths = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ w["W"] + w["b"])
    v, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    e = (v * u) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), lengths))
    attention = e / np.repeat(np.add.reduceat(e, starts), lengths)
    z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
    return {"h": h, "v": v, "u": u, "att": attention, "z": z, "p": _sigmoid(z @ w["c"] + w["d"]), "len": lengths}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
    f = _forward(w, x, starts)
    g = (f["p"] - y) / len(y)
    dz = np.repeat(g[:, None] * w["c"][None, :], f["len"], axis=0)
    inner = (dz * f["h"]).sum(1)
    mean = np.repeat(np.add.reduceat(f["att"] * inner, starts), f["len"])
    de = f["att"] * (inner - mean)
    dgate = de[:, None] * w["a"][None, :]
    dv, du = dgate * f["u"] * (1 - f["v"] ** 2), dgate * f["v"] * f["u"] * (1 - f["u"])
    dh = f["att"][:, None] * dz + dv @ w["V"].T + du @ w["U"].T
    dx = dh * (1 - f["h"] ** 2)
    out = {
        "W": x.T @ dx, "b": dx.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
        "a": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ g, "d": g.sum(keepdims=True),
    }
    return {k: v + decay * w[k] * (k not in "bd") for k, v in out.items()}


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, epochs: int = 25, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model:
    """Adam on the mean log loss of bag labels."""
    rows = np.concatenate(bags).astype(np.float64)
    mean, scale = rows.mean(0), rows.std(0) + 1e-3
    bags = [np.clip((b - mean) / scale, -8, 8) for b in bags]
    rng = np.random.default_rng(seed)
    shapes = {"W": (WIDTH, hidden), "V": (hidden, hidden), "U": (hidden, hidden), "a": (hidden,), "c": (hidden,)}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()} | {"b": np.zeros(hidden), "d": np.zeros(1)}
    first, second, t = {k: 0 * v for k, v in w.items()}, {k: 0 * v for k, v in w.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = [bags[i] for i in order[at : at + batch]]
            starts = np.concatenate([[0], np.cumsum([len(b) for b in chosen])[:-1]])
            g = _gradients(w, np.concatenate(chosen), starts, labels[order[at : at + batch]], decay)
            t += 1
            step = rate * min(1.0, 2 * (1 - epoch / epochs))
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - step * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return Model(mean, scale, w)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows kept from fitting: crc32 of the id as text divides by ``folds``; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    """Fit on at most ``most`` labelled documents outside the held-out fold.

    Labels other than 0 and 1 are left out; a document labelled twice has the
    rounded mean. Of several texts with one id the one with the smallest hash
    is taken, and texts above ``FIT_CHARS`` code points are not, so that what
    comes to the driver is bounded. The sample is the same in every run. Without any
    labelled document every score is one half; with one class the class decides.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    fine = F.coalesce(F.length("text"), F.lit(0)) <= FIT_CHARS
    chosen = docs.select("doc_id", "text").where(fine).join(F.broadcast(known), "doc_id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        held: dict[int, tuple[int, float, bytes]] = {}
        for batch in batches:
            for doc_id, y, text, h in zip(*(c.to_pylist() for c in batch.columns)):
                if doc_id not in held or h < held[doc_id][0]:
                    held[doc_id] = (h, y, passages(text, words).tobytes())
        rows = [(i, *held[i]) for i in held]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.binary()))]
        if rows:
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "h", "y", "bag"])

    bags = chosen.select("doc_id", "y", "text", F.xxhash64("text").alias("h")).mapInArrow(encode, "doc_id bigint, h bigint, y double, bag binary")
    rows = bags.groupBy("doc_id").agg(F.min(F.struct("h", "y", "bag")).alias("r")).select("doc_id", "r.y", "r.bag").toArrow()
    found = sorted(zip(rows["doc_id"].to_pylist(), rows["y"].to_pylist(), rows["bag"].to_pylist()), key=lambda r: r[0])
    if not found:
        zero = {k: np.zeros(s) for k, s in {"W": (WIDTH, 1), "b": 1, "V": (1, 1), "U": (1, 1), "a": 1, "c": 1, "d": 1}.items()}
        return Model(np.zeros(WIDTH), np.ones(WIDTH), zero)
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for _, _, b in found]
    return fit_bags(bags, np.array([y for _, y, _ in found]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row; null texts count as empty ones. Map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            texts = batch.column(1)
            scores: list[np.ndarray] = []
            bags: list[np.ndarray] = []
            held = 0
            for i, text in enumerate(texts):
                bags.append(passages(text.as_py(), words))
                held += len(bags[-1])
                if held > 8192 or i == len(texts) - 1:
                    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
                    scores.append(model.score(np.concatenate(bags).astype(np.float64), starts))
                    bags, held = [], 0
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Repeated rows are scored each. Texts of any length are scored whole.
    """
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, same columns, map-only."""
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def quality(texts):
        import pandas as pd

        words, out, bags, held = Words(), [np.zeros(0)], [], 0
        for i, text in enumerate(texts):
            bags.append(passages(text, words))
            held += len(bags[-1])
            if held > 8192 or i == len(texts) - 1:
                starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
                out.append(model.score(np.concatenate(bags).astype(np.float64), starts))
                bags, held = [], 0
        return pd.Series(np.concatenate(out))

    return docs.where(quality(F.col("text")) >= threshold)
