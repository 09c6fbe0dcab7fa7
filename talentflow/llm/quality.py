"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features describe its characters and words,
repetition within the document, and the same for the lines before and after.
The field is trained on labelled documents whose lines carry the document's
label; forward-backward gives each line's marginal, and the length-weighted
mean of the marginals, calibrated on the training documents, is the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, text_of
from .tokens import BYTE_POWERS, BYTE_VALUES, Words, WORD_POWERS, range_hashes, text_blocks

# The field is fitted on at most so many labelled documents.
SAMPLE = 3000
EPOCHS, RATE, RIDGE = 60, 0.1, 1e-3
THRESHOLD = 0.3

UPPER, LOWER, DIGIT, SYMBOL, STOP = (np.zeros(256, bool) for _ in range(5))
UPPER[ord("A") : ord("Z") + 1] = True
LOWER[ord("a") : ord("z") + 1] = True
LOWER[0x80:] = True
DIGIT[ord("0") : ord("9") + 1] = True
STOP[[ord(c) for c in ".,;:'\"-()?"]] = True
SYMBOL[0x21:0x7F] = True
SYMBOL &= ~(UPPER | LOWER | DIGIT | STOP)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, row) of every line with a word in a block of texts."""
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first[1:][data == 0x0A] = True
    start = np.flatnonzero(first[:-1])
    bounds = np.concatenate([start, [len(data)]])
    w = Words(data, offsets)
    word = np.searchsorted(w.starts, bounds)
    keep = np.flatnonzero(np.diff(word) > 0)
    if not len(keep):
        return np.zeros((0, 3 * 14)), np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.repeat(np.arange(len(start)), np.diff(word))  # of each word
    row = np.searchsorted(offsets, start, "right") - 1
    size = np.diff(bounds)

    def per_line(mask: np.ndarray, cuts: np.ndarray = bounds) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[cuts])

    n_words = np.maximum(np.diff(word), 1)
    n = np.maximum(size, 1)
    same = np.zeros(len(line), bool)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (line[1:] == line[:-1])
    # three-word runs and whole lines that the document has elsewhere too
    at, runs = w.windows(3)
    of = row[line[at]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    again = np.zeros(len(line), bool)
    again[at] = _repeated(runs + of)
    text = range_hashes(BYTE_VALUES[data], w.starts[word[:-1][keep]], w.ends[word[1:][keep] - 1], BYTE_POWERS)
    copied = np.zeros(len(start), bool)
    copied[keep] = _repeated(text + row[keep].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    tail = SYMBOL[data[w.ends - 1]]
    caps = UPPER[data[w.starts]] & UPPER[data[w.ends - 1 - (w.ends - w.starts > 2)]] & (w.ends - w.starts > 1)
    letters = per_line((UPPER | LOWER)[data])
    f = np.stack(
        [
            np.log1p(size),
            letters / n,
            per_line(UPPER[data]) / np.maximum(letters, 1),
            per_line(DIGIT[data]) / n,
            per_line(SYMBOL[data]) / n,
            per_line(STOP[data]) / n,
            per_line(tail, word) / n_words,
            per_line(caps, word) / n_words,
            per_line(same, word) / n_words,
            per_line(again, word) / n_words,
            copied,
            np.log1p(n_words),
            size / n_words,
            per_line((data == ord("|"))) / n_words,
        ],
        axis=1,
    )[keep].astype(np.float64)
    row = row[keep]
    before, after = np.zeros_like(f), np.zeros_like(f)
    linked = row[1:] == row[:-1]
    before[1:][linked] = f[:-1][linked]
    after[:-1][linked] = f[1:][linked]
    return np.hstack([f, before, after]), size[keep], row


def _repeated(values: np.ndarray) -> np.ndarray:
    _, back, n = np.unique(values, return_inverse=True, return_counts=True)
    return n[back] > 1


class Chains:
    """Sequences of line scores side by side, longest first."""

    def __init__(self, row: np.ndarray):
        self.start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
        self.size = np.diff(np.concatenate([self.start, [len(row)]]))
        self.order = np.argsort(-self.size, kind="stable")
        top = int(self.size.max()) if len(self.size) else 0
        self.alive = np.searchsorted(-self.size[self.order], -np.arange(top), "left")

    def steps(self) -> Iterator[np.ndarray]:
        """Line index of every chain that has a line at this step."""
        for t, n in enumerate(self.alive):
            yield self.start[self.order[:n]] + t


def forward_backward(score: np.ndarray, move: np.ndarray, chains: Chains):
    """Marginals of label 1, expected moves and the log partition of chains of
    lines whose label 1 has log odds ``score``."""
    n = len(score)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    node = np.stack([np.zeros(n), score], axis=1)
    steps = list(chains.steps())
    for t, at in enumerate(steps):
        if t == 0:
            alpha[at] = node[at]
        else:
            prev = alpha[at - 1]
            alpha[at] = node[at] + np.logaddexp(prev[:, :1] + move[0], prev[:, 1:] + move[1])
    for t in range(len(steps) - 2, -1, -1):
        at = steps[t][: len(steps[t + 1])]
        after = beta[at + 1] + node[at + 1]
        beta[at, 0] = np.logaddexp(move[0, 0] + after[:, 0], move[0, 1] + after[:, 1])
        beta[at, 1] = np.logaddexp(move[1, 0] + after[:, 0], move[1, 1] + after[:, 1])
    last = chains.start + chains.size - 1
    log_z = np.logaddexp(alpha[last, 0], alpha[last, 1])
    z = np.repeat(log_z, chains.size)
    marginal = np.exp(alpha[:, 1] + beta[:, 1] - z)
    inner = np.ones(n, bool)
    inner[last] = False
    at = np.flatnonzero(inner)
    moves = np.exp(
        alpha[at][:, :, None] + move[None] + (node[at + 1] + beta[at + 1])[:, None, :] - z[at][:, None, None]
    ).sum(axis=0)
    return marginal, moves, log_z


class LineField:
    """The fitted field: standardised features, weights, moves, calibration."""

    def __init__(self, mean, scale, weight, bias, move, slope, shift, prior):
        self.mean, self.scale, self.weight, self.bias, self.move = mean, scale, weight, bias, move
        self.slope, self.shift, self.prior = slope, shift, prior

    def raw(self, f: np.ndarray, size: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
        """Length-weighted mean log odds of each row's marginals; NaN without lines."""
        if not len(f):
            return np.full(n_rows, np.nan)
        marginal, _, _ = forward_backward((f - self.mean) / self.scale @ self.weight + self.bias, self.move, Chains(row))
        weight = np.bincount(row, size, n_rows)
        mean = np.bincount(row, size * marginal, n_rows) / np.where(weight > 0, weight, np.nan)
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = self.raw(*line_features(data, offsets), len(offsets) - 1)
        return np.where(np.isnan(raw), self.prior, 1 / (1 + np.exp(-(self.slope * np.nan_to_num(raw) + self.shift))))


def train(f: np.ndarray, size: np.ndarray, row: np.ndarray, labels: np.ndarray) -> LineField:
    """Gradient ascent (Adam) on the mean log likelihood of the labelled lines;
    ``row`` ascends and indexes ``labels``."""
    prior = float(labels.mean()) if len(labels) else 0.5
    width = f.shape[1]
    if not len(f) or prior in (0.0, 1.0):
        return LineField(np.zeros(width), np.ones(width), np.zeros(width), 0.0, np.zeros((2, 2)), 0.0, 50.0 if prior == 1 else -50.0 if prior == 0 else 0.0, prior)
    mean, scale = f.mean(axis=0), f.std(axis=0) + 1e-6
    x = (f - mean) / scale
    y = labels[row].astype(np.float64)
    chains = Chains(row)
    inner = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner].astype(int), y[inner + 1].astype(int)), 1)
    theta = np.zeros(width + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, EPOCHS + 1):
        marginal, moves, _ = forward_backward(x @ theta[:width] + theta[width], theta[width + 1 :].reshape(2, 2), chains)
        gap = y - marginal
        grad = np.concatenate([x.T @ gap, [gap.sum()], (seen - moves).ravel()]) / len(y) - RIDGE * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    model = LineField(mean, scale, theta[:width], theta[width], theta[width + 1 :].reshape(2, 2), 1.0, 0.0, prior)
    raw = model.raw(f, size, row, len(labels))
    ok = ~np.isnan(raw)
    model.slope, model.shift = _calibrate(raw[ok], labels[ok].astype(np.float64))
    return model


def _calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by ridge-regularised Newton steps."""
    a = np.array([1.0, 0.0])
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        a += np.clip(np.linalg.solve(h, x.T @ (y - p) - 1e-2 * (a - [1, 0])), -1, 1)
    return max(float(a[0]), 1e-3), float(a[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineField:
    """``docs``: doc_id, text; ``labels``: doc_id, label (0/1, no nulls, one row
    per id).  Features of at most ``sample`` documents are computed in Spark and
    trained on the driver."""
    labelled = labelled_sample(docs, labels.select("doc_id", F.col("label").cast("int").alias("label")), sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_blocks(batch.column(1)):
                f, size, row = line_features(data, offsets)
                cuts = np.searchsorted(row, np.arange(len(offsets)))
                part = batch.slice(at, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([f[a:b].astype(np.float32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                        pa.array([size[a:b].astype(np.int64).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    names=["doc_id", "label", "f", "size"],
                )

    id_type = labelled.schema["doc_id"].dataType.simpleString()
    rows = (
        labelled.select("doc_id", "text", "label")
        .mapInArrow(features, f"doc_id {id_type}, label int, f binary, size binary")
        .orderBy("doc_id")
        .collect()
    )
    width = 3 * 14
    parts = [np.frombuffer(r.f, np.float32).reshape(-1, width).astype(np.float64) for r in rows]
    size = np.concatenate([np.frombuffer(r["size"], np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    f = np.concatenate(parts) if parts else np.zeros((0, width))
    return train(f, size, row, np.array([r.label for r in rows]))


def predict(docs: DataFrame, model: LineField, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, predicted.  A text without a word
    (null, empty, blank) has the share of label 1 in training as score.  Repeated
    rows are scored each; other columns are ignored."""
    src = text_of(docs, id_col, text_col)
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_blocks(batch.column(1)):
                score = shared_model.value.score(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(score)), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, model: LineField, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents the classifier does not reject, with all their columns.
    Each row is decided where it is read: ids may be null or repeated."""
    shared_model = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_blocks(batch.column(text_at)):
                good = shared_model.value.score(data, offsets) >= threshold
                yield batch.slice(at, len(good)).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
