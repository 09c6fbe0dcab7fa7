"""Toxicity by weak supervision.

1. Voters.  On a bounded sample of labelled training documents, words (lexicon
   voters) and within-word character runs (pattern voters) are ranked by how
   much more often toxic documents hold them.  A voter votes "toxic" where its
   term occurs and abstains elsewhere.
2. Label model.  Expectation-maximisation over the votes alone estimates every
   voter's hit rates under both classes.  Correlations are the covariances of
   two voters' votes that remain given the class; a voter's evidence is divided
   by the correlated evidence it repeats.  The result is a posterior label for
   every sampled document - the given labels choose voters, not posteriors.
3. Classifier.  A logistic regression on a wider set of terms is trained on the
   posterior labels; it alone scores documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import chunks, letters, q_grams
from .common import labelled_sample, text_of
from .tokens import U64, Powers, mix, range_hashes

# Voters and classifier are fitted on at most so many labelled documents.
SAMPLE = 12000
WORD_VOTERS, PATTERN_VOTERS, TERMS = 64, 64, 1024
GRAM = 6
MIN_DOCS, MIN_LIFT = 4, 16.0
THRESHOLD = 0.5
TERM_POWERS = Powers(0xE7037ED1A0B428DB)
FILTER_BITS = 22


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of every word (even hashes) and within-word character run
    (odd hashes) of the texts, with repetitions."""
    chars, bounds = letters(texts)
    solid = chars != 0x20
    edge = np.concatenate([[False], solid, [False]])
    starts, ends = np.flatnonzero(edge[1:-1] & ~edge[:-2]), np.flatnonzero(edge[1:-1] & ~edge[2:]) + 1
    words = range_hashes(mix(chars.astype(U64) + U64(1)), starts, ends, TERM_POWERS) & ~U64(1)
    grams, at = q_grams(chars, bounds, GRAM)
    gaps = np.concatenate([[0], np.cumsum(~solid)])
    inside = gaps[at + GRAM] == gaps[at]
    grams, at = grams[inside] | U64(1), at[inside]
    row = np.searchsorted(bounds, np.concatenate([starts, at]), "right") - 1
    return row, np.concatenate([words, grams])


class TermSet:
    """A sorted set of terms with a bit filter in front of the exact lookup."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.unique(terms.astype(U64))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.terms >> U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, row: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, index) of the terms that are in the set."""
        maybe = np.flatnonzero(self.filter[(terms >> U64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, terms = row[maybe], terms[maybe]
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        hit = self.terms[at] == terms
        pair = np.unique(row[hit] * len(self.terms) + at[hit])
        return pair // len(self.terms), pair % len(self.terms)


# ------------------------------------------------------------ label model --

def label_model(votes: np.ndarray, prior: float, rounds: int = 30) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 for every row of 0/1 votes, and the parameters.

    A vote of voter j weighs log(hit[1, j] / hit[0, j]), its hit rates under the
    two classes; no vote is no evidence.  That ratio is divided by the voter's
    repeated evidence: one plus the squared correlations with other voters that
    are left given the class.  Rows without any vote keep a small part of the
    prior; the intercept gives the rows with votes the rest of the class (at
    most 95 % of them), which ties the classes down while rates are estimated.
    """
    n, v = votes.shape
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    if not n or not v:
        return np.full(n, prior), {"hit": np.zeros((2, v)), "weight": np.ones(v)}
    x = votes.astype(np.float64)
    voted = x.any(axis=1)
    share = min(0.95, prior * n / max(voted.sum(), 1))

    def posterior(evidence: np.ndarray) -> np.ndarray:
        out = np.full(n, prior * 0.05)
        if voted.any():
            out[voted] = _tied(evidence[voted], share)
        return out

    post = posterior(np.log1p(x.sum(axis=1)))
    for _ in range(rounds):
        mass = np.array([(1 - post).sum(), post.sum()])
        hit = (np.stack([(1 - post) @ x, post @ x]) + np.array([[0.5], [0.5]]) * x.mean(axis=0)) / (mass[:, None] + 0.5)
        weight = 1 / (1 + _repeated_evidence(x, post, hit))
        post = posterior(x @ (weight * np.maximum(np.log(hit[1]) - np.log(hit[0]), 0)))
    return post, {"hit": hit, "weight": weight}


def _tied(evidence: np.ndarray, prior: float) -> np.ndarray:
    """Sigmoid of the evidence with the intercept that gives a mean of prior."""
    low, high = -60.0 - evidence.max(), 60.0
    for _ in range(60):
        middle = (low + high) / 2
        post = 1 / (1 + np.exp(-np.clip(evidence + middle, -30, 30)))
        low, high = (middle, high) if post.mean() < prior else (low, middle)
    return post


def _repeated_evidence(x: np.ndarray, post: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """For every voter the sum of squared correlations with the others that are
    left given the class."""
    total = np.zeros((x.shape[1], x.shape[1]))
    for c, mass in ((0, 1 - post), (1, post)):
        centred = x - hit[c]
        total += (centred * mass[:, None]).T @ centred
    sd = np.sqrt(np.maximum(np.diag(total), 1e-9))
    corr = np.where(np.eye(len(sd), dtype=bool), 0, total / sd[:, None] / sd[None, :])
    return (np.maximum(corr, 0) ** 2).sum(axis=1)


class LinearModel:
    """Logistic regression over term presence."""

    def __init__(self, terms: TermSet, weight: np.ndarray, bias: float):
        self.terms, self.weight, self.bias = terms, weight, bias

    def score(self, texts: list[str]) -> np.ndarray:
        row, at = self.terms.find(*terms_of(texts))
        logit = self.bias + np.bincount(row, self.weight[at], len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train_linear(row: np.ndarray, at: np.ndarray, n_rows: int, n_terms: int, target: np.ndarray, steps: int = 300, ridge: float = 2e-4):
    """Weights and bias by Adam on the cross-entropy with soft targets."""
    theta, first, second = np.zeros(n_terms + 1), np.zeros(n_terms + 1), np.zeros(n_terms + 1)
    if not n_rows:
        return theta[:-1], 0.0
    mean = min(max(float(target.mean()), 1e-3), 1 - 1e-3)
    theta[-1] = np.log(mean / (1 - mean))
    for step in range(1, steps + 1):
        logit = theta[-1] + np.bincount(row, theta[at], n_rows)
        gap = target - 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        grad = np.concatenate([np.bincount(at, gap[row], n_terms), [gap.sum()]]) / n_rows
        grad[:-1] -= ridge * theta[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


# ------------------------------------------------------------- Spark jobs --

def _association(sample: DataFrame, prior_docs: tuple[int, int]) -> DataFrame:
    """(term, toxic, clean): documents of the sample that hold the term, for
    terms that pass the support and lift bounds.  Counts are summed per Arrow
    batch, then by a partial aggregate."""

    def per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column(2))
            for at, texts in chunks(batch.column(1).to_pylist()):
                row, terms = terms_of(texts)
                order = np.lexsort((row, terms))
                row, terms = row[order], terms[order]
                new = np.concatenate([[True], (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])]) if len(row) else np.zeros(0, bool)
                row, terms = row[new], terms[new]
                uniq, back = np.unique(terms, return_inverse=True)
                toxic = np.bincount(back, label[at + row], len(uniq)).astype(np.int64)
                total = np.bincount(back, minlength=len(uniq))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uniq.view(np.int64)), pa.array(toxic), pa.array(total - toxic)], names=["term", "toxic", "clean"]
                )

    counts = sample.mapInArrow(per_document, "term bigint, toxic bigint, clean bigint")
    n_toxic, n_clean = prior_docs
    lift = ((F.col("toxic") + 0.1) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    return (
        counts.groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= MIN_DOCS) & (lift >= MIN_LIFT))
        .withColumn("gain", F.col("toxic") * F.log(lift))
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LinearModel:
    """``docs``: doc_id, text; ``labels``: doc_id, label (0/1, no nulls, one row
    per id).  Only per-term totals of the chosen terms and the sample's
    occurrences of them reach the driver."""
    labels = labels.select("doc_id", F.col("label").cast("int").alias("label"))
    rows = labelled_sample(docs, labels, sample).select("doc_id", "text", "label")
    n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    n_toxic, n_clean = int(n[0]), int(n[1] - n[0])
    if not n_toxic or not n_clean:
        bias = 30.0 if n_toxic else -30.0 if n_clean else 0.0
        return LinearModel(TermSet(np.zeros(0, U64)), np.zeros(0), bias)
    chosen = _association(rows, (n_toxic, n_clean)).orderBy(F.desc("gain"), "term").limit(4 * TERMS).collect()
    terms = np.array([r.term for r in chosen], np.int64).view(U64)
    is_word = (terms & U64(1)) == 0
    voters = np.concatenate([terms[is_word][:WORD_VOTERS], terms[~is_word][:PATTERN_VOTERS]])
    wide = TermSet(np.concatenate([terms[is_word][:TERMS], terms[~is_word][:TERMS]]))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1).to_pylist()):
                row, index = wide.find(*terms_of(texts))
                cuts = np.searchsorted(row, np.arange(len(texts) + 1))
                found = [index[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(found, pa.binary())], names=["doc_id", "found"]
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    held = rows.mapInArrow(occurrences, f"doc_id {id_type}, found binary").orderBy("doc_id").collect()
    found = [np.frombuffer(r.found, np.int32) for r in held]
    row = np.repeat(np.arange(len(held)), [len(f) for f in found])
    at = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
    place = np.searchsorted(wide.terms, np.unique(voters))
    column = np.full(len(wide.terms), -1)
    column[place] = np.arange(len(place))
    votes = np.zeros((len(held), len(place)), np.uint8)
    cast = column[at] >= 0
    votes[row[cast], column[at][cast]] = 1
    posterior, _ = label_model(votes, n_toxic / (n_toxic + n_clean))
    weight, bias = train_linear(row, at, len(held), len(wide.terms), posterior)
    return LinearModel(wide, weight, bias)


def predict(docs: DataFrame, model: LinearModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, predicted.  A text without a known
    term (null and empty ones too) has the classifier's base score.  Repeated
    rows are scored each; other columns are ignored."""
    src = text_of(docs, id_col, text_col)
    shared_model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1).to_pylist()):
                score = shared_model.value.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(score)), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
