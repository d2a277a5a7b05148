"""Quality classifier learned from positive and unlabelled texts.

Trusted positives (labelled 1) and unlabelled web text are described by figures about
words, signs, lines and repetition; each figure is cut into quantile bins and an
additive logistic model minimises the non-negative unbiased risk
``p R+(positives) + max(0, R-(unlabelled) - p R-(positives))``. The class prior p is
estimated by best-bin estimation on cross-fitted scores: a first positive-against-unlabelled
model scores the fold of documents that it was not fitted on, as positives or as text.

The fit takes bounded samples (``POSITIVES``, ``UNLABELLED`` rows at most twice over),
drawn and ordered by a hash of id and text, so one table has one model however it is laid
out; every row of the table is scored from its whole text.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import first_by_hash, id_remainder, read_table, sample_rows, sigmoid, text_udf

POSITIVES, UNLABELLED = 15_000, 25_000
BINS, ROUNDS, LEARNING_RATE, PENALTY = 16, 400, 0.05, 3e-4
FOLDS = 5
SPLIT, HELD_OUT, THRESHOLD = 3, 1, 0.5

_KIND = np.zeros(256, np.int64)   # of bytes: 0 other signs, 1 lower, 2 upper, 3 digit, 4 usual punctuation, 5 space, 6 line end, 7 beyond ASCII
for _k, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:'\"()-", " \t\r", "\n"], 1):
    _KIND[[ord(c) for c in _chars]] = _k
_KIND[128:] = 7


def figures(text: str | None) -> list[float]:
    """What the model sees of a text; null counts as empty."""
    text = text or ""
    words = text.split()
    n, size = len(words), max(1, len(text.encode()))
    by_byte = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    kind = np.bincount(_KIND, weights=by_byte, minlength=8) / size
    share = by_byte[by_byte > 0] / size
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    distinct = len(set(words))
    triples = max(1, n - 2)
    return [
        math.log1p(n), len(text) / max(1, n), distinct / max(1, n), distinct / math.sqrt(max(1, n)),
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 0.0,
        kind[0], kind[2] / max(1e-9, kind[1] + kind[2]), kind[3], kind[4], kind[5], kind[6] * 100, kind[7],
        -float((share * np.log(share)).sum()),
        1 - len(set(filled)) / max(1, len(filled)), math.log1p(len(text) / max(1, len(filled))),
        max(map(len, words), default=0) / 10, text.count(".") / max(1, n), by_byte[ord("!")] / max(1, n),
    ]


class BinnedModel:
    """Additive logistic model over quantile bins of figures."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, bias: float):
        self.edges, self.weights, self.bias = edges, weights, bias

    def bins(self, x: np.ndarray) -> np.ndarray:
        size = self.edges.shape[1] + 1
        return np.stack([np.searchsorted(e, x[:, k], side="right") + size * k for k, e in enumerate(self.edges)], axis=1)

    def margin(self, binned: np.ndarray) -> np.ndarray:
        return self.weights[binned].sum(axis=1) + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(self.bins(x)))


def _fit(edges: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, gradient) -> BinnedModel:
    """Adam on the risk whose margins' gradients ``gradient(positive, unlabelled)`` gives."""
    model = BinnedModel(edges, np.zeros(edges.shape[0] * (edges.shape[1] + 1)), 0.0)
    p, u = model.bins(positive), model.bins(unlabelled)
    size = len(model.weights)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, ROUNDS + 1):
        gp, gu = gradient(model.margin(p), model.margin(u))
        g = np.bincount(p.ravel(), np.repeat(gp, p.shape[1]), size) + np.bincount(u.ravel(), np.repeat(gu, u.shape[1]), size)
        g = np.append(g + PENALTY * model.weights, gp.sum() + gu.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        step = LEARNING_RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        model.weights -= step[:-1]
        model.bias -= step[-1]
    return model


def _against_unlabelled(p: np.ndarray, u: np.ndarray):
    """Gradients of the logistic risk that tells positives from unlabelled rows."""
    return -sigmoid(-p) / len(p) / 2, sigmoid(u) / len(u) / 2


def non_negative_risk(prior: float):
    """Gradients of the non-negative risk with the sigmoid loss. Where the negative part
    falls below zero, its step is taken backwards, so it can't be driven further down."""
    def gradient(p: np.ndarray, u: np.ndarray):
        p, u = sigmoid(p), sigmoid(u)
        slope_p, slope_u = prior * p * (1 - p) / len(p), u * (1 - u) / len(u)
        if u.mean() < prior * p.mean():
            return slope_p, -slope_u
        return -2 * slope_p, slope_u
    return gradient


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Best-bin estimation (Garg et al. 2021): the least ratio, over score thresholds, of
    the unlabelled share above to the positive share above, with its confidence margin."""
    u, p = np.sort(unlabelled), np.sort(positive)
    cuts = np.unique(np.concatenate([u, p]))
    above_u = 1 - np.searchsorted(u, cuts, side="left") / len(u)
    above_p = 1 - np.searchsorted(p, cuts, side="left") / len(p)
    margin = math.sqrt(math.log(40) / 2 / len(u)) + math.sqrt(math.log(40) / 2 / len(p))
    use = above_p > 0
    bound = (above_u[use] + margin) / above_p[use]
    best = int(bound.argmin())
    return float(np.clip(above_u[use][best] / above_p[use][best], 0.02, 0.98))


def cross_fitted_prior(edges: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, folds: tuple[np.ndarray, np.ndarray]) -> float:
    """``class_prior`` of margins that each fold gets from a model of the other folds. A document
    is in one fold, as a positive and as unlabelled text: seen as a positive, it would score
    too high as text."""
    margins = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for k in range(FOLDS):
        here = [f % FOLDS == k for f in folds]
        model = _fit(edges, positive[~here[0]], unlabelled[~here[1]], _against_unlabelled)
        for out, rows, mine in zip(margins, (positive, unlabelled), here):
            out[mine] = model.margin(model.bins(rows[mine]))
    return class_prior(*margins)


def fit_quality(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None,
                folds: tuple[np.ndarray, np.ndarray] | None = None) -> BinnedModel | None:
    """The model, or None where there is nothing to learn from. ``folds``: a number for each
    row, the same for a document wherever it stands (None: rows are documents of their own)."""
    if len(positive) < 10 or len(unlabelled) < 10:
        return None
    both = np.concatenate([positive, unlabelled])
    edges = np.quantile(both, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    if folds is None:
        folds = np.arange(len(positive)), np.arange(len(unlabelled))
    if prior is None:
        prior = cross_fitted_prior(edges, positive, unlabelled, folds)
    return _fit(edges, positive, unlabelled, non_negative_risk(prior))


def figures_udf():
    return text_udf("binary", lambda: lambda texts: [np.array(figures(t)).tobytes() for t in texts])


def score_udf(model: BinnedModel | None):
    def score(texts: list[str | None]) -> np.ndarray:
        return model.score(np.array([figures(t) for t in texts])) if model else np.full(len(texts), 0.5)

    return text_udf("double", lambda: score)


def _gathered(rows: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Figures and hashes of at most twice ``bound`` rows (__id, __text), in the order of the hash."""
    described = rows.select(F.xxhash64(F.lit(9), "__id", "__text").alias("__h"), figures_udf()(F.col("__text")).alias("x"))
    found = first_by_hash(described, 2 * bound, "__h", "x").collect()
    x = np.stack([np.frombuffer(r.x) for r in found]) if found else np.zeros((0, 0))
    return x, np.array([r["__h"] for r in found], np.int64)


def train_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> BinnedModel | None:
    """Fit on rows that are not held out: those labelled 1, and unlabelled text (any row)."""
    learn = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).filter(id_remainder("__id", SPLIT) != HELD_OUT)
    good = labels.filter(F.col(label) == 1).select(F.col(doc_id).alias("__id")).distinct().filter(id_remainder("__id", SPLIT) != HELD_OUT)
    chosen = first_by_hash(sample_rows(good, positives, "__id"), 2 * positives, "__id")   # ids only: bounded, so broadcast
    trusted = learn.join(F.broadcast(chosen), "__id", "left_semi")
    (good_x, good_h), (any_x, any_h) = _gathered(trusted, positives), _gathered(sample_rows(learn, unlabelled, "__id", "__text"), unlabelled)
    return fit_quality(good_x, any_x, folds=(good_h, any_h))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 if score >= 0.5).

    A null or empty text is scored like any other; a null doc_id counts as empty text for
    the split; repeated rows each get a row; without labels every score is 0.5; an empty
    table gives no rows. Labels of ids that the table lacks, and null labels, are unused."""
    model = train_quality(docs, labels, doc_id, text)
    return docs.select(F.col(doc_id).alias("doc_id"), (id_remainder(doc_id, SPLIT) == HELD_OUT).alias("held_out"),
                       score_udf(model)(F.col(text)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; all columns."""
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    return (docs.withColumn("__score", score_udf(model)(F.col("text")))
            .filter(F.col("__score") >= THRESHOLD).select(*docs.columns))
