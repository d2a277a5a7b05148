"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its words and
word beginnings; the document's is their noisy-or, 1 - prod(1 - p). Only documents are
labelled: gradients pass through the noisy-or to the sentences, so training finds out
which sentences offend, and scoring points at them.

The fit takes a bounded sample of labelled rows (``TOXIC``, ``CLEAN``) and the
``FEATURES`` terms that stand out most in toxic ones (by log likelihood against chance);
all rows are scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import first_by_hash, id_remainder, materialise, read_table, sample_rows, sigmoid, text_udf

TOXIC, CLEAN, FEATURES = 5_000, 10_000, 20_000
LEAST_EVIDENCE, LEAST_LIFT = 6.0, 3.0
BEGINNINGS = (4, 5, 6)
ROUNDS, LEARNING_RATE, PENALTY, DROPPED = 600, 0.1, 2e-5, 0.5
SPLIT, HELD_OUT, THRESHOLD = 3, 1, 0.7
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of a text's sentences; null and empty texts have none."""
    return [m.span() for m in _SENTENCE.finditer(text or "") if not m.group().isspace()]


def terms(word: str) -> list[str]:
    """The word itself (with an end mark) and its beginnings."""
    return [word + "$"] + [word[:k] for k in BEGINNINGS if len(word) >= k]


class BagModel:
    """Weights of terms and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "known": {}}

    def _word(self, word: str) -> float:
        if len(self.known) > 300_000:
            self.known.clear()
        get = self.weights.get
        value = self.known[word] = sum(get(t, 0.0) for t in terms(word))
        return value

    def sentence_scores(self, text: str | None) -> list[tuple[int, int, float]]:
        low, known, out = text or "", self.known, []
        for a, b in sentences(low):
            total = 0.0
            for w in set(_WORD.findall(low[a:b].lower())):
                value = known.get(w)
                total += self._word(w) if value is None else value
            out.append((a, b, 1 / (1 + math.exp(-max(-40.0, min(40.0, total + self.bias))))))
        return out

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        found = self.sentence_scores(text)
        return 1 - math.exp(sum(math.log1p(-min(p, 1 - 1e-15)) for _, _, p in found)), found


def fit_bags(bags: list[list[list[int]]], rest: list[int], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise the noisy-or's log loss by Adam. bags: for each
    document the term numbers of its sentences that have any; rest: its other sentences.

    Two thirds of the rounds leave out a share of the terms, and the toxic documents that
    then have none, so that every offending term learns to carry a sentence alone."""
    sentence_doc = np.array([d for d, bag in enumerate(bags) for _ in bag], np.int64)
    flat = [s for bag in bags for s in bag]
    entry_sentence = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    entry_term = np.array([t for s in flat for t in s], np.int64)
    rest, y = np.array(rest, float), labels.astype(float)
    w, b = np.zeros(size), -5.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    each = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    rng = np.random.RandomState(17)
    for t in range(1, ROUNDS + 1):
        kept = rng.rand(size) >= (DROPPED if 3 * t < 2 * ROUNDS else 0)   # the last third fits all terms together
        here = kept[entry_term]
        at, term = entry_sentence[here], entry_term[here]
        left = np.bincount(sentence_doc[at], minlength=len(bags)) > 0
        z = np.bincount(at, w[term], len(flat)) + b
        total = np.bincount(sentence_doc, np.logaddexp(0, z), len(bags)) + rest * np.logaddexp(0, b)
        d_total = each * np.where(y == 1, left * -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)
        dz = sigmoid(z) * d_total[sentence_doc]
        g = np.bincount(term, dz[at], size) + PENALTY * w
        g = np.append(g, dz.sum() + (d_total * rest).sum() * sigmoid(b))
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        step = LEARNING_RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-10)
        w = np.maximum(0.0, w - step[:-1])   # a term can make a sentence offend, none can excuse it
        b -= step[-1]
    return w, float(b)


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of the sample that hold each term, by label; summed a task."""
    found = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, y in zip(batch["__text"], batch["__y"]):
            found[int(y)].update({t for w in set(_WORD.findall((text or "").lower())) for t in terms(w)})
    for y, counter in found.items():
        if counter:
            yield pd.DataFrame({"term": list(counter), "y": y, "n": list(counter.values())})


def _bags_udf(number: dict[str, int]):
    def bag(text: str | None) -> dict:
        at, term, rest, k = [], [], 0, 0
        for a, b in sentences(text):
            here = sorted({number[t] for w in set(_WORD.findall(text[a:b].lower())) for t in terms(w) if t in number})
            if here:
                at += [k] * len(here)
                term += here
                k += 1
            else:
                rest += 1
        return {"sentence": at, "term": term, "rest": rest}

    return text_udf("sentence array<int>, term array<int>, rest int", lambda: lambda texts: [bag(t) for t in texts])


def train_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
                   toxic: int = TOXIC, clean: int = CLEAN, features: int = FEATURES) -> BagModel | None:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    known = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__y"))
             .filter(id_remainder("__id", SPLIT) != HELD_OUT))
    parts = [first_by_hash(sample_rows(known.filter(F.col("__y") == y), n, "__id"), 2 * n, "__id") for y, n in ((1, toxic), (0, clean))]
    chosen = parts[0].unionByName(parts[1])      # ids: bounded, so broadcast
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    rows = materialise(rows, "labelled")     # read three times below
    sizes = {r["__y"]: r["n"] for r in rows.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    counts = rows.select("__text", "__y").mapInPandas(_term_counts, "term string, y int, n long")
    lift = (F.col("toxic") / sizes[1]) / (F.col("clean") / sizes[0] + 0.5 / sizes[0] + 1e-4)
    n, share = F.col("toxic") + F.col("clean"), sizes[1] / (sizes[0] + sizes[1])
    # log likelihood of the term's own toxic share against that of all documents
    evidence = (F.col("toxic") * F.log(F.col("toxic") / (n * share))
                + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - share)))).otherwise(0.0))
    standing = (counts.groupBy("term").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                                           F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean"))
                .filter("toxic > 0").filter(lift >= LEAST_LIFT).withColumn("evidence", evidence).filter(F.col("evidence") >= LEAST_EVIDENCE)
                .orderBy(F.desc("evidence"), "term").limit(features).collect())
    number = {r.term: k for k, r in enumerate(standing)}
    if not number:
        return None
    bagged = rows.select(F.xxhash64(F.lit(9), "__id", "__text").alias("__h"), "__y", _bags_udf(number)(F.col("__text")).alias("b"))
    found = first_by_hash(bagged.select("__h", "__y", "b.*"), 4 * (toxic + clean), "__h", "__y", "sentence", "term", "rest").collect()
    bags = []
    for r in found:
        bag: list[list[int]] = [[] for _ in range(r.sentence[-1] + 1 if r.sentence else 0)]
        for s, t in zip(r.sentence, r.term):
            bag[s].append(t)
        bags.append(bag)
    w, b = fit_bags(bags, [r.rest for r in found], np.array([r["__y"] for r in found]), len(number))
    return BagModel({t: float(w[k]) for t, k in number.items() if abs(w[k]) > 1e-6}, b)


def score_udf(model: BagModel | None):
    def score(text: str | None) -> dict:
        total, found = model.score(text) if model else (0.0, [])
        return {"score": total, "sentences": len(found),
                "offending": [{"start": a, "end": b, "score": p} for a, b, p in found if p >= 0.5]}

    return text_udf("score double, sentences int, offending array<struct<start:int,end:int,score:double>>",
                    lambda: lambda texts: [score(t) for t in texts])


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 if score >= 0.7), and
    offending: the character spans and scores of the sentences at 0.5 or more.

    A text without a sentence (null, empty, white space) has score 0. A null doc_id counts
    as empty text for the split; an id labelled twice is toxic if any label says so;
    without labels of both kinds every score is 0; an empty table gives no rows."""
    model = train_toxicity(docs, labels, doc_id, text)
    return (docs.select(F.col(doc_id).alias("doc_id"), (id_remainder(doc_id, SPLIT) == HELD_OUT).alias("held_out"),
                        score_udf(model)(F.col(text)).alias("s"))
            .select("doc_id", "held_out", "s.score", (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), "s.offending"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
