import math
import random
import zlib

import numpy as np
import pytest

from feedlens.llm import quality as Q, toxicity as X

SF = "/root/testdata/sf0.1"


def _auc(y, p):
    p, y = np.asarray(p), np.asarray(y)
    above = (p[y == 1][:, None] > p[y == 0][None, :]).mean()
    return above + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).mean()


@pytest.fixture(scope="module")
def truth(spark):
    return {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def _held_out(rows, truth, k):
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    return [(truth[r.doc_id][k], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in truth]


def test_quality_on_held_out_rows(spark, truth):
    rows = Q.op3_quality(spark, SF).collect()
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= 0.5) for r in rows)
    y, score, predicted = map(np.array, zip(*_held_out(rows, truth, 0)))
    assert _auc(y, score) > 0.99
    assert predicted[y == 1].mean() > 0.99 and predicted[y == 0].mean() < 0.05


def test_toxicity_on_held_out_rows(spark, truth):
    rows = X.op10_toxicity(spark, SF).collect()
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= 0.7) for r in rows)
    y, score, predicted = map(np.array, zip(*_held_out(rows, truth, 1)))
    assert _auc(y, score) > 0.97
    assert predicted[y == 1].mean() > 0.85 and predicted[y == 0].mean() < 0.02


def test_prior_of_a_known_mixture():
    rng = np.random.RandomState(0)
    for prior in (0.2, 0.6, 0.85):
        n = 20_000
        good = rng.rand(n) < prior
        unlabelled = np.where(good, rng.beta(6, 2, n), rng.beta(1, 6, n))
        assert abs(Q.class_prior(rng.beta(6, 2, n), unlabelled) - prior) < 0.06


def test_gradient_is_that_of_the_risk():
    rng = np.random.RandomState(1)
    p, u = rng.randn(50) + 1, rng.randn(70)
    for prior in (0.3, 0.99):
        def risk(p, u):
            negative = Q.sigmoid(u).mean() - prior * Q.sigmoid(p).mean()
            return prior * Q.sigmoid(-p).mean() + negative if negative >= 0 else -negative
        gp, gu = Q.non_negative_risk(prior)(p, u)
        for k in range(3):
            e = np.zeros(50)
            e[k] = 1e-5
            assert abs((risk(p + e, u) - risk(p - e, u)) / 2e-5 - gp[k]) < 1e-8
            e = np.zeros(70)
            e[k] = 1e-5
            assert abs((risk(p, u + e) - risk(p, u - e)) / 2e-5 - gu[k]) < 1e-8


@pytest.mark.parametrize("text", [None, "", " \n\t", "word", "a" * 100_000, "\n" * 1000, "é 日本 😀"])
def test_figures_are_finite(text):
    assert all(map(math.isfinite, Q.figures(text)))


def _labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_edge_rows(spark, make_docs):
    rng = random.Random(1)
    words = "the sea is calm tonight and full of light on every side".split()
    rows = [(k, " ".join(rng.choice(words) for _ in range(60)) + ".") if k % 4 else (k, "x! " * 40) for k in range(400)]
    rows += [(7, "repeat"), (7, "repeat"), (None, "no id"), (901, None), (902, "")]
    labels = _labelled(spark, [(k, int(k % 4 > 0), 0) for k in range(400)] + [(None, 1, 1), (5000, 1, None), (3, None, None)])
    got = Q.quality_scores(make_docs(rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 400 and r.doc_id != 7:
            assert r.predicted == int(r.doc_id % 4 > 0)
    none = Q.quality_scores(make_docs(rows), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.quality_scores(make_docs([]), labels).collect() == []


def test_stage_keeps_all_but_the_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = Q.quality_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(
        r.doc_id for r in Q.op3_quality(spark, SF).collect() if r.predicted)


def test_noisy_or_and_located_sentences():
    model = X.BagModel({"idiot$": 9.0, "lowei": 7.0}, -6.0)
    text = "A calm one. You idiot! Nothing\nloweixyz here. An IDIOT"
    score, found = model.score(text)
    assert [text[a:b].strip() for a, b, p in found if p >= 0.5] == ["You idiot", "loweixyz here", "An IDIOT"]
    assert score == pytest.approx(1 - math.prod(1 - p for _, _, p in found))
    assert model.score(None)[0] == model.score("")[0] == model.score(" .\n!")[0] == 0


def test_bags_learn_the_offending_term():
    rng = random.Random(2)
    bags, labels = [], []
    for _ in range(400):
        y = rng.random() < 0.4
        bag = [[rng.randrange(1, 10) for _ in range(3)] for _ in range(rng.randrange(1, 6))]
        if y:
            rng.choice(bag).append(0)
        bags.append([sorted(set(s)) for s in bag])
        labels.append(int(y))
    w, b = X.fit_bags(bags, [5] * 400, np.array(labels), 10)
    assert w[0] + b > 1 and all(x + b < -1 for x in w[1:])


def test_toxicity_edge_rows(spark, make_docs):
    rows = [(k, "calm words here. " * 3 + ("you utter gribblot. " if k % 3 == 0 else "") + f"end {k}") for k in range(300)]
    rows += [(None, "you utter gribblot. calm words"), (901, None), (902, ""), (903, "word " * 50_000 + ". you utter gribblot"), (5, "repeat"), (5, "repeat")]
    labels = _labelled(spark, [(k, 1, int(k % 3 == 0)) for k in range(300)] + [(None, 1, 1), (4, 1, None), (7000, 1, 1)])
    got = X.toxicity_scores(make_docs(rows), labels).collect()
    assert len(got) == len(rows)
    text = {i: t for i, t in rows}
    for r in got:
        if r.doc_id != 5:
            assert r.predicted == int("gribblot" in (text[r.doc_id] or "")), r
        assert all("gribblot" in text[r.doc_id][s.start:s.end] for s in r.offending)
    assert {r.score for r in X.toxicity_scores(make_docs(rows), labels.filter("toxic = 0")).collect()} == {0.0}
    assert X.toxicity_scores(make_docs([]), labels).collect() == []


LAYOUTS = [lambda d: d.repartition(1), lambda d: d.repartition(7), lambda d: d.repartition(23, "lang").orderBy("text")]


@pytest.mark.parametrize("scores", [Q.quality_scores, X.toxicity_scores])
def test_one_answer_for_one_table_however_it_is_laid_out(spark, scores):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = [{r.doc_id: r.score for r in scores(lay(docs), lay(labels.withColumn("text", labels["doc_id"].cast("string")).withColumn("lang", labels["toxic"])))
              .collect()} for lay in LAYOUTS]
    assert found[0] == found[1] == found[2] and len(set(found[0].values())) > 100


def test_quality_accuracy_on_the_small_fixture(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    y = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, y[r.doc_id]) for r in Q.quality_scores(docs, labels).collect() if r.held_out and r.doc_id in y]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) >= 0.98


def test_sample_with_null_ids_is_neither_all_nor_nothing(spark, make_docs, monkeypatch):
    """All ids null: rows are drawn by id and text, so a share of them is."""
    docs = make_docs([(None, f"text number {k} " * 3) for k in range(3000)])
    rows = docs.selectExpr("doc_id AS __id", "text AS __text")
    from feedlens.llm.common import sample_rows
    assert 200 < sample_rows(rows, 300, "__id", "__text").count() < 400


def test_fit_reaches_the_least_risk_of_a_grid():
    """One figure with two values: the fitted model's risk against every pair of margins."""
    rng = np.random.RandomState(5)
    positive = (rng.rand(300, 1) < 0.85).astype(float)
    unlabelled = (rng.rand(500, 1) < 0.45).astype(float)
    prior = 0.35

    def risk(low, high):
        p, u = (Q.sigmoid(np.where(x[:, 0] > 0.5, high, low)) for x in (positive, unlabelled))
        return prior * (1 - p).mean() + max(0.0, u.mean() - prior * p.mean())

    model = Q.fit_quality(positive, unlabelled, prior)
    low, high = model.margin(model.bins(np.array([[0.0], [1.0]])))
    grid = np.linspace(-8, 8, 65)
    best = min(risk(a, b) for a in grid for b in grid)
    assert high > 1 and low < -1 and risk(low, high) <= best + 0.02


def test_toxicity_scores_against_plain_python(spark):
    """Every score of the fixture from the model's weights, by the definition."""
    import re
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = X.train_toxicity(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in X.toxicity_scores(docs, labels).collect():
        clean, spans, at = 1.0, [], 0
        for part in re.split(r"([.!?\n])", texts[r.doc_id] or ""):
            if part.strip() and part not in ".!?\n":
                total = model.bias
                for word in set(re.findall(r"\w+", part.lower())):
                    total += sum(w for t, w in model.weights.items() if t == word + "$" or (t[-1] != "$" and len(t) in X.BEGINNINGS and word.startswith(t)))
                p = 1 / (1 + math.exp(-total))
                clean *= 1 - p
                if p >= 0.5:
                    spans.append((at, at + len(part)))
            at += len(part)
        assert r.score == pytest.approx(1 - clean, abs=1e-9)
        assert [(s.start, s.end) for s in r.offending] == spans
