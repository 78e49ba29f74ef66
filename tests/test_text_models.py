"""Text classifiers in blocks: the predictions of Spark's own models, without a vocabulary or coefficients on the driver."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from cauce.operators import nmf, term_blocks as TB, text_models as TM
from cauce.plans import mlops

SCHEMA = "doc_id long, text string, label int, split string"


def corpus(n=90, seed=5):
    rng, rows = random.Random(seed), []
    for i in range(n):
        y = int(rng.random() < 0.45)
        words = [f"w{int(rng.expovariate(0.08)) + 4 * (y and rng.random() < 0.4)}" for _ in range(rng.randint(3, 25))] + [f"own{i}"]
        rows.append((i // 2 if i % 9 == 0 else i, " ".join(words), y, rng.choice(["train", "train", "train", "validation", "test"])))
    # ids and rows that repeat, rows without a known word, and without any
    return [*rows, rows[0], rows[0], (500, "unseen words", 1, "test"), (501, "", 0, "validation"), (502, "!", 1, "train")]


def of_spark(d, rounds):
    d = d.withColumn("label", F.col("label").cast("double"))
    train, rest = d.filter("split = 'train'"), d.filter("split != 'train'")
    features = mlops.tfidf_model(train)
    out = []
    for name, clf in (("naive_bayes", NaiveBayes(smoothing=1.0)), ("logistic", LogisticRegression(maxIter=rounds))):
        got = clf.fit(features.transform(train)).transform(features.transform(rest))
        out += [(r.doc_id, r.split, r.label, r.prediction, name) for r in got.collect()]
    return sorted(out)


def test_predictions_of_t19_are_those_of_spark_and_no_model_is_fitted_on_the_driver(spark, monkeypatch):
    d = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    want = of_spark(d, 50)

    def no_fit(*a, **k):
        raise AssertionError("the model would lie on the driver")
    for kind in (CountVectorizer, NaiveBayes, LogisticRegression):
        monkeypatch.setattr(kind, "fit", no_fit)
    monkeypatch.setattr(mlops, "text_frame", lambda spark, sf: d)
    got = mlops.t19(spark, None)
    assert got.columns == ["doc_id", "split", "label", "prediction", "model"]
    assert sorted(map(tuple, got.collect())) == want
    assert len({r[3] for r in want if r[4] == "logistic"}) == 2


def test_few_rounds_and_small_blocks(spark, monkeypatch):
    d = spark.createDataFrame(corpus(60, 8), SCHEMA).repartition(4)
    want = of_spark(d, 4)
    for where, name, size in ((TB, "PIECE", 40), (nmf, "PIECE", 40), (TM, "BLOCK", 100), (TM, "BUCKET", 60)):
        monkeypatch.setattr(where, name, size)
    assert sorted(map(tuple, TM.classify(d, rounds=4).collect())) == want


def test_one_label_alone_and_no_training_rows(spark):
    rows = [(1, "some words", 1, "train"), (2, "more words", 1, "train"), (3, "words", 0, "test")]
    d = spark.createDataFrame(rows, SCHEMA)
    null = spark.createDataFrame([(4, None, 0, "test")], SCHEMA)
    assert [r.prediction for r in TM.classify(d.union(null)).filter("doc_id = 4").collect()] == [0.0, 1.0]
    assert sorted(map(tuple, TM.classify(d).collect())) == of_spark(d, 50) == [(3, "test", 0.0, 0.0, "naive_bayes"), (3, "test", 0.0, 1.0, "logistic")]
    with pytest.raises(ValueError):
        TM.classify(d.filter("split = 'test'"))
    for wrong in (d.withColumn("label", F.lit(2)), d.withColumn("text", F.lit("!"))):
        with pytest.raises(ValueError):
            TM.classify(wrong)


def test_wolfe_step_and_direction():
    phi = lambda t: ((t - 3) ** 2, 2 * (t - 3))
    t = TM.wolfe(phi, 9.0, -6.0, 0.01)
    assert phi(t)[0] <= 9 - 6e-4 * t and abs(phi(t)[1]) <= 0.9 * 6
    assert TM.wolfe(phi, 9.0, -6.0, 100.0) < 6
    with pytest.raises(TM.SearchFailed):
        TM.wolfe(phi, 9.0, 6.0, 1.0)
    # on a quadratic, the newest pair is met exactly: H y = s
    s, y, gram = np.array([1.0, 0.5]), np.array([2.0, 3.0]), np.array([[2.0, 0.3], [0.3, 1.0]])
    assert -TM._direction(gram, [(s, y)], y) == pytest.approx(s)
