"""Model registry: scoring without fitting, leaderboard, prediction log, killed runs."""

import pathlib

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from cauce.operators import metrics as MT
from cauce.sources import models


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(i, float(i), 3.0 * i + 1) for i in range(50)], "id long, x double, y double")


def fitted(frame, reg=0.0):
    return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y", regParam=reg)]).fit(frame)


def test_a_second_session_scores_without_fitting(spark, frame, tmp_table_dir, monkeypatch):
    model = fitted(frame)
    want = {r.id: r.prediction for r in model.transform(frame).collect()}
    assert models.register(spark, tmp_table_dir, model, "linear", {"rmse": 0.0}) == 1

    def no_fit(*a, **k):
        raise AssertionError("scoring must not fit")
    monkeypatch.setattr(Pipeline, "fit", no_fit)
    monkeypatch.setattr(LinearRegression, "fit", no_fit)
    got = models.score(spark.newSession(), tmp_table_dir, frame, "id")
    assert {r.id: r.prediction for r in got.collect()} == want
    assert {(r.model, r.model_version, r.batch) for r in got.collect()} == {("linear", 1, 1)}


def test_leaderboard_and_versions(spark, frame, tmp_table_dir):
    assert models.leaderboard(spark, tmp_table_dir, "rmse").count() == 0
    with pytest.raises(ValueError):
        models.load(spark, tmp_table_dir)
    for name, rmse in (("a", 2.0), ("b", 1.0), ("c", 1.0)):
        models.register(spark, tmp_table_dir, fitted(frame, rmse), name, {"rmse": rmse, "r2": 1 - rmse})
    assert [tuple(r) for r in models.leaderboard(spark, tmp_table_dir, "rmse", smaller_is_better=True).collect()] == [
        (1, 2, "b", 1.0), (2, 3, "c", 1.0), (3, 1, "a", 2.0)]
    assert models.load(spark, tmp_table_dir)[1:] == (3, "c") and models.load(spark, tmp_table_dir, 1)[1:] == (1, "a")
    with pytest.raises(ValueError):
        models.load(spark, tmp_table_dir, 9)


def test_a_killed_registration_is_no_version(spark, frame, tmp_table_dir):
    models.register(spark, tmp_table_dir, fitted(frame), "good", {"rmse": 1.0})
    # killed before its card was written
    fitted(frame, 1.0).write().save(f"{tmp_table_dir}/model/v=2/stages")
    (pathlib.Path(tmp_table_dir.removeprefix("file:")) / "model" / "v=2" / "card").mkdir()
    assert models.versions(spark, tmp_table_dir) == [1] and models.load(spark, tmp_table_dir)[1] == 1
    assert models.register(spark, tmp_table_dir, fitted(frame), "next", {"rmse": 0.5}) == 3
    assert models.leaderboard(spark, tmp_table_dir, "rmse", True).first()["version"] == 3


def test_newest_rows_of_the_log(spark, frame, tmp_table_dir):
    assert models.newest_predictions(spark, tmp_table_dir, "id", 3) is None
    rule = PipelineModel([SQLTransformer(statement="SELECT *, x * 2 AS prediction FROM __THIS__")])
    models.register(spark, tmp_table_dir, rule, "twice", {})
    models.score(spark, tmp_table_dir, frame.filter("id < 30"), "id")
    models.score(spark, tmp_table_dir, frame.filter("id >= 30"), "id")
    rows = models.newest_predictions(spark, tmp_table_dir, "id", 25).collect()
    assert [(r.id, r.prediction, r.batch) for r in rows] == [(i, 2.0 * i, 2 if i >= 30 else 1) for i in range(49, 24, -1)]


def test_one_vs_rest_roc(spark):
    import random
    rng = random.Random(3)
    rows = [(c, round(rng.random(), 2), rng.random() < 0.3 + 0.1 * c) for c in range(4) for _ in range(200)] + [(9, 0.5, False)]
    df = spark.createDataFrame(rows, "c int, s double, y boolean").repartition(5)
    points = {}
    for r in MT.roc_points_by_class(df, "c", "s", "y").collect():
        points.setdefault(r["class"], {})[r.threshold] = (r.fpr, r.tpr)
    for c in range(4):
        own = [(s, y) for k, s, y in rows if k == c]
        pos, neg = sum(y for _, y in own), sum(not y for _, y in own)
        assert points[c] == {t: (pytest.approx(sum(s >= t and not y for s, y in own) / neg), pytest.approx(sum(s >= t and y for s, y in own) / pos))
                             for t in {s for s, _ in own}}
    assert points[9] == {0.5: (1.0, None)}            # a class without positives
    auc = {r["class"]: r.auc for r in MT.auc_by_class(MT.roc_points_by_class(df.filter("c < 4"), "c", "s", "y")).collect()}
    for c in range(4):
        pos, neg = ([s for k, s, y in rows if k == c and y == want] for want in (True, False))
        assert auc[c] == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg))


def test_pca_report_against_plain_decomposition(spark):
    import numpy as np
    from cauce.operators import ml as ML

    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(3)
    rows = ML.pca_report(df, cols).collect()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    want = np.linalg.svd(z, compute_uv=False) ** 2
    want /= want.sum()
    by = {r["component"]: r for r in rows}
    assert np.allclose([by[j + 1]["explained"] for j in range(4)], want)
    assert by[4]["cumulative"] == 1.0 or abs(by[4]["cumulative"] - 1) < 1e-9
    assert by[1]["k90"] == int((np.cumsum(want) < 0.9).sum() + 1) and by[1]["k95"] == int((np.cumsum(want) < 0.95).sum() + 1)
    assert all(r["score_corr"] < 1e-8 for r in rows)
    v = np.array([[r["loading"] for r in rows if r["component"] == j + 1] for j in range(4)])
    assert np.allclose(v @ v.T, np.eye(4)) and all(max(r, key=abs) > 0 for r in v)
    flat = df.selectExpr("a", "1.0D AS b")
    assert [r["explained"] for r in ML.pca_report(flat, ["a", "b"]).collect()] == [0.5] * 4  # a constant column
    twice = ML.pca_report(df.selectExpr("a", "a AS b"), ["a", "b"]).collect()
    assert [round(r["explained"], 9) for r in twice] == [1, 1, 0, 0] and all(r["score_corr"] == 0 and r["k95"] == 1 for r in twice)
