"""Boosting for several classes and extremely randomised trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.operators import trees


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, size=(600, 4))
    y = (x[:, 0] > 0).astype(int) + 2 * (x[:, 1] * x[:, 2] > 0)          # four classes, an interaction
    return spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "id long, x array<double>, y int").repartition(4)


def test_boosting_beats_one_tree_and_its_deviance_falls(spark, classes):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector
    train, test = classes.filter("id % 4 <> 0"), classes.filter("id % 4 = 0")
    model = trees.SoftmaxBoosting(rounds=6, depth=3, rate=0.5, bins=16).fit(train, "id", "x", "y")
    assert all(b < a for a, b in zip(model.deviance, model.deviance[1:])) and len(model.deviance) == 6
    got = model.predict(test, "x")
    assert got.columns == ["id", "x", "y", "probability", "prediction"]
    accuracy = got.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
    vec = lambda d: d.withColumn("features", array_to_vector("x"))
    tree = DecisionTreeClassifier(labelCol="y", maxDepth=3, seed=1).fit(vec(train)).transform(vec(test))
    single = tree.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
    assert accuracy > single + 0.1
    assert got.filter("abs(aggregate(probability, 0D, (a, p) -> a + p) - 1) > 1e-9").count() == 0


def test_level_histograms_equal_numpy(spark, classes):
    data = trees.Binned(classes, "id", "x", "y", 8)
    tree = trees.Tree(2)
    tree.feature[0], tree.cut[0] = 1, 3

    def targets(x, y):
        return y[:, None], y[:, None] ** 2
    got = trees._histogram(data, [tree], 1, targets)
    rows = data.table.collect()
    x = np.array([list(r.bins) for r in rows])
    y = np.array([r.y for r in rows])
    for node, side in ((1, x[:, 1] <= 3), (2, x[:, 1] > 3)):
        for f in range(4):
            for b in range(8):
                some = side & (x[:, f] == b)
                assert got[0, node][f, b] == pytest.approx([some.sum(), y[some].sum(), (y[some] ** 2).sum()])


def plain_extra_tree(x, y, depth, rng):
    """Extremely randomised tree on raw values, for comparison."""
    if depth == 0 or len(y) < 2 or np.ptp(y) == 0:
        return float(y.mean())
    best = None
    for f in range(x.shape[1]):
        lo, hi = x[:, f].min(), x[:, f].max()
        if lo == hi:
            continue
        cut = rng.uniform(lo, hi)
        left = x[:, f] <= cut
        if left.all() or not left.any():
            continue
        gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum()
        if best is None or gain > best[0]:
            best = gain, f, cut, left
    if best is None:
        return float(y.mean())
    _, f, cut, left = best
    return f, cut, plain_extra_tree(x[left], y[left], depth - 1, rng), plain_extra_tree(x[~left], y[~left], depth - 1, rng)


def walk(tree, v):
    while isinstance(tree, tuple):
        tree = tree[2] if v[tree[0]] <= tree[1] else tree[3]
    return tree


def test_extra_trees_are_as_good_as_plain_ones(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, size=(800, 3))
    y = 3 * x[:, 0] + np.sin(4 * x[:, 1]) + rng.normal(size=800) * 0.1
    df = spark.createDataFrame([(i, v.tolist(), float(c)) for i, (v, c) in enumerate(zip(x, y))], "id long, x array<double>, y double").repartition(4)
    model = trees.ExtraTrees(n_trees=12, depth=6, bins=64, seed=3).fit(df.filter("id % 4 <> 0"), "id", "x", "y")
    test = np.arange(800) % 4 == 0
    got = {r.id: r.prediction for r in model.predict(df.filter("id % 4 = 0"), "x").collect()}
    ours = np.array([got[i] for i in np.flatnonzero(test)])
    plain = [plain_extra_tree(x[~test], y[~test], 6, np.random.default_rng(s)) for s in range(12)]
    theirs = np.array([np.mean([walk(t, v) for t in plain]) for v in x[test]])
    r2 = lambda p: 1 - ((y[test] - p) ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum()
    assert r2(ours) > 0.85 and r2(ours) > r2(theirs) - 0.05
    assert len({t.feature[0] for t in model.trees} | {int(t.cut[0]) for t in model.trees}) > 4      # thresholds are drawn, not chosen
