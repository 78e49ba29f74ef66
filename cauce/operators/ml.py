"""Feature preparation and Spark ML wrappers.

Model fitting is Spark ML's own distributed training; these helpers fix the
reference's semantics (alphabetical label order, population vs sample std,
class-balanced weights, deterministic hash splits).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (OneHotEncoder, PolynomialExpansion, StringIndexer, VectorAssembler)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.operators.sequential import running_totals


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assemble(df: DataFrame, cols, out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """Feature vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def hash_unit(id_col, seed: int) -> Column:
    """A number in [0, 1) from md5(seed || id): reproducible across partitionings."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), _c(id_col).cast("string"))), 1, 12), 16, 10)
    return h.cast("double") / float(16 ** 12)


def hash_split(df: DataFrame, id_col: str, fractions=(0.7, 0.15), seed: int = 42,
               names=("train", "validation", "test")) -> DataFrame:
    """Deterministic split by a hash of the id (``randomSplit`` depends on layout)."""
    u = hash_unit(id_col, seed)
    c1 = fractions[0]
    c2 = fractions[0] + fractions[1]
    return df.withColumn("split", F.when(u < c1, names[0]).when(u < c2, names[1]).otherwise(names[2]))


def stratified_split(df: DataFrame, id_col: str, label_col: str, train_fraction: float = 0.8,
                     seed: int = 42) -> DataFrame:
    """Per class, the first ``round(n_c * p)`` rows by hash order go to train.

    The within-class rank comes from a global running count over (class, hash,
    id) minus each class's starting offset, so a dominant class is not ranked
    by a single task.
    """
    h = F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))
    d = df.withColumn("_h", h).withColumn("_one", F.lit(1.0))
    r = running_totals(d, [label_col, "_h", id_col], ["_one"])
    start = r.groupBy(label_col).agg(F.min("cum__one").alias("_start"), F.count(F.lit(1)).alias("_n"))
    r = r.join(start, label_col)
    rank = F.col("cum__one") - F.col("_start") + 1
    cut = F.round(F.col("_n") * train_fraction)
    return r.withColumn("split", F.when(rank <= cut, F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_h", "_one", "cum__one", "_start", "_n")


def impute(df: DataFrame, col: str, strategy: str = "mean", name: str | None = None) -> DataFrame:
    """Fill nulls with the column mean, median (exact) or mode (smallest on ties)."""
    name = name or col
    if strategy == "mean":
        v = df.agg(F.avg(col)).scalar()
    elif strategy == "median":
        from cauce.operators.aggregates import quantiles
        v = quantiles(df, col, [0.5]).scalar()
    elif strategy == "mode":
        g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        v = g.agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col)))).scalar()
    else:
        raise ValueError(strategy)
    return df.withColumn(name, F.coalesce(F.col(col), v))


def label_encoder(df: DataFrame, col: str, out: str):
    """Alphabetical codes (scikit-learn's LabelEncoder order); returns (frame, mapping)."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df)
    mapping = df.sparkSession.createDataFrame(list(enumerate(model.labels)), f"{out} int, {col} string")
    return model.transform(df).withColumn(out, F.col(out).cast("int")), mapping


def one_hot(df: DataFrame, col: str, out: str, drop_last: bool = True) -> DataFrame:
    """One-hot with unknown categories kept in an extra slot."""
    idx = StringIndexer(inputCol=col, outputCol=f"{col}__idx", stringOrderType="alphabetAsc", handleInvalid="keep")
    enc = OneHotEncoder(inputCols=[f"{col}__idx"], outputCols=[out], dropLast=drop_last, handleInvalid="keep")
    return Pipeline(stages=[idx, enc]).fit(df).transform(df).drop(f"{col}__idx")


def standardize(df: DataFrame, cols, population: bool = True, suffix: str = "_z") -> DataFrame:
    """(x - mean) / std; population std like scikit-learn, sample std like Spark ML; 0 in a constant column."""
    std = F.stddev_pop if population else F.stddev_samp
    # one scan for all statistics
    s = df.agg(F.struct(*[x for i, c in enumerate(cols) for x in (F.avg(c).alias(f"m{i}"), std(c).alias(f"s{i}"))])
               .alias("s")).scalar()
    return df.withColumns({c + suffix: (F.col(c) - s[f"m{i}"]) / F.when(s[f"s{i}"] == 0, 1.0).otherwise(s[f"s{i}"]) for i, c in enumerate(cols)})


class BalancedAccuracy(Evaluator):
    """The mean recall of the classes that occur, for Spark's own tuning."""

    def __init__(self, label: str, prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        hit = (F.col(self.label).cast("double") == F.col(self.prediction)).cast("double")
        got = dataset.groupBy(self.label).agg(F.avg(hit).alias("recall")).agg(F.avg("recall")).first()[0]
        return float(got) if got is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True


def scale_of(df: DataFrame, col: str, population: bool = True):
    """The mean and deviation of a column, as a scalar struct (m, s) for :func:`unscale`."""
    std = F.stddev_pop if population else F.stddev_samp
    return df.agg(F.struct(F.avg(col).alias("m"), std(col).alias("s")).alias("s")).scalar()


def unscale(z, scale):
    """Standardized values (such as predictions of a scaled target) in the target's own units."""
    return z * scale["s"] + scale["m"]


DRAW_BLOCK = 100_000


def oversample(df: DataFrame, label_col: str, id_col: str, seed: int = 42) -> DataFrame:
    """Bootstrap minority classes up to the majority size (with replacement).

    Each class is numbered 0..n_c-1 (hash order); the extra draws are a range
    of ``n_max - n_c`` rows per class whose target index is a seeded hash, and
    they find their source row through an equi-join on (class, index).
    """
    h = F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))
    d = df.withColumn("_h", h).withColumn("_one", F.lit(1.0))
    r = running_totals(d, [label_col, "_h", id_col], ["_one"])
    sizes = r.groupBy(label_col).agg(F.min("cum__one").alias("_start"), F.count(F.lit(1)).alias("_n"))
    r = r.join(sizes, label_col).withColumn("_idx", (F.col("cum__one") - F.col("_start")).cast("long"))
    n_max = sizes.agg(F.max("_n")).scalar()
    # draws are made block by block, so no row ever holds a long array
    need = n_max - F.col("_n")
    blocks = sizes.filter(need > 0).select(label_col, "_n", need.alias("_need"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((need - 1) / DRAW_BLOCK).cast("long"))).alias("_block"))
    extra = blocks.repartition(label_col, "_block").select(label_col, "_n", F.explode(F.sequence(
        F.col("_block") * DRAW_BLOCK, F.least(F.col("_need"), (F.col("_block") + 1) * DRAW_BLOCK) - 1)).alias("_draw")) \
        .withColumn("_idx", F.pmod(F.xxhash64(F.lit(seed), F.col(label_col), F.col("_draw")), F.col("_n")))
    drawn = extra.join(r, [label_col, "_idx"]).select(*df.columns)
    return df.unionByName(drawn)


def balanced_weights(df: DataFrame, label_col: str, name: str = "weight") -> DataFrame:
    """Class weight n / (k * n_c) as a column (for ``weightCol``)."""
    n = df.agg(F.count(F.lit(1))).scalar()
    k = df.agg(F.count_distinct(label_col)).scalar()
    per = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    return df.join(per, label_col).withColumn(name, n / (k * F.col("_nc"))).drop("_nc")


def polynomial_sweep(train: DataFrame, test: DataFrame, feature_cols, label: str, degrees=range(1, 6)):
    """Degree sweep of polynomial features + linear regression; leaderboard rows."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    rows = []
    for d in degrees:
        p = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="raw"),
                             PolynomialExpansion(degree=d, inputCol="raw", outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol=label, maxIter=50)])
        m = p.fit(train)
        pred = m.transform(test)
        ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
        rows.append((d, ev.setMetricName("rmse").evaluate(pred), ev.setMetricName("r2").evaluate(pred)))
    return train.sparkSession.createDataFrame(rows, "degree int, rmse double, r2 double") \
        .orderBy(F.desc("r2"))


def linear_summary(df: DataFrame, feature_cols, label: str) -> DataFrame:
    """OLS coefficients with standard errors, t and p values, R², RMSE."""
    from pyspark.ml.regression import LinearRegression
    data = assemble(df, feature_cols)
    m = LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(data)
    s = m.summary
    names = list(feature_cols) + ["intercept"]
    coefs = list(m.coefficients) + [m.intercept]
    rows = [(n, float(c), float(se), float(tv), float(pv), float(s.r2), float(s.rootMeanSquaredError))
            for n, c, se, tv, pv in zip(names, coefs, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, std_err double, t double, p double, r2 double, rmse double")


def knn_predict(spark, train: DataFrame, test: DataFrame, id_col: str, vec_col: str, label_col: str,
                k: int = 5) -> DataFrame:
    """Inverse-distance weighted vote of the k nearest training rows (Euclidean).

    Neighbours come from the exact cell index (:mod:`cauce.operators.dense`), whose score is ``-||x - y||²``.
    """
    from cauce.operators.dense import nearest

    nn = nearest(spark, train, id_col, vec_col, test, id_col, vec_col, k, metric="euclidean")
    lab = train.select(F.col(id_col).alias("item_id"), F.col(label_col).alias("_lab"))
    votes = nn.join(lab, "item_id").withColumn("_w", 1.0 / (F.sqrt(F.greatest(-F.col("score"), F.lit(0.0))) + 1e-12))
    per = votes.groupBy("qid", "_lab").agg(F.sum("_w").alias("_s"))
    return per.groupBy("qid").agg(F.max_by("_lab", F.struct("_s", -F.col("_lab"))).alias("prediction"))


# ------------------------------------------------------------------- M26
def principal_components(df: DataFrame, cols):
    """(shares of variance, vectors by column) of the correlation matrix, largest share first.

    One distributed aggregate gives the k x k matrix; its decomposition does not
    depend on the number of rows.  A vector's greatest entry is positive."""
    from cauce.operators.stats import pairwise_corr

    at, m = {c: i for i, c in enumerate(cols)}, np.eye(len(cols))
    for r in pairwise_corr(df, cols).collect():
        m[at[r["col_a"]], at[r["col_b"]]] = m[at[r["col_b"]], at[r["col_a"]]] = r["corr"] or 0.0
    values, vectors = np.linalg.eigh(m)
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    top = np.abs(vectors).round(9).argmax(axis=0)
    return values / values.sum(), vectors * np.sign(vectors[top, range(len(cols))])


def component_scores(df: DataFrame, cols, vectors: np.ndarray, k: int, prefix: str = "pc") -> DataFrame:
    """``df`` with the scores on the first k components of its standardised columns."""
    z = standardize(df, cols, suffix="_pcz")
    for j in range(k):
        total = F.lit(0.0)
        for i, c in enumerate(cols):
            total = total + F.col(f"{c}_pcz") * float(vectors[i, j])
        z = z.withColumn(f"{prefix}{j + 1}", total)
    return z.drop(*[f"{c}_pcz" for c in cols])


def components_for(shares, least: float) -> int:
    """The smallest number of components that explain that share."""
    return int(np.searchsorted(np.cumsum(shares), least - 1e-12) + 1)


def pca_report(df: DataFrame, cols) -> DataFrame:
    """Per component and feature the loading, with explained and cumulative share, the numbers of components
    for 90 and 95 %, and the component's greatest absolute correlation with another one's scores (0 if they work)."""
    from cauce.operators.stats import pairwise_corr

    shares, vectors = principal_components(df, cols)
    names = [f"pc{j + 1}" for j in range(len(cols))]
    left = dict.fromkeys(names, 0.0)
    for r in pairwise_corr(component_scores(df, cols, vectors, len(cols)), names).collect():
        a, b = r["col_a"], r["col_b"]
        if min(shares[names.index(a)], shares[names.index(b)]) > 1e-12:  # the scores of an empty component are noise
            left[a], left[b] = (max(left[c], abs(r["corr"] or 0.0)) for c in (a, b))
    rows = [(j + 1, c, float(vectors[i, j]), float(shares[j]), float(shares[:j + 1].sum()), components_for(shares, 0.9),
             components_for(shares, 0.95), left[names[j]]) for j in range(len(cols)) for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "component int, feature string, loading double, explained double, cumulative double, "
                                                 "k90 int, k95 int, score_corr double")
