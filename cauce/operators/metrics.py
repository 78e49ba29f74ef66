"""Classification and regression metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def confusion(df: DataFrame, label: str, pred: str, classes) -> DataFrame:
    """Counts per (actual, predicted) in a fixed class order, zero-filled.

    Every listed class gets a row even when it never occurs as the actual label.
    """
    pv = df.groupBy(F.col(label).alias("actual")).pivot(pred, list(classes)).count()
    allc = df.sparkSession.createDataFrame([(c,) for c in classes],
                                           "actual " + df.schema[label].dataType.simpleString())
    return allc.join(pv, "actual", "left").fillna(0, subset=[str(c) for c in classes])


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class precision, recall, F1, support; zero division -> 0."""
    classes = df.select(F.col(label).alias("c")).union(df.select(F.col(pred).alias("c"))).distinct()
    tp = df.filter(F.col(label) == F.col(pred)).groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("tp"))
    sup = df.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("support"))
    npred = df.groupBy(F.col(pred).alias("c")).agg(F.count(F.lit(1)).alias("n_pred"))
    r = classes.join(tp, "c", "left").join(sup, "c", "left").join(npred, "c", "left").fillna(0)
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    r = r.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return r.withColumn("f1", f1).select(F.col("c").alias("class"), "precision", "recall", "f1", "support")


def summary_scores(report: DataFrame, df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, macro and weighted F1, balanced accuracy, MCC, Cohen's kappa."""
    n = df.agg(F.count(F.lit(1))).scalar()
    acc = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double"))).scalar()
    per = df.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("t_k"))
    pp = df.groupBy(F.col(pred).alias("c")).agg(F.count(F.lit(1)).alias("p_k"))
    tp = df.filter(F.col(label) == F.col(pred)).agg(F.count(F.lit(1)).alias("c_")).select("c_")
    k = per.join(pp, "c", "full_outer").fillna(0)

    def times(a, b):
        # exact: products of counts outgrow a long
        return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")

    sums = k.agg(F.sum(times(F.col("t_k"), F.col("p_k"))).alias("tp_sum"),
                 F.sum(times(F.col("t_k"), F.col("t_k"))).alias("t2"), F.sum(times(F.col("p_k"), F.col("p_k"))).alias("p2"))
    c, n2 = tp.scalar(), times(F.lit(n), F.lit(n))
    rep = report.agg(F.avg("f1").alias("macro_f1"),
                     F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
                     F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"))
    mcc_num = (times(F.lit(c), F.lit(n)) - F.col("tp_sum")).cast("double")
    mcc_den = F.sqrt((n2 - F.col("p2")).cast("double") * (n2 - F.col("t2")).cast("double"))
    pe = F.try_divide(F.col("tp_sum").cast("double"), n2.cast("double"))
    s = sums.select(F.try_divide(mcc_num, mcc_den).alias("mcc"),
                    F.try_divide(F.lit(acc) - pe, F.lit(1.0) - pe).alias("kappa"))
    return rep.withColumn("accuracy", acc).withColumn("mcc", s.select("mcc").scalar()) \
        .withColumn("kappa", s.select("kappa").scalar())


def roc_points(df: DataFrame, score: str, positive: str) -> DataFrame:
    """(fpr, tpr) at every distinct score threshold (score >= t is positive)."""
    from cauce.operators.sequential import running_totals
    lv = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(positive)).cast("double").alias("tp"), F.count_if(~F.col(positive)).cast("double").alias("fp"))
    P = df.agg(F.count_if(F.col(positive))).scalar()
    N = df.agg(F.count_if(~F.col(positive))).scalar()
    cum = running_totals(lv.withColumn("_neg", -F.col("threshold")), ["_neg"], ["tp", "fp"])
    return cum.select("threshold", F.try_divide(F.col("cum_fp"), N).alias("fpr"),
                      F.try_divide(F.col("cum_tp"), P).alias("tpr"))


def auc(points: DataFrame) -> DataFrame:
    """Trapezoidal area under (fpr, tpr) points plus the (0, 0) origin.

    Consecutive points are paired by a running lag in fpr/tpr order.
    """
    from cauce.operators.sequential import ordered_lag
    p = points.select("fpr", "tpr")
    p = ordered_lag(p, [], ["fpr", "tpr"], "fpr", "fpr_prev")
    p = ordered_lag(p, [], ["fpr", "tpr"], "tpr", "tpr_prev")
    area = (F.col("fpr") - F.coalesce("fpr_prev", F.lit(0.0))) * (F.col("tpr") + F.coalesce("tpr_prev", F.lit(0.0))) / 2
    return p.agg(F.sum(area).alias("auc"))


def roc_points_by_class(df: DataFrame, cls: str, score: str, positive: str) -> DataFrame:
    """M20 one-vs-rest: ``(class, threshold, fpr, tpr)`` at every distinct score of every class.

    ``df`` has one row an item and class.  All classes share one range-partitioned
    order on (class, falling score); the running totals restart at class borders
    by taking off what the earlier classes add up to, inside a partition and
    across partitions alike.  A class without positives (or negatives) has null rates.
    """
    from cauce.operators.sequential import running_totals
    lv = df.groupBy(F.col(cls).alias("class"), F.col(score).alias("threshold")).agg(
        F.count_if(F.col(positive)).cast("double").alias("tp"), F.count_if(~F.col(positive)).cast("double").alias("fp"))
    cum = running_totals(lv.withColumn("_neg", -F.col("threshold")), ["class", "_neg"], ["tp", "fp"])
    per = cum.groupBy("class").agg(F.sum("tp").alias("_p"), F.sum("fp").alias("_n"),
                                   F.min(F.col("cum_tp") - F.col("tp")).alias("_tp0"), F.min(F.col("cum_fp") - F.col("fp")).alias("_fp0"))
    joined = cum.alias("c").join(per.alias("k"), F.col("c.class").eqNullSafe(F.col("k.class")))
    return joined.select("c.class", "threshold", F.try_divide(F.col("cum_fp") - F.col("_fp0"), F.col("_n")).alias("fpr"),
                         F.try_divide(F.col("cum_tp") - F.col("_tp0"), F.col("_p")).alias("tpr"))


def auc_by_class(points: DataFrame) -> DataFrame:
    """Trapezoidal area a class; consecutive points are paired in one order on (class, fpr, tpr)."""
    from cauce.operators.sequential import ordered_lag
    p = points.select("class", "fpr", "tpr")
    p = ordered_lag(p, ["class"], ["fpr", "tpr"], "fpr", "fpr_prev")
    p = ordered_lag(p, ["class"], ["fpr", "tpr"], "tpr", "tpr_prev")
    area = (F.col("fpr") - F.coalesce("fpr_prev", F.lit(0.0))) * (F.col("tpr") + F.coalesce("tpr_prev", F.lit(0.0))) / 2
    return p.groupBy("class").agg(F.sum(area).alias("auc"))


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MSE, RMSE, MAE and R² in one pass (R² uses the label's own mean)."""
    e = F.col(label) - F.col(pred)
    mean_y = df.agg(F.avg(label)).scalar()
    return df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                  (F.lit(1.0) - F.sum(e * e) / F.sum((F.col(label) - mean_y) * (F.col(label) - mean_y))).alias("r2")) \
        .withColumn("rmse", F.sqrt("mse"))


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """ARI from the contingency table (one groupBy plus marginal sums)."""
    def comb2(x):
        return x * (x - 1) / 2
    cont = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("nij"))
    s_ij = cont.agg(F.sum(comb2(F.col("nij")))).scalar()
    s_a = cont.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(comb2(F.col("ai")))).scalar()
    s_b = cont.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(comb2(F.col("bj")))).scalar()
    n = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    expected = s_a * s_b / comb2(n)
    return df.sparkSession.range(1).select(
        F.try_divide(s_ij - expected, (s_a + s_b) / 2 - expected).alias("ari"))
