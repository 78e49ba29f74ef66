"""Statistics, metrics and ML queries (M*, T19-T23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cauce.operators import metrics as MT
from cauce.operators import ml as ML
from cauce.operators import stats as ST
from cauce.operators.windows import moving_range
from cauce.plans.facts import t
from cauce.plans.registry import query
from cauce.plans.sqlfrag import R

BASELINE_END = "2024-01-08"
LSL, USL = 0.0, 300.0


# ----------------------------------------------------------------- preparation
@query("m02_hash_split", sql="""
SELECT doc_id, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT doc_id, CAST(('0x' || substr(md5('42' || CAST(doc_id AS VARCHAR)), 1, 12))::BIGINT AS DOUBLE) / 281474976710656.0 AS u
      FROM documents)
""")
def m02(spark, sf):
    return ML.hash_split(t(spark, sf, "documents").select("doc_id"), "doc_id")


@query("m03_stratified_split", sql=f"""
SELECT doc_id, quality, CASE WHEN rn <= {R('n * 0.8', 0)} THEN 'train' ELSE 'test' END AS split FROM (
  SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
         count(*) OVER (PARTITION BY quality) AS n FROM labels)
""")
def m03(spark, sf):
    return ML.stratified_split(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.8)


@query("m04_impute_mean", sql=f"""
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events)
SELECT event_id, {R('coalesce(v, (SELECT avg(v) FROM e))', 9)} AS v FROM e
""")
def m04(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return ML.impute(e, "v", "mean").select("event_id", F.round("v", 9).alias("v"))


@query("m04_impute_mode", sql="""
WITH e AS (SELECT event_id, CASE WHEN value > 100 THEN NULL ELSE event_type END AS et FROM events),
m AS (SELECT arg_min(et, (-n, et)) AS mode FROM (SELECT et, count(*) AS n FROM e WHERE et IS NOT NULL GROUP BY et))
SELECT event_id, coalesce(et, (SELECT mode FROM m)) AS et FROM e
""")
def m04b(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.when(F.col("value") <= 100, F.col("event_type")).alias("et"))
    return ML.impute(e, "et", "mode")


@query("m05_label_encoding", sql="""
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS priority_code FROM orders
""")
def m05(spark, sf):
    df, _ = ML.label_encoder(t(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                             "priority_code")
    return df.select("o_orderkey", "priority_code")


@query("m07_standardize", sql=f"""
SELECT l_orderkey, l_linenumber,
  {R('(l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER ()', 6)} AS l_quantity_z,
  {R('(l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER ()', 6)} AS l_extendedprice_z
FROM lineitem
""")
def m07(spark, sf):
    z = ML.standardize(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], population=True)
    return z.select("l_orderkey", "l_linenumber", F.round("l_quantity_z", 6).alias("l_quantity_z"),
                    F.round("l_extendedprice_z", 6).alias("l_extendedprice_z"))


@query("m08_oversample_counts", sql="""
SELECT label, max(n) OVER () AS n FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
""")
def m08(spark, sf):
    e = t(spark, sf, "embeddings").select("vec_id", "label")
    return ML.oversample(e, "label", "vec_id").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------- metrics
def line_pred(spark, sf):
    li = t(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return li.join(p, "l_partkey").select(F.col("l_extendedprice").alias("y"),
                                          (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"))


@query("m14_regression_metrics", sql=f"""
WITH d AS (SELECT l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS yhat
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT {R('avg((y - yhat) * (y - yhat))', 3)} AS mse, {R('avg(abs(y - yhat))', 6)} AS mae,
  {R('1 - sum((y - yhat) * (y - yhat)) / sum((y - (SELECT avg(y) FROM d)) * (y - (SELECT avg(y) FROM d)))', 9)} AS r2,
  {R('sqrt(avg((y - yhat) * (y - yhat)))', 6)} AS rmse FROM d
""")
def m14(spark, sf):
    m = MT.regression_metrics(line_pred(spark, sf), "y", "yhat")
    return m.select(F.round("mse", 3).alias("mse"), F.round("mae", 6).alias("mae"), F.round("r2", 9).alias("r2"),
                    F.round("rmse", 6).alias("rmse"))


def doc_pred(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "n_chars")
    return t(spark, sf, "labels").join(d, "doc_id").select(
        F.col("quality").alias("actual"), (F.col("n_chars") >= 1000).cast("int").alias("predicted"))


PRED_SQL = """p AS (SELECT l.quality AS actual, CAST(d.n_chars >= 1000 AS INTEGER) AS predicted
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@query("m17_confusion_matrix", sql=f"""
WITH {PRED_SQL}
SELECT c.actual, count(p.actual) FILTER (WHERE p.predicted = 0) AS "0", count(p.actual) FILTER (WHERE p.predicted = 1) AS "1"
FROM (SELECT unnest([0, 1]) AS actual) c LEFT JOIN p ON c.actual = p.actual GROUP BY c.actual
""")
def m17(spark, sf):
    return MT.confusion(doc_pred(spark, sf), "actual", "predicted", [0, 1])


REPORT_SQL = PRED_SQL + """,
cls AS (SELECT actual AS c FROM p UNION SELECT predicted FROM p),
r AS (SELECT c, (SELECT count(*) FROM p WHERE actual = c AND predicted = c) AS tp,
             (SELECT count(*) FROM p WHERE actual = c) AS support, (SELECT count(*) FROM p WHERE predicted = c) AS n_pred FROM cls),
r2 AS (SELECT c, support, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM r),
r3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r2)"""


@query("m18_class_report", sql=f"""
WITH {REPORT_SQL}
SELECT c AS class, {R('precision', 9)} AS precision, {R('recall', 9)} AS recall, {R('f1', 9)} AS f1, support FROM r3
""")
def m18(spark, sf):
    r = MT.class_report(doc_pred(spark, sf), "actual", "predicted")
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("m19_summary_scores", sql=f"""
WITH {REPORT_SQL},
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE actual = predicted) AS c FROM p),
k AS (SELECT coalesce(a.c, b.c) AS c, coalesce(a.t, 0) AS t_k, coalesce(b.pk, 0) AS p_k FROM
      (SELECT actual AS c, count(*) AS t FROM p GROUP BY 1) a FULL OUTER JOIN (SELECT predicted AS c, count(*) AS pk FROM p GROUP BY 1) b ON a.c = b.c),
s AS (SELECT sum(t_k * p_k) AS tps, sum(t_k * t_k) AS t2, sum(p_k * p_k) AS p2 FROM k)
SELECT {R('(SELECT avg(f1) FROM r3)', 9)} AS macro_f1, {R('(SELECT sum(f1 * support) / sum(support) FROM r3)', 9)} AS weighted_f1,
  {R('(SELECT avg(recall) FILTER (WHERE support > 0) FROM r3)', 9)} AS balanced_accuracy,
  {R('n.c * 1.0 / n.n', 9)} AS accuracy,
  {R('(n.c * n.n - s.tps) / sqrt((n.n * n.n - s.p2) * (n.n * n.n - s.t2))', 9)} AS mcc,
  {R('(n.c * 1.0 / n.n - s.tps / (n.n * n.n)) / (1 - s.tps / (n.n * n.n))', 9)} AS kappa
FROM n, s
""")
def m19(spark, sf):
    p = doc_pred(spark, sf)
    s = MT.summary_scores(MT.class_report(p, "actual", "predicted"), p, "actual", "predicted")
    return s.select(*[F.round(c, 9).alias(c) for c in
                      ("macro_f1", "weighted_f1", "balanced_accuracy", "accuracy", "mcc", "kappa")])


def scored_events(spark, sf):
    return t(spark, sf, "events").select((F.col("value") / 500).alias("score"),
                                         (F.col("event_type") == "purchase").alias("positive"))


ROC_SQL = """s AS (SELECT value / 500 AS score, event_type = 'purchase' AS pos FROM events),
lv AS (SELECT score AS threshold, count(*) FILTER (WHERE pos) AS tp, count(*) FILTER (WHERE NOT pos) AS fp FROM s GROUP BY 1),
c AS (SELECT threshold, sum(tp) OVER (ORDER BY threshold DESC) AS ctp, sum(fp) OVER (ORDER BY threshold DESC) AS cfp FROM lv),
pts AS (SELECT threshold, cfp / (SELECT count(*) FILTER (WHERE NOT pos) FROM s) AS fpr,
               ctp / (SELECT count(*) FILTER (WHERE pos) FROM s) AS tpr FROM c)"""


@query("m20_roc_points", sql=f"""
WITH {ROC_SQL}
SELECT threshold, {R('fpr', 9)} AS fpr, {R('tpr', 9)} AS tpr FROM pts
""")
def m20(spark, sf):
    r = MT.roc_points(scored_events(spark, sf), "score", "positive")
    return r.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query("m20_auc", sql=f"""
WITH {ROC_SQL},
l AS (SELECT fpr, tpr, lag(fpr) OVER (ORDER BY fpr, tpr) AS pf, lag(tpr) OVER (ORDER BY fpr, tpr) AS pt FROM pts)
SELECT {R('sum((fpr - coalesce(pf, 0.0)) * (tpr + coalesce(pt, 0.0)) / 2)', 9)} AS auc FROM l
""")
def m20b(spark, sf):
    a = MT.auc(MT.roc_points(scored_events(spark, sf), "score", "positive"))
    return a.select(F.round("auc", 9).alias("auc"))


OVR_SQL = """
cen AS (SELECT label, list(m ORDER BY pos) AS c FROM (
  SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
    generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL) GROUP BY label),
s AS (SELECT cen.label AS class, round(list_dot_product(CAST(e.embedding AS DOUBLE[]), cen.c), 6) AS score, e.label = cen.label AS pos
      FROM cen, embeddings e),
lv AS (SELECT class, score AS threshold, count(*) FILTER (WHERE pos) AS tp, count(*) FILTER (WHERE NOT pos) AS fp FROM s GROUP BY ALL),
w AS (SELECT *, sum(tp) OVER (PARTITION BY class ORDER BY threshold DESC) AS ctp, sum(fp) OVER (PARTITION BY class ORDER BY threshold DESC) AS cfp,
        sum(tp) OVER (PARTITION BY class) AS p, sum(fp) OVER (PARTITION BY class) AS n FROM lv),
pts AS (SELECT class, threshold, cfp / n AS fpr, ctp / p AS tpr FROM w)"""


def class_scores(spark, sf):
    """One row an item and class: the dot product with the class's mean vector (a handful of classes)."""
    from cauce.plans.textops import label_centroids
    emb = t(spark, sf, "embeddings")
    # one row a label, every item meets each: the labels are a fixed list
    means = label_centroids(emb).agg(F.collect_list(F.struct("label", "centroid"))).scalar()
    each = emb.withColumn("_m", F.explode(means)).withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    dot = F.aggregate(F.zip_with("v", F.col("_m.centroid"), lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return each.select(F.col("_m.label").alias("class"), F.round(dot, 6).alias("score"), (F.col("label") == F.col("_m.label")).alias("positive"))


@query("m20_one_vs_rest_roc", sql=f"""
WITH {OVR_SQL} SELECT class, threshold, {R('fpr', 9)} AS fpr, {R('tpr', 9)} AS tpr FROM pts
""")
def m20c(spark, sf):
    r = MT.roc_points_by_class(class_scores(spark, sf), "class", "score", "positive")
    return r.select("class", "threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query("m20_one_vs_rest_auc", sql=f"""
WITH {OVR_SQL},
l AS (SELECT *, lag(fpr) OVER (PARTITION BY class ORDER BY fpr, tpr) AS pf, lag(tpr) OVER (PARTITION BY class ORDER BY fpr, tpr) AS pt FROM pts)
SELECT class, {R('sum((fpr - coalesce(pf, 0.0)) * (tpr + coalesce(pt, 0.0)) / 2)', 9)} AS auc FROM l GROUP BY class
""")
def m20d(spark, sf):
    a = MT.auc_by_class(MT.roc_points_by_class(class_scores(spark, sf), "class", "score", "positive"))
    return a.select("class", F.round("auc", 9).alias("auc"))


@query("m29_adjusted_rand", sql=f"""
WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS nij FROM lineitem GROUP BY ALL),
s AS (SELECT sum(nij * (nij - 1) / 2) AS sij, (SELECT sum(a * (a - 1) / 2) FROM (SELECT sum(nij) AS a FROM c GROUP BY l_returnflag)) AS sa,
             (SELECT sum(b * (b - 1) / 2) FROM (SELECT sum(nij) AS b FROM c GROUP BY l_linestatus)) AS sb,
             (SELECT count(*) FROM lineitem) AS n FROM c)
SELECT {R('(sij - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2))', 9)} AS ari FROM s
""")
def m29(spark, sf):
    a = MT.adjusted_rand_index(t(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return a.select(F.round("ari", 9).alias("ari"))


# ---------------------------------------------------------------- statistics
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]


@query("m23_pearson_pairs", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(f'corr({a}, {b})', 9)} AS corr FROM lineitem" for a, b in _PAIRS))
def m23(spark, sf):
    c = ST.pairwise_corr(t(spark, sf, "lineitem"), CORR_COLS)
    return c.select("col_a", "col_b", F.round("corr", 9).alias("corr"))


@query("m24_high_corr_pairs", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {R(f'corr({a}, {b})', 9)} AS corr FROM lineitem "
    f"HAVING abs(corr({a}, {b})) > 0.8" for a, b in _PAIRS))
def m24(spark, sf):
    c = ST.high_corr_pairs(ST.pairwise_corr(t(spark, sf, "lineitem"), CORR_COLS), 0.8)
    return c.select("col_a", "col_b", F.round("corr", 9).alias("corr"))


@query("m23_spearman", sql=f"""
WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra,
                  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb
           FROM lineitem)
SELECT {R('corr(ra, rb)', 9)} AS spearman FROM r
""")
def m23b(spark, sf):
    s = ST.spearman(t(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return s.select(F.round("spearman", 9).alias("spearman"))


IQR_COLS = ["l_quantity", "l_discount", "l_tax"]


@query("m30_iqr_outliers", sql=" UNION ALL ".join(f"""
SELECT '{c}' AS column, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
  (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""" for c in IQR_COLS))
def m30(spark, sf):
    return ST.iqr_outliers(t(spark, sf, "lineitem"), IQR_COLS)


@query("m31_pooled_t", sql=f"""
WITH g AS (SELECT o_orderstatus AS s, count(o_totalprice) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v
           FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1),
a AS (SELECT * FROM g WHERE s = 'F'), b AS (SELECT * FROM g WHERE s = 'O')
SELECT {R('(a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n))', 9)} AS t,
  a.n + b.n - 2 AS df, {R('a.m', 6)} AS mean_a, {R('b.m', 6)} AS mean_b FROM a, b
""")
def m31(spark, sf):
    r = ST.pooled_t(t(spark, sf, "orders"), "o_totalprice", "o_orderstatus", "F", "O")
    return r.select(F.round("t", 9).alias("t"), "df", F.round("mean_a", 6).alias("mean_a"),
                    F.round("mean_b", 6).alias("mean_b"))


@query("m32_control_limits", sql=f"""
WITH b AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events WHERE ts < TIMESTAMP '{BASELINE_END}')
SELECT event_id, value > mu + 3 * sd OR value < mu - 3 * sd AS out_of_control FROM events, b
""")
def m32(spark, sf):
    e = t(spark, sf, "events")
    c = ST.control_limits(e, "value", F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz"))
    return c.select("event_id", "out_of_control")


MR_SQL = """mr AS (SELECT abs(value - lag(value) OVER (ORDER BY ts, event_id)) AS moving_range FROM events)"""


@query("m33_moving_range_chart", sql=f"""
WITH {MR_SQL}
SELECT {R('avg(moving_range)', 9)} AS mr_mean,
  count(*) FILTER (WHERE moving_range > (SELECT avg(moving_range) FROM mr) * 3.267) AS n_above,
  {R('avg(moving_range) * 3.267', 9)} AS mr_ucl FROM mr
""")
def m33(spark, sf):
    mr = moving_range(t(spark, sf, "events"), ["ts", "event_id"], "value")
    c = ST.moving_range_chart(mr)
    return c.select(F.round("mr_mean", 9).alias("mr_mean"), "n_above", F.round("mr_ucl", 9).alias("mr_ucl"))


def _grade(x):
    return (f"CASE WHEN {x} >= 2.00 THEN 'Excellent (Six Sigma level)' WHEN {x} >= 1.33 THEN 'Adequate' "
            f"WHEN {x} >= 1.00 THEN 'Marginal - Improvement needed' ELSE 'Poor - Immediate action required' END")


@query("m34_capability", sql=f"""
WITH b AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events WHERE ts < TIMESTAMP '{BASELINE_END}'),
a AS (SELECT avg(value) AS pm, stddev_samp(value) AS ps FROM events),
c AS (SELECT mu, sd, ({USL} - {LSL}) / (6 * sd) AS cp, least(({USL} - mu) / (3 * sd), (mu - {LSL}) / (3 * sd)) AS cpk,
             ({USL} - {LSL}) / (6 * ps) AS pp, least(({USL} - pm) / (3 * ps), (pm - {LSL}) / (3 * ps)) AS ppk FROM b, a)
SELECT {R('mu', 6)} AS process_mean, {R('sd', 6)} AS process_std, {R('cp', 9)} AS cp, {R('cpk', 9)} AS cpk,
  {R('pp', 9)} AS pp, {R('ppk', 9)} AS ppk, {_grade('cpk')} AS cpk_grade, {_grade('ppk')} AS ppk_grade FROM c
""")
def m34(spark, sf):
    e = t(spark, sf, "events")
    c = ST.capability(e, "value", LSL, USL, F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz"))
    return c.select(F.round("process_mean", 6).alias("process_mean"), F.round("process_std", 6).alias("process_std"),
                    *[F.round(x, 9).alias(x) for x in ("cp", "cpk", "pp", "ppk")], "cpk_grade", "ppk_grade")


@query("m35_defect_rate", sql=f"""
SELECT {R(f'avg(CASE WHEN value < {LSL} OR value > {USL} THEN 1.0 ELSE 0.0 END)', 9)} AS defect_rate,
  {R('avg(value)', 6)} AS mean, {R('stddev_samp(value)', 6)} AS std FROM events
""")
def m35(spark, sf):
    d = ST.defect_rate(t(spark, sf, "events"), "value", LSL, USL)
    return d.select(F.round("defect_rate", 9).alias("defect_rate"), F.round("mean", 6).alias("mean"),
                    F.round("std", 6).alias("std"))


@query("m35_normal_tail", sql=f"""
WITH m AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd, avg(CASE WHEN value < {LSL} OR value > {USL} THEN 1.0 ELSE 0.0 END) AS rate FROM events),
z AS (SELECT *, ({LSL} - mu) / sd AS a, ({USL} - mu) / sd AS b FROM m),
s AS (SELECT sum((b - a) / 4000 / 3 * (CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
        * exp(-0.5 * (a + i * (b - a) / 4000) * (a + i * (b - a) / 4000)) / sqrt(2 * pi())) AS inside FROM z, range(4001) AS r(i))
SELECT {R('rate', 9)} AS defect_rate, {R('1 - inside', 8)} AS normal_rate FROM m, s
""")
def m35b(spark, sf):
    """The observed share outside the limits beside the one of a normal distribution."""
    d = ST.defect_rate(t(spark, sf, "events"), "value", LSL, USL)
    r = d.first()
    tail = ST.normal_tail_rate(r["mean"], r["std"], LSL, USL) if r["std"] else None
    return d.select(F.round("defect_rate", 9).alias("defect_rate"), F.round(F.lit(tail).cast("double"), 8).alias("normal_rate"))


@query("m07_target_inverse", sql=f"""
SELECT o_orderkey, {R('o_totalprice', 6)} AS back, {R('(o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders)', 9)} AS z
FROM orders
""")
def m07b(spark, sf):
    """A target scaled for fitting and brought back to its own units."""
    o = ML.standardize(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"])
    scale = ML.scale_of(t(spark, sf, "orders"), "o_totalprice")
    return o.select("o_orderkey", F.round(ML.unscale(F.col("o_totalprice_z"), scale), 6).alias("back"), F.round("o_totalprice_z", 9).alias("z"))


# ------------------------------------------------------------- model fitting (rows)
def regression_frame(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
                                         "l_tax", "l_extendedprice")
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size")
    return ML.hash_split(li.join(p, "l_partkey").withColumn(
        "rid", F.col("l_orderkey") * 100 + F.col("l_linenumber")), "rid", (0.8, 0.0))


def written_frame(spark, sf):
    """The regression frame as a written table: every fit and score reads it again, and the join is made once."""
    from cauce.operators import corpus as C
    return C.written(regression_frame(spark, sf), "regression")


REG_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice"]


@query("m01_assemble", sql="""
SELECT l_orderkey, l_linenumber, list_extract(f, 1) AS f1, list_extract(f, 2) AS f2, list_extract(f, 3) AS f3
FROM (SELECT l_orderkey, l_linenumber, [CAST(l_quantity AS DOUBLE), CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE)] AS f FROM lineitem)
""")
def m01(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = ML.assemble(t(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    v = vector_to_array("features")
    return d.select("l_orderkey", "l_linenumber", *[v[i].alias(f"f{i + 1}") for i in range(3)])


@query("m06_one_hot", sql="""
WITH k AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS i, count(*) OVER () AS n
           FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL))
SELECT c.c_custkey, c.c_mktsegment, repeat('0', CAST(coalesce(k.i, x.n) AS INT)) || '1' || repeat('0', CAST(x.n - coalesce(k.i, x.n) AS INT)) AS segment_bits
FROM customer c CROSS JOIN (SELECT max(n) AS n FROM k) x LEFT JOIN k ON c.c_mktsegment = k.c_mktsegment
""")
def m06(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = ML.one_hot(t(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment_vec")
    bits = F.array_join(F.transform(vector_to_array("segment_vec"), lambda x: x.cast("int").cast("string")), "")
    return d.select("c_custkey", "c_mktsegment", bits.alias("segment_bits"))


@query("m11_polynomial_sweep")
def m11(spark, sf):
    d = written_frame(spark, sf)
    return ML.polynomial_sweep(d.filter("split = 'train'"), d.filter("split != 'train'"),
                               ["l_quantity", "p_retailprice"], "l_extendedprice", range(1, 6))


@query("m12_linear_summary")
def m12(spark, sf):
    return ML.linear_summary(regression_frame(spark, sf), REG_FEATURES, "l_extendedprice")


@query("m13_tree_regressors")
def m13(spark, sf):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
    d = ML.assemble(written_frame(spark, sf), REG_FEATURES)
    train, test = d.filter("split = 'train'"), d.filter("split != 'train'")
    ev = RegressionEvaluator(labelCol="l_extendedprice")
    rows = []
    for name, est in (("decision_tree", DecisionTreeRegressor(maxDepth=6, seed=42)),
                      ("random_forest", RandomForestRegressor(numTrees=20, maxDepth=6, seed=42)),
                      ("gbt", GBTRegressor(maxIter=20, maxDepth=4, seed=42))):
        pred = est.setLabelCol("l_extendedprice").fit(train).transform(test)
        rows.append((name, ev.setMetricName("rmse").evaluate(pred), ev.setMetricName("r2").evaluate(pred)))
    return spark.createDataFrame(rows, "model string, rmse double, r2 double")


def embedding_frame(spark, sf):
    from pyspark.ml.functions import array_to_vector
    e = t(spark, sf, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))
    return ML.hash_split(e, "vec_id", (0.8, 0.0))


@query("m15_classifiers")
def m15(spark, sf):
    from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression, OneVsRest,
                                           RandomForestClassifier)
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    d = ML.balanced_weights(embedding_frame(spark, sf), "label")
    train, test = d.filter("split = 'train'"), d.filter("split != 'train'")
    ev = MulticlassClassificationEvaluator(labelCol="label")
    rows = []
    for name, est in (("logistic", LogisticRegression(maxIter=30, labelCol="label")),
                      ("logistic_balanced", LogisticRegression(maxIter=30, labelCol="label", weightCol="weight")),
                      ("decision_tree", DecisionTreeClassifier(labelCol="label", maxDepth=6, seed=42)),
                      ("random_forest", RandomForestClassifier(labelCol="label", numTrees=20, seed=42)),
                      ("linear_svm_ovr", OneVsRest(classifier=LinearSVC(maxIter=15), labelCol="label",
                                                   parallelism=4))):
        pred = est.fit(train).transform(test)
        rows.append((name, ev.setMetricName("accuracy").evaluate(pred), ev.setMetricName("f1").evaluate(pred)))
    return spark.createDataFrame(rows, "model string, accuracy double, f1 double")


@query("m15_gradient_boosting")
def m15b(spark, sf):
    """Softmax boosting on the embeddings: training deviance a round, and the held-out accuracy of the whole model."""
    from cauce.operators.trees import SoftmaxBoosting
    e = ML.hash_split(t(spark, sf, "embeddings").select("vec_id", "label", "embedding"), "vec_id", (0.8, 0.0))
    model = SoftmaxBoosting(rounds=5, depth=3, rate=0.5, bins=16).fit(e.filter("split = 'train'"), "vec_id", "embedding", "label")
    pred = model.predict(e.filter("split <> 'train'").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x")), "x")
    accuracy = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    return spark.createDataFrame([(i + 1, d, accuracy) for i, d in enumerate(model.deviance)], "round int, deviance double, accuracy double")


@query("m13_extra_trees")
def m13b(spark, sf):
    """Held-out error of extremely randomised trees on the regression frame."""
    from cauce.operators.trees import ExtraTrees
    d = regression_frame(spark, sf).withColumn("x", F.array(*[F.col(c).cast("double") for c in REG_FEATURES]))
    d = d.select("rid", "split", "x", F.col("l_extendedprice").cast("double").alias("y"))
    model = ExtraTrees(n_trees=16, depth=8, bins=64).fit(d.filter("split = 'train'"), "rid", "x", "y")
    path = _registry(spark, "m13")
    model.predict(d.filter("split <> 'train'").select("rid", "x", "y"), "x").select("y", "prediction").write.parquet(path)
    return MT.regression_metrics(spark.read.parquet(path), "y", "prediction").select(F.lit("extra_trees").alias("model"), "rmse", "r2")


@query("m16_cross_validation")
def m16(spark, sf):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from cauce.operators.relational import sequence_id
    # folds stratified by label: places in the order (label, hash) are dealt out in turn
    d = sequence_id(embedding_frame(spark, sf).withColumn("_h", F.xxhash64("vec_id")), ["label", "_h", "vec_id"], "_at")
    d = d.withColumn("fold", (F.col("_at") % 5).cast("int"))
    lr = LogisticRegression(maxIter=30, labelCol="label")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, foldCol="fold", numFolds=5, seed=42, parallelism=4,
                        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="f1"))
    m = cv.fit(d)
    return spark.createDataFrame([(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(s)) for p, s in zip(grid, m.avgMetrics)],
                                 "reg_param double, elastic_net double, mean_f1 double")


@query("m16_balanced_accuracy_search")
def m16b(spark, sf):
    """The same stratified five folds and grid, chosen by balanced accuracy."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from cauce.operators.relational import sequence_id
    d = sequence_id(embedding_frame(spark, sf).withColumn("_h", F.xxhash64("vec_id")), ["label", "_h", "vec_id"], "_at")
    d = d.withColumn("fold", (F.col("_at") % 5).cast("int"))
    lr = LogisticRegression(maxIter=30, labelCol="label")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, foldCol="fold", numFolds=5, seed=42, parallelism=4,
                        evaluator=ML.BalancedAccuracy("label"))
    scores = cv.fit(d).avgMetrics
    best = max(range(len(grid)), key=lambda i: (scores[i], -i))
    return spark.createDataFrame([(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(s), i == best)
                                  for i, (p, s) in enumerate(zip(grid, scores))],
                                 "reg_param double, elastic_net double, mean_balanced_accuracy double, chosen boolean")


HASH_SPLIT_SQL = """CASE WHEN CAST(('0x' || substr(md5('42' || CAST(vec_id AS VARCHAR)), 1, 12))::BIGINT AS DOUBLE)
  / 281474976710656.0 < 0.8 THEN 'train' ELSE 'test' END"""


@query("m21_knn_classifier", sql="""
WITH sp AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, """ + HASH_SPLIT_SQL + """ AS split FROM embeddings),
d AS (SELECT q.vec_id AS qid, q.label, i.vec_id AS tid, i.label AS lab,
        list_distance(q.v, i.v) AS dist FROM sp q JOIN sp i ON q.split != 'train' AND i.split = 'train'),
nn AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist * dist, 9), tid) AS r FROM d),
vote AS (SELECT qid, label, lab, sum(1.0 / (dist + 1e-12)) AS s FROM nn WHERE r <= 5 GROUP BY ALL)
SELECT qid, arg_max(lab, s) AS prediction, label FROM vote GROUP BY qid, label
""")
def m21(spark, sf):
    d = embedding_frame(spark, sf)
    e = t(spark, sf, "embeddings").join(d.select("vec_id", "split"), "vec_id")
    pred = ML.knn_predict(spark, e.filter("split = 'train'"), e.filter("split != 'train'"), "vec_id", "embedding",
                          "label", k=5)
    return pred.join(e.select(F.col("vec_id").alias("qid"), "label"), "qid")


@query("m22_feature_importances")
def m22(spark, sf):
    from pyspark.ml.regression import RandomForestRegressor
    d = ML.assemble(regression_frame(spark, sf), REG_FEATURES)
    m = RandomForestRegressor(labelCol="l_extendedprice", numTrees=20, maxDepth=6, seed=42).fit(d)
    rows = sorted(zip(REG_FEATURES, m.featureImportances.toArray().tolist()), key=lambda x: -x[1])
    return spark.createDataFrame(rows, "feature string, importance double")


VIF_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _vif_sql() -> str:
    """The diagonal of the inverse correlation matrix, by cofactors (rows without nulls)."""
    rows = "(SELECT * FROM lineitem WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in VIF_COLS) + ")"
    pairs = [(VIF_COLS[i], VIF_COLS[j]) for i in range(4) for j in range(i + 1, 4)]
    cor = ", ".join(f"corr({x}, {y}) AS {n}" for (x, y), n in zip(pairs, "abcdef"))
    minor = "1 + 2 * {0} * {1} * {2} - {0} * {0} - {1} * {1} - {2} * {2}"
    det = ("1 - a*a - b*b - c*c - d*d - e*e - f*f + 2 * (a*b*d + a*c*e + b*c*f + d*e*f) "
           "+ a*a*f*f + b*b*e*e + c*c*d*d - 2 * (a*b*e*f + a*c*d*f + b*c*d*e)")
    each = [f"SELECT '{c}' AS feature, ({minor.format(*m)}) / ({det}) AS v FROM k" for c, m in zip(VIF_COLS, ("def", "bcf", "ace", "abd"))]
    return f"WITH k AS (SELECT {cor} FROM {rows}) SELECT feature, {R('v', 6)} AS vif, v > 10 AS redundant FROM ({' UNION ALL '.join(each)})"


@query("m25_vif", sql=_vif_sql())
def m25(spark, sf):
    rows = [(c, v, v > 10) for c, v in ST.vif(t(spark, sf, "lineitem"), VIF_COLS)]
    return spark.createDataFrame(rows, "feature string, vif double, redundant boolean").withColumn("vif", F.round("vif", 6))


@query("m26_pca")
def m26(spark, sf):
    from pyspark.ml.feature import PCA, StandardScaler
    d = ML.assemble(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "raw")
    d = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(d).transform(d)
    m = PCA(k=4, inputCol="features", outputCol="pcs").fit(d)
    ev = m.explainedVariance.toArray().tolist()
    cum, rows = 0.0, []
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, v, cum))
    return spark.createDataFrame(rows, "component int, explained double, cumulative double")


_PAIR = ("l_quantity", "l_extendedprice")


@query("m26_pca_report", sql=f"""
WITH c AS (SELECT corr({_PAIR[0]}, {_PAIR[1]}) AS r FROM lineitem),
k AS (SELECT unnest([1, 2]) AS component, unnest([(1 + abs(r)) / 2, (1 - abs(r)) / 2]) AS explained, unnest([(1 + abs(r)) / 2, 1.0]) AS cumulative,
        unnest([sign(r), -sign(r)]) AS side, (1 + abs(r)) / 2 AS first FROM c)
SELECT component, feature, {R("(CASE WHEN feature = '" + _PAIR[0] + "' THEN 1 ELSE side END) / sqrt(2)", 9)} AS loading, {R('explained', 9)} AS explained,
  {R('cumulative', 9)} AS cumulative, CASE WHEN first >= 0.9 THEN 1 ELSE 2 END AS k90, CASE WHEN first >= 0.95 THEN 1 ELSE 2 END AS k95, 0.0 AS score_corr
FROM k, (SELECT unnest(['{_PAIR[0]}', '{_PAIR[1]}']) AS feature)
""")
def m26b(spark, sf):
    r = ML.pca_report(t(spark, sf, "lineitem"), list(_PAIR))
    return r.select("component", "feature", *[F.round(c, 9).alias(c) for c in ("loading", "explained", "cumulative")], "k90", "k95",
                    F.round("score_corr", 6).alias("score_corr"))


@query("m27_kmeans_elbow")
def m27(spark, sf):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    d = embedding_frame(spark, sf)
    rows = []
    # one cluster: the spread about the mean, and no silhouette
    each = t(spark, sf, "embeddings").select(F.posexplode("embedding").alias("pos", "x"))
    spread = each.groupBy("pos").agg((F.var_pop("x") * F.count("x")).alias("s")).agg(F.sum("s")).first()[0]
    rows.append((1, float(spread or 0.0), None))
    for k in range(2, 11):
        m = KMeans(k=k, seed=42, maxIter=20).fit(d)
        rows.append((k, float(m.summary.trainingCost), float(ClusteringEvaluator().evaluate(m.transform(d)))))
    best = max((r for r in rows if r[2] is not None), key=lambda r: (r[2], -r[0]))[0]
    return spark.createDataFrame([(*r, r[0] == best) for r in rows], "k int, cost double, silhouette double, best boolean")


@query("m27_kmeans_labels")
def m27b(spark, sf):
    """Final labels at the k of the best silhouette (no cost curve is needed for it)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    d = embedding_frame(spark, sf)
    fits = [(ClusteringEvaluator().evaluate(KMeans(k=k, seed=42, maxIter=20).fit(d).transform(d)), -k) for k in range(2, 11)]
    k = -max(fits)[1]
    return KMeans(k=k, seed=42, maxIter=20).fit(d).transform(d).select("vec_id", F.col("prediction").alias("cluster"))


@query("m28_bisecting_kmeans")
def m28(spark, sf):
    from pyspark.ml.clustering import BisectingKMeans
    d = embedding_frame(spark, sf)
    m = BisectingKMeans(k=10, seed=42).fit(d)
    p = m.transform(d)
    ari = MT.adjusted_rand_index(p, "label", "prediction").select("ari")
    return p.groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).withColumn("ari_vs_label", ari.scalar())


@query("m28_ward")
def m28b(spark, sf):
    """Ward clusters of the embeddings: sizes and agreement with the labels."""
    from cauce.operators.ward import ward
    path = _registry(spark, "m28")
    ward(t(spark, sf, "embeddings").select("vec_id", "label", "embedding"), "embedding", 10).select("label", "cluster").write.parquet(path)
    p = spark.read.parquet(path)
    ari = MT.adjusted_rand_index(p, "label", "cluster").select("ari")
    return p.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).withColumn("ari_vs_label", ari.scalar())


def _registry(spark, name):
    import uuid

    from cauce.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("m36_leaderboard")
def m36(spark, sf):
    """Several pipelines on the same data, registered with their metrics; the board is read back from the registry."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
    from cauce.sources import models
    base, d = _registry(spark, "m36"), written_frame(spark, sf)
    train, test = d.filter("split = 'train'"), d.filter("split != 'train'")
    for name, est in (("linear", LinearRegression(labelCol="l_extendedprice", maxIter=50)),
                      ("decision_tree", DecisionTreeRegressor(labelCol="l_extendedprice", maxDepth=6, seed=42)),
                      ("random_forest", RandomForestRegressor(labelCol="l_extendedprice", numTrees=20, maxDepth=6, seed=42))):
        model = Pipeline(stages=[VectorAssembler(inputCols=REG_FEATURES, outputCol="features"), est]).fit(train)
        pred, ev = model.transform(test), RegressionEvaluator(labelCol="l_extendedprice")
        got = {m: ev.setMetricName(m).evaluate(pred) for m in ("r2", "rmse")}
        models.register(spark, base, model, name, got)
    r2 = models.leaderboard(spark, base, "r2")
    rmse = models.leaderboard(spark, base, "rmse", smaller_is_better=True).select("version", F.col("value").alias("rmse"))
    return r2.join(rmse, "version").select("model", "rmse", F.col("value").alias("r2"), "rank")


@query("m37_batch_scoring")
def m37(spark, sf):
    """A model is fitted and stored once; the batch is scored from the stored version."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.feature import VectorAssembler
    from cauce.sources import models
    base, d = _registry(spark, "m37"), regression_frame(spark, sf)
    model = Pipeline(stages=[VectorAssembler(inputCols=REG_FEATURES, outputCol="features"),
                             LinearRegression(labelCol="l_extendedprice", maxIter=50)]).fit(d.filter("split = 'train'"))
    models.register(spark, base, model, "linear", {})
    return models.score(spark, base, d, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "prediction", F.concat_ws("-v", "model", F.col("model_version").cast("string")).alias("model_version"))


RULE_SQL = "l_extendedprice * (1 - l_discount)"


@query("s22_prediction_log", sql=f"""
SELECT l_orderkey * 100 + l_linenumber AS rid, {R(RULE_SQL, 6)} AS prediction, 'net_price' AS model, 2 AS model_version,
  CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 2 END AS batch
FROM lineitem ORDER BY rid DESC LIMIT 20
""")
def s22b(spark, sf):
    """Two batches scored by a stored version (a rule as a pipeline) and logged; the newest 20 rows of the log."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    from cauce.sources import models
    base = _registry(spark, "s22")
    for rule in ("l_extendedprice", RULE_SQL):
        models.register(spark, base, PipelineModel([SQLTransformer(statement=f"SELECT *, {rule} AS prediction FROM __THIS__")]), "net_price", {})
    li = t(spark, sf, "lineitem").withColumn("rid", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    for batch in ("l_orderkey % 2 = 0", "l_orderkey % 2 <> 0"):
        models.score(spark, base, li.filter(batch), "rid")
    return models.newest_predictions(spark, base, "rid", 20).select("rid", F.round("prediction", 6).alias("prediction"), "model", "model_version", "batch")


# --------------------------------------------------------------- text models
def text_frame(spark, sf):
    from cauce.plans.textops import split_docs
    return split_docs(spark, sf).filter(F.col("label").isNotNull())


ALL_TERMS = (1 << 31) - 1


def tfidf_model(train, min_df: float = 1.0, max_df: float = float(1 << 62), stop_words=()):
    """T10's features as a fitted Spark ML model: tf * (ln((1 + n) / (1 + df)) + 1), rows of length one.

    Spark's ``IDF`` lacks the ``+ 1``, so its weights are raised by one.  The vocabulary is not capped."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import (IDF, CountVectorizer, ElementwiseProduct, Normalizer, RegexTokenizer,
                                    StopWordsRemover)
    from pyspark.ml.linalg import Vectors
    tok = RegexTokenizer(inputCol="text", outputCol="all_toks", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False, toLowercase=True)
    stop = StopWordsRemover(inputCol="all_toks", outputCol="toks", stopWords=list(stop_words), locale="en_US")
    words = stop.transform(tok.transform(train))
    counts = CountVectorizer(inputCol="toks", outputCol="tf", minDF=min_df, maxDF=max_df, vocabSize=ALL_TERMS).fit(words)
    idf = IDF(inputCol="tf", outputCol="w").fit(counts.transform(words))
    scale = ElementwiseProduct(inputCol="tf", outputCol="w", scalingVec=Vectors.dense(idf.idf.toArray() + 1.0))
    return PipelineModel([tok, stop, counts, scale, Normalizer(inputCol="w", outputCol="features")])


@query("t19_text_classifiers")
def t19(spark, sf):
    from cauce.operators.text_models import classify
    return classify(text_frame(spark, sf))


@query("t20_model_selection")
def t20(spark, sf):
    """Macro-F1 per model on validation; ties -> simpler model (naive Bayes first)."""
    return model_selection(t19(spark, sf))


def model_selection(preds):
    """T20 on a predictions table (validation rows), decision recorded before test is read."""
    p = preds.filter("split = 'validation'").withColumn("prediction", F.col("prediction").cast("int")) \
        .withColumn("label", F.col("label").cast("int"))
    out = None
    for name, rank in (("naive_bayes", 0), ("logistic", 1)):
        pm = p.filter(F.col("model") == name)
        rep = MT.class_report(pm, "label", "prediction")
        r = rep.agg(F.avg("f1").alias("macro_f1")).withColumn("model", F.lit(name)).withColumn("simplicity", F.lit(rank))
        out = r if out is None else out.unionByName(r)
    # two rows (one per model): the decision is taken on the driver, recorded before test
    best = out.agg(F.min_by("model", F.struct(-F.col("macro_f1"), F.col("simplicity"))).alias("chosen")).first()[0]
    return out.withColumn("chosen", F.lit(best))


# Stop words of the topic model, and the share of documents above which a term is left out.
TOPIC_STOP_WORDS = ("de la el en un una y no mi que al del para con lo se es").split()


@query("t21_topics")
def t21(spark, sf):
    from pyspark.ml.clustering import LDA
    d = t(spark, sf, "documents").select("doc_id", "text")
    features = tfidf_model(d, min_df=2.0, max_df=0.95, stop_words=TOPIC_STOP_WORDS)
    m = LDA(k=4, maxIter=10, seed=42).fit(features.transform(d))
    vocab = features.stages[2].vocabulary
    rows = [(int(r["topic"]), [vocab[i] for i in r["termIndices"]]) for r in m.describeTopics(6).collect()]
    return spark.createDataFrame(rows, "topic int, top_terms array<string>")


@query("t21_nmf_topics")
def t21b(spark, sf):
    """Four topics with six terms each, by non-negative factors of the TF-IDF table (stop words and terms of one document left out)."""
    from cauce.operators import nmf, term_blocks as TB
    d = t(spark, sf, "documents")
    n = d.agg(F.count(F.lit(1))).first()[0]
    blocks = TB.term_blocks(d, "doc_id", "text", stop_words=TOPIC_STOP_WORDS, block=4 * TB.BLOCK, bucket=8 * TB.BUCKET)
    topics = nmf.factorise_blocks(*nmf.tfidf_blocks(blocks, n, 2, 0.95 * n), 4, rounds=6)
    return topics.top_terms(6).select("topic", "rank", "term", F.round("weight", 9).alias("weight"))


WORD2VEC_SHARE = 8 << 20


def word2vec_shares(texts) -> int:
    """Shares of WORD2VEC_SHARE characters at most, about, in which the texts are trained side by side, their vectors averaged."""
    size = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return max(1, -(-size // WORD2VEC_SHARE))


class WordModels:
    """Word vectors by window: of one share Spark's own, of several ones those of :mod:`cauce.operators.word_vectors`."""

    def __init__(self, spark, sf):
        from cauce.operators.word_vectors import WordShares
        self.texts = t(spark, sf, "documents").select("text")
        shares = word2vec_shares(self.texts)
        self.shares = WordShares(self.texts, shares) if shares > 1 else None

    def _spark_model(self, window):
        from pyspark.ml.feature import RegexTokenizer, Word2Vec
        tok = RegexTokenizer(inputCol="text", outputCol="toks", pattern=r"[\p{L}\p{N}_]+", gaps=False).transform(self.texts)
        return Word2Vec(vectorSize=32, windowSize=window, minCount=1, maxSentenceLength=ALL_TERMS, seed=42, maxIter=1,
                        numPartitions=1, inputCol="toks", outputCol="vec").fit(tok)

    def vectors(self, window=2):
        from pyspark.ml.functions import array_to_vector
        if self.shares is None:
            return self._spark_model(window).getVectors()
        return self.shares.vectors(window).select("word", array_to_vector("vector").alias("vector"))

    def nearest(self, words, n, window):
        """For each of the words its ``n`` nearest ones."""
        if self.shares is None:
            m = self._spark_model(window)
            return {w: [r["word"] for r in m.findSynonyms(w, n).collect()] for w in words}
        from cauce.operators.word_vectors import nearest_words
        return nearest_words(self.shares.vectors(window), words, n)


@query("t22_word_embeddings")
def t22(spark, sf):
    return WordModels(spark, sf).vectors()


@query("t23_neighbour_overlap")
def t23(spark, sf):
    """Nearest words of frequent terms under two window sizes and the Jaccard overlap of the sets."""
    from cauce.functions.numeric import jaccard
    from cauce.functions.strings import explode_nonnull, words as word_tokens
    # probe words: the five most frequent corpus words (a top-k report; ties by word)
    w = explode_nonnull(t(spark, sf, "documents"), word_tokens("text", 3), "word")
    top = w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(5)
    words = [r["word"] for r in top.collect()]
    models = WordModels(spark, sf)
    near = [models.nearest(words, 5, window) for window in (2, 5)]
    rows = [(w, *[m[w] for m in near]) for w in words]
    df = spark.createDataFrame(rows, "word string, near_w2 array<string>, near_w5 array<string>")
    return df.withColumn("jaccard", jaccard("near_w2", "near_w5"))


@query("m09_oversample_inside_folds")
def m09(spark, sf):
    """Oversampling applied to each CV training fold only; the held-out fold stays untouched."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    e = t(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    e = e.withColumn("fold", F.pmod(F.xxhash64("vec_id"), F.lit(3)).cast("int"))
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    rows = []
    for k in range(3):
        train = ML.oversample(e.filter(F.col("fold") != k), "label", "vec_id")
        test = e.filter(F.col("fold") == k)
        vec = lambda d: d.withColumn("features", array_to_vector("embedding"))
        m = LogisticRegression(maxIter=20, labelCol="label").fit(vec(train))
        rows.append((k, train.count(), test.count(), ev.evaluate(m.transform(vec(test)))))
    return spark.createDataFrame(rows, "fold int, train_rows long, test_rows long, f1 double")


@query("m10_univariate_selection")
def m10(spark, sf):
    """k best features by F-regression (continuous features, continuous label)."""
    from pyspark.ml.feature import UnivariateFeatureSelector
    cols = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
    d = ML.assemble(regression_frame(spark, sf), cols)
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol="l_extendedprice", outputCol="selected",
                                    selectionMode="numTopFeatures").setFeatureType("continuous") \
        .setLabelType("continuous").setSelectionThreshold(2)
    m = sel.fit(d)
    return spark.createDataFrame([(cols[i],) for i in m.selectedFeatures], "feature string")
