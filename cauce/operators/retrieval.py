"""Retrieval operators.

Dense search (J14, T14, M21) is in :mod:`cauce.operators.dense`, lexical search
(T13) in :mod:`cauce.operators.inverted`, containment (T08) in
:mod:`cauce.operators.containment`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions import strings as S
from cauce.operators import inverted
from cauce.operators.containment import containment_pairs  # noqa: F401  (T08)

def topk_sparse(spark: SparkSession, items_w: DataFrame, queries_w: DataFrame, k: int,
                max_queries: int | None = None, max_postings: int = inverted.SHARD) -> DataFrame:
    """Exact top-k by sparse dot product of ``(id, term, weight)`` tables; ``(qid, item_id, score, rank)``.

    ``max_postings`` bounds the documents of a shard, hence the postings of a block.  Queries are rows of joins
    and need no bound: ``max_queries`` is there for earlier callers and changes nothing."""
    queries = inverted.query_terms(queries_w, unit=False)
    asked = queries.select("term").distinct().withColumn("asked", F.lit(True))
    return inverted.search(items_w.join(asked, "term", "left"), queries, k, unit=False, size=max_postings)


# -------------------------------------------------------------------- metrics
def retrieval_metrics(ranking: DataFrame, relevant: DataFrame) -> DataFrame:
    """recall@k and MRR over answerable queries (queries with a relevant item).

    ``ranking``: (qid, item_id, rank); ``relevant``: (qid, item_id).
    """
    rel_n = relevant.groupBy("qid").agg(F.count(F.lit(1)).alias("n_rel"))
    hits = ranking.join(relevant.withColumn("_rel", F.lit(True)), ["qid", "item_id"], "left")
    per_q = hits.groupBy("qid").agg(F.count_if(F.col("_rel")).alias("hits"),
                                    F.min(F.when(F.col("_rel"), F.col("rank"))).alias("first_hit"))
    per_q = rel_n.join(per_q, "qid", "left").select(
        "qid", (F.coalesce("hits", F.lit(0)) / F.col("n_rel")).alias("recall"),
        F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)).alias("reciprocal_rank"))
    return per_q.agg(F.avg("recall").alias("recall_at_k"), F.avg("reciprocal_rank").alias("mrr"),
                     F.count(F.lit(1)).alias("n_answerable"))


def best_threshold(scored: DataFrame, score: str = "score", positive: str = "positive",
                   low: float = 0.0, high: float = 1.01) -> DataFrame:
    """Threshold maximising balanced accuracy; ties -> the larger threshold.

    Candidates are ``low``, midpoints of consecutive distinct scores, ``high``.
    Cumulative class counts and the next distinct score come from the
    range-partitioned sequential operators, so even a table whose scores are
    all distinct is never ordered by a single task.
    """
    from cauce.operators.sequential import ordered_lag, running_totals
    lv = scored.groupBy(F.col(score).alias("v")).agg(
        F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    P = scored.agg(F.count_if(F.col(positive))).scalar()
    N = scored.agg(F.count_if(~F.col(positive))).scalar()
    cum = running_totals(lv, ["v"], ["pos", "neg"])
    # next distinct score = previous one in descending order
    cum = ordered_lag(cum.withColumn("_neg_v", -F.col("v")), [], ["_neg_v"], "v", "nv")
    mids = cum.filter(F.col("nv").isNotNull()).select(
        ((F.col("v") + F.col("nv")) / 2).alias("threshold"),
        (F.try_divide(F.lit(P) - F.col("cum_pos"), P) + F.try_divide(F.col("cum_neg"), N)).alias("_s"))

    def fixed(t):
        return scored.agg(
            F.lit(t).cast("double").alias("threshold"),
            (F.try_divide(F.count_if(F.col(positive) & (F.col(score) >= t)), P)
             + F.try_divide(F.count_if(~F.col(positive) & (F.col(score) < t)), N)).alias("_s"))

    allc = mids.unionByName(fixed(low)).unionByName(fixed(high)) \
        .withColumn("balanced_accuracy", F.col("_s") / 2)
    return allc.agg(F.max_by("threshold", F.struct("balanced_accuracy", "threshold")).alias("threshold"),
                    F.max("balanced_accuracy").alias("balanced_accuracy"))


def span_scores(gold: DataFrame, pred: DataFrame, keys=("doc_id", "start", "end", "label")) -> DataFrame:
    """Exact-match micro precision/recall/F1 over span tuples (full outer join)."""
    keys = list(keys)
    g = gold.select(*keys).distinct().withColumn("_g", F.lit(True))
    p = pred.select(*keys).distinct().withColumn("_p", F.lit(True))
    j = g.join(p, keys, "full_outer")
    m = j.agg(F.count_if(F.col("_g") & F.col("_p")).alias("tp"),
              F.count_if(F.col("_p") & F.col("_g").isNull()).alias("fp"),
              F.count_if(F.col("_g") & F.col("_p").isNull()).alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    m = m.withColumn("precision", prec).withColumn("recall", rec)
    return m.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                        .otherwise(0.0))


def screen_evidence(ranked: DataFrame, threshold: float, text_col: str = "text",
                    title_col: str = "title", questions: DataFrame | None = None) -> DataFrame:
    """The decision on each query, in this order: a suspicious question; no evidence that is not
    suspicious, or the first such one below the threshold; contradiction (several texts under one title
    among all evidence that is not suspicious); else answer."""
    safe = ~S.suspicious(F.col(text_col))
    per_q = ranked.groupBy("qid").agg(
        F.count_if(safe).alias("n_allowed"), F.count_distinct(F.when(safe, F.col(text_col))).alias("n_texts"),
        F.count_distinct(F.when(safe, F.col(title_col))).alias("n_titles"),
        F.min_by(F.when(safe, F.col("score")), F.when(safe, F.col("rank"))).alias("best_score"))
    decision = (F.when((F.col("n_allowed") == 0) | (F.col("best_score") < threshold), F.lit("insufficient_evidence"))
                .when((F.col("n_texts") > 1) & (F.col("n_titles") == 1), F.lit("contradictory"))
                .otherwise(F.lit("answer")))
    if questions is not None:
        per_q = per_q.join(questions.select("qid", S.suspicious(F.col("question")).alias("_odd")), "qid", "left")
        decision = F.when(F.coalesce(F.col("_odd"), F.lit(False)), F.lit("suspicious_question")).otherwise(decision)
    return per_q.withColumn("decision", decision).drop("_odd")


def literal_support(ranked: DataFrame, answers: DataFrame, text_col: str = "text") -> DataFrame:
    """T17 citations: ``(qid, item_id)`` of safe evidence whose canonical text holds the canonical answer
    (three characters or more).  ``answers``: (qid, answer)."""
    a = answers.select("qid", S.canonical_key("answer").alias("_a")).filter(F.length("_a") >= 3)
    return ranked.filter(~S.suspicious(F.col(text_col))).join(a, "qid") \
        .filter(S.canonical_key(text_col).contains(F.col("_a"))).select("qid", "item_id")
