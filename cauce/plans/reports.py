"""Named analytical report pack Q1-Q5 (Z07) and the flagship slice.

Each report is a lazy DataFrame; ordering is applied where the report
defines one, with explicit tiebreaks so ``limit`` is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions.numeric import money, pct_label
from cauce.operators.relational import split_valid
from cauce.operators.windows import lag_change, trend_label
from cauce.plans.facts import EXCLUDED_STATUS, FLAG_STATUS, ORDER_FACT_SQL, order_fact, t, nations
from cauce.plans.registry import query
from cauce.plans.sqlfrag import MONEY, PCT, R


# ------------------------------------------------------------------ library
def revenue_by_category(fact: DataFrame, category: str = "category", amount: str = "amount",
                        status: str = "status", excluded=EXCLUDED_STATUS) -> DataFrame:
    """Revenue and mean ticket per category, excluded status left out."""
    return (fact.filter(F.col(status) != excluded)
            .groupBy(F.col(category).alias("category"))
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.round(F.sum(amount), 2).alias("revenue"),
                 F.round(F.avg(amount), 2).alias("avg_ticket"),
                 F.round(F.avg(amount) / 100, 2).alias("avg_ticket_hundreds"))
            .orderBy(F.desc("revenue"), "category"))


def rate_above_overall(fact: DataFrame, group: str = "branch", status: str = "status",
                       flag=FLAG_STATUS) -> DataFrame:
    """Flagged-rate per group vs the overall rate; keep groups above.

    Both rates are rounded to 2 decimals *before* comparing, as the reference
    does.  The overall rate is a scalar subquery, not a cross join.
    """
    hit = F.when(F.col(status) == flag, 1).otherwise(0)
    per = fact.groupBy(F.col(group).alias("group_key")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(hit).cast("long").alias("flagged"),
        F.round(F.sum(hit) / F.count(F.lit(1)) * 100, 2).alias("rate_pct"))
    # the overall rate from the per-group counts (same integers): the subquery reads the
    # small aggregate and Spark reuses its exchange instead of scanning the fact again
    overall = per.agg(F.round(F.sum("flagged") / F.sum("total_orders") * 100, 2)).scalar()
    return (per.withColumn("overall_pct", overall)
            .filter(F.col("rate_pct") > F.col("overall_pct"))
            .withColumn("rate_label", pct_label(F.col("rate_pct")))
            .withColumn("overall_label", pct_label(F.col("overall_pct")))
            .withColumn("diff_pct", F.round(F.col("rate_pct") - F.col("overall_pct"), 2))
            .orderBy(F.desc("rate_pct"), "group_key"))


def monthly_change(fact: DataFrame, group: str = "branch", amount: str = "amount",
                   status: str = "status", excluded=EXCLUDED_STATUS, since: str | None = None) -> DataFrame:
    """Monthly revenue per group with previous month and % change.

    The window runs on the (group, month) aggregate, never on raw rows.
    """
    m = (fact.filter(F.col(status) != excluded)
         .groupBy(F.col(group).alias("group_key"), F.col("month"))
         .agg(F.round(F.sum(amount), 2).alias("revenue"), F.count(F.lit(1)).alias("orders")))
    m = lag_change(m, "group_key", "month", "revenue", "revenue_prev", "pct_change")
    from pyspark.sql import Window
    w = Window.partitionBy("group_key").orderBy("month")
    m = m.withColumn("orders_prev", F.lag("orders").over(w))
    if since:
        m = m.filter(F.col("month") >= since)
    return (m.withColumn("revenue_label", money(F.col("revenue")))
             .withColumn("change_label", F.when(F.col("pct_change").isNull(), F.lit("N/A (primer mes)"))
                         .otherwise(pct_label(F.col("pct_change"), signed=True)))
             .withColumn("trend", trend_label(F.col("pct_change")))
             .orderBy("group_key", "month"))


def top_entities(detail: DataFrame, entity: str, amount: str, gap: str, extra: str, k: int = 10) -> DataFrame:
    """Per-entity count, totals, gap sums with a class; top ``k`` by count.

    Ties on the count are broken by the entity key so the limit is stable.
    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject (per-partition top-k).
    """
    g = detail.groupBy(F.col(entity).alias("entity")).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.round(F.sum(amount), 2).alias("total_spent"),
        F.round(F.avg(amount), 2).alias("avg_ticket"),
        F.round(F.sum(gap), 2).alias("gap_total"),
        F.round(F.avg(gap), 2).alias("gap_avg"),
        F.round(F.avg(extra), 0).alias("extra_avg"))
    cls = (F.when(F.col("gap_total") < -1000, F.lit("Descuento alto"))
            .when(F.col("gap_total") < -100, F.lit("Descuento moderado"))
            .otherwise(F.lit("Sin descuento significativo")))
    return g.withColumn("gap_class", cls).orderBy(F.desc("n_items"), "entity").limit(k)


def reasons_by_period(quarantine: DataFrame, period_col: str = "period",
                      reason_col: str = "reject_reason") -> DataFrame:
    """Reasons split and counted per period, period total, share, bar."""
    r = (quarantine.select(F.col(period_col).alias("period"),
                           F.explode(F.split(F.col(reason_col), ";")).alias("reason"))
         .withColumn("reason", F.trim("reason")).filter(F.col("reason") != ""))
    c = r.groupBy("period", "reason").agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy("period").agg(F.sum("n").alias("period_total"))
    share = F.col("n") / F.col("period_total")
    bar = (F.when(share >= 0.30, F.lit("██████████")).when(share >= 0.20, F.lit("████████"))
           .when(share >= 0.10, F.lit("██████")).when(share >= 0.05, F.lit("████"))
           .otherwise(F.lit("██")))
    return (c.join(tot, "period")
            .withColumn("period_total", F.col("period_total").cast("long"))
            .withColumn("share_pct", F.round(share * 100, 2))
            .withColumn("bar", bar)
            .orderBy(F.desc("period"), F.desc("n"), "reason"))


# ------------------------------------------------------------------ queries
FACT = "WITH " + ORDER_FACT_SQL


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Minimum slice: validity split (P02) -> nation lookup (J02) -> Q1."""
    o = t(spark, sf, "orders")
    valid, _ = split_valid(o, (F.col("o_totalprice") > 0) & F.col("o_orderdate").isNotNull())
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = valid.join(c, valid.o_custkey == c.c_custkey).join(
        nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    fact = j.select(F.col("o_orderpriority").alias("category"), F.col("n_name").alias("branch"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    return revenue_by_category(fact)


query("g03_revenue_by_category", sql=f"""
{FACT}
SELECT category, count(*) AS total_orders, {R('sum(amount)')} AS revenue,
       {R('avg(amount)')} AS avg_ticket, {R('avg(amount) / 100')} AS avg_ticket_hundreds
FROM fact WHERE status != 'P' GROUP BY category ORDER BY revenue DESC, category
""")(lambda spark, sf: revenue_by_category(order_fact(spark, sf)))

query("z00_flagship_valid_revenue", sql=f"""
WITH v AS (SELECT * FROM orders WHERE o_totalprice > 0 AND o_orderdate IS NOT NULL),
fact AS (SELECT v.o_orderpriority AS category, n.n_name AS branch, v.o_orderstatus AS status,
                v.o_totalprice AS amount
         FROM v JOIN customer c ON v.o_custkey = c.c_custkey
         LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT category, count(*) AS total_orders, {R('sum(amount)')} AS revenue,
       {R('avg(amount)')} AS avg_ticket, {R('avg(amount) / 100')} AS avg_ticket_hundreds
FROM fact WHERE status != 'P' GROUP BY category
""")(flagship)

_RATE = "sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) * 1.0 / count(*) * 100"
query("g04_rate_above_overall", sql=f"""
{FACT},
per AS (SELECT branch AS group_key, count(*) AS total_orders,
               CAST(sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
               {R(_RATE)} AS rate_pct FROM fact GROUP BY branch),
ov AS (SELECT {R(_RATE)} AS overall_pct FROM fact)
SELECT per.*, ov.overall_pct, {PCT('rate_pct')} AS rate_label, {PCT('overall_pct')} AS overall_label,
       {R('rate_pct - overall_pct')} AS diff_pct
FROM per, ov WHERE rate_pct > overall_pct
""")(lambda spark, sf: rate_above_overall(order_fact(spark, sf)))

_Q3_SINCE = "1996-01"
query("w01_monthly_change", sql=f"""
{FACT},
m AS (SELECT branch AS group_key, month, {R('sum(amount)')} AS revenue, count(*) AS orders
      FROM fact WHERE status != 'P' GROUP BY branch, month),
l AS (SELECT *, lag(revenue) OVER (PARTITION BY group_key ORDER BY month) AS revenue_prev,
             lag(orders) OVER (PARTITION BY group_key ORDER BY month) AS orders_prev FROM m),
p AS (SELECT *, {R('(revenue - revenue_prev) / nullif(revenue_prev, 0) * 100')} AS pct_change FROM l)
SELECT group_key, month, revenue, orders, revenue_prev, pct_change, orders_prev,
       {MONEY('revenue')} AS revenue_label,
       CASE WHEN pct_change IS NULL THEN 'N/A (primer mes)'
            WHEN pct_change > 0 THEN '+' || {PCT('pct_change')} ELSE {PCT('pct_change')} END AS change_label,
       CASE WHEN pct_change > 0 THEN 'Aumento' WHEN pct_change < 0 THEN 'Disminución'
            ELSE 'Sin cambio' END AS trend
FROM p WHERE month >= '{_Q3_SINCE}'
""")(lambda spark, sf: monthly_change(order_fact(spark, sf), since=_Q3_SINCE))


def line_detail(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part: charged vs list price per line (the revenue gap)."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                                         "l_discount")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    p = t(spark, sf, "part").select("p_partkey", "p_retailprice")
    charged = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey, "left")
            .select(F.col("o_custkey").alias("customer_id"), F.col("l_quantity").alias("qty"),
                    charged.alias("charged"),
                    (charged - F.col("l_quantity") * F.col("p_retailprice")).alias("gap")))


LINE_DETAIL_SQL = """
detail AS (
  SELECT o.o_custkey AS customer_id, l.l_quantity AS qty,
         l.l_extendedprice * (1 - l.l_discount) AS charged,
         l.l_extendedprice * (1 - l.l_discount) - l.l_quantity * p.p_retailprice AS gap
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

query("g20_top_customers", sql=f"""
WITH {LINE_DETAIL_SQL},
g AS (SELECT customer_id AS entity, count(*) AS n_items, {R('sum(charged)')} AS total_spent,
             {R('avg(charged)')} AS avg_ticket, {R('sum(gap)')} AS gap_total, {R('avg(gap)')} AS gap_avg,
             {R('avg(qty)', 0)} AS extra_avg
      FROM detail GROUP BY customer_id)
SELECT *, CASE WHEN gap_total < -1000 THEN 'Descuento alto'
               WHEN gap_total < -100 THEN 'Descuento moderado'
               ELSE 'Sin descuento significativo' END AS gap_class
FROM g ORDER BY n_items DESC, entity LIMIT 10
""")(lambda spark, sf: top_entities(line_detail(spark, sf), "customer_id", "charged", "gap", "qty"))
