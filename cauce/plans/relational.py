"""Relational core queries: projections, joins, aggregates, windows, sets, sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cauce.functions.dates import month_key
from cauce.functions.numeric import safe_div
from cauce.functions.strings import norm_key
from cauce.operators import aggregates as A
from cauce.operators import relational as RL
from cauce.operators import windows as W
from cauce.plans.facts import FLAG_STATUS, ORDER_FACT_SQL, nations, order_fact, t
from cauce.plans.registry import query
from cauce.plans.sqlfrag import R

FACT = "WITH " + ORDER_FACT_SQL


# ------------------------------------------------------------- projections (P)
@query("p01_filter_select_derive", sql="""
SELECT o_orderkey, o_custkey, o_totalprice, 2002 - year(o_orderdate) AS order_age_years
FROM orders WHERE o_orderstatus = 'F'
""")
def p01(spark, sf):
    return (t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
            .select("o_orderkey", "o_custkey", "o_totalprice",
                    (F.lit(2002) - F.year("o_orderdate")).alias("order_age_years")))


@query("p02_split_valid", sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN coalesce(l_discount <= 0.08 AND l_tax > 0, false) THEN 'valid' ELSE 'rejected' END AS split
FROM lineitem
""")
def p02(spark, sf):
    li = t(spark, sf, "lineitem")
    ok, bad = RL.split_valid(li, (F.col("l_discount") <= 0.08) & (F.col("l_tax") > 0))
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    return ok.select(*cols, F.lit("valid").alias("split")) \
        .unionByName(bad.select(*cols, F.lit("rejected").alias("split")))


@query("p03_multi_predicate", sql="""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 250000
""")
def p03(spark, sf):
    return (t(spark, sf, "orders")
            .filter((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                    & (F.col("o_totalprice") >= 250000))
            .select("o_orderkey", "o_totalprice"))


@query("p04_between", sql="""
SELECT p_partkey, p_size, p_retailprice FROM part
WHERE p_size BETWEEN 10 AND 20 AND p_retailprice BETWEEN 920 AND 960
""")
def p04(spark, sf):
    return (t(spark, sf, "part")
            .filter(F.col("p_size").between(10, 20) & F.col("p_retailprice").between(920, 960))
            .select("p_partkey", "p_size", "p_retailprice"))


@query("p05_membership", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def p05(spark, sf):
    c = t(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return (t(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
            .join(c, "o_custkey", "left_semi").select("o_orderkey", "o_custkey"))


@query("p07_dropna_subset", sql="""
SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value FROM events
WHERE nullif(event_type, 'error') IS NOT NULL AND value IS NOT NULL
""")
def p07(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id",
                                      F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value")
    return e.dropna(subset=["event_type", "value"])


@query("p11_sequence_id", sql="""
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row_id FROM customer
""")
def p11(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return RL.sequence_id(c, [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_custkey", "row_id")


@query("p12_case_bands", sql="""
SELECT c_custkey,
  CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 1000 THEN 'low'
       WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS balance_band
FROM customer
""")
def p12(spark, sf):
    b = (F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") < 1000, "low")
         .when(F.col("c_acctbal") < 5000, "mid").otherwise("high"))
    return t(spark, sf, "customer").select("c_custkey", b.alias("balance_band"))


@query("p13_flags", sql="""
SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS is_purchase,
  CAST(hour(ts) BETWEEN 9 AND 13 AS INTEGER) AS is_peak_hour,
  CAST(value >= 100 AND event_type = 'purchase' AS INTEGER) AS is_big_purchase
FROM events
""")
def p13(spark, sf):
    from cauce.functions.dates import is_peak_hour
    e = t(spark, sf, "events")
    return e.select("event_id", (F.col("event_type") == "purchase").cast("int").alias("is_purchase"),
                    is_peak_hour("ts").cast("int").alias("is_peak_hour"),
                    ((F.col("value") >= 100) & (F.col("event_type") == "purchase")).cast("int")
                    .alias("is_big_purchase"))


@query("p14_fill_clip", sql="""
SELECT event_id, greatest(coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value - 100 END, 0), 0) AS net_value
FROM events
""")
def p14(spark, sf):
    from cauce.functions.numeric import fill_clip
    e = t(spark, sf, "events")
    v = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value") - 100)
    return e.select("event_id", fill_clip(v).alias("net_value"))


# ------------------------------------------------------------------- joins (J)
@query("j01_left_join_shared_name", sql="""
SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def j01(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t(spark, sf, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left")


@query("j02_broadcast_dimension", sql="""
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def j02(spark, sf):
    r = RL.sized_broadcast(t(spark, sf, "region").select("r_regionkey", "r_name"), 1000)
    n = nations(spark, sf).join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    n = RL.sized_broadcast(n, 1000)
    return t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .select("c_custkey", "n_name", "r_name")


@query("j03_inner_join", sql="""
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def j03(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = t(spark, sf, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "o_orderdate",
                                                            "l_shipdate")


@query("j04_composite_lookup_last_wins", sql="""
WITH rates AS (SELECT p_brand, p_type, max_by(p_retailprice, p_partkey) AS base_rate FROM part GROUP BY ALL)
SELECT l.l_orderkey, l.l_linenumber, r.base_rate
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN rates r ON p.p_brand = r.p_brand AND p.p_type = r.p_type
""")
def j04(spark, sf):
    part = t(spark, sf, "part")
    rates = RL.dedupe_lookup(part.select("p_brand", "p_type", "p_retailprice", "p_partkey"),
                             ["p_brand", "p_type"], "p_partkey", last_wins=True) \
        .select("p_brand", "p_type", F.col("p_retailprice").alias("base_rate"))
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return li.join(p, "l_partkey", "left").join(rates, ["p_brand", "p_type"], "left") \
        .select("l_orderkey", "l_linenumber", "base_rate")


@query("j05_left_join_indicator", sql="""
WITH r AS (SELECT o_custkey AS custkey, sum(o_totalprice) AS acctbal FROM orders
           WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
SELECT c.c_custkey AS custkey, c.c_acctbal AS acctbal, r.acctbal AS acctbal_right,
       CASE WHEN r.custkey IS NOT NULL THEN 'both' ELSE 'left_only' END AS _merge
FROM customer c LEFT JOIN r ON c.c_custkey = r.custkey
""")
def j05(spark, sf):
    left = t(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("acctbal"))
    right = (t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
             .groupBy(F.col("o_custkey").alias("custkey")).agg(F.sum("o_totalprice").alias("acctbal")))
    return RL.left_join_indicator(left, right, "custkey")


@query("j06_lookup_struct", sql="""
WITH n AS (SELECT * FROM nation WHERE n_regionkey != 4)
SELECT s.s_suppkey, CASE WHEN n.n_nationkey IS NULL THEN NULL ELSE n.n_name END AS nation_name,
       n.n_regionkey AS nation_region
FROM supplier s LEFT JOIN n ON s.s_nationkey = n.n_nationkey
""")
def j06(spark, sf):
    n = t(spark, sf, "nation").filter(F.col("n_regionkey") != 4) \
        .withColumnRenamed("n_nationkey", "s_nationkey")
    j = RL.lookup_struct(t(spark, sf, "supplier"), n, "s_nationkey", ["n_name", "n_regionkey"], "nation")
    return j.select("s_suppkey", F.col("nation.n_name").alias("nation_name"),
                    F.col("nation.n_regionkey").alias("nation_region"))


@query("j06_unknown_keys", sql="""
SELECT DISTINCT s_nationkey FROM supplier
WHERE s_nationkey IS NOT NULL AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey != 4)
""")
def j06b(spark, sf):
    n = t(spark, sf, "nation").filter(F.col("n_regionkey") != 4)
    return RL.unknown_keys(t(spark, sf, "supplier"), n, "s_nationkey", "n_nationkey")


@query("j07_theta_vs_overall", sql="""
SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)
""")
def j07(spark, sf):
    p = t(spark, sf, "part")
    overall = p.agg(F.avg("p_retailprice")).scalar()
    return p.filter(F.col("p_retailprice") > overall).select("p_partkey", "p_retailprice")


@query("j08_anti_join", sql="""
SELECT c_custkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')
""")
def j08(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@query("j09_semi_join", sql="""
SELECT o_orderkey FROM orders o
WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 0)
""")
def j09(spark, sf):
    c = t(spark, sf, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return t(spark, sf, "orders").join(c, "o_custkey", "left_semi").select("o_orderkey")


@query("j10_equi_plus_inequality", sql="""
SELECT l.l_orderkey, l.l_linenumber, datediff('day', o.o_orderdate, l.l_shipdate) AS days_to_ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < o.o_orderdate
""")
def j10(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = t(spark, sf, "lineitem")
    return (li.join(o, li.l_orderkey == o.o_orderkey).filter(F.col("l_shipdate") < F.col("o_orderdate"))
            .select("l_orderkey", "l_linenumber",
                    F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days_to_ship")))


def nation_catalogue(spark, sf):
    """S07-shaped alias catalogue derived from ``nation``: canonical and two spellings."""
    n = t(spark, sf, "nation").select("n_name")
    aliases = F.array(F.col("n_name"), F.lower("n_name"), F.replace(F.col("n_name"), F.lit("_"), F.lit("-")))
    return n.select(F.explode(aliases).alias("alias"), F.col("n_name").alias("canonical")) \
        .select(norm_key("alias").alias("alias_norm"), "canonical").distinct()


RAW_NATION = """CASE WHEN c.c_acctbal > 9000 THEN 'unknown place'
  WHEN c.c_acctbal < 0 THEN lower(n.n_name)
  WHEN c.c_acctbal < 1000 THEN ' ''' || n.n_name || ''' '
  ELSE replace(n.n_name, '_', '-') END"""


@query("j11_homologation", sql=f"""
WITH raw AS (SELECT c.c_custkey, {RAW_NATION} AS raw_nation
             FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
cat AS (SELECT DISTINCT lower(trim(a)) AS alias_norm, n_name AS canonical FROM nation,
        unnest([n_name, lower(n_name), replace(n_name, '_', '-')]) AS u(a))
SELECT raw.c_custkey, raw.raw_nation, cat.canonical AS nation_clean
FROM raw LEFT JOIN cat ON lower(trim(regexp_replace(trim(raw.raw_nation), '^[''"]+|[''"]+$', '', 'g'))) = cat.alias_norm
""")
def j11(spark, sf):
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    c = t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    raw = (F.when(F.col("c_acctbal") > 9000, F.lit("unknown place"))
           .when(F.col("c_acctbal") < 0, F.lower("n_name"))
           .when(F.col("c_acctbal") < 1000, F.concat(F.lit(" '"), F.col("n_name"), F.lit("' ")))
           .otherwise(F.replace(F.col("n_name"), F.lit("_"), F.lit("-"))))
    df = c.select("c_custkey", raw.alias("raw_nation"))
    return RL.homologate(df, "raw_nation", nation_catalogue(spark, sf), "nation_clean")


@query("j12_share_of_customer_total", sql="""
SELECT o_orderkey, o_custkey, o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey) AS share
FROM orders
""")
def j12(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return W.share_of_group(o, "o_custkey", "o_totalprice").select(
        "o_orderkey", "o_custkey", F.col("share"))


# -------------------------------------------------------------- aggregates (G)
@query("g01_group_count_avg", sql="""
SELECT p_type, count(*) AS n, avg(p_retailprice) AS avg_price FROM part GROUP BY p_type ORDER BY avg_price DESC
""")
def g01(spark, sf):
    return (t(spark, sf, "part").groupBy("p_type")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("avg_price"))
            .orderBy(F.desc("avg_price")))


def three_key_groupby(spark, sf):
    """3-key group with count, sum, avg, conditional sum and a ratio of aggregates.

    The fact is reduced on narrow keys first (nation key, priority, month number); names and the
    month's text are put to the few groups that are left."""
    o = t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice",
        (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("m"))
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    g = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", "o_orderpriority", "m").agg(
        F.count("o_orderkey").alias("n"), F.sum("o_totalprice").alias("s"), F.count("o_totalprice").alias("k"),
        F.count_if(F.col("o_orderstatus") == FLAG_STATUS).alias("f"))
    month = F.concat_ws("-", F.lpad(F.floor(F.col("m") / 12).cast("string"), 4, "0"),
                        F.lpad((F.col("m") % 12 + 1).cast("string"), 2, "0"))
    named = g.join(nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("n_name").alias("branch"), F.col("o_orderpriority").alias("category"),
        F.when(F.col("m").isNotNull(), month).alias("month"), "n", "s", "k", "f")
    return (named.groupBy("branch", "category", "month")
            .agg(F.sum("n").alias("total_orders"), F.sum("s").alias("revenue"), F.sum("k").alias("_k"),
                 F.sum("f").alias("flagged"))
            .select("branch", "category", "month", "total_orders", "revenue",
                    F.try_divide("revenue", "_k").alias("avg_ticket"), "flagged",
                    F.try_divide("flagged", "total_orders").alias("flag_rate")))


@query("g02_three_key_groupby", sql=f"""
{FACT}
SELECT branch, category, month, count(order_id) AS total_orders, sum(amount) AS revenue,
  avg(amount) AS avg_ticket, CAST(sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
  sum(CASE WHEN status = 'F' THEN 1 ELSE 0 END) / count(order_id) AS flag_rate
FROM fact GROUP BY branch, category, month
""")
def g02(spark, sf):
    return three_key_groupby(spark, sf)


@query("g05_global_aggregates", sql=f"""
SELECT count(*) AS n, {R('sum(l_extendedprice)')} AS total, {R('avg(l_extendedprice)', 6)} AS mean,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM lineitem
""")
def g05(spark, sf):
    return t(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_extendedprice"), 6).alias("mean"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"))


@query("g06_sorted_distinct_set", sql=f"""
SELECT l_suppkey, {R('avg(l_extendedprice)', 4)} AS avg_price, count(*) AS n,
  array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags
FROM lineitem GROUP BY l_suppkey
""")
def g06(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"))


@query("g07_segment_table", sql=f"""
SELECT c_mktsegment, n.n_name, count(*) AS n, CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS positives,
  {R('avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END)', 4)} AS rate, {R('avg(c_acctbal)')} AS mean_balance
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY ALL
""")
def g07(spark, sf):
    c = t(spark, sf, "customer").join(nations(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    neg = F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    return c.groupBy("c_mktsegment", "n_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(neg).cast("long").alias("positives"),
        F.round(F.avg(neg.cast("double")), 4).alias("rate"), F.round(F.avg("c_acctbal"), 2).alias("mean_balance"))


@query("g08_latest_per_key", sql="""
SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, max(ts) AS ts
FROM events GROUP BY user_id
""")
def g08(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts")
    return RL.keep_first(e, "user_id", ["ts", "event_id"], keep="last")


@query("g09_distinct_counts", sql="""
SELECT 'o_custkey' AS column, count(DISTINCT o_custkey) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders
""")
def g09(spark, sf):
    return A.distinct_counts(t(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])


@query("g10_value_counts", sql="""
SELECT o_orderstatus AS value, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share
FROM orders GROUP BY o_orderstatus
""")
def g10(spark, sf):
    return A.value_counts(t(spark, sf, "orders"), "o_orderstatus")


_G11 = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, {R(f'avg({c})', 4)} AS mean, "
    f"{R(f'stddev_samp({c})', 4)} AS std, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


@query("g11_describe", sql=_G11)
def g11(spark, sf):
    d = A.describe_long(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return d.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query("g12_null_census", sql="""
WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT count(*) AS n_rows, 'lang' AS column, count(*) FILTER (WHERE lang IS NULL) AS n_null,
  round(count(*) FILTER (WHERE lang IS NULL) * 100.0 / count(*), 4) AS pct_null FROM j
UNION ALL SELECT count(*), 'quality', count(*) FILTER (WHERE quality IS NULL),
  round(count(*) FILTER (WHERE quality IS NULL) * 100.0 / count(*), 4) FROM j
UNION ALL SELECT count(*), 'toxic', count(*) FILTER (WHERE toxic IS NULL),
  round(count(*) FILTER (WHERE toxic IS NULL) * 100.0 / count(*), 4) FROM j
""")
def g12(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang")
    j = d.join(t(spark, sf, "labels"), "doc_id", "left")
    return A.null_census(j, ["lang", "quality", "toxic"])


@query("g13_absence_census", sql="""
SELECT 'text' AS column, count(*) FILTER (WHERE text IS NULL) AS n_null, count(*) FILTER (WHERE text = '') AS n_empty,
  count(*) FILTER (WHERE regexp_full_match(text, '\\s+')) AS n_blank, count(*) FILTER (WHERE text = '__NULO__') AS n_marker
FROM documents
UNION ALL
SELECT 'lang', count(*) FILTER (WHERE lang IS NULL), count(*) FILTER (WHERE lang = ''),
  count(*) FILTER (WHERE regexp_full_match(lang, '\\s+')), count(*) FILTER (WHERE lang = '__NULO__') FROM documents
""")
def g13(spark, sf):
    return A.absence_census(t(spark, sf, "documents"), ["text", "lang"])


@query("g14_quantiles", sql="""
SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50,
  quantile_cont(l_quantity, 0.75) AS p75, quantile_cont(l_quantity, 0.9) AS p90
FROM lineitem GROUP BY l_returnflag
""")
def g14(spark, sf):
    return A.quantiles(t(spark, sf, "lineitem"), "l_quantity", group_cols=["l_returnflag"])


@query("g15_crosstab", sql="""
SELECT o_orderpriority AS row,
  count(*) FILTER (WHERE o_orderstatus = 'F') * 1.0 / count(*) AS F,
  count(*) FILTER (WHERE o_orderstatus = 'O') * 1.0 / count(*) AS O,
  count(*) FILTER (WHERE o_orderstatus = 'P') * 1.0 / count(*) AS P
FROM orders GROUP BY o_orderpriority
""")
def g15(spark, sf):
    return A.crosstab(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], normalize=True)


@query("g15_crosstab_counts", sql="""
SELECT o_orderpriority AS row, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P
FROM orders GROUP BY o_orderpriority
""")
def g15b(spark, sf):
    return A.crosstab(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("g16_duplicate_counts", sql="""
WITH g AS (SELECT lower(trim(text)) AS k, count(*) AS c FROM documents GROUP BY 1 HAVING count(*) > 1)
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS extra_rows, CAST(coalesce(sum(c), 0) AS BIGINT) AS rows_involved,
  count(*) AS dup_keys FROM g
""")
def g16(spark, sf):
    return A.duplicate_counts(t(spark, sf, "documents"), [F.lower(F.trim("text"))])


@query("g17_near_duplicates", sql="""
SELECT o_custkey, o_orderdate, count(*) AS n, count(DISTINCT o_orderkey) AS n_ids,
  count(DISTINCT o_totalprice) AS n_amounts
FROM orders GROUP BY o_custkey, o_orderdate
HAVING count(DISTINCT o_orderkey) > 1 AND count(DISTINCT o_totalprice) > 1
""")
def g17(spark, sf):
    return A.near_duplicate_groups(t(spark, sf, "orders"), ["o_custkey", "o_orderdate"], "o_orderkey", "o_totalprice")


@query("g18_label_conflicts", sql="""
SELECT d.text AS key, count(DISTINCT l.quality) AS n_labels, count(*) AS n_rows
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.text HAVING count(DISTINCT l.quality) > 1
""")
def g18(spark, sf):
    j = t(spark, sf, "documents").select("doc_id", "text").join(t(spark, sf, "labels"), "doc_id")
    return A.label_conflicts(j, "text", "quality")


@query("g19_rates_with_confounder", sql=f"""
SELECT c.c_mktsegment, o.o_orderpriority, count(*) AS n,
  CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
  {R("avg(CASE WHEN o.o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100")} AS flagged_pct
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL
""")
def g19(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = t(spark, sf, "orders").join(c, "o_custkey")
    f = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return j.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(f).cast("long").alias("flagged"),
        F.round(F.avg(f.cast("double")) * 100, 2).alias("flagged_pct"))


@query("g22_mode", sql="""
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
           WHERE o_orderpriority IS NOT NULL GROUP BY ALL)
SELECT o_orderstatus, arg_min(o_orderpriority, (-n, o_orderpriority)) AS mode FROM c GROUP BY o_orderstatus
""")
def g22(spark, sf):
    return A.mode(t(spark, sf, "orders"), "o_orderpriority", ["o_orderstatus"])


@query("g23_group_profile", sql=f"""
SELECT l_returnflag AS "group", count(*) AS size,
  {R('avg(l_quantity)', 6)} AS mean_l_quantity, {R('avg(l_discount)', 6)} AS mean_l_discount,
  {R('(avg(l_quantity) - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem)', 6)} AS z_l_quantity,
  {R('(avg(l_discount) - (SELECT avg(l_discount) FROM lineitem)) / (SELECT stddev_samp(l_discount) FROM lineitem)', 6)} AS z_l_discount
FROM lineitem GROUP BY l_returnflag
""")
def g23(spark, sf):
    g = A.group_profile(t(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_discount"])
    return g.select("group", "size", *[F.round(c, 6).alias(c) for c in
                                       ("mean_l_quantity", "mean_l_discount", "z_l_quantity", "z_l_discount")])


@query("g24_two_table_group_avg", sql=f"""
SELECT p.p_type, {R('avg(l.l_extendedprice)', 4)} AS avg_price
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type
""")
def g24(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return t(spark, sf, "lineitem").join(p, "l_partkey").groupBy("p_type").agg(
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"))


# ---------------------------------------------------------------- windows (W)
_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]


def dedupe_lineitem(li):
    """Exact key dedupe (keep first), then near dedupe on business columns."""
    first = RL.keep_first(li, ["l_orderkey", "l_linenumber"], _LI_ORDER)
    return RL.keep_first(first, ["l_partkey", "l_suppkey", "l_quantity"],
                         ["l_shipdate", "l_orderkey", "l_linenumber"])


@query("w02_dedupe_exact_then_near", sql="""
WITH a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem),
b AS (SELECT * EXCLUDE (rn) FROM a WHERE rn = 1),
c AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_quantity
             ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM c WHERE rn = 1
""")
def w02(spark, sf):
    return dedupe_lineitem(t(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", "l_partkey",
                                                            "l_extendedprice")


@query("w04_moving_range", sql="""
SELECT event_id, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS moving_range
FROM events
""")
def w04(spark, sf):
    from cauce.operators.windows import moving_range
    e = t(spark, sf, "events")
    return moving_range(e, ["ts", "event_id"], "value", part=["user_id"]).select("event_id", "moving_range")


@query("w05_lorenz_levels", sql="""
WITH k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY 1),
lv AS (SELECT cnt, count(*) AS n_keys FROM k GROUP BY cnt)
SELECT cnt, n_keys, sum(n_keys) OVER (ORDER BY cnt DESC) AS cum_keys,
  sum(cnt * n_keys) OVER (ORDER BY cnt DESC) AS cum_rows,
  sum(n_keys) OVER (ORDER BY cnt DESC) / (SELECT sum(n_keys) FROM lv) AS cum_key_share,
  sum(cnt * n_keys) OVER (ORDER BY cnt DESC) / (SELECT sum(cnt * n_keys) FROM lv) AS cum_row_share
FROM lv
""")
def w05(spark, sf):
    return W.lorenz_levels(t(spark, sf, "orders"), "o_custkey")


@query("w07_first_n_per_group", sql="""
SELECT event_id, user_id, rn FROM (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= 3
""")
def w07(spark, sf):
    e = t(spark, sf, "events").select("event_id", "user_id", "ts")
    return RL.top_n_per_group(e, "user_id", ["ts", "event_id"], 3).select("event_id", "user_id", "rn")


@query("w09_share_of_month", sql=f"""
{FACT},
m AS (SELECT month, branch, sum(amount) AS revenue FROM fact GROUP BY ALL)
SELECT month, branch, {R('revenue / sum(revenue) OVER (PARTITION BY month)', 6)} AS share FROM m
""")
def w09(spark, sf):
    m = order_fact(spark, sf).groupBy("month", "branch").agg(F.sum("amount").alias("revenue"))
    return W.share_of_group(m, "month", "revenue").select("month", "branch", F.round("share", 6).alias("share"))


# ------------------------------------------------------------ sort / limit (L)
@query("l01_multi_key_sort", sql="""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey
""")
def l01(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice") \
        .orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("l02_top_k", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def l02(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_totalprice") \
        .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


# ------------------------------------------------------------ set operations (U)
@query("u01_union_aligned", sql="""
SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
""")
def u01(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"),
                                        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                        F.lit("customer").alias("kind"))
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"),
                                        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                                        F.lit("supplier").alias("kind"))
    return RL.union_aligned([c, s])


@query("l03_first_rows_display", sql="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20
""")
def l03(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice") \
        .orderBy("o_orderdate", "o_orderkey").limit(20)


@query("p06_numeric_projection", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def p06(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select(RL.numeric_columns(li))


@query("p08_conform_contract", sql="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, upper(o_orderstatus) AS status, o_totalprice AS amount
FROM orders
""")
def p08(spark, sf):
    return RL.conform(t(spark, sf, "orders"), {"order_id": "o_orderkey", "customer_id": "o_custkey",
                                               "status": F.upper("o_orderstatus"), "amount": "o_totalprice"})


@query("j04_asof_rate_in_force", sql="""
WITH r AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT e.event_id, r.value AS last_purchase
FROM events e ASOF LEFT JOIN r ON e.user_id = r.user_id AND e.ts >= r.ts
""")
def j04_asof(spark, sf):
    """Value in force (the user's latest purchase up to and including each event)."""
    e = t(spark, sf, "events")
    rates = e.filter(F.col("event_type") == "purchase").select("user_id", "ts", "value")
    ev = e.select("event_id", "user_id", "ts")
    return RL.asof_lookup(ev, rates, "user_id", "ts", "ts", "value", "last_purchase").select("event_id", "last_purchase")
