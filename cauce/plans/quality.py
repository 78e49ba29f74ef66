"""Contracts for the driver tables and the validation/quality queries (V*, G21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.functions.dates import month_key
from cauce.operators.contracts import ColumnContract as C
from cauce.operators.contracts import TableContract, apply_contract, split_by_contract, to_quarantine
from cauce.operators.quality import (against_expected, idempotency, join_loss, quality_gate, reason_histogram,
                                     reconcile, completeness)
from cauce.operators.windows import top_share
from cauce.plans.facts import t
from cauce.plans.registry import query
from cauce.plans.reports import reasons_by_period
from cauce.plans.sqlfrag import R

# ------------------------------------------------------------------ contracts
# Fixed values of the driver-table contracts.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ORDER_STATUSES = ("F", "O", "P")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
RETURN_FLAGS = ("A", "N", "R")
ORDER_DATE_MAX = "2001-06-30"
BATCH_ID = "batch-0001"
RUN_TS = "2024-01-01 00:00:00"

CUSTOMER = TableContract("customer", (
    C("c_custkey", dtype="long", nullable=False),
    C("c_name", nullable=False, regex=r"Customer#[0-9]{9}"),
    C("c_nationkey", dtype="int", nullable=False, fk="nation"),
    C("c_acctbal", dtype="double", nullable=False, min=-500.0, max=9999.99),
    C("c_mktsegment", nullable=False, values=SEGMENTS),
), primary_key=("c_custkey",))

ORDERS = TableContract("orders", (
    C("o_orderkey", dtype="long", nullable=False),
    C("o_custkey", dtype="long", nullable=False, fk="customer"),
    C("o_orderstatus", nullable=False, values=ORDER_STATUSES),
    C("o_totalprice", dtype="double", nullable=False, negative=True, sentinel_above=450000.0),
    C("o_orderdate", nullable=False),
    C("o_orderpriority", nullable=False, regex=r"[1-5]-[A-Z ]+"),
), primary_key=("o_orderkey",), rules=(
    # callables: Columns are built at compile time, so importing needs no SparkContext
    ("o_orderdate_out_of_range", lambda: F.col("o_orderdate") > F.lit(ORDER_DATE_MAX).cast("timestamp_ntz")),
    ("pending_high_amount", lambda: (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)),
))

PART = TableContract("part", (
    C("p_partkey", dtype="long", nullable=False),
    C("p_brand", nullable=False, regex=r"Brand#[0-9]{1,2}"),
    C("p_type", nullable=False, values=PART_TYPES),
    C("p_size", dtype="int", nullable=False, min=1, max=45, multiple_of=1),
    C("p_retailprice", dtype="double", nullable=False, min=905.0, max=995.0),
), primary_key=("p_partkey",))

LINEITEM = TableContract("lineitem", (
    C("l_orderkey", dtype="long", nullable=False, fk="orders"),
    C("l_quantity", dtype="double", nullable=False, min=1, max=48),
    C("l_extendedprice", dtype="double", nullable=False, min=1000.0),
    C("l_discount", dtype="double", nullable=False, min=0.0, max=0.09),
    C("l_returnflag", nullable=False, values=RETURN_FLAGS),
), primary_key=("l_orderkey", "l_linenumber"))


def customer_checked(spark, sf):
    n = t(spark, sf, "nation").select("n_nationkey")
    return apply_contract(t(spark, sf, "customer"), CUSTOMER, {"c_nationkey": n})


def valid_customers(spark, sf):
    return customer_checked(spark, sf).filter(F.size("reject_reasons") == 0)


def orders_checked(spark, sf):
    vc = valid_customers(spark, sf).select("c_custkey")
    return apply_contract(t(spark, sf, "orders"), ORDERS, {"o_custkey": vc})


# SQL twins of the contracts (hand-written oracles).
CUSTOMER_SQL = """
cust_chk AS (
  SELECT c.*, concat_ws(';',
    CASE WHEN c.c_custkey IS NULL THEN 'c_custkey_null' END,
    CASE WHEN c.c_name IS NULL OR trim(c.c_name) = '' THEN 'c_name_null' END,
    CASE WHEN c.c_name IS NOT NULL AND NOT regexp_full_match(c.c_name, 'Customer#[0-9]{9}')
         THEN 'c_name_invalid_format' END,
    CASE WHEN c.c_nationkey IS NULL THEN 'c_nationkey_null' END,
    CASE WHEN c.c_nationkey IS NOT NULL AND n.n_nationkey IS NULL THEN 'c_nationkey_not_found' END,
    CASE WHEN c.c_acctbal IS NULL THEN 'c_acctbal_null' END,
    CASE WHEN c.c_acctbal < -500.0 OR c.c_acctbal > 9999.99 THEN 'c_acctbal_out_of_range' END,
    CASE WHEN c.c_mktsegment IS NULL OR trim(c.c_mktsegment) = '' THEN 'c_mktsegment_null' END,
    CASE WHEN c.c_mktsegment NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')
         THEN 'c_mktsegment_invalid_value' END) AS reject_reason
  FROM customer c LEFT JOIN (SELECT DISTINCT n_nationkey FROM nation) n ON c.c_nationkey = n.n_nationkey
),
valid_cust AS (SELECT DISTINCT c_custkey FROM cust_chk WHERE reject_reason = '')"""

ORDERS_SQL = CUSTOMER_SQL + """,
ord_chk AS (
  SELECT o.*, concat_ws(';',
    CASE WHEN o.o_orderkey IS NULL THEN 'o_orderkey_null' END,
    CASE WHEN o.o_custkey IS NULL THEN 'o_custkey_null' END,
    CASE WHEN o.o_custkey IS NOT NULL AND v.c_custkey IS NULL THEN 'o_custkey_not_found' END,
    CASE WHEN o.o_orderstatus IS NULL OR trim(o.o_orderstatus) = '' THEN 'o_orderstatus_null' END,
    CASE WHEN o.o_orderstatus NOT IN ('F','O','P') THEN 'o_orderstatus_invalid_value' END,
    CASE WHEN o.o_totalprice IS NULL THEN 'o_totalprice_null' END,
    CASE WHEN o.o_totalprice < 0 THEN 'o_totalprice_negative' END,
    CASE WHEN o.o_totalprice > 450000.0 THEN 'o_totalprice_sentinel' END,
    CASE WHEN o.o_orderdate IS NULL THEN 'o_orderdate_null' END,
    CASE WHEN o.o_orderpriority IS NULL OR trim(o.o_orderpriority) = '' THEN 'o_orderpriority_null' END,
    CASE WHEN o.o_orderpriority IS NOT NULL AND NOT regexp_full_match(o.o_orderpriority, '[1-5]-[A-Z ]+')
         THEN 'o_orderpriority_invalid_format' END,
    CASE WHEN o.o_orderdate > TIMESTAMP '2001-06-30' THEN 'o_orderdate_out_of_range' END,
    CASE WHEN o.o_orderstatus = 'P' AND o.o_totalprice > 400000 THEN 'pending_high_amount' END
  ) AS reject_reason
  FROM orders o LEFT JOIN valid_cust v ON o.o_custkey = v.c_custkey
)"""


@query("v02_customer_contract", sql=f"""
WITH {CUSTOMER_SQL}
SELECT c_custkey, reject_reason FROM cust_chk
""")
def v02(spark, sf):
    return customer_checked(spark, sf).select("c_custkey", "reject_reason")


@query("v03_order_contract", sql=f"""
WITH {ORDERS_SQL}
SELECT o_orderkey, reject_reason FROM ord_chk
""")
def v03(spark, sf):
    return orders_checked(spark, sf).select("o_orderkey", "reject_reason")


@query("v04_part_contract", sql="""
SELECT p_partkey, concat_ws(';',
  CASE WHEN p_partkey IS NULL THEN 'p_partkey_null' END,
  CASE WHEN p_brand IS NULL OR trim(p_brand) = '' THEN 'p_brand_null' END,
  CASE WHEN p_brand IS NOT NULL AND NOT regexp_full_match(p_brand, 'Brand#[0-9]{1,2}') THEN 'p_brand_invalid_format' END,
  CASE WHEN p_type IS NULL OR trim(p_type) = '' THEN 'p_type_null' END,
  CASE WHEN p_type NOT IN ('ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD') THEN 'p_type_invalid_value' END,
  CASE WHEN p_size IS NULL THEN 'p_size_null' END,
  CASE WHEN p_size < 1 OR p_size > 45 THEN 'p_size_out_of_range' END,
  CASE WHEN p_retailprice IS NULL THEN 'p_retailprice_null' END,
  CASE WHEN p_retailprice < 905.0 OR p_retailprice > 995.0 THEN 'p_retailprice_out_of_range' END
) AS reject_reason FROM part
""")
def v04(spark, sf):
    return apply_contract(t(spark, sf, "part"), PART).select("p_partkey", "reject_reason")


@query("v05_lineitem_contract", sql="""
SELECT l.l_orderkey, l.l_linenumber, concat_ws(';',
  CASE WHEN l.l_orderkey IS NULL THEN 'l_orderkey_null' END,
  CASE WHEN l.l_orderkey IS NOT NULL AND o.o_orderkey IS NULL THEN 'l_orderkey_not_found' END,
  CASE WHEN l.l_quantity IS NULL THEN 'l_quantity_null' END,
  CASE WHEN l.l_quantity < 1 OR l.l_quantity > 48 THEN 'l_quantity_out_of_range' END,
  CASE WHEN l.l_extendedprice IS NULL THEN 'l_extendedprice_null' END,
  CASE WHEN l.l_extendedprice < 1000.0 THEN 'l_extendedprice_out_of_range' END,
  CASE WHEN l.l_discount IS NULL THEN 'l_discount_null' END,
  CASE WHEN l.l_discount < 0.0 OR l.l_discount > 0.09 THEN 'l_discount_out_of_range' END,
  CASE WHEN l.l_returnflag IS NULL OR trim(l.l_returnflag) = '' THEN 'l_returnflag_null' END,
  CASE WHEN l.l_returnflag NOT IN ('A','N','R') THEN 'l_returnflag_invalid_value' END
) AS reject_reason
FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) o ON l.l_orderkey = o.o_orderkey
""")
def v05(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey")
    return apply_contract(t(spark, sf, "lineitem"), LINEITEM, {"l_orderkey": o}) \
        .select("l_orderkey", "l_linenumber", "reject_reason")


@query("v09_quarantine_union", sql=f"""
WITH {ORDERS_SQL}
SELECT 'orders' AS source, CAST(NULL AS VARCHAR) AS run_id, '{BATCH_ID}' AS batch_id,
       CAST(o_orderkey AS VARCHAR) AS record_id, reject_reason, TIMESTAMP '{RUN_TS}' AS ingested_at
FROM ord_chk WHERE reject_reason != ''
UNION ALL
SELECT 'customer', NULL, '{BATCH_ID}', CAST(c_custkey AS VARCHAR), reject_reason, TIMESTAMP '{RUN_TS}'
FROM cust_chk WHERE reject_reason != ''
""")
def v09(spark, sf):
    bad_o = orders_checked(spark, sf).filter(F.size("reject_reasons") > 0)
    bad_c = customer_checked(spark, sf).filter(F.size("reject_reasons") > 0)
    q1 = to_quarantine(bad_o, "orders", BATCH_ID, F.col("o_orderkey"), RUN_TS)
    q2 = to_quarantine(bad_c, "customer", BATCH_ID, F.col("c_custkey"), RUN_TS)
    return q1.unionByName(q2).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query("g21_reasons_by_month", sql=f"""
WITH {ORDERS_SQL},
r AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, trim(unnest(string_split(reject_reason, ';'))) AS reason
      FROM ord_chk WHERE reject_reason != ''),
c AS (SELECT period, reason, count(*) AS n FROM r WHERE reason != '' GROUP BY period, reason),
tt AS (SELECT period, CAST(sum(n) AS BIGINT) AS period_total FROM c GROUP BY period)
SELECT c.period, c.reason, c.n, tt.period_total, {R('c.n * 1.0 / tt.period_total * 100')} AS share_pct,
  CASE WHEN c.n * 1.0 / tt.period_total >= 0.30 THEN '██████████'
       WHEN c.n * 1.0 / tt.period_total >= 0.20 THEN '████████'
       WHEN c.n * 1.0 / tt.period_total >= 0.10 THEN '██████'
       WHEN c.n * 1.0 / tt.period_total >= 0.05 THEN '████' ELSE '██' END AS bar
FROM c JOIN tt ON c.period = tt.period
""")
def g21(spark, sf):
    q = orders_checked(spark, sf).filter(F.size("reject_reasons") > 0) \
        .withColumn("period", month_key("o_orderdate"))
    return reasons_by_period(q)


@query("v15_reason_histogram", sql=f"""
WITH {ORDERS_SQL},
r AS (SELECT unnest(string_split(reject_reason, ';')) AS reason FROM ord_chk),
f AS (SELECT reason FROM r WHERE reason != '')
SELECT reason, count(*) AS n, {R('count(*) * 100.0 / (SELECT count(*) FROM f)')} AS share_pct
FROM f GROUP BY reason
""")
def v15(spark, sf):
    return reason_histogram(orders_checked(spark, sf))


def _fact_for_reconcile(spark, sf):
    """Valid orders enriched with customer segment and nation (left joins)."""
    valid = orders_checked(spark, sf).filter(F.size("reject_reasons") == 0)
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    return valid.join(c, valid.o_custkey == c.c_custkey, "left") \
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")


RECON_SQL = ORDERS_SQL + """,
vf AS (SELECT o.*, c.c_nationkey, n.n_name FROM ord_chk o
       LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.reject_reason = '')"""


@query("v10_reconcile", sql=f"""
WITH {RECON_SQL}
SELECT count(*) AS rows_after, count(*) - count(DISTINCT o_orderkey) AS duplicate_keys,
  count(*) FILTER (WHERE n_name IS NOT NULL) AS matched_n_name,
  count(*) FILTER (WHERE n_name IS NULL) AS unmatched_n_name,
  count(DISTINCT o_custkey) AS distinct_o_custkey, count(DISTINCT o_orderpriority) AS distinct_o_orderpriority,
  {R('sum(o_totalprice)')} AS total_o_totalprice, {R('avg(o_totalprice)')} AS avg_o_totalprice,
  (SELECT count(*) FROM orders) AS rows_before
FROM vf
""")
def v10(spark, sf):
    before = t(spark, sf, "orders").agg(F.count(F.lit(1))).scalar()
    return reconcile(_fact_for_reconcile(spark, sf), "o_orderkey", lookups=("n_name",),
                     amount="o_totalprice", distinct_cols=("o_custkey", "o_orderpriority"),
                     rows_before=before)


# Fixed gate thresholds of the order load.
GATE = {
    "completeness": ("min", 0.98),
    "duplicate_rate": ("max", 0.0),
    "unmatched_rate": ("max", 0.05),
    "reject_rate": ("max", 0.25),
    "rows": ("min", 1),
}


@query("v11_quality_gate", sql=f"""
WITH {RECON_SQL},
m AS (SELECT
  (SELECT count(*) FROM vf) AS rows,
  (SELECT count(*) FILTER (WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND n_name IS NOT NULL)
     * 1.0 / count(*) FROM vf) AS completeness,
  (SELECT (count(*) - count(DISTINCT o_orderkey)) * 1.0 / count(*) FROM vf) AS duplicate_rate,
  (SELECT count(*) FILTER (WHERE n_name IS NULL) * 1.0 / count(*) FROM vf) AS unmatched_rate,
  (SELECT count(*) FILTER (WHERE reject_reason != '') * 1.0 / count(*) FROM ord_chk) AS reject_rate),
f AS (SELECT *, list_filter([
   CASE WHEN completeness IS NULL OR completeness < 0.98 THEN 'completeness' END,
   CASE WHEN duplicate_rate IS NULL OR duplicate_rate > 0.0 THEN 'duplicate_rate' END,
   CASE WHEN unmatched_rate IS NULL OR unmatched_rate > 0.05 THEN 'unmatched_rate' END,
   CASE WHEN reject_rate IS NULL OR reject_rate > 0.25 THEN 'reject_rate' END,
   CASE WHEN rows IS NULL OR rows < 1 THEN 'rows' END], lambda x: x IS NOT NULL) AS fl FROM m)
SELECT rows, {R('completeness', 6)} AS completeness, {R('duplicate_rate', 6)} AS duplicate_rate,
  {R('unmatched_rate', 6)} AS unmatched_rate, {R('reject_rate', 6)} AS reject_rate,
  CASE WHEN rows = 0 THEN [] ELSE fl END AS failures,
  array_to_string(CASE WHEN rows = 0 THEN [] ELSE fl END, ';') AS failed_checks,
  CASE WHEN rows = 0 OR len(fl) = 0 THEN 'PASS' ELSE 'FAIL' END AS quality_status
FROM f
""")
def v11(spark, sf):
    vf = _fact_for_reconcile(spark, sf)
    checked = orders_checked(spark, sf)
    reject_rate = checked.agg(F.try_divide(F.count_if(F.size("reject_reasons") > 0).cast("double"),
                                           F.count(F.lit(1)))).scalar()
    m = vf.agg(F.count(F.lit(1)).alias("rows"),
               completeness(vf, ["o_orderkey", "o_custkey", "n_name"]).alias("completeness"),
               F.try_divide((F.count(F.lit(1)) - F.count_distinct("o_orderkey")).cast("double"),
                            F.count(F.lit(1))).alias("duplicate_rate"),
               F.try_divide(F.count_if(F.col("n_name").isNull()).cast("double"),
                            F.count(F.lit(1))).alias("unmatched_rate")) \
        .withColumn("reject_rate", reject_rate)
    g = quality_gate(m, GATE)
    return g.select("rows", *[F.round(c, 6).alias(c) for c in
                              ("completeness", "duplicate_rate", "unmatched_rate", "reject_rate")],
                    "failures", "failed_checks", "quality_status")


@query("v14_idempotency_summary", sql="""
SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem
""")
def v14(spark, sf):
    return idempotency(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])[0]


@query("v14_duplicated_keys", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 5
""")
def v14b(spark, sf):
    return idempotency(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])[1]


@query("v16_defect_census", sql="""
WITH d AS (
  SELECT o.*, c.c_custkey AS parent,
         count(*) OVER (PARTITION BY o.o_custkey, o.o_orderdate, o.o_totalprice) AS same_n
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT
  count(*) FILTER (WHERE parent IS NULL) AS d1_orphan_fk,
  count(*) FILTER (WHERE o_totalprice < 0 OR o_totalprice > 450000.0) AS d2_invalid_amount,
  count(*) FILTER (WHERE o_totalprice IS NULL OR o_orderpriority IS NULL) AS d3_relevant_null,
  count(*) FILTER (WHERE same_n > 1) AS d4_duplicates,
  count(*) FILTER (WHERE o_orderpriority != upper(trim(o_orderpriority))) AS d5_spelling,
  count(*) FILTER (WHERE NOT regexp_full_match(o_orderpriority, '[1-5]-[A-Z ]+')) AS d6_format,
  count(*) FILTER (WHERE o_orderstatus = 'P' AND o_totalprice > 400000) AS d7_impossible
FROM d
""")
def v16(spark, sf):
    o = t(spark, sf, "orders")
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("parent")).distinct()
    dup = o.groupBy("o_custkey", "o_orderdate", "o_totalprice").agg(F.count(F.lit(1)).alias("same_n"))
    d = o.join(c, o.o_custkey == c.parent, "left") \
        .join(dup, ["o_custkey", "o_orderdate", "o_totalprice"], "left")
    return d.agg(
        F.count_if(F.col("parent").isNull()).alias("d1_orphan_fk"),
        F.count_if((F.col("o_totalprice") < 0) | (F.col("o_totalprice") > 450000.0)).alias("d2_invalid_amount"),
        F.count_if(F.col("o_totalprice").isNull() | F.col("o_orderpriority").isNull()).alias("d3_relevant_null"),
        F.count_if(F.col("same_n") > 1).alias("d4_duplicates"),
        F.count_if(F.col("o_orderpriority") != F.upper(F.trim("o_orderpriority"))).alias("d5_spelling"),
        F.count_if(~F.col("o_orderpriority").rlike(r"^(?:[1-5]-[A-Z ]+)$")).alias("d6_format"),
        F.count_if((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)).alias("d7_impossible"))


@query("v16_defects_expected", sql="""
SELECT 'd1_orphan_fk' AS "check", count(*) AS found, count(*) AS expected, true AS ok FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'd2_invalid_amount', count(*), count(*), true FROM orders WHERE o_totalprice < 0 OR o_totalprice > 450000.0
UNION ALL SELECT 'd3_relevant_null', count(*), count(*), true FROM orders WHERE o_totalprice IS NULL OR o_orderpriority IS NULL
UNION ALL SELECT 'd4_duplicates', coalesce(sum(n), 0)::BIGINT, coalesce(sum(n), 0)::BIGINT, true
  FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate, o_totalprice HAVING count(*) > 1)
UNION ALL SELECT 'd5_spelling', count(*), count(*), true FROM orders WHERE o_orderpriority != upper(trim(o_orderpriority))
UNION ALL SELECT 'd6_format', count(*), count(*), true FROM orders WHERE NOT regexp_full_match(o_orderpriority, '[1-5]-[A-Z ]+')
UNION ALL SELECT 'd7_impossible', count(*), -1, false FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000
UNION ALL SELECT 'd8_not_measured', NULL, 0, false
""")
def v16b(spark, sf):
    """The census against counts that come from other operators (anti-join, grouping, filters); the last two must differ."""
    o = t(spark, sf, "orders")
    orphans = o.join(t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").count()
    copies = o.groupBy("o_custkey", "o_orderdate", "o_totalprice").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = [("d1_orphan_fk", orphans), ("d2_invalid_amount", o.filter("o_totalprice < 0 or o_totalprice > 450000.0").count()),
            ("d3_relevant_null", o.filter("o_totalprice is null or o_orderpriority is null").count()),
            ("d4_duplicates", copies.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]),
            ("d5_spelling", o.filter("o_orderpriority <> upper(trim(o_orderpriority))").count()),
            ("d6_format", o.filter(~F.col("o_orderpriority").rlike("^(?:[1-5]-[A-Z ]+)$")).count()), ("d7_impossible", -1), ("d8_not_measured", 0)]
    return against_expected(v16(spark, sf), spark.createDataFrame(rows, "check string, expected long"))


@query("v17_join_loss", sql="""
SELECT 'lineitem_orders' AS step, count(*) AS rows_lost FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'orders_customer', count(*) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'orders_valid_customer', count(*) FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= -500.0)
""")
def v17(spark, sf):
    li, o, c = t(spark, sf, "lineitem"), t(spark, sf, "orders"), t(spark, sf, "customer")
    return join_loss([
        ("lineitem_orders", li, o.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"]),
        ("orders_customer", o, c.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]),
        ("orders_valid_customer", o,
         c.filter(F.col("c_acctbal") >= -500.0).withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"]),
    ])


@query("v20_concentration_check", sql="""
WITH k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey),
r AS (SELECT cnt, row_number() OVER (ORDER BY cnt DESC, o_custkey) AS rn FROM k),
n AS (SELECT count(*) AS total_keys, sum(cnt) AS total_rows, max(cnt) AS mx, min(cnt) AS mn FROM k)
SELECT CAST(n.total_rows AS BIGINT) AS total_rows, n.total_keys,
  CAST((SELECT sum(cnt) FROM r WHERE rn <= floor(n.total_keys * 0.3)) AS BIGINT) AS top_rows,
  n.mx AS max_per_key, n.mn AS min_per_key, CAST(floor(n.total_keys * 0.3) AS BIGINT) AS top_keys,
  {share} AS top_share, {mean} AS mean_per_key,
  {share} BETWEEN 0.65 AND 0.75 AS accepted
FROM n
""".format(share=R("(SELECT sum(cnt) FROM r WHERE rn <= floor(n.total_keys * 0.3)) * 1.0 / n.total_rows", 6),
           mean=R("n.total_rows * 1.0 / n.total_keys", 6)))
def v20(spark, sf):
    s = top_share(t(spark, sf, "orders"), "o_custkey", 0.3)
    return s.withColumn("top_share", F.round("top_share", 6)) \
        .withColumn("mean_per_key", F.round("mean_per_key", 6)) \
        .withColumn("accepted", F.col("top_share").between(0.65, 0.75))


# ------------------------------------------------------- post-load checks
@query("v12_post_load_assertions", sql="""
WITH f AS (SELECT o.* FROM orders o)
SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys,
  count(*) FILTER (WHERE o_totalprice <= 0) AS non_positive_amount,
  count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1990-01-01' OR o_orderdate > TIMESTAMP '2030-12-31') AS date_out_of_range,
  count(*) - count(DISTINCT o_orderkey) AS duplicate_keys
FROM f
""")
def v12(spark, sf):
    from cauce.operators.quality import violation_counts
    o = t(spark, sf, "orders")
    counts = violation_counts(o, {
        "null_keys": F.col("o_orderkey").isNull(),
        "non_positive_amount": F.col("o_totalprice") <= 0,
        "date_out_of_range": (F.col("o_orderdate") < F.lit("1990-01-01").cast("timestamp_ntz"))
        | (F.col("o_orderdate") > F.lit("2030-12-31").cast("timestamp_ntz"))})
    dup = o.agg(F.count(F.lit(1)) - F.count_distinct("o_orderkey")).scalar()
    return counts.withColumn("duplicate_keys", dup)


@query("v13_source_equals_curated_plus_quarantine", sql=f"""
WITH {ORDERS_SQL}
SELECT (SELECT count(*) FROM orders) AS source_rows,
  count(*) FILTER (WHERE reject_reason = '') AS curated_rows,
  count(*) FILTER (WHERE reject_reason != '') AS quarantined_rows,
  (SELECT count(*) FROM orders) = count(*) AS balanced,
  count(*) FILTER (WHERE contains(CAST(o_orderstatus AS VARCHAR), '''')) AS dirty_quotes
FROM ord_chk
""")
def v13(spark, sf):
    chk = orders_checked(spark, sf)
    src = t(spark, sf, "orders").agg(F.count(F.lit(1))).scalar()
    return chk.agg(F.count_if(F.size("reject_reasons") == 0).alias("curated_rows"),
                   F.count_if(F.size("reject_reasons") > 0).alias("quarantined_rows"),
                   (F.count(F.lit(1)) == src).alias("balanced"),
                   F.count_if(F.col("o_orderstatus").contains("'")).alias("dirty_quotes")) \
        .withColumn("source_rows", src)


@query("v19_latest_run_report", sql=f"""
WITH {ORDERS_SQL}
SELECT 'run-2' AS run_id, 'SUCCESS' AS status, count(*) AS source_rows, count(*) FILTER (WHERE reject_reason = '') AS valid_rows,
  count(*) FILTER (WHERE reject_reason != '') AS quarantined,
  round(count(*) FILTER (WHERE reject_reason != '') * 1.0 / count(*), 9) AS reject_rate
FROM ord_chk WHERE o_orderdate > TIMESTAMP '1998-01-01'
""")
def v19(spark, sf):
    """Latest audited run with its reject rate: the second of two loads, the first of which saw older orders only."""
    import uuid as _uuid
    from cauce.plans.jobs import governed_etl
    from cauce.session import scratch_path
    from cauce.sources import state
    base = scratch_path(spark, f"v19-{_uuid.uuid4().hex}")
    old = t(spark, sf, "orders").filter("o_orderdate <= TIMESTAMP '1998-01-01'")
    governed_etl(spark, sf, base, run_id="run-1", source=old)
    # the second run's window opens at the end of the first one's
    state.write_watermark(spark, f"{base}/watermark", "1998-01-01 00:00:00")
    governed_etl(spark, sf, base, run_id="run-2")
    runs = state.newest(state.read_table(spark, f"{base}/etl_runs"), "finished_at", 1)
    n = lambda c: F.col(c).cast("long").alias(c)
    return runs.select("run_id", "status", n("source_rows"), n("valid_rows"), n("quarantined"),
                       F.round(F.try_divide(F.col("quarantined").cast("double"), F.col("source_rows").cast("double")), 9).alias("reject_rate"))
