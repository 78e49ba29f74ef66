"""End-to-end jobs (Z01-Z12) composed from the operators.

Jobs write only under the shared folder named by ``spark.checkpoint.dir``
(a fresh sub-folder per run); loads are versioned, so a killed run leaves the
previous version in place and a rerun repeats the same result.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from cauce.functions.dates import date_parts
from cauce.operators import aggregates as A
from cauce.operators import quality as Q
from cauce.operators import relational as RL
from cauce.operators.contracts import apply_contract, to_quarantine
from cauce.plans.facts import t
from cauce.plans.quality import CUSTOMER, ORDERS, ORDERS_SQL
from cauce.plans.registry import query
from cauce.plans.sqlfrag import R
from cauce.session import scratch_path
from cauce.sources import periods, sinks, state

# Fixed values of the governed load.
STATUS_SUCCESS, STATUS_EMPTY, STATUS_GATE, STATUS_FAIL = "SUCCESS", "SUCCESS_EMPTY", "FAILED_QUALITY_GATE", "FAIL"
DEFAULT_MARK = "1990-01-01 00:00:00"
Z01_GATE = {"completeness": ("min", 0.98), "duplicate_rate": ("max", 0.0),
            "unmatched_rate": ("max", 0.05), "reject_rate": ("max", 0.25)}


def _run_dir(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def governed_etl(spark, sf: str, base: str, run_id: str | None = None, gate=Z01_GATE,
                 mark_from: str = "staged", source=None) -> dict:
    """Incremental, validated, gated, idempotent load with an audit row per run.

    Statuses: SUCCESS, SUCCESS_EMPTY (nothing newer than the mark),
    FAILED_QUALITY_GATE (nothing loaded, mark unchanged), FAIL (error).
    The mark is written last, from staged rows by default (so trailing
    rejects are not re-read every run) or from loaded rows.
    """
    run_id = run_id or uuid.uuid4().hex
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    mark_path, fact_path = f"{base}/watermark", f"{base}/fact"
    q_path, audit_path = f"{base}/quarantine", f"{base}/etl_runs"
    run = {"run_id": run_id, "started_at": str(started), "status": STATUS_FAIL, "error_message": None}
    cached = []
    try:
        wm = state.read_watermark(spark, mark_path, default=DEFAULT_MARK)
        run["watermark_before"] = wm
        src = state.incremental_scan(t(spark, sf, "orders") if source is None else source, "o_orderdate", wm)
        # the upper mark is fixed once, before anything is loaded: rows that arrive during the run lie
        # above it and belong to the next run
        seen = src.agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("upper"),
                       F.max("o_orderdate").cast("string").alias("mark")).first()
        n_src = seen["n"]
        src = src.filter(F.col("o_orderdate") <= F.lit(seen["upper"]))
        run["source_rows"] = n_src
        if n_src == 0:
            run.update(status=STATUS_EMPTY, watermark_after=wm)
            return run
        staged = RL.with_provenance(src, "orders_db", f"batch-{run_id[:8]}", run_id, started)
        nat = t(spark, sf, "nation").select("n_nationkey")
        customers = apply_contract(t(spark, sf, "customer"), CUSTOMER, {"c_nationkey": nat})
        # read twice (FK parents and enrichment): cached for the job, released in finally
        valid_c = customers.filter(F.size("reject_reasons") == 0) \
            .select("c_custkey", "c_mktsegment", "c_nationkey").persist()
        cached.append(valid_c)
        checked = apply_contract(staged, ORDERS, {"o_custkey": valid_c.select("c_custkey")}).persist()
        cached.append(checked)
        valid = checked.filter(F.size("reject_reasons") == 0)
        # transform: derived columns, then exact and near de-duplication (keep first)
        valid = valid.withColumns(date_parts("o_orderdate", "order"))
        valid = RL.keep_first(valid, ["o_orderkey"], ["o_orderdate", "o_totalprice"])
        valid = RL.keep_first(valid, ["o_custkey", "o_orderdate", "o_totalprice"], ["o_orderkey"])
        # integrate: customer segment and nation name (left joins keep every fact row)
        cust = valid_c.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
        names = RL.sized_broadcast(t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                                                  F.col("n_name").alias("branch")), 1000,
                                   cache_key=(sf, "nation"))
        fact = valid.join(cust, "o_custkey", "left").join(names, "c_nationkey", "left").persist()
        cached.append(fact)
        metrics = fact.agg(
            F.count(F.lit(1)).alias("rows"),
            Q.completeness(fact, ["o_orderkey", "o_custkey", "branch"]).alias("completeness"),
            F.try_divide((F.count(F.lit(1)) - F.count_distinct("o_orderkey")).cast("double"),
                         F.count(F.lit(1))).alias("duplicate_rate"),
            F.try_divide(F.count_if(F.col("branch").isNull()).cast("double"), F.count(F.lit(1))).alias("unmatched_rate"))
        reject_rate = checked.agg(F.try_divide(F.count_if(F.size("reject_reasons") > 0).cast("double"),
                                               F.count(F.lit(1)))).scalar()
        outcome = Q.gate_outcome(Q.quality_gate(metrics.withColumn("reject_rate", reject_rate), gate))
        run["quality_status"] = outcome["status"]
        if outcome["status"] != "PASS":
            run.update(status=STATUS_GATE, error_message=";".join(outcome["failures"]), watermark_after=wm)
            return run
        load = fact.select("o_orderkey", "o_custkey", "branch", "c_mktsegment", "o_orderstatus", "o_totalprice",
                           "o_orderdate", "order_month", "order_day_of_week", "run_id", "batch_id", "ingested_at")
        # only the months that this load changes are written anew
        ins, upd = periods.upsert_periods(spark, fact_path, load, "o_orderkey", periods.month_of("o_orderdate"))
        bad = checked.filter(F.size("reject_reasons") > 0)
        quarantined = state.append_keyed(
            spark, q_path, to_quarantine(bad, "orders", f"batch-{run_id[:8]}", F.col("o_orderkey"), started, run_id),
            ["batch_id", "source", "record_id"])
        new_mark = seen["mark"] if mark_from == "staged" else \
            load.agg(F.max("o_orderdate").cast("string")).first()[0] or wm
        run.update(inserted=ins, updated=upd, quarantined=quarantined, watermark_after=new_mark,
                   valid_rows=ins + upd,
                   status=STATUS_SUCCESS)
        state.write_watermark(spark, mark_path, new_mark)   # last, after the load committed
        return run
    except Exception as e:  # noqa: BLE001 - every failure is audited, then re-raised
        run.update(status=STATUS_FAIL, error_message=f"{type(e).__name__}: {e}")
        raise
    finally:
        for c in cached:
            c.unpersist()
        run["finished_at"] = str(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        state.audit_run(spark, audit_path, run)


@query("z01_governed_etl", sql=f"""
WITH {ORDERS_SQL}
SELECT o.o_orderkey, n.n_name AS branch, o.o_totalprice FROM ord_chk o
JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.reject_reason = '' AND o.o_orderdate > TIMESTAMP '{DEFAULT_MARK}'
""")
def z01(spark, sf):
    base = _run_dir(spark, "z01")
    run = governed_etl(spark, sf, base)
    if run["status"] != STATUS_SUCCESS:
        raise RuntimeError(f"governed load ended with {run['status']}: {run.get('error_message')}")
    return state.read_table(spark, f"{base}/fact").select("o_orderkey", "branch", "o_totalprice")


REPEATED_SQL = """src AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL SELECT * REPLACE (o_orderkey + 1000000000 AS o_orderkey) FROM orders WHERE o_orderkey % 10 = 1)"""


@query("z01_governed_etl_repeats", sql=f"""
WITH {REPEATED_SQL}, {ORDERS_SQL.replace('FROM orders', 'FROM src')},
one AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate, o_totalprice) AS r1
        FROM ord_chk WHERE reject_reason = '' AND o_orderdate > TIMESTAMP '{DEFAULT_MARK}'),
two AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate, o_totalprice ORDER BY o_orderkey) AS r2
        FROM one WHERE r1 = 1)
SELECT o.o_orderkey, n.n_name AS branch, o.o_totalprice FROM two o
JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE r2 = 1
""")
def z01c(spark, sf):
    """The load on a source that repeats a tenth of its orders under their key and a tenth under new keys."""
    o = t(spark, sf, "orders")
    repeats = o.unionByName(o.filter("o_orderkey % 10 = 0")).unionByName(
        o.filter("o_orderkey % 10 = 1").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000))
    base = _run_dir(spark, "z01c")
    run = governed_etl(spark, sf, base, source=repeats)
    if run["status"] != STATUS_SUCCESS:
        raise RuntimeError(f"governed load ended with {run['status']}: {run.get('error_message')}")
    return state.read_table(spark, f"{base}/fact").select("o_orderkey", "branch", "o_totalprice")


@query("z01_audit_statuses", sql=f"""
WITH {ORDERS_SQL},
m AS (SELECT count(*) AS n, count(*) FILTER (WHERE reject_reason = '') AS ok, CAST(max(o_orderdate) AS VARCHAR) AS mark
      FROM ord_chk WHERE o_orderdate > TIMESTAMP '{DEFAULT_MARK}')
SELECT 'run-1' AS run_id, 'SUCCESS' AS status, CAST(n AS VARCHAR) AS source_rows, CAST(ok AS VARCHAR) AS inserted,
  '{DEFAULT_MARK}' AS watermark_before, mark AS watermark_after FROM m
UNION ALL SELECT 'run-2', 'SUCCESS_EMPTY', '0', NULL, mark, mark FROM m
""")
def z01b(spark, sf):
    """Two runs: the first loads, the second finds nothing newer (SUCCESS_EMPTY)."""
    base = _run_dir(spark, "z01b")
    governed_etl(spark, sf, base, run_id="run-1")
    governed_etl(spark, sf, base, run_id="run-2")
    return state.read_table(spark, f"{base}/etl_runs").select("run_id", "status", "source_rows", "inserted",
                                                               "watermark_before", "watermark_after")


def gated_load(spark, base: str, good, bad, key, gate, checks, period=None) -> "DataFrame":  # noqa: F821
    """Gate a batch on its reject rate, upsert its good rows (without a key they are the new snapshot), append its bad ones to the quarantine, and
    check the table after the load.  ``bad``: (record_id, reject_reason); ``checks``: predicates that no
    loaded row may meet.  With ``period`` (a column) the table is kept by period (S15), else by whole versions.
    Both sides are evaluated once, into staged files, which the counts and the load read.  A batch that fails
    the gate loads nothing."""
    good, bad = (_staged(spark, base, df) for df in (good, bad))
    n_good, n_bad = good.count(), bad.count()      # from the files' footers
    metrics = spark.createDataFrame([(n_good, n_bad / (n_good + n_bad) if n_good + n_bad else 0.0)], "rows long, reject_rate double")
    outcome = Q.gate_outcome(Q.quality_gate(metrics, gate))
    if outcome["status"] != "PASS":
        raise RuntimeError(f"{STATUS_GATE}: {';'.join(outcome['failures'])}")
    if key is None:
        state.publish(spark, good, f"{base}/curated")
    elif period is None:
        state.upsert(spark, f"{base}/curated", good, key)
    else:
        periods.upsert_periods(spark, f"{base}/curated", good, key, period)
    state.append_keyed(spark, f"{base}/quarantine", bad, ["record_id"])
    table = state.read_table(spark, f"{base}/curated")
    Q.assert_no_violations(Q.violation_counts(table, checks))
    return table


def _staged(spark, base: str, df):
    path = f"{base}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------- Z02
PRICE_GATE = {"reject_rate": ("max", 0.05)}


def load_prices(spark, base: str, lines):
    """One incremental run: lines newer than the mark give each part's latest price, which is upserted."""
    mark = state.read_watermark(spark, f"{base}/mark", default=DEFAULT_MARK)
    new = state.incremental_scan(lines, "l_shipdate", mark)
    upper = new.agg(F.max("l_shipdate").alias("u"), F.max("l_shipdate").cast("string").alias("m")).first()
    if upper["u"] is None:
        return
    new = new.filter(F.col("l_shipdate") <= F.lit(upper["u"]))
    good, bad = RL.split_valid(new, F.col("l_quantity") > 0)
    prices = RL.assert_unique(latest_unit_price(good), "p_partkey")    # V18 guard before the join
    gated_load(spark, base, prices, bad.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("record_id"), F.lit("quantity_invalid").alias("reject_reason")),
        "p_partkey", PRICE_GATE, {"no_part": F.col("p_partkey").isNull(), "no_date": F.col("price_date").isNull()},
        period=periods.month_of("price_date"))
    state.write_watermark(spark, f"{base}/mark", upper["m"])


def latest_unit_price(lines):
    li = lines.select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate",
                                         (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))
    latest = RL.keep_first(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], keep="last")
    return latest.select(F.col("l_partkey").alias("p_partkey"), "unit_price", F.col("l_shipdate").alias("price_date"))


@query("z02_latest_price_integration", sql=f"""
WITH lp AS (SELECT l_partkey AS p_partkey, arg_max(l_extendedprice / l_quantity, (l_shipdate, l_orderkey, l_linenumber)) AS unit_price,
                   max(l_shipdate) AS price_date FROM lineitem GROUP BY l_partkey)
SELECT p.p_partkey, p.p_brand, {R('lp.unit_price', 8)} AS unit_price, lp.price_date,
  {R('lp.unit_price - p.p_retailprice', 8)} AS gap_vs_list
FROM part p LEFT JOIN lp ON p.p_partkey = lp.p_partkey
""")
def z02(spark, sf):
    """Two incremental runs (lines up to the middle date, then the rest) and one with nothing new."""
    base, li = _run_dir(spark, "z02"), t(spark, sf, "lineitem")
    middle = li.agg(F.percentile_approx("l_shipdate", 0.5)).first()[0]
    load_prices(spark, base, li.filter(F.col("l_shipdate") <= F.lit(middle)))
    for _ in range(2):
        load_prices(spark, base, li)
    lp = state.read_table(spark, f"{base}/curated")
    p = t(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    j = p.join(lp, "p_partkey", "left")
    # unit prices have at most 7 exact decimals (cents / quantity <= 50): round at 8, never on a tie
    return j.select("p_partkey", "p_brand", F.round("unit_price", 8).alias("unit_price"), "price_date",
                    F.round(F.col("unit_price") - F.col("p_retailprice"), 8).alias("gap_vs_list"))


# ------------------------------------------------------------------- Z03
@query("z03_listing_integration", sql=f"""
WITH j AS (SELECT l.*, p.p_brand, p.p_type, s.s_nationkey,
             concat_ws(';', CASE WHEN p.p_partkey IS NULL THEN 'part_not_found' END,
                            CASE WHEN s.s_suppkey IS NULL THEN 'supplier_not_found' END,
                            CASE WHEN l.l_extendedprice IS NULL OR l.l_extendedprice <= 0 THEN 'price_invalid' END,
                            CASE WHEN l.l_discount > 0.08 THEN 'discount_out_of_range' END) AS reasons
           FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey)
SELECT p_brand, {R('avg(l_extendedprice)', 4)} AS avg_price, count(*) AS n,
  array_to_string(list_sort(list_distinct(list(p_type))), ',') AS types
FROM j WHERE reasons = '' GROUP BY p_brand
""")
def z03(spark, sf):
    li = t(spark, sf, "lineitem")
    part = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    sup = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = RL.left_join_indicator(li, part, "l_partkey", flag="_part")
    j = RL.left_join_indicator(j, sup, "l_suppkey", flag="_supp")
    reasons = F.array_compact(F.array(
        F.when(F.col("_part") == "left_only", F.lit("part_not_found")),
        F.when(F.col("_supp") == "left_only", F.lit("supplier_not_found")),
        F.when(F.col("l_extendedprice").isNull() | (F.col("l_extendedprice") <= 0), F.lit("price_invalid")),
        F.when(F.col("l_discount") > 0.08, F.lit("discount_out_of_range"))))
    j = j.withColumn("reasons", F.array_join(reasons, ";"))
    good, bad = RL.split_valid(j, F.col("reasons") == "")
    good = gated_load(spark, _run_dir(spark, "z03"), good.select("l_orderkey", "l_linenumber", "p_brand", "p_type", "l_extendedprice"),
                      bad.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("record_id"), F.col("reasons").alias("reject_reason")),
                      None, {"reject_rate": ("max", 0.5)},
                      {"no_price": F.col("l_extendedprice").isNull(), "price_invalid": F.col("l_extendedprice") <= 0})
    return good.groupBy("p_brand").agg(F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
                                       F.count(F.lit(1)).alias("n"),
                                       F.array_join(F.sort_array(F.collect_set("p_type")), ",").alias("types"))


# ------------------------------------------------------------------- Z04
@query("z04_segment_elt", sql="""
WITH ten AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS tenure FROM orders GROUP BY 1),
src AS (SELECT c.c_custkey, c.c_mktsegment, coalesce(ten.tenure, 0) AS tenure,
          CASE WHEN c.c_acctbal < 0 THEN ' ' ELSE '''' || CAST(c.c_acctbal AS VARCHAR) || '''' END AS total_text
        FROM customer c LEFT JOIN ten ON c.c_custkey = ten.o_custkey),
clean AS (SELECT *, trim(trim(total_text), '''') AS t FROM src),
ok AS (SELECT *, CASE WHEN t = '' THEN 0.0 ELSE CAST(t AS DOUBLE) END AS total FROM clean WHERE NOT (t = '' AND tenure != 0)),
b AS (SELECT *, CASE WHEN tenure = 0 THEN 'new' WHEN tenure <= 3 THEN '1-3' WHEN tenure <= 6 THEN '4-6' ELSE '7+' END AS tenure_band FROM ok)
SELECT c_mktsegment, tenure_band, count(*) AS n, count(*) FILTER (WHERE total > 5000) AS positives,
  round(avg(CASE WHEN total > 5000 THEN 1.0 ELSE 0.0 END), 4) AS rate, round(avg(total), 2) AS mean_total
FROM b GROUP BY ALL
""")
def z04(spark, sf):
    from cauce.functions.strings import strip_quotes
    ten = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("tenure"))
    c = t(spark, sf, "customer").join(ten, "c_custkey", "left").withColumn("tenure", F.coalesce("tenure", F.lit(0)))
    text = F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(
        F.concat(F.lit("'"), F.col("c_acctbal").cast("string"), F.lit("'")))
    src = c.select("c_custkey", "c_mktsegment", "tenure", text.alias("total_text"))
    src = RL.sequence_id(src, ["c_custkey"], "row_id")            # P11 surrogate id
    clean = src.withColumn("t", strip_quotes("total_text"))       # F02
    ok, bad = RL.split_valid(clean, ~((F.col("t") == "") & (F.col("tenure") != 0)))   # V06
    ok = gated_load(spark, _run_dir(spark, "z04"), ok, bad.select(
        F.col("c_custkey").cast("string").alias("record_id"), F.lit("total_missing").alias("reject_reason")), "c_custkey",
        {"reject_rate": ("max", 0.5)}, {"no_key": F.col("c_custkey").isNull(), "no_row_id": F.col("row_id").isNull()})
    ok = ok.withColumn("total", F.when(F.col("t") == "", F.lit(0.0)).otherwise(F.col("t").try_cast("double")))
    band = (F.when(F.col("tenure") == 0, "new").when(F.col("tenure") <= 3, "1-3").when(F.col("tenure") <= 6, "4-6")
            .otherwise("7+"))
    pos = F.when(F.col("total") > 5000, 1).otherwise(0)
    return ok.withColumn("tenure_band", band).groupBy("c_mktsegment", "tenure_band").agg(
        F.count(F.lit(1)).alias("n"), F.sum(pos).cast("long").alias("positives"),
        F.round(F.avg(pos.cast("double")), 4).alias("rate"), F.round(F.avg("total"), 2).alias("mean_total"))


# ------------------------------------------------------------------- Z05
@query("z05_basic_clean", sql=f"""
SELECT p_partkey, upper(trim(p_brand)) AS brand, {R('p_retailprice / p_size', 6)} AS price_per_size
FROM part WHERE p_size BETWEEN 1 AND 45 AND p_retailprice > 0
""")
def z05(spark, sf):
    p = t(spark, sf, "part")
    ok, _ = RL.split_valid(p, F.col("p_size").between(1, 45) & (F.col("p_retailprice") > 0))
    return ok.select("p_partkey", F.upper(F.trim("p_brand")).alias("brand"),
                     F.round(F.col("p_retailprice") / F.col("p_size"), 6).alias("price_per_size"))


@query("z05_homologated_clean", sql=f"""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'B-' || upper(trim(p_brand)) END AS brand, {R('p_retailprice / p_size', 6)} AS price_per_size
FROM part WHERE p_size BETWEEN 1 AND 45 AND p_retailprice > 0
""")
def z05b(spark, sf):
    """Z05 with J11: brands in several spellings go to one canonical name, those the catalogue lacks to none."""
    from cauce.functions.strings import norm_key
    p = t(spark, sf, "part")
    ok, _ = RL.split_valid(p, F.col("p_size").between(1, 45) & (F.col("p_retailprice") > 0))
    messy = F.when(F.col("p_size") % 7 == 0, F.lit("unknown brand")).when(F.col("p_size") % 3 == 0, F.concat(F.lit("  "), F.lower("p_brand"))) \
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit("'"), F.col("p_brand"), F.lit("'"))).otherwise(F.upper("p_brand"))
    catalogue = p.select(norm_key(F.col("p_brand")).alias("alias_norm"), F.concat(F.lit("B-"), F.upper(F.trim("p_brand"))).alias("canonical")).distinct()
    out = RL.homologate(ok.withColumn("_brand", messy), "_brand", catalogue, "brand")
    return out.select("p_partkey", "brand", F.round(F.col("p_retailprice") / F.col("p_size"), 6).alias("price_per_size"))


# ------------------------------------------------------------------- Z06
def spark_etl(spark, sf, out_dir: str | None = None):
    """Read, validate, derive, checked-broadcast join, aggregate, partitioned write."""
    li = t(spark, sf, "lineitem")
    ok, _rej = RL.split_valid(li, (F.col("l_extendedprice") > 0) & F.col("l_quantity").between(1, 50)
                              & (F.col("l_discount") <= 0.1))
    derived = ok.withColumn("ship_year", F.year("l_shipdate")).withColumn("age", F.lit(2002) - F.col("ship_year"))
    sup = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    nat = RL.sized_broadcast(t(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), 1000,
                             cache_key=(sf, "nation"))
    curated = derived.join(sup, "l_suppkey", "left").join(nat, "s_nationkey", "left")
    if out_dir:
        sinks.write_parquet(curated.select("l_orderkey", "l_linenumber", "n_name", "l_extendedprice", "age",
                                           "ship_year"), out_dir, partition_by=["ship_year"])
    return curated.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.avg("l_extendedprice").alias("avg_price")) \
        .orderBy(F.desc("avg_price"))


@query("z06_spark_etl_summary", sql="""
SELECT n.n_name, count(*) AS n, avg(l.l_extendedprice) AS avg_price
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE l.l_extendedprice > 0 AND l.l_quantity BETWEEN 1 AND 50 AND l.l_discount <= 0.1 GROUP BY n.n_name
""")
def z06(spark, sf):
    return spark_etl(spark, sf, _run_dir(spark, "z06"))


@query("s13_snapshots", sql="""
SELECT n.n_name, count(*) AS n, avg(l.l_extendedprice) AS avg_price, count(*) AS curated_rows
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE l.l_extendedprice > 0 AND l.l_quantity BETWEEN 1 AND 50 AND l.l_discount <= 0.1 GROUP BY n.n_name
""")
def s13(spark, sf):
    """Both snapshots of the job, the curated rows and their aggregate, written and read back."""
    base = _run_dir(spark, "s13")
    state.publish(spark, spark_etl(spark, sf, f"{base}/curated"), f"{base}/summary")
    rows = spark.read.parquet(f"{base}/curated").groupBy("n_name").agg(F.count(F.lit(1)).alias("curated_rows"))
    summary = state.read_table(spark, f"{base}/summary")
    return summary.alias("s").join(rows.alias("r"), F.col("s.n_name").eqNullSafe(F.col("r.n_name"))).select("s.*", "curated_rows")


# ------------------------------------------------------------------- Z07
def _z07_sql():
    from cauce.plans.registry import _ORACLES
    import cauce.plans.quality  # noqa: F401  (registers g21)
    parts = [f"SELECT '{n}' AS report, count(*) AS row_count FROM ({_ORACLES[n]})" for n in _report_names()]
    return " UNION ALL ".join(parts)


def _report_names():
    return ["g03_revenue_by_category", "g04_rate_above_overall", "w01_monthly_change", "g20_top_customers",
            "g21_reasons_by_month"]


@query("z07_report_pack", sql=_z07_sql())
def z07(spark, sf):
    """Run Q1-Q5, export each as JSON with its row count (one job per report)."""
    from cauce.plans.registry import all_queries
    qs = all_queries()
    base = _run_dir(spark, "z07")
    rows = [(n, sinks.export_json(qs[n](spark, sf), f"{base}/{n}")) for n in _report_names()]
    return spark.createDataFrame(rows, "report string, row_count long")


# ------------------------------------------------------------------- Z08-Z12 (rows)
def _z08_sql() -> str:
    from cauce.plans.textops import PREP_SQL
    return f"""
WITH {PREP_SQL},
kp AS (SELECT * FROM st WHERE state = 'conservar'),
bad AS (SELECT text_processed FROM kp GROUP BY 1 HAVING count(DISTINCT label) > 1),
k2 AS (SELECT * FROM kp WHERE text_processed NOT IN (SELECT text_processed FROM bad)),
fam AS (SELECT source, row_number() OVER (ORDER BY md5('42' || source), source) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM k2)),
sp AS (SELECT k2.*, CASE WHEN rk <= floor(n * 0.7) THEN 'train' WHEN rk <= floor(n * 0.7) + floor(n * 0.15) THEN 'validation' ELSE 'test' END AS split
       FROM k2 LEFT JOIN fam ON k2.source IS NOT DISTINCT FROM fam.source)
SELECT split, count(*) AS rows, count(DISTINCT source) AS families, count(label) AS labelled,
  count(DISTINCT label) AS labels, count(*) / (SELECT count(*) FROM sp) AS share FROM sp GROUP BY split"""


@query("z08_corpus_pipeline_report", sql=_z08_sql())
def z08(spark, sf):
    from cauce.operators import corpus as C
    from cauce.plans.textops import labelled_docs
    base = _run_dir(spark, "z08")
    prepared = C.prepare(labelled_docs(spark, sf), "doc_id", "text", "label")
    # each is read several times by the next step
    kept = C.written(prepared.filter(F.col("state") == C.STATE_KEEP), "kept")
    kept = C.written(C.drop_conflicting_groups(kept, "text_processed", "label"), "agreed")
    split = C.family_split(kept, "source").checkpoint(eager=True)
    C.assert_split_ok(C.split_violations(split, "doc_id", "text_processed", "source", "label"))
    out = split.select("doc_id", "source", "label", "text_processed", "split")
    sinks.write_csv_partitioned(out, f"{base}/splits")
    fp = sinks.fingerprint(out).first()
    sinks.write_manifest(spark, f"{base}/manifest", {
        "source": "documents+labels", "seed": 42, "policy": "nfc+spaces+redaction", "rows": fp["rows"],
        "hash_sum": fp["hash_sum"], "label_order": [0, 1]})
    back = spark.read.option("header", True).option("multiLine", True).csv(f"{base}/splits").select(
        F.col("doc_id").cast("long"), "source", F.col("label").cast("int"), "text_processed", "split")
    if not sinks.same_rows(out, back):
        raise AssertionError("round trip changed the data")
    return C.split_report(split, "source", "label")


@query("z09_text_experiment")
def z09(spark, sf):
    from cauce.operators import metrics as MT
    from cauce.plans.mlops import model_selection, t19
    preds = t19(spark, sf).checkpoint(eager=True)          # fit once; selection and test read it
    chosen = model_selection(preds).select("chosen").first()["chosen"]
    test = preds.filter((F.col("split") == "test") & (F.col("model") == chosen)) \
        .select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))
    return MT.class_report(test, "label", "prediction").withColumn("model", F.lit(chosen))


def _z10_sql() -> str:
    from cauce.plans.textops import LEX_SQL
    return f"""
WITH {LEX_SQL},
rel AS (SELECT b.item_id AS qid, d.doc_id AS item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)),
top AS (SELECT * FROM rk WHERE rank <= 3),
pq AS (SELECT r.qid, count(*) AS n_rel, count(*) FILTER (WHERE t.item_id IS NOT NULL) AS hits, min(t.rank) AS first_hit
       FROM rel r LEFT JOIN top t ON r.qid = t.qid AND r.item_id = t.item_id GROUP BY r.qid),
s AS (SELECT round(score, 9) AS score, qid IN (SELECT qid FROM rel) AS positive FROM rk WHERE rank = 1),
pn AS (SELECT count(*) FILTER (WHERE positive) AS P, count(*) FILTER (WHERE NOT positive) AS N FROM s),
lv AS (SELECT score AS v, count(*) FILTER (WHERE positive) AS pos, count(*) FILTER (WHERE NOT positive) AS neg FROM s GROUP BY 1),
cum AS (SELECT v, sum(pos) OVER (ORDER BY v) AS cpos, sum(neg) OVER (ORDER BY v) AS cneg, lead(v) OVER (ORDER BY v) AS nv FROM lv),
cand AS (
  SELECT (v + nv) / 2 AS threshold, ((P - cpos) / P + cneg / N) / 2 AS ba FROM cum, pn WHERE nv IS NOT NULL
  UNION ALL SELECT 0.0, ((SELECT count(*) FROM s WHERE positive AND score >= 0.0) / P
                        + (SELECT count(*) FROM s WHERE NOT positive AND score < 0.0) / N) / 2 FROM pn
  UNION ALL SELECT 1.01, ((SELECT count(*) FROM s WHERE positive AND score >= 1.01) / P
                         + (SELECT count(*) FROM s WHERE NOT positive AND score < 1.01) / N) / 2 FROM pn)
SELECT (SELECT {R('avg(hits * 1.0 / n_rel)', 9)} FROM pq) AS recall_at_k, (SELECT {R('avg(coalesce(1.0 / first_hit, 0.0))', 9)} FROM pq) AS mrr,
  (SELECT count(*) FROM pq) AS n_answerable, {R('arg_max(threshold, (ba, threshold))', 9)} AS threshold,
  {R('max(ba)', 9)} AS balanced_accuracy FROM cand"""


@query("z10_retrieval_evaluation", sql=_z10_sql())
def z10(spark, sf):
    from cauce.operators import retrieval as RT
    from cauce.plans.textops import lexical_search
    ranking = lexical_search(spark, sf)
    rel = RT.containment_pairs(t(spark, sf, "documents"), "doc_id", "text", t(spark, sf, "benchmark"),
                               "item_id", "text").select(F.col("pid").alias("qid"), F.col("doc_id").alias("item_id"))
    metrics = RT.retrieval_metrics(ranking, rel)
    answerable = rel.select("qid").distinct().withColumn("positive", F.lit(True))
    top1 = ranking.filter("rank = 1").join(answerable, "qid", "left") \
        .select(F.col("score"), F.coalesce("positive", F.lit(False)).alias("positive"))
    thr = RT.best_threshold(top1)
    return metrics.select(F.round("recall_at_k", 9).alias("recall_at_k"), F.round("mrr", 9).alias("mrr"), "n_answerable") \
        .withColumn("threshold", thr.select(F.round("threshold", 9)).scalar()) \
        .withColumn("balanced_accuracy", thr.select(F.round("balanced_accuracy", 9)).scalar())


_Z11_CORR = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")]
_Z11_ROWS = [
    *[f"SELECT 'distinct' AS section, '{c}' AS metric, CAST(count(DISTINCT {c}) AS DOUBLE) AS value FROM lineitem"
      for c in ("l_returnflag", "l_linestatus", "l_suppkey")],
    *[f"SELECT 'nulls', '{c}', round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 4) FROM lineitem" for c in ("l_quantity", "l_discount")],
    *[f"SELECT 'quantiles_l_quantity', 'p{q}', quantile_cont(l_quantity, 0.{q}) FROM lineitem" for q in (25, 50, 75, 90)],
    *[f"SELECT 'corr', '{a}~{b}', {R(f'corr({a}, {b})', 9)} FROM lineitem" for a, b in _Z11_CORR],
    *[f"""SELECT 'iqr_outliers', '{c}', CAST((SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS DOUBLE)
      FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem)""" for c in ("l_quantity", "l_discount")],
    f"""SELECT 'concentration', 'top30_share', {R('sum(cnt) FILTER (WHERE rn <= floor(n * 0.3)) * 1.0 / sum(cnt)', 6)}
      FROM (SELECT cnt, row_number() OVER (ORDER BY cnt DESC, o_custkey) AS rn, count(*) OVER () AS n
            FROM (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey))""",
    # value counts, duplicates and the two most frequent pairs of flags
    "SELECT 'value_counts', l_returnflag, CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY l_returnflag",
    "SELECT 'crosstab', l_returnflag || '~' || l_linestatus, CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY l_returnflag, l_linestatus",
    "SELECT 'duplicates', 'rows', CAST(coalesce(sum(c - 1), 0) AS DOUBLE) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)",
    # description, kinds of absence and the Lorenz curve
    *[f"SELECT 'describe_{c}', '{m}', {R(f'{f}({c})', 4)} FROM lineitem" for c in ("l_quantity", "l_extendedprice")
      for m, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))],
    *[f"SELECT 'absent_{c}', '{m}', CAST(count(*) FILTER (WHERE {p}) AS DOUBLE) FROM documents" for c in ("text", "lang")
      for m, p in (("n_null", f"{c} IS NULL"), ("n_empty", f"{c} = ''"), ("n_blank", f"regexp_full_match({c}, '\\s+')"), ("n_marker", f"{c} = '__NULO__'"))],
    f"""SELECT 'lorenz', CAST(cnt AS VARCHAR), {R('sum(cnt * n) OVER (ORDER BY cnt DESC) * 1.0 / (SELECT count(*) FROM orders)', 9)}
      FROM (SELECT cnt, count(*) AS n FROM (SELECT count(*) AS cnt FROM orders GROUP BY o_custkey) GROUP BY cnt)""",
]


@query("z11_eda_report", sql=" UNION ALL ".join(_Z11_ROWS))
def z11(spark, sf):
    from cauce.operators import stats as ST
    from cauce.operators.windows import lorenz_levels, top_share
    li = t(spark, sf, "lineitem")
    parts = [
        A.distinct_counts(li, ["l_returnflag", "l_linestatus", "l_suppkey"]).select(
            F.lit("distinct").alias("section"), F.col("column").alias("metric"), F.col("n_distinct").cast("double").alias("value")),
        A.null_census(li, ["l_quantity", "l_discount"]).select(
            F.lit("nulls").alias("section"), "column", F.col("pct_null").cast("double")),
        A.quantiles(li, "l_quantity").unpivot([], ["p25", "p50", "p75", "p90"], "metric", "value").select(
            F.lit("quantiles_l_quantity").alias("section"), "metric", "value"),
        ST.pairwise_corr(li, ["l_quantity", "l_extendedprice", "l_discount"]).select(
            F.lit("corr").alias("section"), F.concat_ws("~", "col_a", "col_b"), F.round("corr", 9)),
        ST.iqr_outliers(li, ["l_quantity", "l_discount"]).select(
            F.lit("iqr_outliers").alias("section"), "column", F.col("n_outliers").cast("double")),
        top_share(t(spark, sf, "orders"), "o_custkey", 0.3).select(
            F.lit("concentration").alias("section"), F.lit("top30_share"), F.round("top_share", 6)),
        li.groupBy("l_returnflag").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("value_counts").alias("section"), "l_returnflag", "value"),
        li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("crosstab").alias("section"), F.concat_ws("~", "l_returnflag", "l_linestatus"), "value"),
        li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("c")).agg(
            F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("double").alias("value")).select(
            F.lit("duplicates").alias("section"), F.lit("rows"), "value"),
        A.describe_long(li, ["l_quantity", "l_extendedprice"]).unpivot("column", ["mean", "std", "min", "max"], "metric", "value").select(
            F.concat(F.lit("describe_"), "column"), "metric", F.round("value", 4)),
        A.absence_census(t(spark, sf, "documents"), ["text", "lang"]).unpivot(
            "column", ["n_null", "n_empty", "n_blank", "n_marker"], "metric", "value").select(
            F.concat(F.lit("absent_"), "column"), "metric", F.col("value").cast("double")),
        lorenz_levels(t(spark, sf, "orders"), "o_custkey").select(
            F.lit("lorenz"), F.col("cnt").cast("string"), F.round("cum_row_share", 9)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("z12_unsupervised_segmentation")
def z12(spark, sf):
    from pyspark.ml.clustering import KMeans
    from cauce.operators import metrics as MT
    from cauce.operators import ml as ML
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                         "l_tax", "l_returnflag")
    li = ML.impute(li, "l_tax", "mean")
    z = ML.standardize(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], population=True)
    feats = ["l_quantity_z", "l_extendedprice_z", "l_discount_z", "l_tax_z"]
    d = ML.assemble(z, feats)
    m = KMeans(k=4, seed=42, maxIter=20).fit(d)
    p = m.transform(d)
    prof = A.group_profile(p, "prediction", ["l_quantity", "l_extendedprice", "l_discount"])
    ari = MT.adjusted_rand_index(p, "prediction", "l_returnflag").select("ari")
    return prof.withColumn("ari_vs_returnflag", ari.scalar())


@query("z12_segmentation_report")
def z12b(spark, sf):
    """The choices of a segmentation in long form: correlated pairs, inflation, components for 90 and 95 %, the number of
    clusters by silhouette on the scores, and how far k-means, bisecting k-means and Ward agree with the flag."""
    import uuid

    from pyspark.ml.clustering import BisectingKMeans, KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import vector_to_array
    from cauce.operators import metrics as MT
    from cauce.operators import ml as ML
    from cauce.operators import stats as ST
    from cauce.operators.ward import ward
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = ML.impute(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols, "l_returnflag"), "l_tax", "mean")
    corr = ST.pairwise_corr(li, cols)
    shares, vectors = ML.principal_components(li, cols)
    k90 = ML.components_for(shares, 0.9)
    rows = [("vif", c, v) for c, v in ST.vif(li, cols)] + [
        ("components", "k90", float(k90)), ("components", "k95", float(ML.components_for(shares, 0.95)))]
    scores = ML.component_scores(li, cols, vectors, k90)
    base = _run_dir(spark, "z12")
    ML.assemble(scores, [f"pc{j + 1}" for j in range(k90)]).withColumn("point", vector_to_array("features")).select(
        "l_returnflag", "features", "point").write.parquet(f"{base}/scores-{uuid.uuid4().hex}")
    d = spark.read.parquet(f"{base}/scores-*")
    fits = {k: KMeans(k=k, seed=42, maxIter=20).fit(d) for k in range(2, 7)}
    silhouettes = {k: ClusteringEvaluator().evaluate(m.transform(d)) for k, m in fits.items()}
    best = max(silhouettes, key=lambda k: (silhouettes[k], -k))
    rows += [("silhouette", f"k{k}", float(v)) for k, v in silhouettes.items()] + [("clusters", "best_k", float(best))]
    # written: the agreement reads the clusters several times
    ward(d.select("l_returnflag", "point"), "point", best).select("l_returnflag", "cluster").write.parquet(f"{base}/ward-{uuid.uuid4().hex}")
    labelled = {"kmeans": fits[best].transform(d).withColumnRenamed("prediction", "cluster"),
                "bisecting": BisectingKMeans(k=best, seed=42).fit(d).transform(d).withColumnRenamed("prediction", "cluster"),
                "ward": spark.read.parquet(f"{base}/ward-*")}
    rows += [("ari_vs_returnflag", n, float(MT.adjusted_rand_index(p, "cluster", "l_returnflag").first()["ari"])) for n, p in labelled.items()]
    return spark.createDataFrame(rows, "section string, metric string, value double").unionByName(
        ST.high_corr_pairs(corr, 0.8).select(F.lit("high_corr").alias("section"), F.concat_ws("~", "col_a", "col_b").alias("metric"), F.col("corr").alias("value")))
