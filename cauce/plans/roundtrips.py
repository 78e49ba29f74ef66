"""Readers, sinks and state checked by round trips: driver tables are written in the source formats to the
shared scratch folder and come back through the operator."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.functions import dates as D
from cauce.operators import corpus as C
from cauce.operators import relational as RL
from cauce.plans.facts import t
from cauce.plans.registry import query
from cauce.session import scratch_path
from cauce.sources import readers, sinks, state


def _place(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _csv(df, path, sep=",", **options):
    df.write.options(header=True, sep=sep, **options).csv(path)
    return path


@query("s01_csv_inferred", sql="SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def s01(spark, sf):
    src = t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    p = _csv(src.toDF(*[f" {c} " for c in src.columns]), _place(spark, "s01"))
    return readers.read_csv(spark, p).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query("s04_csv_separator_schema", sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s04(spark, sf):
    p = _csv(t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), _place(spark, "s04"), sep=";")
    return readers.read_csv(spark, p, sep=";", schema="o_orderkey long, o_orderstatus string, o_totalprice double")


BROKEN = "o_orderkey % 50 = 7"


@query("s02_csv_permissive", sql=f"""
SELECT o_orderkey, o_totalprice, {BROKEN} AS corrupt FROM orders
""")
def s02(spark, sf):
    """A fiftieth of the lines has text in the number column."""
    o = t(spark, sf, "orders")
    lines = o.select(F.col("o_orderkey").cast("string").alias("k"), F.concat(
        F.when(F.expr(BROKEN), F.lit("x")).otherwise(F.lit("")), F.col("o_totalprice").cast("string")).alias("price"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("price", T.DoubleType())])
    good, bad = readers.read_csv_permissive(spark, _csv(lines, _place(spark, "s02")), schema)
    price = F.substring_index(readers.CORRUPT, ",", -1)
    bad = bad.select("k", F.substr(price, F.lit(2)).cast("double").alias("price"), F.lit(True).alias("corrupt"))
    return good.select("k", "price", F.lit(False).alias("corrupt")).unionByName(bad).toDF("o_orderkey", "o_totalprice", "corrupt")


@query("s03_csv_null_marker", sql="""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE ' ' || c_name || ' ' END AS note FROM customer
""")
def s03(spark, sf):
    k = F.col("c_custkey") % 3
    src = t(spark, sf, "customer").select("c_custkey", F.when(k == 0, "__NULO__").when(k == 1, "").otherwise(
        F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("note"))
    p = _csv(src, _place(spark, "s03"), ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.read_csv_null_marker(spark, p).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("s06_json_array", sql="SELECT p_partkey, p_name, p_size FROM part")
def s06(spark, sf):
    """One JSON array of objects a file."""
    p, part = _place(spark, "s06"), t(spark, sf, "part")
    # documents of 256 rows, so an array never grows with the table
    rows = part.groupBy(F.floor(F.col("p_partkey") / 256).alias("file")).agg(
        F.to_json(F.collect_list(F.struct("p_partkey", "p_name", "p_size"))).alias("value"))
    rows.write.partitionBy("file").text(p)
    return readers.read_json_records(spark, p, "p_partkey long, p_name string, p_size int").select("p_partkey", "p_name", "p_size")


@query("s07_alias_catalogue", sql="""
SELECT lower(n_name) AS alias_norm, CAST(n_nationkey AS VARCHAR) AS canonical FROM nation
UNION SELECT lower(trim(r_name)) || ' ' || lower(n_name), CAST(n_nationkey AS VARCHAR) FROM nation JOIN region ON n_regionkey = r_regionkey
UNION SELECT CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR) FROM nation
""")
def s07(spark, sf):
    """The nations written as a nested JSON catalogue, read back flat."""
    n = t(spark, sf, "nation").join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    clinic = F.struct(F.col("n_nationkey").cast("string").alias("clinic_code"), F.col("n_name").alias("nombre"),
                      F.col("r_name").alias("ciudad"), F.array(F.concat_ws(" ", "r_name", "n_name")).alias("aliases"))
    p = _place(spark, "s07")
    n.agg(F.collect_list(clinic).alias("clinicas")).write.json(p)
    clinics, _ = readers.read_alias_catalogue(spark, p)
    return clinics


@query("s10_persisted_mark", sql="SELECT CAST(max(o_orderdate) AS VARCHAR) AS mark, 'kept' AS other FROM orders")
def s10(spark, sf):
    p = _place(spark, "s10")
    state.write_watermark(spark, p, "kept", key="other")
    state.write_watermark(spark, p, "1990-01-01 00:00:00")
    o = t(spark, sf, "orders")
    new = state.incremental_scan(o, "o_orderdate", state.read_watermark(spark, p))
    state.write_watermark(spark, p, new.agg(state.next_watermark(new, "o_orderdate", "1990-01-01 00:00:00")).first()[0])
    return readers.frame(spark, [(state.read_watermark(spark, p), state.read_watermark(spark, p, key="other"))], "mark string, other string")


@query("s14_csv_by_split", sql="""
SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 10 < 7 THEN 'train' WHEN c_custkey % 10 < 8 THEN 'validation' ELSE 'test' END AS split FROM customer
""")
def s14(spark, sf):
    k = F.col("c_custkey") % 10
    src = t(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.when(k < 7, "train").when(k < 8, "validation").otherwise("test").alias("split"))
    p = _place(spark, "s14")
    sinks.write_csv_partitioned(src, p)
    return spark.read.option("header", True).schema("c_custkey long, c_mktsegment string, split string").csv(p)


@query("s15_upsert", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders
""")
def s15(spark, sf):
    """Half of the orders, then a third of all with another price, then the rest; the last load runs twice."""
    p = _place(spark, "s15")
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    third = F.col("o_orderkey") % 3 == 0
    state.upsert(spark, p, o.filter("o_orderkey % 2 = 0"), "o_orderkey")
    state.upsert(spark, p, o.filter(third).withColumn("price", F.col("price") + 1), "o_orderkey")
    rest = o.filter(~third & (F.col("o_orderkey") % 2 != 0))
    state.upsert(spark, p, rest, "o_orderkey")
    again = state.upsert(spark, p, rest, "o_orderkey")
    if again[0]:
        raise RuntimeError("a replay inserted rows")
    return state.read_table(spark, p)


@query("s16_append_quarantine", sql="""
SELECT 'orders' AS source, CAST(o_orderkey AS VARCHAR) AS record_id FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0
""")
def s16(spark, sf):
    p = _place(spark, "s16")
    rows = t(spark, sf, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").cast("string").alias("record_id"), "o_orderkey")
    for cond in ("o_orderkey % 5 = 0", "o_orderkey % 3 = 0", "o_orderkey % 15 = 0"):
        state.append_keyed(spark, p, rows.filter(cond).drop("o_orderkey"), ["source", "record_id"])
    return state.read_table(spark, p)


@query("s17_audit_runs", sql="""
SELECT 'run-' || CAST(r AS VARCHAR) AS run_id, CASE WHEN r = 2 THEN 'SUCCESS' ELSE 'FAIL' END AS status, CAST((SELECT count(*) FROM orders) AS VARCHAR) AS source_rows
FROM range(1, 4) t(r)
""")
def s17(spark, sf):
    """Three failed runs, one of which is repeated with success: a row a run id."""
    p, n = _place(spark, "s17"), t(spark, sf, "orders").count()
    for r, status in ((1, "FAIL"), (2, "FAIL"), (3, "FAIL"), (2, "SUCCESS")):
        state.audit_run(spark, p, {"run_id": f"run-{r}", "status": status, "source_rows": n})
    return state.read_table(spark, p).select("run_id", "status", "source_rows")


@query("s20_manifest", sql="SELECT count(*) AS rows, max(o_orderkey) AS last_key FROM orders")
def s20(spark, sf):
    p, o = _place(spark, "s20"), t(spark, sf, "orders")
    got = o.agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("last_key")).first().asDict()
    sinks.write_manifest(spark, p, got)
    back = sinks.read_manifest(spark, p)
    return readers.frame(spark, [(back["rows"], back["last_key"])], "rows long, last_key long")


@query("s21_same_rows", sql="SELECT true AS same_after_round_trip, false AS same_with_a_row_changed, count(*) AS n FROM orders")
def s21(spark, sf):
    p, o = _place(spark, "s21"), t(spark, sf, "orders")
    sinks.write_parquet(o, p, ["o_orderstatus"])
    back = spark.read.parquet(p)
    one = o.agg(F.min("o_orderkey")).first()[0]
    changed = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") == one, -1.0).otherwise(F.col("o_totalprice")))
    return o.agg(F.lit(sinks.same_rows(o, back)).alias("same_after_round_trip"),
                 F.lit(sinks.same_rows(o, changed)).alias("same_with_a_row_changed"), F.count(F.lit(1)).alias("n"))


@query("s26_required_columns", sql="SELECT 'missing columns: [''nope'']' AS message, count(*) AS n FROM part")
def s26(spark, sf):
    p = RL.require_columns(t(spark, sf, "part"), ["p_partkey", "p_name"])
    try:
        RL.require_columns(p, ["p_partkey", "nope"])
        message = None
    except ValueError as e:
        message = str(e)
    return p.agg(F.lit(message).alias("message"), F.count(F.lit(1)).alias("n"))


@query("p09_normalise_headers", sql="SELECT p_partkey, p_size FROM part")
def p09(spark, sf):
    return RL.normalise_headers(t(spark, sf, "part").select(F.col("p_partkey").alias(" P_PartKey "), F.col("p_size").alias("P_SIZE")))


@query("p10_provenance", sql="""
SELECT o_orderkey, 'orders_db' AS source_system, 'batch-1' AS batch_id, 'run-1' AS run_id, TIMESTAMP '2024-05-06 07:08:09' AS ingested_at FROM orders
""")
def p10(spark, sf):
    out = RL.with_provenance(t(spark, sf, "orders").select("o_orderkey"), "orders_db", "batch-1", "run-1", "2024-05-06 07:08:09")
    return out.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


@query("f08_parse_formats", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 2 THEN date_trunc('day', o_orderdate) ELSE date_trunc('second', o_orderdate) END AS parsed FROM orders
""")
def f08(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")) \
        .when(k == 2, F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(F.lit("no date "), F.date_format(d, "yyyy")))
    return t(spark, sf, "orders").select("o_orderkey", D.parse_timestamp(text).alias("parsed"))


@query("t06_leak_detector", sql="""
SELECT count(*) AS n, true AS clean_passes, true AS moved_row_fails FROM documents
""")
def t06(spark, sf):
    """A family split passes; the same split with one document moved to another part does not."""
    from cauce.plans.textops import split_docs
    d = split_docs(spark, sf)
    one = d.agg(F.min("doc_id")).first()[0]
    moved = d.withColumn("split", F.when(F.col("doc_id") == one, F.when(F.col("split") == "train", "test").otherwise("train")).otherwise(F.col("split")))
    families = lambda x: x.groupBy("source").agg(F.count_distinct("split").alias("k")).agg(
        F.count_if(F.col("k") > 1).alias("families_in_several_splits"))

    def passes(x):
        try:
            C.assert_split_ok(families(x))
            return True
        except ValueError:
            return False
    return d.agg(F.count(F.lit(1)).alias("n"), F.lit(passes(d)).alias("clean_passes"), F.lit(not passes(moved)).alias("moved_row_fails"))
