"""Streaming queries (X01, X02): bounded availableNow runs over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cauce.operators import quality as Q
from cauce.operators.contracts import apply_contract
from cauce.plans.facts import t
from cauce.plans.quality import ORDERS, ORDERS_SQL, valid_customers
from cauce.plans.registry import query
from cauce.session import scratch_path
from cauce.sources import periods, state
from cauce.streaming.incremental import dedupe_stream, file_stream, incremental_ingest, run_to_parquet


def _run_dir(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


#: A batch in which more rows than this fail their contract is not loaded at all.
X01_GATE = {"reject_rate": ("max", 0.9)}


def _arrive(df, folder: str, take) -> None:
    """One added batch of as many files as it has parts, which the next run takes whole."""
    df.write.mode("append").parquet(folder)
    take()


@query("x01_incremental_ingest", sql=f"""
WITH {ORDERS_SQL}
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM ord_chk WHERE reject_reason = ''
""")
def x01(spark, sf):
    """Four batches of files, one a run: the stream ends after each and is restarted on its checkpoint; the
    last batch repeats rows that are already loaded."""
    base = _run_dir(spark, "x01")
    orders = t(spark, sf, "orders")
    parents = valid_customers(spark, sf).select("c_custkey")
    target, quarantine, folder = f"{base}/fact", f"{base}/quarantine", f"{base}/incoming"

    def handle(batch, epoch):
        checked = apply_contract(batch, ORDERS, {"o_custkey": parents}).persist()
        try:
            rate = checked.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.try_divide(F.count_if(F.size("reject_reasons") > 0).cast("double"),
                                                       F.count(F.lit(1))), F.lit(0.0)).alias("reject_rate"))
            passed = Q.gate_outcome(Q.quality_gate(rate, X01_GATE))["status"] == "PASS"
            ok = (F.size("reject_reasons") == 0) & F.lit(passed)
            reason = F.when(F.size("reject_reasons") > 0, F.col("reject_reason")).otherwise(F.lit("quality_gate"))
            state.append_keyed(spark, quarantine, checked.filter(~ok).select(
                F.lit("orders").alias("source"), F.lit(f"epoch-{epoch}").alias("batch_id"),
                F.col("o_orderkey").cast("string").alias("record_id"), reason.alias("reject_reason")),
                ["source", "record_id"])
            if passed:
                periods.upsert_periods(spark, target, checked.filter(ok).select(
                    "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate"), "o_orderkey",
                    periods.month_of("o_orderdate"))
        finally:
            checked.unpersist()

    def ingest():
        incremental_ingest(file_stream(spark, folder, orders.schema), handle, f"{base}/_checkpoint")

    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    for k in (0, 1, 2, 1):
        _arrive(orders.filter(part == k), folder, ingest)
    return state.read_table(spark, target).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query("x02_stream_dedupe", sql="SELECT event_id, user_id, event_type FROM events")
def x02(spark, sf):
    """Events in time order over three runs, then the middle ones again.  Copies within the delay are
    known, older ones are late; either way each event comes out once and state is dropped behind the
    watermark."""
    base = _run_dir(spark, "x02")
    events = t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    lo, mid, hi = events.agg(F.percentile_approx(F.unix_micros("ts"), [0.0, 0.33, 0.66]).alias("p")).first()["p"]
    at = F.unix_micros("ts")
    files = [events.filter(at < mid), events.filter((at >= mid) & (at < hi)), events.filter(at >= hi)]
    # some events come twice in one batch
    files = [f.unionByName(f.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0)) for f in files]
    folder = f"{base}/incoming"

    def dedupe():
        s = dedupe_stream(file_stream(spark, folder, events.schema), ["event_id"], "ts", "1 hour")
        run_to_parquet(s.select("event_id", "user_id", "event_type", "ts"), f"{base}/out", f"{base}/_checkpoint")

    for batch in (*files, files[1]):
        _arrive(batch, folder, dedupe)
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type")
