"""Gate, reconciliation, upsert idempotency, watermark, audit, quarantine."""

from pyspark.sql import functions as F

from cauce.operators.quality import gate_outcome, quality_gate, reason_histogram
from cauce.sources import state


def _metrics(spark, rows, unmatched):
    return spark.createDataFrame([(rows, unmatched / rows if rows else None)], "rows long, unmatched_tarifa_rate double")


def test_gate_fails_on_unmatched_rates(spark):
    g = quality_gate(_metrics(spark, 100, 10), {"unmatched_tarifa_rate": ("max", 0.05)})
    out = gate_outcome(g)
    assert out["status"] == "FAIL" and out["failures"] == ["unmatched_tarifa_rate"]


def test_gate_passes_and_empty_batch_passes(spark):
    assert gate_outcome(quality_gate(_metrics(spark, 100, 1), {"unmatched_tarifa_rate": ("max", 0.05)}))["status"] == "PASS"
    empty = spark.createDataFrame([(0, None)], "rows long, unmatched_tarifa_rate double")
    assert gate_outcome(quality_gate(empty, {"unmatched_tarifa_rate": ("max", 0.05)}))["status"] == "PASS"


def test_gate_range_check(spark):
    m = spark.createDataFrame([(5,)], "rows long")
    assert gate_outcome(quality_gate(m, {"rows": ("range", (10, 20))}))["failures"] == ["rows"]


def test_upsert_idempotent(spark, tmp_table_dir):
    rows = spark.createDataFrame([("A1", 500.0), ("A2", 300.0)], "appointment_id string, amount double")
    assert state.upsert(spark, tmp_table_dir, rows, "appointment_id") == (2, 0)
    assert state.upsert(spark, tmp_table_dir, rows, "appointment_id") == (0, 2)
    assert state.read_table(spark, tmp_table_dir).count() == 2


def test_upsert_replaces_values(spark, tmp_table_dir):
    state.upsert(spark, tmp_table_dir, spark.createDataFrame([("A1", 1.0)], "k string, v double"), "k")
    state.upsert(spark, tmp_table_dir, spark.createDataFrame([("A1", 2.0), ("A3", 3.0)], "k string, v double"), "k")
    got = {r["k"]: r["v"] for r in state.read_table(spark, tmp_table_dir).collect()}
    assert got == {"A1": 2.0, "A3": 3.0}


def test_upsert_rejects_duplicate_updates(spark, tmp_table_dir):
    import pytest
    dup = spark.createDataFrame([("A1", 1.0), ("A1", 2.0)], "k string, v double")
    with pytest.raises(ValueError):
        state.upsert(spark, tmp_table_dir, dup, "k")


def test_quarantine_append_is_keyed(spark, tmp_table_dir):
    q = spark.createDataFrame([("b1", "appointments", "A1", "x_null")], "batch_id string, source string, record_id string, reject_reason string")
    assert state.append_keyed(spark, tmp_table_dir, q, ["batch_id", "source", "record_id"]) == 1
    assert state.append_keyed(spark, tmp_table_dir, q, ["batch_id", "source", "record_id"]) == 0
    assert state.read_table(spark, tmp_table_dir).count() == 1


def test_watermark_default_and_keeps_other_keys(spark, tmp_table_dir):
    p = f"{tmp_table_dir}/wm"
    assert state.read_watermark(spark, p) == "2024-01-01 00:00:00"
    spark.createDataFrame([{"other": "keep-me"}]).coalesce(1).write.json(p)
    state.write_watermark(spark, p, "2024-02-01 10:00:00")
    r = spark.read.json(p).first()
    assert r["last_created_at"] == "2024-02-01 10:00:00" and r["other"] == "keep-me"


def test_incremental_scan_is_strict(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id int, ts timestamp")
    assert [r[0] for r in state.incremental_scan(df, "ts", "2024-01-01 00:00:00").collect()] == [2]


def test_audit_insert_or_replace(spark, tmp_table_dir):
    state.audit_run(spark, tmp_table_dir, {"run_id": "r1", "status": "FAIL"})
    state.audit_run(spark, tmp_table_dir, {"run_id": "r1", "status": "SUCCESS", "inserted": 3})
    rows = state.read_table(spark, tmp_table_dir).collect()
    assert len(rows) == 1 and rows[0]["status"] == "SUCCESS" and rows[0]["inserted"] == "3"


def test_reason_histogram(spark):
    q = spark.createDataFrame([("a;b",), ("a",), ("",)], "reject_reason string")
    got = {r["reason"]: (r["n"], r["share_pct"]) for r in reason_histogram(q).collect()}
    assert got == {"a": (2, 66.67), "b": (1, 33.33)}


def test_governed_etl_statuses(spark, tmp_table_dir):
    from cauce.plans.jobs import governed_etl
    sf = "/root/testdata/sf0.001"
    r1 = governed_etl(spark, sf, tmp_table_dir, run_id="r1")
    r2 = governed_etl(spark, sf, tmp_table_dir, run_id="r2")
    assert r1["status"] == "SUCCESS" and r1["inserted"] > 0
    assert r2["status"] == "SUCCESS_EMPTY"
    strict = {"completeness": ("min", 1.01)}
    r3 = governed_etl(spark, sf, f"{tmp_table_dir}-gate", run_id="r3", gate=strict)
    assert r3["status"] == "FAILED_QUALITY_GATE"
    audit = {r["run_id"]: r["status"] for r in state.read_table(spark, f"{tmp_table_dir}/etl_runs").collect()}
    assert audit == {"r1": "SUCCESS", "r2": "SUCCESS_EMPTY"}
    assert state.read_table(spark, f"{tmp_table_dir}-gate/fact") is None


def test_leftover_of_a_killed_load_does_not_block(spark, tmp_table_dir):
    import pathlib
    from cauce.sources import state
    rows = lambda *ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k long, v string")
    assert state.upsert(spark, tmp_table_dir, rows(1, 2), "k") == (2, 0)
    base = pathlib.Path(tmp_table_dir.removeprefix("file:"))
    (base / "v=2" / "_temporary").mkdir(parents=True)
    (base / "v=2" / "part-0.parquet").write_bytes(b"half a file")
    assert state.current_version(spark, tmp_table_dir) == 1
    assert state.upsert(spark, tmp_table_dir, rows(2, 3), "k") == (1, 1)
    assert sorted(r.k for r in state.read_table(spark, tmp_table_dir).collect()) == [1, 2, 3]
    for k in range(10, 16):
        state.upsert(spark, tmp_table_dir, rows(k), "k")
    assert len(list(base.glob("v=*"))) <= state.KEEP_VERSIONS + 1


def test_killed_mark_write_keeps_a_mark(spark, tmp_table_dir):
    import pathlib
    import shutil

    from cauce.sources import state
    p = f"{tmp_table_dir}/mark"
    state.write_watermark(spark, p, "2024-02-01 00:00:00")
    beside = pathlib.Path(f"{p}__next".removeprefix("file:"))
    (beside / "_temporary").mkdir(parents=True)                      # killed while writing
    assert state.read_watermark(spark, p) == "2024-02-01 00:00:00"
    state.write_watermark(spark, p, "2024-03-01 00:00:00")
    assert state.read_watermark(spark, p) == "2024-03-01 00:00:00" and not beside.exists()
    spark.createDataFrame([{"last_created_at": "2024-04-01 00:00:00"}]).coalesce(1).write.json(f"{p}__next")
    assert state.read_watermark(spark, p) == "2024-04-01 00:00:00"   # killed before the move
    shutil.rmtree(p.removeprefix("file:"))
    assert state.read_watermark(spark, p) == "2024-04-01 00:00:00"   # killed in the middle of it
    state.write_watermark(spark, p, "x", key="other")
    assert state.read_watermark(spark, p) == "2024-04-01 00:00:00" and state.read_watermark(spark, p, key="other") == "x"


def test_rows_that_arrive_during_a_load_wait_for_the_next(spark, tmp_table_dir):
    """The mark and the load both stop at what the first scan saw."""
    from pyspark.sql import functions as F

    from cauce.plans import jobs
    from cauce.sources import state
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    cut = orders.agg(F.expr("percentile_approx(o_orderdate, 0.5)")).first()[0]
    source = f"{tmp_table_dir}/source"
    orders.filter(F.col("o_orderdate") <= F.lit(cut)).write.parquet(source)
    seen = []

    def gate_then_append(gate, real=jobs.Q.gate_outcome):
        if not seen:  # in the middle of the first run the source grows
            seen.append(1)
            orders.filter(F.col("o_orderdate") > F.lit(cut)).write.mode("append").parquet(source)
        return real(gate)

    jobs.Q.gate_outcome, real = gate_then_append, jobs.Q.gate_outcome
    try:
        first = jobs.governed_etl(spark, sf, f"{tmp_table_dir}/job", source=spark.read.parquet(source))
    finally:
        jobs.Q.gate_outcome = real
    assert first["watermark_after"] == str(cut)
    second = jobs.governed_etl(spark, sf, f"{tmp_table_dir}/job", source=spark.read.parquet(source))
    assert first["source_rows"] + second["source_rows"] == orders.count()
    whole = jobs.governed_etl(spark, sf, f"{tmp_table_dir}/whole")
    assert state.read_table(spark, f"{tmp_table_dir}/job/fact").count() == whole["valid_rows"]
