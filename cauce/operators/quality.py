"""Reconciliation, quality gates and post-load assertions.

Metrics are one aggregate row computed in a single pass; the gate compares
that row with thresholds as column expressions, so the decision itself is a
(one-row) DataFrame.  Only that one row ever reaches the driver, for control
flow (:func:`gate_outcome`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reconcile(df: DataFrame, key: str, lookups=(), amount: str | None = None,
              distinct_cols=(), rows_before: int | Column | None = None) -> DataFrame:
    """Rows, matched/unmatched per lookup column, duplicate keys, distincts, totals."""
    aggs = [F.count(F.lit(1)).alias("rows_after"),
            (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys")]
    for lk in lookups:
        aggs += [F.count_if(F.col(lk).isNotNull()).alias(f"matched_{lk}"),
                 F.count_if(F.col(lk).isNull()).alias(f"unmatched_{lk}")]
    for c in distinct_cols:
        aggs.append(F.count_distinct(c).alias(f"distinct_{c}"))
    if amount:
        aggs += [F.round(F.sum(amount), 2).alias(f"total_{amount}"),
                 F.round(F.avg(amount), 2).alias(f"avg_{amount}")]
    out = df.agg(*aggs)
    if rows_before is not None:
        out = out.withColumn("rows_before", F.lit(rows_before) if not isinstance(rows_before, Column)
                             else rows_before)
    return out


def completeness(df: DataFrame, required) -> Column:
    """Share of rows with every required column non-null (aggregate expression)."""
    ok = None
    for c in required:
        ok = F.col(c).isNotNull() if ok is None else ok & F.col(c).isNotNull()
    return F.try_divide(F.count_if(ok).cast("double"), F.count(F.lit(1)))


def quality_gate(metrics: DataFrame, thresholds: dict, rows_col: str = "rows") -> DataFrame:
    """PASS/FAIL plus the names of failed checks.

    ``thresholds`` maps a metric column to ``("min", x)``, ``("max", x)`` or
    ``("range", (lo, hi))``.  An empty batch passes.  A null metric fails
    (it could not be measured).
    """
    fails = []
    for m, (kind, val) in thresholds.items():
        v = F.col(m)
        if kind == "min":
            bad = v.isNull() | (v < val)
        elif kind == "max":
            bad = v.isNull() | (v > val)
        elif kind == "range":
            bad = v.isNull() | (v < val[0]) | (v > val[1])
        else:
            raise ValueError(kind)
        fails.append(F.when(bad, F.lit(m)))
    failures = F.array_compact(F.array(*fails)) if fails else F.array().cast("array<string>")
    empty = F.col(rows_col) == 0
    return metrics.withColumn("failures", F.when(empty, F.array().cast("array<string>")).otherwise(failures)) \
        .withColumn("failed_checks", F.array_join("failures", ";")) \
        .withColumn("quality_status", F.when(F.size("failures") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")))


def gate_outcome(gate: DataFrame) -> dict:
    """Driver-side decision from the one-row gate frame."""
    r = gate.select("quality_status", "failures").first()
    return {"status": r["quality_status"], "failures": list(r["failures"] or [])}


def violation_counts(df: DataFrame, checks: dict) -> DataFrame:
    """One row of violation counts, one column per named predicate."""
    return df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in checks.items()])


def assert_no_violations(counts: DataFrame) -> None:
    """Raise listing every non-zero violation count."""
    r = counts.first().asDict()
    bad = {k: v for k, v in r.items() if v}
    if bad:
        raise AssertionError(f"post-load assertions failed: {bad}")


def idempotency(df: DataFrame, keys, show: int = 5):
    """(summary row: total vs distinct keys, duplicated key sample)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    k = F.struct(*[F.col(c) for c in keys])
    summary = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(k).alias("distinct_keys")) \
        .withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys"))
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .orderBy(F.desc("n"), *keys).limit(show)
    return summary, dups


def reason_histogram(rejects: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """Reasons split on ';', counted, with share of all reasons."""
    r = rejects.select(F.explode(F.split(F.col(reason_col), ";")).alias("reason")) \
        .filter(F.col("reason") != "")
    total = r.agg(F.count(F.lit(1))).scalar()
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("share_pct", F.round(F.col("n") * 100.0 / total, 2))


def join_loss(steps) -> DataFrame:
    """Rows lost per inner-join step: ``[(name, left, right, keys)]``.

    Each loss is a ``left_anti`` count; all steps are one union of aggregates.
    """
    frames = []
    for name, left, right, keys in steps:
        keys_r = right.select(*keys).distinct()
        frames.append(left.join(keys_r, keys, "left_anti")
                      .agg(F.count(F.lit(1)).alias("rows_lost"))
                      .withColumn("rows_in", F.lit(None).cast("long"))
                      .select(F.lit(name).alias("step"), "rows_lost"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def against_expected(census: DataFrame, expected: DataFrame) -> DataFrame:
    """``(check, found, expected, ok)`` of a one-row census against expected counts ``(check, expected)``.

    A check that only one side knows is not ok; its other count is null."""
    found = census.unpivot([], list(census.columns), "check", "found")
    both = found.join(expected, "check", "full_outer")
    return both.select("check", "found", "expected", F.coalesce(F.col("found") == F.col("expected"), F.lit(False)).alias("ok"))
