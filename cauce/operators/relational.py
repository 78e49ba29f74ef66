"""Relational operators that add semantics on top of Spark's join/select.

Scale notes
-----------
* Dimension tables are broadcast only through :func:`sized_broadcast`, which
  proves the row bound with a ``limit(n + 1).count()`` before hinting; above
  the bound the plan falls back to a shuffle join (AQE may still convert it
  at runtime from real statistics).
* "Keep first / latest per key" is an aggregate (``min_by``/``max_by``), not
  a window: partial aggregation keeps a hot key from landing in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 1_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------- schema helpers
def require_columns(df: DataFrame, required) -> DataFrame:
    """Raise with the missing list; returns ``df`` for chaining."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-cased, stripped column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def conform(df: DataFrame, mapping: dict) -> DataFrame:
    """rename/reorder to an output contract ``{out_name: source}``."""
    return df.select([_c(src).alias(out) for out, src in mapping.items()])


# ---------------------------------------------------------------- predicates
def split_valid(df: DataFrame, predicate: Column):
    """(valid, rejected), disjoint and complete.

    A null predicate counts as *not valid*, so rows are never lost to
    three-valued logic (``filter(~p)`` would drop them).
    """
    ok = F.coalesce(predicate, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def with_provenance(df: DataFrame, source_system: str, batch_id: str, run_id: str,
                    ingested_at) -> DataFrame:
    """P10: provenance columns; one timestamp literal per run."""
    return df.withColumns({
        "source_system": F.lit(source_system),
        "batch_id": F.lit(batch_id),
        "run_id": F.lit(run_id),
        "ingested_at": F.lit(ingested_at).cast("timestamp"),
    })


def sequence_id(df: DataFrame, order_cols, name: str = "row_id", start: int = 1) -> DataFrame:
    """Contiguous ids in a declared total order without a global window.

    Rows are range-partitioned by the order, numbered inside each partition,
    and shifted by the row count of all earlier partitions.  Only one row per
    partition (the counts) is ever combined, so no task sees the whole table.
    """
    cols = [_c(c) for c in order_cols]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    # partition ids and positions are non-deterministic across re-executions and the
    # frame is read twice (counts and join back): materialise it once
    tagged = ranged.withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_mono", F.monotonically_increasing_id()).checkpoint(eager=True)
    # monotonically_increasing_id = (pid << 33) + local index
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))) \
        .select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = tagged.join(F.broadcast(offsets), "_pid") \
        .withColumn(name, (local + F.col("_off") + F.lit(start)).cast("long"))
    return out.drop("_pid", "_mono", "_off")


def row_hash_id(df: DataFrame, cols=None, name: str = "row_id") -> DataFrame:
    """P11 alternative when no order exists: 64-bit hash of the row values."""
    cols = cols or df.columns
    return df.withColumn(name, F.xxhash64(*[_c(c) for c in cols]))


# -------------------------------------------------------------------- joins
_PROVEN: dict = {}


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, cache_key=None) -> DataFrame:
    """Hint a broadcast only after proving ``count <= max_rows``.

    The probe is ``limit(max_rows + 1).count()``: it stops reading as soon as
    the bound is exceeded, so it is cheap for both small and large inputs.
    ``cache_key`` (for immutable inputs such as a dimension file) remembers the
    proof for the rest of the application, so repeated queries skip the probe.
    """
    key = (df.sparkSession.sparkContext.applicationId, cache_key, max_rows) if cache_key else None
    if key is not None and key in _PROVEN:
        small = _PROVEN[key]
    else:
        small = df.limit(max_rows + 1).count() <= max_rows
        if key is not None:
            _PROVEN[key] = small
    return F.broadcast(df) if small else df


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """A lookup must have unique keys or a left join multiplies rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    dup = df.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if dup:
        raise ValueError(f"lookup keys not unique, e.g. {[tuple(r)[:-1] for r in dup]}")
    return df


def dedupe_lookup(dim: DataFrame, keys, order_col: str, last_wins: bool = True) -> DataFrame:
    """One row per key; with duplicate keys the last row (by ``order_col``) wins."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in dim.columns if c not in keys]
    pick = F.max_by if last_wins else F.min_by
    row = pick(F.struct(*others), F.col(order_col))
    return dim.groupBy(*keys).agg(row.alias("_r")).select(*keys, "_r.*")


def left_join_indicator(left: DataFrame, right: DataFrame, on, suffix: str = "_right",
                        flag: str = "_merge") -> DataFrame:
    """Left join with ``both``/``left_only`` and suffixed same-name columns."""
    on = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    r = right.select(*on, *[F.col(c).alias(c + suffix if c in clash else c)
                            for c in right.columns if c not in on], F.lit(True).alias("_hit"))
    out = left.join(r, on, "left")
    return out.withColumn(flag, F.when(F.col("_hit"), F.lit("both")).otherwise(F.lit("left_only"))) \
        .drop("_hit")


def lookup_struct(df: DataFrame, dim: DataFrame, key: str, fields, name: str) -> DataFrame:
    """Attach ``struct(fields)`` from ``dim``; miss -> struct of nulls."""
    d = dim.select(F.col(key), F.struct(*fields).alias("_s"), F.lit(True).alias("_hit"))
    j = df.join(d, key, "left")
    nulls = F.struct(*[F.lit(None).cast(dim.schema[f].dataType).alias(f) for f in fields])
    return j.withColumn(name, F.when(F.col("_hit"), F.col("_s")).otherwise(nulls)).drop("_s", "_hit")


def unknown_keys(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct keys of ``df`` absent from ``dim`` (null-safe anti-join)."""
    dim_key = dim_key or key
    d = dim.select(F.col(dim_key).alias(key))
    return df.select(key).filter(F.col(key).isNotNull()).join(d, key, "left_anti").distinct()


def homologate(df: DataFrame, col: str, catalogue: DataFrame, out: str,
               keep_original: bool = False) -> DataFrame:
    """Normalise spelling, look up the canonical value; miss -> null or original.

    ``catalogue`` has ``(alias_norm, canonical)`` with unique aliases (S07).
    It is bounded by the catalogue size, hence a checked broadcast.
    """
    from cauce.functions.strings import norm_key, strip_quotes
    key = norm_key(strip_quotes(F.col(col)))
    cat = sized_broadcast(catalogue.select(F.col("alias_norm").alias("_alias"),
                                           F.col("canonical").alias("_canon")))
    j = df.withColumn("_alias", key).join(cat, "_alias", "left")
    val = F.coalesce(F.col("_canon"), F.col(col)) if keep_original else F.col("_canon")
    return j.withColumn(out, val).drop("_alias", "_canon")


# ----------------------------------------------------------------- dedupe
def keep_first(df: DataFrame, keys, order_cols, keep: str = "first") -> DataFrame:
    """One row per key, first (or last) by an explicit total order.

    Implemented as ``groupBy(keys).agg(min_by(struct(all), struct(order)))``.
    Rows of variable size make this a sort aggregate, but a partial one: a key
    holding a third of the table is reduced on every mapper before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = F.struct(*[_c(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in df.columns])
    pick = F.min_by if keep == "first" else F.max_by
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]) \
        .agg(pick(payload, order).alias("_r")).select("_r.*")


def top_n_per_group(df: DataFrame, group_cols, order_cols, n: int, salt: int = 16,
                    rank_col: str = "rn") -> DataFrame:
    """First ``n`` rows per group by ``order_cols`` (ties broken by them).

    Two phases: rows are first ranked inside ``(group, salt)`` sub-groups so a
    hot group is spread over ``salt`` tasks; only ``n * salt`` candidates per
    group reach the final ranking.  Exact: every global top-n row is in the
    top-n of its own sub-group.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    ords = [_c(c) for c in order_cols]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*ords)
    cand = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= n)
    w2 = Window.partitionBy(*group_cols).orderBy(*ords)
    return cand.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= n) \
        .drop("_salt", "_r1")


def union_aligned(frames, allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def integrate_with_rejects(base: DataFrame, lookups, extra_rules=()):
    """Enrich ``base`` through left lookups and collect every failed rule.

    ``lookups`` is ``[(dim, key, reason)]``: a row whose key is absent from
    ``dim`` gets ``reason``.  ``extra_rules`` is ``[(reason, bad_predicate)]``.
    Returns ``(curated, rejected)``; rejected rows carry ``reject_reason``
    (all reasons joined by ';', in the listed order).
    """
    out = base
    flags = []
    for i, (dim, key, reason) in enumerate(lookups):
        d = dim.withColumn(f"_hit{i}", F.lit(True))
        out = out.join(d, key, "left")
        flags.append((reason, F.col(f"_hit{i}").isNull()))
    checks = flags + list(extra_rules)
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(r)) for r, bad in checks]))
    out = out.withColumn("reject_reason", F.array_join(reasons, ";")) \
        .drop(*[f"_hit{i}" for i in range(len(lookups))])
    ok = out.filter(F.col("reject_reason") == "").drop("reject_reason")
    return ok, out.filter(F.col("reject_reason") != "")


def asof_lookup(events: DataFrame, rates: DataFrame, key: str, event_ts: str, rate_ts: str, value: str,
                out: str | None = None) -> DataFrame:
    """J04 ``as_of``: the ``value`` in force at each event (latest rate with ``rate_ts <= event_ts``).

    Rates must be unique per (key, rate_ts).  Events and rates are unioned,
    ordered by (key, time, rates before events at equal time) and the last
    rate is carried forward; range partitioning spreads a hot key.
    """
    from cauce.operators.sequential import forward_fill
    out = out or value
    vt = rates.schema[value].dataType
    e = events.withColumn("_k", F.col(key)).withColumn("_t", F.col(event_ts)) \
        .withColumn("_kind", F.lit(1)).withColumn("_v", F.lit(None).cast(vt)) \
        .withColumn("_rid", F.monotonically_increasing_id())
    r = rates.select(F.col(key).alias("_k"), F.col(rate_ts).alias("_t"), F.lit(0).alias("_kind"),
                     F.col(value).alias("_v"), F.lit(-1).cast("long").alias("_rid"))
    u = e.unionByName(r, allowMissingColumns=True)
    filled = forward_fill(u, ["_k"], ["_t", "_kind", "_rid"], "_v", "_asof")
    return filled.filter(F.col("_kind") == 1).withColumn(out, F.col("_asof")) \
        .drop("_k", "_t", "_kind", "_v", "_rid", "_asof")
