"""Window-style operators (W*).

Windows here run on *aggregated* inputs (branch x month, count levels) or on
keys that are spread by salting.  Whole-table orderings (Lorenz curve,
top-30 % share) are computed on the histogram of per-key counts, whose size
is bounded by the number of distinct count values (at most sqrt(2N)), not by
the number of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.functions.numeric import safe_div


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lag_change(df: DataFrame, part, order, value: str, prev_name: str | None = None,
               pct_name: str = "pct_change", scale: int = 2) -> DataFrame:
    """Previous value within ``part`` by ``order`` and % change (NULLIF prev 0)."""
    w = Window.partitionBy(*([part] if isinstance(part, str) else part)).orderBy(order)
    prev_name = prev_name or f"{value}_prev"
    return df.withColumn(prev_name, F.lag(value).over(w)) \
        .withColumn(pct_name, F.round(safe_div(F.col(value) - F.col(prev_name), F.col(prev_name)) * 100,
                                      scale))


def trend_label(pct: Column, up: str = "Aumento", down: str = "Disminución",
                flat: str = "Sin cambio") -> Column:
    """Label of a change (null counts as no change)."""
    return F.when(pct > 0, F.lit(up)).when(pct < 0, F.lit(down)).otherwise(F.lit(flat))


def moving_range(df: DataFrame, order, value: str, part=(), name: str = "moving_range") -> DataFrame:
    """|x_t - x_{t-1}| along ``order`` (a total order) within ``part``.

    Uses the range-partitioned lag, so neither a whole-table series nor a hot
    ``part`` key is processed by a single task.
    """
    from cauce.operators.sequential import ordered_lag
    order = [order] if isinstance(order, str) else list(order)
    lagged = ordered_lag(df, list(part), order, value, "_prev")
    return lagged.withColumn(name, F.abs(F.col(value) - F.col("_prev"))).drop("_prev")


def count_levels(df: DataFrame, key) -> DataFrame:
    """Histogram of per-key row counts: (count_value, n_keys)."""
    per_key = df.groupBy(_c(key)).agg(F.count(F.lit(1)).alias("cnt"))
    return per_key.groupBy("cnt").agg(F.count(F.lit(1)).alias("n_keys"))


def lorenz_levels(df: DataFrame, key) -> DataFrame:
    """Cumulative share of keys and of rows, keys ordered by count desc.

    One row per distinct count level (the curve is linear between levels).
    The window runs over the count histogram only.
    """
    lv = count_levels(df, key).withColumn("rows", F.col("cnt") * F.col("n_keys"))
    w = Window.orderBy(F.col("cnt").desc()).rowsBetween(Window.unboundedPreceding, 0)
    tot_keys = lv.agg(F.sum("n_keys")).scalar()
    tot_rows = lv.agg(F.sum("rows")).scalar()
    return lv.select(
        "cnt", "n_keys",
        F.sum("n_keys").over(w).alias("cum_keys"),
        F.sum("rows").over(w).alias("cum_rows"),
    ).withColumn("cum_key_share", F.col("cum_keys") / tot_keys) \
     .withColumn("cum_row_share", F.col("cum_rows") / tot_rows)


def top_share(df: DataFrame, key, fraction: float = 0.3) -> DataFrame:
    """Share of rows held by the top ``int(n_keys * fraction)`` keys, plus stats.

    The sum of the k largest counts does not depend on how ties are broken,
    so it is computed exactly from the count histogram.
    """
    lv = count_levels(df, key)
    w = Window.orderBy(F.col("cnt").desc()).rowsBetween(Window.unboundedPreceding, -1)
    n_keys = lv.agg(F.sum("n_keys")).scalar()
    k = F.floor(n_keys * F.lit(fraction)).cast("long")
    before = F.coalesce(F.sum("n_keys").over(w), F.lit(0))
    take = F.greatest(F.least(F.col("n_keys"), k - before), F.lit(0))
    parts = lv.withColumn("_take_rows", take * F.col("cnt"))
    return parts.agg(
        F.sum(F.col("cnt") * F.col("n_keys")).cast("long").alias("total_rows"),
        F.sum("n_keys").cast("long").alias("total_keys"),
        F.sum("_take_rows").cast("long").alias("top_rows"),
        F.max("cnt").cast("long").alias("max_per_key"),
        F.min("cnt").cast("long").alias("min_per_key"),
    ).withColumn("top_keys", F.floor(F.col("total_keys") * F.lit(fraction)).cast("long")) \
     .withColumn("top_share", F.col("top_rows") / F.col("total_rows")) \
     .withColumn("mean_per_key", F.col("total_rows") / F.col("total_keys"))


def share_of_group(df: DataFrame, group_cols, value: str, name: str = "share") -> DataFrame:
    """Value / group total, via an aggregate joined back.

    The totals are a partial-combined aggregate; the join back is a shuffle
    join that AQE's skew handling can split when one group is hot.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    tot = df.groupBy(*group_cols).agg(F.sum(value).alias("_group_total"))
    return df.join(tot, group_cols, "left").withColumn(name, F.col(value) / F.col("_group_total"))


def canonical_first(df: DataFrame, id_col: str, key_col: str, seq_col: str,
                    eligible: Column) -> DataFrame:
    """The first eligible id per key, and each later eligible row points to it.

    Returns the input plus ``canonical_id`` (null for non-eligible rows).
    """
    firsts = df.filter(eligible).groupBy(F.col(key_col).alias("_key")) \
        .agg(F.min_by(F.col(id_col), F.col(seq_col)).alias("canonical_id"))
    return df.join(firsts, df[key_col].eqNullSafe(firsts["_key"]), "left").drop("_key") \
        .withColumn("canonical_id", F.when(eligible, F.col("canonical_id")))
