"""Aggregation operators (G*): one hash aggregate each, partial combine first.

Results that need a grand total use a scalar subquery (``DataFrame.scalar``)
instead of a cross join or a window over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_counts(df: DataFrame, col, name: str = "value") -> DataFrame:
    """Absolute count and share of the total (null is its own value)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(_c(col).alias(name)).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("share", F.col("n") / total)


def distinct_counts(df: DataFrame, cols) -> DataFrame:
    """Exact distinct count per column, long form."""
    aggs = [F.count_distinct(F.col(c)).alias(c) for c in cols]
    wide = df.agg(*aggs)
    return long_form(wide, cols, "n_distinct")


def long_form(wide: DataFrame, cols, value_name: str, label: str = "column",
              keep=()) -> DataFrame:
    """Unpivot the named columns of a (small) wide frame."""
    return wide.unpivot(list(keep), list(cols), label, value_name)


def null_census(df: DataFrame, cols=None) -> DataFrame:
    """Null count and percentage per column in one pass."""
    cols = list(cols or df.columns)
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return long_form(wide, cols, "n_null", keep=["_rows"]) \
        .withColumn("pct_null", F.round(F.col("n_null") * 100.0 / F.col("_rows"), 4)) \
        .withColumnRenamed("_rows", "n_rows")


def absence_census(df: DataFrame, cols, marker: str = "__NULO__") -> DataFrame:
    """Null vs '' vs whitespace-only vs marker, per text column."""
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count_if(x.isNull()).alias(f"{c}__null"),
                 F.count_if(x == "").alias(f"{c}__empty"),
                 F.count_if(x.rlike(r"^\s+$")).alias(f"{c}__blank"),
                 F.count_if(x == marker).alias(f"{c}__marker")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     F.col(f"{c}__null").alias("n_null"), F.col(f"{c}__empty").alias("n_empty"),
                     F.col(f"{c}__blank").alias("n_blank"), F.col(f"{c}__marker").alias("n_marker"))
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def order_statistics(df: DataFrame, value: str, probs, group_cols=()) -> DataFrame:
    """``group_cols``, ``q``: the exact quantiles of a column a group, by distributed selection.

    Rows are first reduced to a histogram (value, count), with map-side
    combining, so a value that a third of the rows share is one row.  The
    histogram is range-partitioned by (group, value) and gets running totals
    stitched over the partitions, so no task holds all values, not even of one
    group.  A level p of a group of n values then needs two rows, those whose
    totals cover the ranks below and above ``p * (n - 1)``; between them it is
    interpolated as pandas and ``quantile_cont`` do.  Nulls and NaN don't
    count; a group without values gives nulls.
    """
    from cauce.operators.sequential import running_totals
    groups = list(group_cols)
    keys = [f"_g{i}" for i in range(len(groups))]
    named = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(value).cast("double").alias("_v"))
    present = F.col("_v").isNotNull() & ~F.isnan("_v")
    hist = named.filter(present).groupBy(*keys, "_v").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    totals = running_totals(hist, [*keys, "_v"], ["_n"])
    below = F.col("cum__n") - F.col("_n")
    sizes = totals.groupBy(*keys).agg(F.min(below).alias("_start"), F.sum("_n").alias("_size"))
    if keys:
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
        rows = totals.alias("t").join(sizes.alias("s"), on).select("t.*", "s._start", "s._size")
    else:
        # one row: a scalar subquery, no join of everything with one key
        one = sizes.select(F.struct("_start", "_size").alias("s")).scalar()
        rows = totals.withColumns({"_start": one["_start"], "_size": one["_size"]})
    lo, hi = F.col("cum__n") - F.col("_n") - F.col("_start"), F.col("cum__n") - F.col("_start")   # ranks lo <= r < hi
    picks = []
    for p in probs:
        h = F.lit(float(p)) * (F.col("_size") - 1)
        for r in (F.floor(h), F.ceil(h)):
            picks.append(F.max(F.when((lo <= r) & (r < hi), F.col("_v"))))
    agg = rows.groupBy(*keys).agg(F.max("_size").alias("_size"), F.array(*picks).alias("_x"))
    level = []
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("_size") - 1)
        x, y = F.col("_x")[2 * i], F.col("_x")[2 * i + 1]
        level.append(x + (h - F.floor(h)) * (y - x))
    out = agg.select(*keys, F.array(*level).alias("q"))
    if keys:
        # groups whose values are all null
        every = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"e.{k}").eqNullSafe(F.col(f"o.{k}"))
        out = every.alias("e").join(out.alias("o"), on, "left").select(*[f"e.{k}" for k in keys], "o.q")
    return out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], "q")


def quantiles(df: DataFrame, col, probs=(0.25, 0.5, 0.75, 0.9), group_cols=(),
              exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Quantiles with linear interpolation (pandas/DuckDB ``quantile_cont``).

    Exact ones by :func:`order_statistics`; ``exact=False`` takes ``percentile_approx``.
    """
    if exact:
        agg = order_statistics(df.withColumn("_value", _c(col)), "_value", probs, group_cols).withColumnRenamed("q", "_q")
    else:
        f = F.percentile_approx(_c(col), list(probs), accuracy).alias("_q")
        agg = df.groupBy(*group_cols).agg(f) if group_cols else df.agg(f)
    return agg.select(*group_cols, *[F.col("_q")[i].alias(f"p{int(round(p * 100))}")
                                     for i, p in enumerate(probs)])


def crosstab(df: DataFrame, row, col, values, normalize: bool = False) -> DataFrame:
    """Counts with a fixed column order; zero-filled; optional row shares."""
    pv = df.groupBy(_c(row).alias("row")).pivot(col if isinstance(col, str) else col, list(values)) \
        .count().fillna(0, subset=[str(v) for v in values])
    if normalize:
        tot = sum((F.col(f"`{v}`") for v in values), F.lit(0))
        pv = pv.select("row", *[(F.col(f"`{v}`") / tot).alias(str(v)) for v in values])
    return pv


def duplicate_counts(df: DataFrame, keys) -> DataFrame:
    """Extra occurrences (Σ(c-1)) and rows involved (Σc) over keys with c>1."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    g = df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return g.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("extra_rows"),
                 F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("rows_involved"),
                 F.count(F.lit(1)).alias("dup_keys"))


def near_duplicate_groups(df: DataFrame, keys, id_col: str, amount_col: str) -> DataFrame:
    """Same business key, several ids and several amounts."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(id_col).alias("n_ids"),
        F.count_distinct(amount_col).alias("n_amounts"),
    ).filter((F.col("n_ids") > 1) & (F.col("n_amounts") > 1))


def label_conflicts(df: DataFrame, key, label) -> DataFrame:
    """Keys carrying more than one distinct label."""
    return df.groupBy(_c(key).alias("key")).agg(
        F.count_distinct(_c(label)).alias("n_labels"), F.count(F.lit(1)).alias("n_rows")
    ).filter("n_labels > 1")


def mode(df: DataFrame, col, group_cols=()) -> DataFrame:
    """Most frequent value; ties -> smallest value (deterministic)."""
    g = df.filter(_c(col).isNotNull()).groupBy(*group_cols, _c(col).alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    # order struct: highest count first, then smallest value
    pick = F.min_by(F.col("_v"), F.struct(-F.col("_n"), F.col("_v")))
    return (g.groupBy(*group_cols).agg(pick.alias("mode")) if group_cols
            else g.agg(pick.alias("mode")))


def describe_long(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample std, min, max per numeric column (long form)."""
    rows = []
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        rows.append(F.struct(F.lit(c).alias("column"),
                             F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
                             F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"),
                             F.col(f"{c}__max").alias("max")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def group_profile(df: DataFrame, group_col, features) -> DataFrame:
    """Per-group mean of each feature, size, and z-score vs the global mean/std."""
    g = df.groupBy(_c(group_col).alias("group")).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(f).alias(f"mean_{f}") for f in features])
    # one scan for all statistics
    s = df.agg(F.struct(*[x for i, f in enumerate(features) for x in (F.avg(f).alias(f"m{i}"), F.stddev_samp(f).alias(f"s{i}"))])
               .alias("s")).scalar()
    return g.withColumns({f"z_{f}": (F.col(f"mean_{f}") - s[f"m{i}"]) / s[f"s{i}"] for i, f in enumerate(features)})
