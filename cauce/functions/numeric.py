"""Numeric and vector column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Fixed values.
MILES_TO_KM = 1.60934


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def miles_to_km(value, unit) -> Column:
    """convert when the unit says miles."""
    v, u = _c(value), F.lower(F.trim(_c(unit)))
    return F.when(u.isin("mi", "miles", "millas"), v * F.lit(MILES_TO_KM)).otherwise(v)


def safe_div(num, den) -> Column:
    """NULLIF(den, 0) semantics: zero or null denominator -> null."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def div_or_zero(num, den) -> Column:
    """zero denominator -> 0.0."""
    return F.coalesce(safe_div(num, den).cast("double"), F.lit(0.0))


def fill_clip(c, floor: float = 0.0) -> Column:
    """Null -> floor, then clip at floor."""
    return F.greatest(F.coalesce(_c(c), F.lit(floor)), F.lit(floor))


def money(c, prefix: str = "$") -> Column:
    """currency label with two decimals; keep the numeric twin column."""
    return F.concat(F.lit(prefix), F.format_string("%.2f", _c(c)))


def pct_label(c, signed: bool = False, decimals: int = 2) -> Column:
    """'12.50%' and, when signed, '+12.50%' for positive values."""
    s = F.concat(F.format_string(f"%.{decimals}f", _c(c)), F.lit("%"))
    if signed:
        s = F.when(_c(c) > 0, F.concat(F.lit("+"), s)).otherwise(s)
    return s


# ----------------------------------------------------------------- vectors
def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0),
                              lambda acc, x: acc + x))


def cosine(a, b) -> Column:
    return safe_div(dot(a, b), norm(a) * norm(b))


def l2_normalize(a) -> Column:
    n = norm(a)
    return F.transform(_c(a), lambda x: F.try_divide(x.cast("double"), F.nullif(n, F.lit(0.0))))


def jaccard(a, b) -> Column:
    """|a ∩ b| / |a ∪ b| of two arrays treated as sets (empty ∪ -> null)."""
    inter = F.size(F.array_intersect(_c(a), _c(b)))
    union = F.size(F.array_union(_c(a), _c(b)))
    return safe_div(inter.cast("double"), union)


# ---------------------------------------------------------- activations
def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def softmax_by(df, c, keys, name: str = "p"):
    """Max-shifted softmax of ``c`` over the rows of each key, as column ``name`` of ``df``.

    Two small aggregates (maximum, then sum of shifted exponentials) join the rows, so a key with a
    third of the rows is combined on every mapper and its join is split, never one task's window."""
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    same = lambda s: F.expr(" AND ".join(f"`{k}` <=> `{s}{i}`" for i, k in enumerate(keys)))
    top = df.groupBy(*named).agg(F.max(c).alias("_m"))
    sums = df.join(top, same("_k")).groupBy(*[F.col(f"_k{i}").alias(f"_s{i}") for i in range(len(keys))]).agg(
        F.first("_m").alias("_m"), F.sum(F.exp(c - F.col("_m"))).alias("_t"))
    return df.join(sums, same("_s")).withColumn(name, F.exp(c - F.col("_m")) / F.col("_t")).drop(
        "_m", "_t", *[f"_s{i}" for i in range(len(keys))])


def softmax(c, *partition_cols) -> Column:
    """Max-shifted softmax of ``c`` within each partition."""
    w = Window.partitionBy(*partition_cols)
    e = F.exp(_c(c) - F.max(_c(c)).over(w))
    return e / F.sum(e).over(w)


def normal_cdf(z: float) -> float:
    """Standard normal CDF for one driver-side scalar (used on one-row results)."""
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))
