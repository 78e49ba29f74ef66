"""Declarative data contracts compiled into reject-reason expressions.

A :class:`TableContract` lists column rules; :func:`reasons` turns them into
one ``array<string>`` column holding every broken rule's name, in contract
order.  The whole check is one projection (plus one join per foreign key),
so validation costs a single pass instead of the reference's per-row loops.

Reason names are ``<column>_<rule>``:
``null, invalid_type, invalid_format, invalid_value, negative, sentinel,
out_of_range, not_multiple, too_long, unparseable, not_found``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.strings import strip

from cauce.functions.dates import parse_timestamp
from cauce.functions.strings import full_match


@dataclass(frozen=True)
class ColumnContract:
    name: str
    dtype: str | None = None          # cast target; an uncastable value is invalid_type
    nullable: bool = True
    values: tuple | None = None       # enumeration
    min: float | None = None
    max: float | None = None
    negative: bool = False            # separate reason for x < 0
    sentinel_above: float | None = None
    regex: str | None = None          # full-match format
    timestamp: bool = False           # must parse with the multi-format parser
    max_length: int | None = None
    multiple_of: float | None = None
    fk: str | None = None             # name of a parent key set passed to ``apply``


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple
    primary_key: tuple = ()
    rules: tuple = field(default_factory=tuple)   # (reason, Column or zero-arg callable -> Column)
    expected_rows: tuple | None = None

    @property
    def column_names(self):
        return [c.name for c in self.columns]


def _column_checks(cc: ColumnContract, fk_hit: Column | None):
    x = F.col(cc.name)
    present = x.isNotNull()
    if cc.dtype in ("string", None):
        blank = present & (strip(x.cast("string")) == "")
    else:
        blank = F.lit(False)
    checks = []
    if not cc.nullable:
        checks.append((f"{cc.name}_null", x.isNull() | blank))
    v = x
    if cc.dtype and cc.dtype != "string":
        v = x.try_cast(cc.dtype)
        checks.append((f"{cc.name}_invalid_type", present & ~blank & v.isNull()))
    if cc.regex:
        checks.append((f"{cc.name}_invalid_format", present & ~full_match(x.cast("string"), cc.regex)))
    if cc.timestamp:
        checks.append((f"{cc.name}_unparseable", present & parse_timestamp(x).isNull()))
    if cc.values is not None:
        checks.append((f"{cc.name}_invalid_value", present & ~x.isin(list(cc.values))))
    if cc.negative:
        checks.append((f"{cc.name}_negative", v < 0))
    if cc.sentinel_above is not None:
        checks.append((f"{cc.name}_sentinel", v > cc.sentinel_above))
    if cc.min is not None or cc.max is not None:
        lo = (v < cc.min) if cc.min is not None else F.lit(False)
        hi = (v > cc.max) if cc.max is not None else F.lit(False)
        if cc.negative:
            lo = lo & (v >= 0)          # a negative value carries its own reason
        if cc.sentinel_above is not None:
            hi = hi & (v <= cc.sentinel_above)
        checks.append((f"{cc.name}_out_of_range", lo | hi))
    if cc.multiple_of is not None:
        q = v / F.lit(cc.multiple_of)
        checks.append((f"{cc.name}_not_multiple", F.abs(q - F.round(q)) > 1e-9))
    if cc.max_length is not None:
        checks.append((f"{cc.name}_too_long", F.length(x.cast("string")) > cc.max_length))
    if cc.fk is not None and fk_hit is not None:
        checks.append((f"{cc.name}_not_found", present & fk_hit.isNull()))
    return checks


def compile_contract(contract: TableContract, fk_hits: dict | None = None):
    """``[(reason, bad_condition)]`` in contract order, then table rules."""
    fk_hits = fk_hits or {}
    out = []
    for cc in contract.columns:
        out += _column_checks(cc, fk_hits.get(cc.name))
    out += [(reason, pred() if callable(pred) else pred) for reason, pred in contract.rules]
    return out


def reasons_column(checks) -> Column:
    """``array<string>`` of broken rules; a null condition is not a failure."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for reason, bad in checks]))


def apply_contract(df: DataFrame, contract: TableContract, parents: dict | None = None,
                   out: str = "reject_reasons") -> DataFrame:
    """Add ``reject_reasons`` (array) and ``reject_reason`` (';'-joined) columns.

    ``parents`` maps an fk column to a DataFrame whose single column holds the
    valid parent keys.  Keys are de-duplicated before the left join, so the
    join never multiplies rows; a hot key on the child side is split by AQE's
    skew-join handling.
    """
    parents = parents or {}
    hits = {}
    for col, keys in parents.items():
        k = keys.select(keys.columns[0]).distinct() \
            .select(F.col(keys.columns[0]).alias(f"_fk_{col}"), F.lit(True).alias(f"_hit_{col}"))
        df = df.join(k, df[col] == k[f"_fk_{col}"], "left").drop(f"_fk_{col}")
        hits[col] = F.col(f"_hit_{col}")
    checks = compile_contract(contract, hits)
    res = df.withColumn(out, reasons_column(checks))
    res = res.withColumn("reject_reason", F.array_join(F.col(out), ";"))
    return res.drop(*[f"_hit_{c}" for c in parents])


def split_by_contract(df: DataFrame, contract: TableContract, parents: dict | None = None):
    """(valid, rejected) after :func:`apply_contract`; complete and disjoint."""
    checked = apply_contract(df, contract, parents)
    ok = F.size("reject_reasons") == 0
    return checked.filter(ok), checked.filter(~ok)


def to_quarantine(rejected: DataFrame, source: str, batch_id: str, record_id: Column,
                  ingested_at, run_id: str | None = None) -> DataFrame:
    """Normalised quarantine rows ``(source, run_id, batch_id, record_id, reject_reason, ingested_at)``."""
    return rejected.select(
        F.lit(source).alias("source"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(batch_id).alias("batch_id"),
        record_id.cast("string").alias("record_id"),
        F.col("reject_reason"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"))
