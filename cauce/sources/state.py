"""Incremental state and set-based loads.

Tables written by :func:`upsert` are versioned folders ``<path>/v=<n>``; a
version is visible once Spark's job commit wrote its ``_SUCCESS`` marker, so a
failed or killed load never exposes half a table (all-or-nothing).  Readers
take the highest committed version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: F401
from pyspark.sql import functions as F

from cauce.sources import fs

DEFAULT_WATERMARK = "2024-01-01 00:00:00"


# --------------------------------------------------------------- watermark
def _state_row(spark: SparkSession, path: str) -> dict:
    """The state row; a successor that was fully written but not yet moved into place is the newest."""
    for place in (f"{path}__next", path):
        if fs.exists(spark, place) and (place == path or fs.exists(spark, f"{place}/_SUCCESS")):
            r = spark.read.json(place).first()
            return r.asDict() if r is not None else {}
    return {}


def read_watermark(spark: SparkSession, path: str, key: str = "last_created_at",
                   default: str = DEFAULT_WATERMARK) -> str:
    """Persisted high-water mark; default when absent."""
    return _state_row(spark, path).get(key) or default


def write_watermark(spark: SparkSession, path: str, value: str, key: str = "last_created_at") -> None:
    """Store the mark, keeping any other keys of the state row.  Call last.

    The new row is written beside the old one and then moved into its place.
    A kill at any point leaves either the old row or the complete new one.
    """
    state = _state_row(spark, path) | {key: value}
    after = f"{path}__next"
    if fs.exists(spark, f"{after}/_SUCCESS"):    # finish a move that was cut short
        fs.delete(spark, path)
        fs.rename(spark, after, path)
    fs.delete(spark, after)
    spark.createDataFrame([state]).coalesce(1).write.json(after)
    fs.delete(spark, path)
    fs.rename(spark, after, path)


def incremental_scan(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """Rows strictly newer than the mark; a literal filter reaches the Parquet scan."""
    return df.filter(F.col(ts_col) > F.lit(watermark).cast(df.schema[ts_col].dataType))


def next_watermark(df: DataFrame, ts_col: str, current) -> Column:
    """Max of the processed rows' timestamps, or the current mark for an empty batch."""
    return F.coalesce(F.max(ts_col).cast("string"), F.lit(str(current)))


# ------------------------------------------------------------ versioned tables
KEEP_VERSIONS = 3


def _folders(spark: SparkSession, path: str, prefix: str = "v=") -> list[int]:
    names = (n for n in fs.list_dirs(spark, path) if n.startswith(prefix))
    return sorted(int(n[len(prefix):]) for n in names if n[len(prefix):].isdigit())


def _committed(spark: SparkSession, path: str, number: int, prefix: str = "v=") -> bool:
    return fs.exists(spark, f"{path}/{prefix}{number}/_SUCCESS")


def current_version(spark: SparkSession, path: str) -> int | None:
    return next((v for v in reversed(_folders(spark, path)) if _committed(spark, path, v)), None)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed version, a table of periods, or all committed parts of an append-only table."""
    v = current_version(spark, path)
    if v is not None:
        return spark.read.parquet(f"{path}/v={v}")
    if fs.exists(spark, f"{path}/manifest"):
        from cauce.sources.periods import read_periods
        return read_periods(spark, path)
    parts = [f"{path}/part={p}" for p in _folders(spark, path, "part=") if _committed(spark, path, p, "part=")]
    return spark.read.option("mergeSchema", "true").parquet(*parts) if parts else None


def _write_next(spark: SparkSession, df: DataFrame, path: str, prefix: str, writer: str = "parquet") -> int:
    """Write the next numbered folder.  Its number lies above every folder, committed or not, so what a
    killed write left behind never blocks the table."""
    n = max(_folders(spark, path, prefix), default=0) + 1
    df.write.mode("errorifexists").format(writer).save(f"{path}/{prefix}{n}")
    return n


def publish(spark: SparkSession, df: DataFrame, path: str, keep: int = KEEP_VERSIONS) -> int:
    """Write ``df`` as the next version; visible only after a complete commit.

    Folders older than the last ``keep`` committed versions are removed
    afterwards (``keep`` is at least 2: a reader may still be on the last one).
    """
    older = _folders(spark, path)
    v = _write_next(spark, df, path, "v=")
    committed = [x for x in older if _committed(spark, path, x)]
    if len(committed) >= keep:
        for x in older:
            if x < committed[1 - max(keep, 2)]:
                fs.delete(spark, f"{path}/v={x}")
    return v


def merge_frames(target: DataFrame | None, updates: DataFrame, key) -> DataFrame:
    """Set-based upsert: rows of ``target`` whose key is absent from ``updates``, plus all ``updates``."""
    keys = [key] if isinstance(key, str) else list(key)
    if target is None:
        return updates
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def upsert(spark: SparkSession, path: str, updates: DataFrame, key) -> tuple[int, int]:
    """Insert new keys, replace existing ones; returns ``(inserted, updated)``.

    Idempotent: replaying the same updates gives ``(0, n)`` and the same table.
    ``updates`` must be unique on ``key`` (checked).  The merged table is
    written as a new version, so the load is all-or-nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    target = read_table(spark, path)
    # one pass over the updates' keys: uniqueness and the two counts
    per_key = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if target is None:
        per_key = per_key.withColumn("_exists", F.lit(False))
    else:
        per_key = per_key.join(target.select(*keys).withColumn("_exists", F.lit(True)), keys, "left")
    counts = per_key.agg(F.coalesce(F.max("_n"), F.lit(0)).alias("most"), F.count(F.lit(1)).alias("all"),
                         F.count_if(F.col("_exists")).alias("upd")).first()
    if counts["most"] > 1:
        raise ValueError("updates are not unique on the key")
    publish(spark, merge_frames(target, updates, keys), path)
    return int(counts["all"] - counts["upd"]), int(counts["upd"])


def append_keyed(spark: SparkSession, path: str, rows: DataFrame, key) -> int:
    """Append rows whose key is not stored yet (replays do not duplicate).

    Each append writes its new rows only, as one committed folder ``part=<n>``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    target = read_table(spark, path)
    new = rows.dropDuplicates(keys)
    if target is not None:
        new = new.join(target.select(*keys), keys, "left_anti")
    n = _write_next(spark, new, path, "part=")
    return spark.read.parquet(f"{path}/part={n}").count()


AUDIT_COLUMNS = ("run_id", "started_at", "finished_at", "watermark_before", "watermark_after", "source_rows",
                 "valid_rows", "quarantined", "inserted", "updated", "quality_status", "status", "error_message")


def audit_run(spark: SparkSession, path: str, run: dict) -> None:
    """One row per run id, insert-or-replace (S15 on the runs table).

    All fields are stored as text with a fixed column list, so every status
    (including an early failure with most fields unset) has the same schema.
    """
    row = tuple(None if run.get(c) is None else str(run.get(c)) for c in AUDIT_COLUMNS)
    schema = ", ".join(f"{c} string" for c in AUDIT_COLUMNS)
    upsert(spark, path, spark.createDataFrame([row], schema), "run_id")


def newest(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """Newest ``n`` rows of a log (top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(F.desc(order_col)).limit(n)
