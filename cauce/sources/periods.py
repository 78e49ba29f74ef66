"""S15 by period: a table of which a load rewrites only the periods that it changes.

Layout below one folder::

    data/load=<n>/_period=<p>/...   rows of period p as load n wrote them
    manifest/v=<m>/                 one JSON row a live period: (period, load), with the table's columns

A load writes its periods with one partitioned Spark write and then a new
manifest.  A manifest counts once its ``_SUCCESS`` marker exists, and it is the
only thing readers follow, so a load is all or nothing: one that is killed
before the manifest leaves files that nothing refers to, and those go when a
later load clears up.  Two loads at once can't both write manifest v=m; the
second one fails and changes nothing.

Every row carries ``_row``, a hash of its values, so that finding out which
stored rows an update changes reads the key, the hash and the period of the
stored table and no other column.  A row whose key moved to another period is
taken out of its old one.  Updates equal to what is stored touch no period.

The manifest has one row a period (months, days): the only thing that passes
through the driver.  Null periods are a period of their own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cauce.session import scratch_path
from cauce.sources import fs
from cauce.sources.state import _committed, _folders, _write_next

PERIOD, ROW = "_period", "_row"
NO_PERIOD = "none"
KEEP_MANIFESTS = 3


def month_of(col) -> Column:
    """The period of a date or timestamp: its month."""
    return F.date_format(col, "yyyy-MM")


class Manifest(dict):
    """period -> load, and the columns of the table's files."""

    schema: T.StructType | None = None


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The newest committed manifest (or one version of it); empty if there is none."""
    out, v = Manifest(), version or current_manifest(spark, path)
    if v is not None:
        for r in spark.read.schema("period string, load int, columns string").json(f"{path}/manifest/v={v}").collect():
            out[r["period"]] = r["load"]
            out.schema = out.schema or T.StructType.fromJson(json.loads(r["columns"]))
    return out


def current_manifest(spark: SparkSession, path: str) -> int | None:
    base = f"{path}/manifest"
    return next((v for v in reversed(_folders(spark, base)) if _committed(spark, base, v)), None)


def _read(spark: SparkSession, path: str, live: Manifest, only=None) -> DataFrame | None:
    """Rows of the live periods (or of some) with ``_period`` and ``_row``.  No footer is read for the columns."""
    folders = [f"{path}/data/load={n}/{PERIOD}={p}" for p, n in sorted(live.items()) if only is None or p in only]
    if not folders:
        return None
    schema = T.StructType([*live.schema.fields, T.StructField(PERIOD, T.StringType())])
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read_periods(spark: SparkSession, path: str, periods=None) -> DataFrame | None:
    """The committed table, or only some periods of it (other folders are not even listed)."""
    df = _read(spark, path, manifest(spark, path), periods)
    return None if df is None else df.drop(PERIOD, ROW)


def _row_hash(df: DataFrame) -> Column:
    # xxhash64 skips nulls, so each value goes with whether it is null
    return F.xxhash64(*[x for c in sorted(df.columns) for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def _tagged(updates: DataFrame, period: Column) -> DataFrame:
    # '_period' becomes a folder name: keep it to plain characters, and text even if all digits
    safe = F.regexp_replace(F.coalesce(period.cast("string"), F.lit(NO_PERIOD)), "[^0-9A-Za-z.-]", "_")
    return updates.select("*", F.concat(F.lit("p"), safe).alias(PERIOD), _row_hash(updates).alias(ROW))


def _write_data(spark: SparkSession, df: DataFrame, path: str) -> tuple[int, list[str]]:
    """Write one load's folders; AQE splits a period that outgrows a task and joins small ones."""
    n = max(_folders(spark, f"{path}/data", "load="), default=0) + 1
    folder = f"{path}/data/load={n}"
    df.hint("rebalance", PERIOD).write.mode("errorifexists").partitionBy(PERIOD).parquet(folder)
    return n, [d[len(PERIOD) + 1:] for d in fs.list_dirs(spark, folder) if d.startswith(f"{PERIOD}=")]


def _publish(spark: SparkSession, path: str, live: Manifest) -> None:
    base, columns = f"{path}/manifest", live.schema.json()
    rows = spark.createDataFrame([(p, n, columns) for p, n in sorted(live.items())], "period string, load int, columns string")
    _write_next(spark, rows.coalesce(1), base, "v=", writer="json")
    versions = [v for v in _folders(spark, base) if _committed(spark, base, v)]
    kept = versions[-KEEP_MANIFESTS:]
    used = {n for v in kept for n in manifest(spark, path, v).values()}
    for v in _folders(spark, base):
        if v < kept[0]:
            fs.delete(spark, f"{base}/v={v}")
    # loads that no kept manifest names: replaced ones, and what killed loads left behind
    for n in _folders(spark, f"{path}/data", "load="):
        if n not in used and n < max(used, default=0):
            fs.delete(spark, f"{path}/data/load={n}")


def upsert_periods(spark: SparkSession, path: str, updates: DataFrame, key, period: Column) -> tuple[int, int]:
    """Insert new keys and replace existing ones; returns ``(inserted, updated)``.

    Only the periods that hold a new, changed or moved row are rewritten;
    replaying the same updates gives ``(0, n)`` and writes nothing.  The updates
    are evaluated once and must be unique on ``key`` (checked before anything
    becomes visible).
    """
    keys = [key] if isinstance(key, str) else list(key)
    tagged = _tagged(updates, period)
    live = manifest(spark, path)
    if not live:
        return _first_load(spark, path, tagged, keys), 0
    stored = _read(spark, path, live)
    same_key = [F.col(f"u.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    known = stored.select(*keys, F.col(PERIOD).alias("_was"), F.col(ROW).alias("_stored"), F.lit(True).alias("_known"))
    on = same_key[0]
    for c in same_key[1:]:
        on = on & c
    joined = tagged.alias("u").join(known.alias("s"), on, "left").select("u.*", "s._was", "s._stored", "s._known")
    staged_path = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    joined.write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    per_key = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("_known").alias("known"))
    seen = per_key.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count(F.lit(1)).alias("all"), F.count("known").alias("known")).first()
    if seen["most"] > 1:
        raise ValueError("updates are not unique on the key")
    changed = staged.filter(F.col("_known").isNull() | (F.col("_was") != F.col(PERIOD)) | (F.col("_stored") != F.col(ROW)))
    touched = {r[0] for r in changed.select(F.explode(F.array_compact(F.array(PERIOD, "_was")))).distinct().collect()}
    if touched:
        new = staged.filter(F.col(PERIOD).isin(*touched)).drop("_was", "_stored", "_known")
        old = _read(spark, path, live, touched)
        if old is not None:
            gone = staged.select(*keys)
            cond = old[keys[0]].eqNullSafe(gone[keys[0]])
            for k in keys[1:]:
                cond = cond & old[k].eqNullSafe(gone[k])
            new = old.join(gone, cond, "left_anti").unionByName(new, allowMissingColumns=True)
        n, written = _write_data(spark, new, path)
        after = _with_schema({p: m for p, m in live.items() if p not in touched} | {p: n for p in written}, live.schema, new.schema)
        _publish(spark, path, after)
    fs.delete(spark, staged_path)
    return int(seen["all"] - seen["known"]), int(seen["known"])


def _with_schema(live: dict, *schemas: T.StructType | None) -> Manifest:
    out, fields = Manifest(live), {}
    for schema in schemas:
        for f in schema.fields if schema is not None else []:
            if f.name != PERIOD:
                fields.setdefault(f.name, T.StructField(f.name, f.dataType))
    out.schema = T.StructType(list(fields.values()))
    return out


def _first_load(spark: SparkSession, path: str, tagged: DataFrame, keys: list) -> int:
    n, written = _write_data(spark, tagged, path)
    if not written:
        return 0
    live = _with_schema({p: n for p in written}, tagged.schema)
    per_key = _read(spark, path, live).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = per_key.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("all")).first()
    if seen["most"] > 1:
        raise ValueError("updates are not unique on the key")
    _publish(spark, path, live)
    return int(seen["all"])
