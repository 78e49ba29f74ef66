"""Sinks and dataset identity."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    """Full overwrite, optionally Hive-partitioned (partition pruning on read)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    The mode is a per-write option, so the session default stays untouched.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition_by).parquet(path)


def write_csv_partitioned(df: DataFrame, path: str, partition_by: str = "split") -> None:
    """One CSV file set per partition value (e.g. train/validation/test)."""
    df.write.mode("overwrite").option("header", True).partitionBy(partition_by).csv(path)


def export_json(df: DataFrame, path: str) -> int:
    """Write rows as JSON lines and return the row count of what was written.

    The count is read back from the written files (a metadata-light scan), which
    also checks the export.  (``DataFrame.observe`` would count in the same job,
    but a registered Observation breaks later ML jobs in the same session on
    PySpark 4.1.)
    """
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.json(path).count()


def fingerprint(df: DataFrame, cols=None) -> DataFrame:
    """Order-insensitive dataset hash: row count + sum of 64-bit row hashes.

    Summed as DECIMAL(38,0) so it never overflows; independent of partitioning.
    """
    cols = cols or df.columns
    h = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("hash_sum"))


def row_sha256(df: DataFrame, cols=None, name: str = "row_sha256") -> DataFrame:
    """Per-row SHA-256 of the row as JSON."""
    cols = cols or df.columns
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256))


def write_manifest(spark: SparkSession, path: str, info: dict) -> None:
    """One-row JSON manifest written beside the data (values as JSON text)."""
    row = {k: json.dumps(v, sort_keys=True, default=str) for k, v in info.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    r = spark.read.json(path).first().asDict()
    return {k: json.loads(v) for k, v in r.items()}


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality (``exceptAll`` both ways is empty)."""
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return a.exceptAll(b).limit(1).count() == 0 and b.exceptAll(a).limit(1).count() == 0
