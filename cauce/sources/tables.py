"""Access to the driver's parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Tables whose rows carry long texts or vectors: per-row work (tokenizing,
# regexes, Arrow UDFs) dominates, so the scan's parallelism matters.
HEAVY_ROW_TABLES = {"documents", "pages", "conversations", "benchmark", "embeddings"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in HEAVY_ROW_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin repartition only when the scan has fewer partitions than cores.

    A file written as one row group is read by one task however many
    partitions the scan reports, and everything before the first shuffle
    (tokenizing whole texts) would run serially.  On a cluster the input has
    far more splits than cores and this is a no-op, so no extra shuffle of
    the corpus is added at scale.
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose tables as temp views so the SQL API sees the same plans."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
