"""Model registry (M36, M37, S22): versioned models, their metrics, and a log of predictions.

Layout below one folder::

    model/v=<n>/stages       a fitted Spark ML pipeline, as its own writer stores it
    model/v=<n>/card         one JSON row (name, metrics); written last: the version counts once it is complete
    metrics/part=<n>         rows of a leaderboard, appended one committed part at a time
    predictions/part=<n>     rows of scored batches, likewise

A run that is killed leaves folders that no reader looks at, and the next
version or part takes a higher number.  Scoring loads a version and never fits.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.sources import fs
from cauce.sources.state import _folders, _write_next, newest, read_table

METRICS = "version int, model string, metric string, value double"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return [v for v in _folders(spark, f"{path}/model") if fs.exists(spark, f"{path}/model/v={v}/card/_SUCCESS")]


def register(spark: SparkSession, path: str, model: PipelineModel, name: str, metrics: dict[str, float]) -> int:
    """Store a fitted pipeline as the next version, with its metrics on the leaderboard; returns the version."""
    v = max(_folders(spark, f"{path}/model"), default=0) + 1
    model.write().save(f"{path}/model/v={v}/stages")
    rows = spark.createDataFrame([(v, name, k, float(x)) for k, x in sorted(metrics.items())], METRICS)
    _write_next(spark, rows.coalesce(1), f"{path}/metrics", "part=")
    card = spark.createDataFrame([(name, json.dumps(metrics, sort_keys=True))], "name string, metrics string")
    card.coalesce(1).write.mode("errorifexists").json(f"{path}/model/v={v}/card")
    return v


def load(spark: SparkSession, path: str, version: int | None = None) -> tuple[PipelineModel, int, str]:
    """(model, version, name) of a complete version, the newest by default."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise ValueError(f"no model version {version or ''} in {path}")
    v = version or known[-1]
    name = spark.read.schema("name string, metrics string").json(f"{path}/model/v={v}/card").first()["name"]
    return PipelineModel.load(f"{path}/model/v={v}/stages"), v, name


def leaderboard(spark: SparkSession, path: str, metric: str, smaller_is_better: bool = False) -> DataFrame:
    """Rank, version, model, value of the complete versions, best first (ties: the older version)."""
    known = versions(spark, path)
    rows = read_table(spark, f"{path}/metrics")
    if rows is None or not known:
        return spark.createDataFrame([], "rank int, version int, model string, value double")
    rows = rows.filter((F.col("metric") == metric) & F.col("version").isin(known)).select("version", "model", "value")
    order = F.asc("value") if smaller_is_better else F.desc("value")
    # one row a version: a leaderboard is as long as the list of experiments
    return rows.select(F.row_number().over(Window.orderBy(order, "version")).alias("rank"), "version", "model", "value")


def score(spark: SparkSession, path: str, rows: DataFrame, keys, version: int | None = None,
          prediction: str = "prediction", at: datetime | None = None) -> DataFrame:
    """Predictions of a stored version for ``rows``, appended to the log; returns what was logged.

    Logged columns: ``keys``, prediction, model, model_version, scored_at, batch (its number in the log)."""
    model, v, name = load(spark, path, version)
    keys = [keys] if isinstance(keys, str) else list(keys)
    base = f"{path}/predictions"
    batch = max(_folders(spark, base, "part="), default=0) + 1
    out = model.transform(rows).select(*keys, F.col(prediction).cast("double").alias("prediction"), F.lit(name).alias("model"),
                                       F.lit(v).alias("model_version"), F.lit(at or datetime.now()).cast("timestamp").alias("scored_at"),
                                       F.lit(batch).alias("batch"))
    n = _write_next(spark, out, base, "part=")
    return spark.read.parquet(f"{base}/part={n}")


def newest_predictions(spark: SparkSession, path: str, order_col: str, n: int) -> DataFrame | None:
    """The newest ``n`` rows of the prediction log."""
    log = read_table(spark, f"{path}/predictions")
    return None if log is None else newest(log, order_col, n)
