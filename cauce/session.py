"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job needs for correct and scalable plans.  They are applied
# only when the session does not already carry a value, so a cluster's own
# configuration always wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_session(master: str | None = None, app: str = "cauce",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  ``master`` is only for local runs/tests."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is; there
    it must be set.  Only a local session without it gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="cauce-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for written intermediate tables."""
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", name)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


@atexit.register
def _clear_scratch() -> None:
    """Remove this application's scratch tables when it ends with its session still open."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    from cauce.sources import fs
    for path in _SCRATCH:
        fs.delete(spark, path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cauce`` importable in every Python worker (pandas UDFs, mapInPandas).

    Functions defined in the package are pickled by reference, so executors
    need the package itself.  It is zipped once per application on the driver
    and distributed with ``addPyFile`` (Spark's mechanism for job code).
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="cauce-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
