"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a laptop and on a cluster alike; sizes are left to the deployment.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "foliospark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that all executors and the driver see.

    The one the deployment names in `spark.checkpoint.dir`. A local session that names none gets a
    folder in its warehouse; on a cluster that may be a machine's own disk, so one must be named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def make_folder(spark: SparkSession, folder: str) -> None:
    """Make a folder, in any store that Spark writes to, if it is not there yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder, so that later reads see one fixed result."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


_SHIPPED: set[str] = set()


def ship_code(df: DataFrame) -> None:
    """Give Python workers this package, as they may not have it on their path."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="code-"), "foliospark_code.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(at)
    _SHIPPED.add(sc.applicationId)
