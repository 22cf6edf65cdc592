"""Run history: which run of a stage is the latest, and its rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.sinks.stages import PUBLISHED


def latest_runs(runs: DataFrame, required: str | None = None) -> DataFrame:
    """Latest run_ts per stage, by the whole time stamp. `required` names a boolean column."""
    kept = runs.where(F.col(required)) if required else runs
    return kept.groupBy("stage").agg(F.max("run_ts").alias("run_ts"))


def latest_run_with_prefix(runs: DataFrame, prefix: str) -> DataFrame:
    return latest_runs(runs.where(F.col("stage").startswith(prefix)))


def rows_of_run(
    tracker: DataFrame, stage: str, run_ts: str | None = None, published: DataFrame | None = None
) -> DataFrame:
    """Rows of one run; by default the latest one of the stage.

    The filters are on partition columns. The latest run is a scalar subquery over `published`
    (stage, run_ts), the small table of finished runs: the runs of the stage are not looked at, and
    one that is half written is none. Without that table, the latest run that has rows counts.
    """
    rows = tracker.where(F.col("stage") == stage)
    if run_ts is not None:
        return rows.where(F.col("run_ts") == run_ts)
    known = tracker if published is None else published
    latest = known.where(F.col("stage") == stage).agg(F.max("run_ts")).scalar()
    return rows.where(F.col("run_ts") == latest)


def tracker_rows(
    tracker: DataFrame, stage: str, run_ts: str | None = None, published: DataFrame | None = None
) -> DataFrame:
    """Rows of one run of the tracker in the order of their paths."""
    return rows_of_run(tracker, stage, run_ts, published).orderBy("path")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """(stage, run_ts, facts) of the finished runs of the stage table at `path`; none if no run of it
    was ever published."""
    shape = "facts STRING, stage STRING, run_ts STRING"
    try:
        return spark.read.schema(shape).parquet(f"{path}/{PUBLISHED}").select("stage", "run_ts", "facts")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], shape).select("stage", "run_ts", "facts")


def read_tracker(spark: SparkSession, path: str) -> DataFrame:
    """The table that `sinks.stages.write_stage` fills, with the columns of all stages."""
    return spark.read.schema(schemas.TRACKER).parquet(path)
