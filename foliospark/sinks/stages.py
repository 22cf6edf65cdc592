"""Stage outputs as partitioned tables and flat files.

Writes replace the partition of their run, so a repeated attempt leaves one copy. Each output
is independent of the others.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foliospark.operators.extract import extraction_summary_rows
from foliospark.operators.skew import with_running
from foliospark.functions.text import folder_safe

#: Folder of the finished runs below a stage table; Spark skips it when it reads the table.
PUBLISHED = "_published"


def with_run(df: DataFrame, stage: str, run_ts: str) -> DataFrame:
    return df.withColumns({"stage": F.lit(stage), "run_ts": F.lit(run_ts)})


def write_stage(df: DataFrame, path: str, stage: str, run_ts: str) -> None:
    """Write one run of one stage to its folder of the table at `path`, which is partitioned by
    stage and run. A repeated attempt replaces the run, also by nothing."""
    folder = f"{path}/stage={stage}/run_ts={run_ts}"
    df.drop("stage", "run_ts").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def publish_run(spark: SparkSession, path: str, stage: str, run_ts: str, **facts: object) -> None:
    """Say that a run of the table at `path` is finished: one row (stage, run_ts, facts as JSON text)
    beside the table, written last. A run without it is never taken for the latest."""
    row = spark.createDataFrame([(json.dumps(facts, default=str),)], "facts STRING")
    write_stage(row.coalesce(1), f"{path}/{PUBLISHED}", stage, run_ts)


def write_run(df: DataFrame, path: str, stage: str, run_ts: str) -> int:
    """Write one run of one stage and publish it, with the number of its rows, which is counted in the
    same pass. Whatever fails before the end leaves a run that no reader sees."""
    seen = Observation()
    write_stage(df.observe(seen, F.count(F.lit(1)).alias("n")), path, stage, run_ts)
    publish_run(df.sparkSession, path, stage, run_ts, rows=seen.get["n"])
    return seen.get["n"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_extraction_summary(records: DataFrame, path: str) -> None:
    write_csv(extraction_summary_rows(records), path)


def write_analysis(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_report(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Write the report tables; returns the names of those that have rows. Each is computed once:
    what was written tells whether there is anything."""
    for name, df in tables.items():
        write_csv(df, f"{path}/{name}")
    return [
        name
        for name, df in tables.items()
        if not df.sparkSession.read.option("header", True).csv(f"{path}/{name}").isEmpty()
    ]


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes up before compression: its texts, and eight bytes for each other value."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(8)
        for c, kind in df.dtypes
    ]
    return sum(sizes[1:], sizes[0]).cast("bigint") if sizes else F.lit(1).cast("bigint")


def packed_by_bytes(df: DataFrame, folder: str, bytes_per_file: int, name: str = "part") -> DataFrame:
    """Add the number of the file of its folder that a row belongs to: files of a folder are filled one
    after another, so that none holds more than `bytes_per_file` and the row that fills it.

    Rows follow the hash of all their columns, whatever any one of them holds; the running sum over
    them is taken in ranges (see `skew.with_running`), so a folder may hold any share of the rows.
    """
    hashed = df.withColumns({"_bytes": F.greatest(row_bytes(df), F.lit(1)), "_hash": F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))})
    summed = with_running(hashed, [folder, "_hash"], F.col("_bytes"), "_upto")
    # the running sum goes on from folder to folder, so a folder may begin amid a number
    return summed.withColumn(name, F.floor((F.col("_upto") - 1) / F.lit(bytes_per_file))).drop("_bytes", "_hash", "_upto")


def write_by_type(
    documents: DataFrame,
    path: str,
    run_ts: str,
    doc_type: Column | str = "predicted_type",
    bytes_per_file: int = 256 << 20,
) -> None:
    """Place documents in one folder per type below the folder of the run, replacing that run.

    Below the folder of a type there is one file for each part of about `bytes_per_file` (texts as
    they are, before compression), so a large type is written by many tasks and a file's size does
    not depend on how long its documents are.
    """
    column = F.col(doc_type) if isinstance(doc_type, str) else doc_type
    placed = packed_by_bytes(documents.withColumn("folder", folder_safe(column)), "folder", bytes_per_file)
    (
        placed.repartition("folder", "part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("folder", "part")
        .parquet(f"{path}/run_ts={run_ts}")
    )
