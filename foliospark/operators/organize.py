"""Where each source document belongs, by predicted type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.operators.skew import lookup_join


def organize_manifest(ingestion: DataFrame, classification: DataFrame, key: str = "path") -> DataFrame:
    """Source path, type and folder of every ingested document that was classified.

    Both tables have `key`, which tells documents apart; names may repeat. `ingestion` has
    path and document_name (with suffix). Each document gets its own type.
    """
    files = ingestion.select(
        *dict.fromkeys([key, "path"]), T.stem(F.col("document_name")).alias("document_name_stem")
    )
    typed = classification.groupBy(key).agg(F.max("predicted_type").alias("predicted_type"))
    return files.join(typed, key).select(
        "path", "document_name_stem", "predicted_type",
        T.folder_safe(F.col("predicted_type")).alias("folder"),
    )


def type_per_name(classification: DataFrame) -> DataFrame:
    """For sources that only know names: one type per document_name, that of the last path, and
    `conflict` where documents of that name have several types."""
    return classification.groupBy("document_name").agg(
        F.max_by("predicted_type", "path").alias("predicted_type"),
        (F.min("predicted_type") != F.max("predicted_type")).alias("conflict"),
    )


def organize_manifest_by_name(
    ingestion: DataFrame, classification: DataFrame, salts: int | None = None
) -> DataFrame:
    """Like `organize_manifest` over `type_per_name`, with its `conflict`. Many files may share a
    name (without suffix)."""
    typed = type_per_name(classification).withColumnRenamed("document_name", "document_name_stem")
    files = ingestion.select("path", T.stem(F.col("document_name")).alias("document_name_stem"))
    return lookup_join(files, typed, ["document_name_stem"], ["path"], "inner", salts).withColumn(
        "folder", T.folder_safe(F.col("predicted_type"))
    )


def with_presence(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Add `exists`: whether the path is still in a fresh listing (paths are unique)."""
    present = listing.select("path").distinct().withColumn("exists", F.lit(True))
    return manifest.join(present, "path", "left").withColumn(
        "exists", F.coalesce("exists", F.lit(False))
    )


def organize_summary(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count_if("exists").alias("copied"), F.count_if(~F.col("exists")).alias("failed")
    )
