"""Stage 1 again and again: a run reads only what is new or changed since the last published one.

Beside the texts, which are written once and stay where they are, each run has a manifest: one slim
row for each document of its listing that says in which run's part its text is. A run compares its
listing with the last manifest, so texts of earlier runs are neither read nor moved. It is published
last; one that dies before is as if it had never been, and is written over by the next attempt.

The texts are a table that is bucketed by path: reading those of a manifest moves only the manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.operators import ingest as G
from foliospark.plans import ingestion
from foliospark.session import make_folder
from foliospark.sinks import stages
from foliospark.sources import files, runs

STAGE = "01_Ingestion"
BUCKETS = 64
#: What a manifest keeps of a document's outcome.
OUTCOME = {
    "method": "STRING", "success": "BOOLEAN", "text_length": "BIGINT", "ocr_pages": "INT", "error": "STRING",
}
_TOLD = {"source": "STRING", "length": "BIGINT", "modified": "TIMESTAMP"}
_KEPT = ", ".join(f"{c} {t}" for c, t in {"root": "STRING", "path": "STRING", **_TOLD, **OUTCOME}.items())
MANIFEST = _KEPT + ", text_run STRING"


def text_table(spark: SparkSession, base: str, buckets: int = BUCKETS) -> str:
    """The name of the text table of `base`, which this session comes to know if it does not yet."""
    at = f"{base.rstrip('/')}/texts"
    name = "texts_" + hashlib.sha256(at.encode()).hexdigest()[:16]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_KEPT}, text STRING, run_ts STRING) USING parquet "
        f"PARTITIONED BY (run_ts) CLUSTERED BY (path) SORTED BY (path) INTO {buckets} BUCKETS LOCATION '{at}'"
    )
    make_folder(spark, at)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def last_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The manifest of the last published run; empty if there is none."""
    at = f"{base}/manifest"
    published = runs.read_published(spark, at)
    if published.isEmpty():
        return spark.createDataFrame([], MANIFEST)
    every = spark.read.schema(MANIFEST + ", stage STRING, run_ts STRING").parquet(at)
    return runs.rows_of_run(every, STAGE, published=published).drop("stage", "run_ts")


def current_texts(spark: SparkSession, base: str, buckets: int = BUCKETS) -> DataFrame:
    """(path, text, and what the manifest has) of the documents of the last published run that have a
    text, whichever run read it. Only the manifest is shuffled."""
    name = text_table(spark, base, buckets)
    texts = spark.table(name).select(F.col("path").alias("_path"), "text", "run_ts")
    listed = last_manifest(spark, base).where("success")
    # bucketed by path alone, so the run must not become a key of the join as well
    same_run = (F.col("run_ts") >= F.col("text_run")) & (F.col("run_ts") <= F.col("text_run"))
    return listed.join(texts, (F.col("path") == F.col("_path")) & same_run).drop("_path", "run_ts")


def ingest_changes(
    spark: SparkSession,
    base: str,
    roots: Sequence[str],
    run_ts: str,
    extracted: DataFrame | None = None,
    max_docs: int | None = None,
    max_size_mb: float | None = rules.MAX_FILE_SIZE_MB,
    reuse: bool = True,
    buckets: int = BUCKETS,
    **how,
) -> dict[str, int]:
    """Run stage 1 over the folders and publish it; counts of new, changed, unchanged and gone
    documents. Arguments as in `ingestion.ingest_files`; `base` is a folder that all share.

    A document is unchanged if the file its text comes from has the same path, length and
    modification time as in the last published run. What has no such file (its text is in
    `extracted`) goes by the document's own. Documents that could not be read are tried again.
    """
    name = text_table(spark, base, buckets)
    chosen = ingestion.chosen_documents(files.list_files(spark, roots), max_docs, max_size_mb, reuse)
    done = F.col("success") | (F.col("source").isNotNull() & (F.col("error") == rules.ERROR_NO_TEXT))
    before = last_manifest(spark, base).select(
        "path", "source", F.when(done, F.col("length")).alias("length"), "modified",
        F.struct(*OUTCOME, "text_run").alias("before"),
    )
    compared = G.listing_changes(chosen, before, tuple(_TOLD))
    fresh = compared.where("change IN ('new', 'changed')").select(*chosen.columns)
    kept = ["root", "path", *_TOLD, *OUTCOME]
    # the one pass that opens files
    outcome = ingestion.chosen_outcome(fresh, extracted, **how).select(*kept, "text")
    outcome.repartition(buckets, "path").createOrReplaceTempView(f"{name}_new")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (run_ts = '{run_ts}') SELECT * FROM {name}_new")
    spark.catalog.dropTempView(f"{name}_new")
    seen = Observation()
    kinds = ("new", "changed", "unchanged", "gone")
    counted = compared.observe(seen, *(F.count_if(F.col("change") == k).alias(k) for k in kinds))
    told = counted.where("change = 'unchanged'").select("root", "path", *_TOLD, "before.*")
    written = spark.table(name).where(F.col("run_ts") == run_ts).select(*kept, F.col("run_ts").alias("text_run"))
    manifest = told.unionByName(written)
    at = f"{base}/manifest"
    stages.write_stage(manifest, at, STAGE, run_ts)
    counts = {k: seen.get[k] for k in kinds}
    stages.publish_run(spark, at, STAGE, run_ts, **counts)
    return counts
