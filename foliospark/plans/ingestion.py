"""Stage 1 as one lazy lineage: listing → filters → texts → reuse → outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.operators import ingest as G
from foliospark.sources import contents, files


def ingestion_flow(
    listing: DataFrame,
    texts: DataFrame,
    reuse_texts: DataFrame | None = None,
    max_docs: int | None = None,
    max_size_mb: float | None = rules.MAX_FILE_SIZE_MB,
    root: str | None = "root",
) -> DataFrame:
    """Outcome of every document of a listing that is supported and not too large.

    `texts` (path, text and, optionally, ocr_pages and error) is what the extractors made of the
    files; only those of listed documents are used. Already extracted texts (`reuse_texts`) are
    preferred. The result keeps the text, for the text table of the run.
    """
    found = G.discover_documents(listing, max_size_mb=max_size_mb, root=root)
    found = G.limit_documents(found, max_docs)
    keys = [c for c in (root, "path") if c]
    routed = found.select(*keys, G.extractor_route(F.col("extension")).alias("method"))
    extra = [c for c in ("ocr_pages", "error") if c in texts.columns]
    documents = routed.join(texts.select("path", "text", *extra), "path", "left")
    if reuse_texts is not None:
        documents = G.attach_reused_text(documents, reuse_texts, root)
        if "error" in extra:  # a text that was there is not a failure
            documents = documents.withColumn(
                "error", F.when(F.col("method") != "reused", F.col("error"))
            )
    return G.ingestion_outcome(documents)


def chosen_documents(
    listing: DataFrame,
    max_docs: int | None = None,
    max_size_mb: float | None = rules.MAX_FILE_SIZE_MB,
    reuse: bool = True,
) -> DataFrame:
    """(root, path, method, source, length, modified): which documents are read, and from which file.

    All is decided on the listing: the limit, and the already extracted text that takes the place
    of a document's own. `source` is NULL for documents that some extractor has to read.
    """
    if "modified" not in listing.columns:
        listing = listing.withColumn("modified", F.lit(None).cast("timestamp"))
    found = G.limit_documents(G.discover_documents(listing, max_size_mb=max_size_mb), max_docs)
    routed = found.withColumn("method", G.extractor_route(F.col("extension")))
    if reuse:
        routed = G.with_reused_path(routed, listing)
    else:
        nothing = {"path": "string", "length": "long", "modified": "timestamp"}
        routed = routed.withColumns({f"reused_{c}": F.lit(None).cast(t) for c, t in nothing.items()})
    reused = F.col("reused_path").isNotNull()
    return routed.select(
        "root",
        "path",
        F.when(reused, "reused").otherwise(F.col("method")).alias("method"),
        F.coalesce("reused_path", F.when(F.col("method") == "text", F.col("path"))).alias("source"),
        F.when(reused, F.col("reused_length")).otherwise(F.col("length")).alias("length"),
        F.when(reused, F.col("reused_modified")).otherwise(F.col("modified")).alias("modified"),
    )


def read_documents(chosen: DataFrame, **how) -> DataFrame:
    """The chosen documents that have a `source`, with text and error; only those files are opened
    (see `sources.contents`). `method` is NULL where reading failed."""
    read = contents.read_contents(chosen.where("source IS NOT NULL"), source="source", **how)
    return read.select(
        *(c for c in chosen.columns if c != "method"),
        F.when(F.col("read_error").isNull(), F.col("method")).alias("method"),
        files.decode_text(F.col("content")).alias("text"),
        F.col("read_error").alias("error"),
    )


def chosen_outcome(chosen: DataFrame, extracted: DataFrame | None = None, **how) -> DataFrame:
    """Outcome of chosen documents: text from the file that `source` names, or from `extracted` (path,
    text and, optionally, ocr_pages and error). Texts that are read are not shuffled."""
    if extracted is None:
        extracted = chosen.sparkSession.createDataFrame([], "path STRING, text STRING")
    extra = [c for c in ("ocr_pages", "error") if c in extracted.columns]
    made = chosen.where("source IS NULL").join(extracted.select("path", "text", *extra), "path", "left")
    return G.ingestion_outcome(read_documents(chosen, **how).unionByName(made, allowMissingColumns=True))


def ingest_files(
    spark: SparkSession,
    roots: Sequence[str],
    extracted: DataFrame | None = None,
    max_docs: int | None = None,
    max_size_mb: float | None = rules.MAX_FILE_SIZE_MB,
    reuse: bool = True,
    **how,
) -> DataFrame:
    """The flow over folders: list, choose, and only then open the files that were chosen.

    Text files and already extracted texts are read here, each document from one file at most;
    `extracted` (path, text and, optionally, ocr_pages and error) has the texts of other documents.
    Texts are not shuffled. `how` goes to `sources.contents.read_contents`.
    """
    chosen = chosen_documents(files.list_files(spark, roots), max_docs, max_size_mb, reuse)
    return chosen_outcome(chosen, extracted, **how).drop("source", "length", "modified")
