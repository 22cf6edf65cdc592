"""Listing, text reuse and ingestion outcomes.

Inputs are listings (`root`, `path`, `length`) and text tables; how files become text is
outside this package.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import text as T
from foliospark.operators.skew import lookup_join, with_ordinal

_REUSE_FOLDER = rf"/[^/]*{rules.REUSE_FOLDER_MARK}[^/]*/"


def path_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Add document_name, document_name_stem, extension (lower case) and source_folder."""
    return df.withColumn("document_name", T.file_name(F.col(path))).withColumns(
        {
            "document_name_stem": T.stem(F.col("document_name")),
            "extension": F.lower(T.suffix(F.col("document_name"))),
            "source_folder": T.parent(F.col(path)),
        }
    )


def _below_root(path: str, root: str | None) -> Column:
    """The part of the path that decides about folders: below `root` where it is known."""
    if root is None:
        return F.col(path)
    inside = F.startswith(F.col(path), F.col(root))
    return F.when(
        inside, F.substring(F.col(path), F.length(F.col(root)) + 1, F.length(F.col(path)))
    ).otherwise(F.col(path))


def discover_documents(
    listing: DataFrame,
    suffixes: Iterable[str] = rules.SUPPORTED_SUFFIXES,
    max_size_mb: float | None = rules.MAX_FILE_SIZE_MB,
    exclude_reuse_folders: bool = True,
    root: str | None = "root",
) -> DataFrame:
    """Supported documents of a listing that are not too large.

    Folders with already extracted text are left out: their files are copies, not documents.
    The size test is a plain comparison, which a file scan can push down.
    """
    kept = listing
    if max_size_mb is not None:
        kept = kept.where(F.col("length") <= int(max_size_mb * 1024 * 1024))
    kept = path_parts(kept).where(F.col("extension").isin(*suffixes))
    if exclude_reuse_folders:
        kept = kept.where(~_below_root("path", root).rlike(_REUSE_FOLDER))
    return kept


def union_roots(listings: Sequence[DataFrame]) -> DataFrame:
    """All roots in one listing, each row with the position of its root (`root_ord`)."""
    numbered = [df.withColumn("root_ord", F.lit(i)) for i, df in enumerate(listings)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def limit_documents(documents: DataFrame, max_docs: int | None) -> DataFrame:
    """The first `max_docs` documents by root and path, in that order; no limit for 0 or None.

    Positions come from key ranges, of which only those that begin within the limit are sorted, so
    that no task sees more than its part however many documents are asked for. A path is unique
    below its root.
    """
    if not max_docs:
        return documents
    keys = ["root_ord", "path"]
    return with_ordinal(documents, keys, "_n", max_docs).drop("_n").orderBy(*keys)


def extractor_route(extension: Column) -> Column:
    """How a document becomes text: as text, as PDF, and everything else as an image."""
    return F.when(extension == ".txt", "text").when(extension == ".pdf", "pdf").otherwise("image")


def _reuse_index(listing: DataFrame, root: str | None) -> DataFrame:
    key = ["root", "stem_key"] if root else ["stem_key"]
    texts = path_parts(listing).where(
        F.col("document_name").endswith(".txt") & _below_root("path", root).rlike(_REUSE_FOLDER)
    )
    return texts.withColumn("stem_key", F.lower("document_name_stem")).groupBy(*key)


def reuse_index(listing: DataFrame, root: str | None = "root") -> DataFrame:
    """Already extracted text files, one per root and lower-cased stem: the last path wins."""
    return _reuse_index(listing, root).agg(F.max("path").alias("reused_path"))


def with_reused_path(documents: DataFrame, listing: DataFrame, root: str | None = "root") -> DataFrame:
    """Add reused_path, reused_length and, where the listing has it, reused_modified: the already
    extracted text of each document, by the listing alone. A popular stem is spread over sub-keys."""
    key = ["root", "stem_key"] if root else ["stem_key"]
    told = [c for c in ("length", "modified") if c in listing.columns]
    index = _reuse_index(listing, root).agg(
        F.max("path").alias("reused_path"), *(F.max_by(c, "path").alias(f"reused_{c}") for c in told)
    )
    docs = documents.withColumn("stem_key", F.lower(T.stem(T.file_name(F.col("path")))))
    return lookup_join(docs, index, key, ["path"]).drop("stem_key")


def listing_changes(listing: DataFrame, previous: DataFrame, told: Sequence[str] = ("source", "length", "modified")) -> DataFrame:
    """`listing` (path and `told`) with `change`: new, changed or unchanged against `previous` (path,
    `told` and more), whose other columns come along, and rows of gone documents, with the path only.

    Paths are unique on either side. NULLs are values like others.
    """
    more = [c for c in previous.columns if c not in ("path", *told)]
    before = previous.select(F.col("path").alias("_path"), *(F.col(c).alias(f"_{c}") for c in told), *more)
    now = listing.drop(*more)
    same = F.lit(True)
    for c in told:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    change = (
        F.when(F.col("path").isNull(), "gone").when(F.col("_path").isNull(), "new").when(same, "unchanged").otherwise("changed")
    )
    joined = now.join(before, F.col("path") == F.col("_path"), "full").withColumn("change", change)
    carried = [F.when(F.col("change") == "unchanged", F.col(c)).alias(c) for c in more]
    return joined.select(F.coalesce("path", "_path").alias("path"), *(c for c in now.columns if c != "path"), *carried, "change")


def attach_reused_text(
    documents: DataFrame,
    reuse_texts: DataFrame,
    root: str | None = "root",
    salts: int | None = None,
) -> DataFrame:
    """Prefer reused text over the document's own.

    `documents` has path, text and method; `reuse_texts` has path and text of a listing with
    reuse folders. A popular stem ("invoice.pdf") is spread over many sub-keys.
    """
    key = ["root", "stem_key"] if root else ["stem_key"]
    index = reuse_index(reuse_texts.drop("text"), root)
    texts = reuse_texts.select(F.col("path").alias("reused_path"), F.col("text").alias("reused_text"))
    reusable = index.join(texts, "reused_path")
    docs = documents.withColumn("stem_key", F.lower(T.stem(T.file_name(F.col("path")))))
    joined = lookup_join(docs, reusable, key, ["path"], "left", salts, wide=True)
    return joined.withColumns(
        {
            "text": F.coalesce("reused_text", "text"),
            "method": F.when(F.col("reused_text").isNotNull(), "reused").otherwise(F.col("method")),
        }
    ).drop("reused_text", "stem_key")


def ingestion_outcome(documents: DataFrame) -> DataFrame:
    """Success, length, page count and error per document.

    `documents` has path, text, method and, optionally, ocr_pages and error (a failure of the
    extraction itself). Blank text is a failure; its length and page count are 0.
    """
    have = set(documents.columns)
    failed = F.col("error") if "error" in have else F.lit(None).cast("string")
    pages = F.col("ocr_pages") if "ocr_pages" in have else F.lit(0)
    success = failed.isNull() & ~T.is_blank(F.coalesce("text", F.lit("")))
    scored = path_parts(documents).withColumn("success", success)
    ok = F.col("success")
    return scored.select(
        *(c for c in documents.columns if c not in ("ocr_pages", "error", "method")),
        "document_name",
        "document_name_stem",
        "source_folder",
        "extension",
        F.when(failed.isNotNull(), F.coalesce("method", F.lit("failed")))
        .otherwise(F.col("method")).alias("method"),
        "success",
        F.when(ok, F.length("text")).otherwise(0).cast("bigint").alias("text_length"),
        F.when(ok & (F.col("method") == "ocr"), pages).otherwise(0).cast("int").alias("ocr_pages"),
        F.when(ok, "").otherwise(F.coalesce(failed, F.lit(rules.ERROR_NO_TEXT))).alias("error"),
    )


def ingestion_metrics(outcome: DataFrame) -> DataFrame:
    return outcome.select(
        F.col("path").alias("file_path"), "method", "success", "text_length", "ocr_pages", "error"
    )


def ingestion_tracker(outcome: DataFrame) -> DataFrame:
    return outcome.select(
        "document_name", "source_folder", "path", "extension",
        F.upper("method").alias("method"),
        F.when(F.col("success"), "SUCCESS").otherwise("FAILED").alias("status"),
    )


def ingestion_log_lines(outcome: DataFrame) -> DataFrame:
    flag = F.when(F.col("success"), "True").otherwise("False")
    return outcome.select(
        F.concat_ws(
            " | ", "path", "method", F.concat(F.lit("success="), flag),
            F.concat(F.lit("len="), F.col("text_length").cast("string")),
        ).alias("line")
    )
