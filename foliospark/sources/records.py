"""Records and results that an earlier stage wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import rules, schemas
from foliospark.functions import json as J
from foliospark.functions import text as T
from foliospark.functions.binding import bind
from foliospark.operators.extract import all_fields


def read_classification_csv(spark: SparkSession, path: str) -> DataFrame:
    """Results of stage 2 from its flat file. A flat file does not tell NULL from empty: texts are empty."""
    return (
        spark.read.schema(schemas.CLASSIFICATION)
        .options(header=True, multiLine=True, escape='"', emptyValue="", nullValue="\0")
        .csv(path)
    )


def parse_records(df: DataFrame, column: str = "json") -> DataFrame:
    """Add the record columns from JSON text; amounts stay as written, lists become arrays.

    A text that is not JSON leaves all of them NULL. Unknown keys stay in `data`.
    """
    kinds = {f: k for fields in rules.TARGET_SCHEMAS.values() for f, k in fields.items()}
    read = bind(df.withColumn("data", J.parse_object(F.col(column))), ["data"])
    v = F.col("data")
    columns = {
        f: J.get_strings(v, f) if kinds[f] == "array" else J.get_string(v, f)
        for f in all_fields()
    }
    status = {c: J.get_string(v, c) for c in ("extraction_status", "error", "reason")}
    return read.withColumns({**status, **columns})


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One JSON file per document below `path`; the file name gives document_name."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        T.stem(T.file_name(F.col("_metadata.file_path"))).alias("document_name"),
        F.col("value").alias("json"),
    )
    return parse_records(texts)


def read_analysis(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The finding tables that `sinks.stages.write_analysis` wrote."""
    shapes = {
        "duplicate_invoices": None,
        "expiring_contracts": schemas.EXPIRING,
        "vendor_spend": schemas.VENDOR_SPEND,
        "data_quality_flags": schemas.QUALITY_FLAGS,
    }
    return {
        name: (spark.read.schema(s) if s else spark.read).parquet(f"{path}/{name}")
        for name, s in shapes.items()
    }


def join_classified_text(
    classification: DataFrame, texts: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Every classified document with its text; `text` is NULL where there is none."""
    return classification.join(texts.select(key, "text"), key, "left")


def join_classified_records(
    classification: DataFrame, records: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Classified documents that have a record."""
    return classification.join(records, key, "inner")


def unextracted_documents(
    classification: DataFrame, records: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Classified documents without a record (failed or skipped at extraction)."""
    return classification.join(records.select(key), key, "left_anti")
