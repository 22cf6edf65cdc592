"""Run summaries and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions.dates import iso_stamp
from foliospark.operators import analyze as A

SUMMARY_INSTRUCTION = "Write a short executive summary of these findings.\n\n"


def counts_by(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def ingestion_summary(outcome: DataFrame) -> DataFrame:
    """One row: totals and success rate in percent (0 for an empty run)."""
    total, good = F.count(F.lit(1)), F.count_if(F.col("success"))
    return outcome.agg(
        total.alias("docs_total"),
        good.alias("success"),
        (total - good).alias("fail"),
        F.when(total > 0, F.round(good / total * 100.0, 2)).otherwise(0.0).alias("success_rate_pct"),
    )


def run_summary(outcome: DataFrame, run_timestamp: str) -> DataFrame:
    """The summary with the counts per method as a map (methods are few)."""
    methods = outcome.groupBy("method").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("success")).alias("good")
    )
    total, good = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))
    return methods.agg(
        F.lit(run_timestamp).alias("run_timestamp"),
        total.alias("docs_total"),
        good.alias("success"),
        (total - good).alias("fail"),
        F.when(total > 0, F.round(good / total * 100.0, 2)).otherwise(0.0).alias("success_rate_pct"),
        F.map_from_entries(F.collect_list(F.struct("method", "n"))).alias("method_distribution"),
    )


def classification_summary(results: DataFrame) -> DataFrame:
    """One row: documents, and those whose method mentions a model (failed calls included)."""
    return results.agg(
        F.count(F.lit(1)).alias("docs_total"),
        F.count_if(F.col("method").contains("llm")).alias("llm_fallbacks_used"),
    )


def extraction_run_summary(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("docs_processed"),
        F.count_if(F.col("extraction_status").contains("success")).alias("successful_extractions"),
    )


def extraction_tracker(records: DataFrame) -> DataFrame:
    """What the run tracker keeps of stage 3: one row per document."""
    return records.select("document_name", "document_type", F.col("extraction_status").alias("status"), "error")


def stage_run_summaries(
    outcome: DataFrame, classified: DataFrame, records: DataFrame, run_timestamp: Column
) -> DataFrame:
    """One row per stage: stage, run_timestamp (ISO text), docs_total and the stage's own count."""
    def row(stage: str, df: DataFrame, total: str, count: str) -> DataFrame:
        return df.select(
            F.lit(stage).alias("stage"), iso_stamp(run_timestamp).alias("run_timestamp"),
            F.col(total).alias("docs_total"), F.lit(count).alias("counted"), F.col(count).alias("n"),
        )

    return (
        row("01_Ingestion", ingestion_summary(outcome), "docs_total", "success")
        .unionByName(row("02_Classification", classification_summary(classified), "docs_total", "llm_fallbacks_used"))
        .unionByName(row("03_Extraction", extraction_run_summary(records), "docs_processed", "successful_extractions"))
    )


def summary_request(
    kpis: DataFrame, spend: DataFrame, instruction: str = SUMMARY_INSTRUCTION
) -> DataFrame:
    """One request for an executive summary: the headline counts and the top vendor as JSON."""
    counts = kpis.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("counts"))
    spent = F.col("net_spend").try_cast("decimal(38,2)").alias("net_spend")
    facts = F.struct(counts.scalar().alias("counts"), "top_vendor", spent)
    body = F.to_json(facts, {"ignoreNullFields": "false"})
    return top_vendor(spend).select(
        body.alias("facts"), F.concat(F.lit(instruction), body).alias("request")
    )


def classify_route_counts(classified: DataFrame) -> DataFrame:
    """Documents per rule status: resolved, unresolved, error."""
    return counts_by(classified, "status", "docs")


def consolidation_summary(outcomes: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """One row: when it was processed (ISO text; the present by default), and counters over `outcome`
    (see `plans.invoices.invoice_outcomes`).

    Documents that never reached validation are counted on their own.
    """
    at = F.current_timestamp() if processing_time is None else processing_time

    def count(*values: str) -> Column:
        return F.count_if(F.col("outcome").isin(*values))

    return outcomes.agg(
        iso_stamp(at).alias("processing_time"),
        F.count(F.lit(1)).alias("total_files_found"),
        count("valid", "invalid").alias("total_files_processed"),
        count("valid").alias("successful_invoices"),
        count("invalid").alias("failed_or_skipped_invoices"),
        count("no_text").alias("skipped_no_text"),
        count("other_type").alias("skipped_other_type"),
        count("low_confidence").alias("skipped_low_confidence"),
    )


def top_vendor(spend: DataFrame) -> DataFrame:
    """The vendor with the largest net spend, `N/A` when there is none."""
    first = spend.orderBy(F.desc("net_spend"), "vendor_name").limit(1)
    # an aggregate without keys also has a row for an empty input
    return first.agg(
        F.coalesce(F.first("vendor_name"), F.lit("N/A")).alias("top_vendor"),
        F.first("net_spend").alias("net_spend"),
    )


def dashboard_kpis(
    records: DataFrame, as_of: str, labels: dict[str, str] | None = None
) -> DataFrame:
    """Four (metric, value) rows, counted where the data are, in one pass over the records."""
    labels = labels or rules.KPI_LABELS
    entries = F.array(
        *(F.struct(F.lit(label).alias("metric"), F.col(k).alias("value")) for k, label in labels.items())
    )
    return A.finding_counts(records, as_of).select(F.inline(entries))
