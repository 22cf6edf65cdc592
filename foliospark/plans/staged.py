"""The staged flow as one lazy lineage: texts → types → fields → records → findings.

Each step returns a DataFrame; write it with `sinks.stages` where a materialised hand-off is
wanted and read it back for the next step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.operators import analyze as A
from foliospark.operators import classify as C
from foliospark.operators import extract as E
from foliospark.operators.report import dashboard_kpis
from foliospark.rules import RuleSet


def classify_documents(
    texts: DataFrame,
    answers: DataFrame | None = None,
    rule_set: RuleSet = rules.FULL_RULES,
    origin: str = "llm",
) -> DataFrame:
    """Types for (doc_id, document_name, file_name, text); `answers` fill what rules leave open."""
    ruled = C.classify_with_rules(texts, rule_set)
    return ruled if answers is None else C.apply_fallback(ruled, answers, origin=origin)


def extract_records(classified_texts: DataFrame, answers: DataFrame) -> DataFrame:
    """Documents (doc_id, document_name, document_type, text) with status and merged fields.

    `answers` has doc_id, response and, optionally, error and answered_at; of several answers
    the latest counts (see `latest_answers`). Texts end where the patterns have read them: the
    join with the answers sees whether there was one.
    """
    return _merged(E.with_has_text(E.extract_fields(classified_texts)).drop("text"), answers)


def extract_states(classified_texts: DataFrame, answers: DataFrame) -> DataFrame:
    """Status, error and reason of `extract_records`, for trackers and summaries: no field is merged."""
    return _stated(E.with_has_text(E.extract_fields(classified_texts)).drop("text"), answers)


def _stated(slim: DataFrame, answers: DataFrame) -> DataFrame:
    """Status of rows whose patterns have been read; no texts any more."""
    renamed = C.latest_answers(answers, "doc_id").withColumnRenamed("error", "response_error")
    return E.extraction_status(slim.join(renamed, "doc_id", "left"))


def _merged(slim: DataFrame, answers: DataFrame) -> DataFrame:
    return E.merge_gap_fill(_stated(slim, answers))


def records_of_texts(
    texts: DataFrame,
    type_answers: DataFrame,
    field_answers: DataFrame,
    rule_set: RuleSet = rules.FULL_RULES,
    patterns: E.Patterns = rules.FIELD_PATTERNS,
    origin: str = "llm",
) -> DataFrame:
    """`classify_documents` and then `extract_records` over (doc_id, document_name, file_name, text),
    in one pass over the texts and without moving them.

    A document that the rules leave open gets its type from an answer, by a join. Its patterns are
    read before that, for each type that has patterns, and the join picks the row of the type that
    was answered: what is shuffled is slim.
    """
    kinds = list(patterns)
    open_, answered = F.col("status") == "unresolved", F.col("predicted_type")
    none = F.lit(None).cast("string")
    candidates = F.when(open_, F.array(none, *(F.lit(k) for k in kinds))).otherwise(F.array("predicted_type"))
    ruled = C.classify_with_rules(texts, rule_set).withColumn("document_type", F.explode(candidates))
    slim = E.with_has_text(E.extract_fields(ruled, patterns)).drop("text", "file_name")
    typed = C.apply_fallback(slim, type_answers, origin=origin)
    # of an open document, the row of its type, or the one without patterns
    wanted = F.when(answered.isin(*kinds), answered)
    chosen = typed.where(~open_ | F.col("document_type").eqNullSafe(wanted))
    chosen = chosen.withColumn("document_type", answered).drop("status", *C.RESULT_COLUMNS)
    return _merged(chosen, field_answers)


def analyze_records(records: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The four finding tables over records that exist (failed and skipped ones do not)."""
    return {
        "duplicate_invoices": A.duplicate_invoices(records),
        "expiring_contracts": A.expiring_contracts(records, as_of),
        "vendor_spend": A.vendor_net_spend(records),
        "data_quality_flags": A.data_quality_flags(records),
    }


def report_tables(records: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The report: headline counts, duplicate alerts, risks, spend and flags."""
    findings = analyze_records(records, as_of)
    return {
        "dashboard_summary": dashboard_kpis(records, as_of),
        "duplicate_payment_alerts": A.duplicate_alert_rows(records),
        "contract_expiry_risks": findings["expiring_contracts"].withColumn(
            "parties", F.to_json("parties")
        ),
        "top_vendor_net_spend": findings["vendor_spend"],
        "data_quality_flags": findings["data_quality_flags"],
    }
