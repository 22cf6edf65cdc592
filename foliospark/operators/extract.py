"""Typed fields per document: patterns first, then the answers of an external model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import json as J
from foliospark.functions import money as M
from foliospark.functions import text as T
from foliospark.functions.binding import bind
from foliospark.functions.guards import LOOKED_AT, guarded, with_folded
from foliospark.functions.patterns import commit_to_first_lead, search

Patterns = dict[str, dict[str, str]]
Schemas = dict[str, dict[str, str]]
INSTRUCTION = (
    "Copy the values of the listed fields from the document text, exactly as written; use null "
    "for a field that does not occur. Answer with one JSON object with this layout: "
)


def is_number_field(field: str) -> bool:
    return "amount" in field or "balance" in field


def all_fields(schemas: Schemas = rules.TARGET_SCHEMAS, patterns: Patterns | None = None) -> list[str]:
    """Every field of every type, in declared order."""
    seen: dict[str, None] = {}
    for fields in (*schemas.values(), *(patterns or {}).values()):
        seen.update(dict.fromkeys(fields))
    return list(seen)


def _by_type(doc_type: Column, per_type: dict[str, Column]) -> Column:
    chosen = None
    for name, value in per_type.items():
        hit = doc_type == name
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen


def rule_values(
    doc_type: Column, text: Column, patterns: Patterns = rules.FIELD_PATTERNS, linear: bool = True
) -> dict[str, Column]:
    """Raw text per field: first match of the pattern of the row's type; '' when none.

    `linear` uses the form of the patterns whose cost grows with the text only once, behind
    their literal guards (the frame is one of `guards.with_folded`).
    """
    def found(pattern: str) -> Column:
        return guarded(pattern, search(text, commit_to_first_lead(pattern))) if linear else search(text, pattern)

    values = {}
    for field in all_fields({}, patterns):
        per_type = {t: found(fields[field]) for t, fields in patterns.items() if field in fields}
        values[field] = _by_type(doc_type, per_type)
    return values


def extract_fields(
    df: DataFrame,
    patterns: Patterns = rules.FIELD_PATTERNS,
    doc_type: str = "document_type",
    text: str = "text",
    linear: bool = True,
) -> DataFrame:
    """Add `rule_fields`: an array of (field, value, method) with the fields that were found.

    Numbers are kept as clean text (no thousands separators).
    """
    raw = rule_values(F.col(doc_type), F.col(text), patterns, linear)
    # types without patterns are not folded
    seen = F.when(F.col(doc_type).isin(*patterns), F.col(text))
    df = with_folded(df.withColumn("_seen", seen), "_seen") if linear else df
    df = df.withColumns({f"_raw_{f}": c for f, c in raw.items()})
    entries = []
    for field in raw:
        value = T.strip(F.col(f"_raw_{field}"))
        if is_number_field(field):
            value = F.replace(value, F.lit(","), F.lit(""))
        entries.append(
            F.when(
                F.col(f"_raw_{field}") != "",
                F.struct(
                    F.lit(field).alias("field"), value.alias("value"), F.lit("regex").alias("method")
                ),
            )
        )
    found = df.withColumn("rule_fields", F.array_compact(F.array(*entries)))
    return bind(found.drop("_seen", *LOOKED_AT, *(f"_raw_{f}" for f in raw)), ["rule_fields"])


def field_provenance(df: DataFrame, fields: str = "rule_fields") -> DataFrame:
    """One row per found field, with the method that found it."""
    return df.select(
        "document_name", "document_type", F.explode(fields).alias("_f")
    ).select("document_name", "document_type", "_f.field", "_f.value", "_f.method")


def schema_fields(doc_type: Column, schemas: Schemas = rules.TARGET_SCHEMAS) -> Column:
    """Field names of the type's target schema; NULL when the type has none."""
    return _by_type(
        doc_type, {t: F.array(*(F.lit(f) for f in fields)) for t, fields in schemas.items()}
    )


def missing_fields(df: DataFrame, schemas: Schemas = rules.TARGET_SCHEMAS) -> DataFrame:
    """Add `missing`: target fields that the patterns did not find, in declared order."""
    found = F.transform("rule_fields", lambda f: f["field"])
    return df.withColumn("missing", F.array_except(schema_fields(F.col("document_type"), schemas), found))


def gap_fill_requests(
    df: DataFrame,
    schemas: Schemas = rules.TARGET_SCHEMAS,
    limit: tuple[int, float, float] = rules.EXTRACT_TEXT_LIMIT,
    instruction: str = INSTRUCTION,
    key: str = "doc_id",
) -> DataFrame:
    """What to ask a model: one row per document with a schema and missing fields."""
    kinds = F.create_map(
        *(
            F.lit(x)
            for f in all_fields(schemas)
            for x in (f, next(s[f] for s in schemas.values() if f in s))
        )
    )
    layout = F.to_json(
        F.map_from_arrays("missing", F.transform("missing", lambda f: F.element_at(kinds, f)))
    )
    body = T.truncate_head_tail(F.col("text"), limit)
    return (
        missing_fields(df, schemas)
        .where(F.size("missing") > 0)
        .select(
            key,
            layout.alias("missing_schema"),
            F.concat(F.lit(instruction), layout, F.lit("\n\n"), body).alias("request"),
        )
    )


def with_has_text(df: DataFrame) -> DataFrame:
    """Add `has_text`: whether the document's text was found."""
    return df.withColumn("has_text", F.col("text").isNotNull())


def extraction_status(
    df: DataFrame, schemas: Schemas = rules.TARGET_SCHEMAS
) -> DataFrame:
    """Add extraction_status, error and reason.

    `df` has document_type, has_text, rule_fields and the model answer:
    `response` and, optionally, `response_error`. A document is complete when the patterns
    found as many fields as its schema has; otherwise the answer decides.
    """
    call_error = (
        F.col("response_error") if "response_error" in df.columns else F.lit(None).cast("string")
    )
    read = df.withColumn("_wanted", F.size(schema_fields(F.col("document_type"), schemas)))
    no_text, no_schema = ~F.col("has_text"), F.col("_wanted") < 0
    wanted = F.coalesce("_wanted", F.lit(-1))
    read = read.withColumn("_wanted", wanted).withColumn(
        "_open",
        ~no_text & ~no_schema & (F.size("rule_fields") != F.col("_wanted")),
    ).withColumn(
        "_answer",
        F.when(F.col("_open"), J.parse_object(J.outermost_object(F.col("response")))),
    )
    failure = F.coalesce(
        call_error,
        F.when(F.col("response").isNull(), "no response"),
        F.when(F.col("_answer").isNull(), "invalid JSON in response"),
    )
    status = (
        F.when(no_text, "failed")
        .when(no_schema, "skipped")
        .when(~F.col("_open"), "success_regex")
        .when(failure.isNull(), "success_hybrid")
        .otherwise("failed_llm")
    )
    done = read.withColumns(
        {
            "extraction_status": status,
            "error": F.when(no_text, rules.ERROR_NO_SOURCE).when(F.col("_open"), failure),
            "reason": F.when(
                ~no_text & no_schema, F.concat(F.lit(rules.REASON_NO_SCHEMA), F.col("document_type"))
            ),
        }
    ).drop("_wanted", "_open")
    return bind(done, ["_answer", "extraction_status", "error", "reason"])


def merge_gap_fill(
    df: DataFrame, schemas: Schemas = rules.TARGET_SCHEMAS, patterns: Patterns = rules.FIELD_PATTERNS
) -> DataFrame:
    """Add `fields`: an array of (field, value, method) after merging the model answer.

    `df` comes from `extraction_status`. A key of the answer replaces the value the patterns
    found, even by null; the values that were found stay when the call failed. Documents
    without a record (failed, skipped) get no fields. Fields outside the type's schema stay
    in the `answer` variant.
    """
    usable = F.col("extraction_status") == "success_hybrid"
    recorded = F.col("extraction_status").isin("success_regex", "success_hybrid", "failed_llm")
    found = F.map_from_entries(
        F.transform("rule_fields", lambda f: F.struct(f["field"], f["value"]))
    )
    df = df.withColumn("_found", found)
    entries = []
    for field in all_fields(schemas, patterns):
        types = [
            t for t in {*schemas, *patterns} if field in schemas.get(t, {}) or field in patterns.get(t, {})
        ]
        applies = F.col("document_type").isin(*sorted(types))
        answered = usable & J.has_key(F.col("_answer"), field)
        entries.append(
            F.when(
                recorded & applies & answered,
                F.struct(
                    F.lit(field).alias("field"),
                    J.get_string(F.col("_answer"), field).alias("value"),
                    F.lit("llm_fallback").alias("method"),
                ),
            ).when(
                recorded & applies & F.map_contains_key("_found", field),
                F.struct(
                    F.lit(field).alias("field"),
                    F.element_at("_found", field).alias("value"),
                    F.lit("regex").alias("method"),
                ),
            )
        )
    merged = (
        df.withColumn("fields", F.array_compact(F.array(*entries)))
        .withColumn("answer", F.when(usable, F.col("_answer")))
        .drop("_found", "_answer")
    )
    return bind(merged, ["fields"])


def record_wide(df: DataFrame, schemas: Schemas = rules.TARGET_SCHEMAS) -> DataFrame:
    """One typed column per target field (numbers as double, lists as arrays)."""
    values = F.map_from_entries(F.transform("fields", lambda f: F.struct(f["field"], f["value"])))
    kinds = {f: k for fields in schemas.values() for f, k in fields.items()}
    columns = []
    for field in all_fields(schemas):
        value = F.element_at("_values", field)
        if kinds[field] == "number":
            value = M.parse_money(value)
        elif kinds[field] == "array":
            value = F.coalesce(
                F.from_json(value, "array<string>"), F.when(value.isNotNull(), F.array(value))
            )
        columns.append(value.alias(field))
    return df.withColumn("_values", values).select(
        *(["doc_id"] if "doc_id" in df.columns else []),
        "document_name", "document_type", "extraction_status", "error", "reason", *columns,
    )


def scalar_columns(df: DataFrame) -> list[str]:
    """Names of the columns a flat file can hold, sorted."""
    nested = ("array", "map", "struct", "variant")
    return sorted(n for n, t in df.dtypes if not t.startswith(nested))


def extraction_summary_rows(records: DataFrame) -> DataFrame:
    """Flat rows for the summary file: scalar columns only, in name order."""
    return records.select(*scalar_columns(records))


def record_to_json(records: DataFrame, key: str = "document_name") -> DataFrame:
    """One JSON text per document, without absent fields."""
    data = [c for c in records.columns if c not in ("doc_id", "document_name", "document_type")]
    return records.select(
        key, *(c for c in ("document_type",) if c in records.columns),
        F.to_json(F.struct(*data)).alias("json"),
    )


def distinct_field_names(df: DataFrame, fields: str = "fields") -> DataFrame:
    """Every key that occurs in any record, with its method key."""
    names = df.select(F.explode(fields).alias("_f")).select(F.col("_f.field").alias("name")).distinct()
    return names.select(
        F.explode(F.array("name", F.concat("name", F.lit("_method")))).alias("name")
    )
