"""Every operator as a query over whole tables: name → callable(spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.catalog import derive as X
from foliospark.functions import dates as D
from foliospark.functions import money as M
from foliospark.functions import text as T
from foliospark.functions.binding import bind
from foliospark.operators import analyze as A
from foliospark.operators import classify as C
from foliospark.operators import extract as E
from foliospark.operators import ingest as G
from foliospark.operators import invoices as I
from foliospark.operators import keywords as KW
from foliospark.operators import organize as O
from foliospark.operators import report as R
from foliospark.operators import validate as V
from foliospark.operators.skew import lookup_join
from foliospark.plans import ingestion as PG
from foliospark.plans import invoices as PI
from foliospark.plans import staged as PS
from foliospark.session import cut_lineage, remove_folder, shared_folder
from foliospark.sinks import stages as K
from foliospark.sources import records as SR
from foliospark.sources import runs as RUN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUN_TS = "20240102_030405"


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return plain(f(spark, sf))

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Only BIGINT, DOUBLE, BOOLEAN and STRING columns; lists become comma-separated text."""
    out: list[Column] = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        out.append(c.alias(name))
    return df.select(*out)


def fingerprint(c: Column | str) -> Column:
    """Whole texts are compared by their hash."""
    return F.md5(F.col(c) if isinstance(c, str) else c)


# --- ingestion --------------------------------------------------------------------------


@query
def discover_documents(spark, sf):
    found = G.discover_documents(X.page_listing(spark, sf).drop("text"), max_size_mb=0.01)
    return found.orderBy("path").select("path", "document_name", "extension", "length")


@query
def path_parts(spark, sf):
    return G.path_parts(X.page_listing(spark, sf)).select(
        "path", "document_name", "document_name_stem", "extension", "source_folder"
    )


@query
def extractor_route(spark, sf):
    listed = G.discover_documents(X.page_listing(spark, sf).drop("text"))
    return listed.select("path", G.extractor_route(F.col("extension")).alias("route"))


def _two_roots(spark, sf):
    docs = X.table(spark, sf, "documents").selectExpr(
        "'/data' AS root", f"{X.DOC_PATH} AS path", "octet_length(text) AS length"
    )
    pages = X.page_listing(spark, sf).select("root", "path", "length")
    return G.union_roots([pages, docs])


@query
def multi_root_union(spark, sf):
    return G.discover_documents(_two_roots(spark, sf)).select("root_ord", "root", "path", "length")


@query
def max_docs_limit(spark, sf):
    found = G.discover_documents(_two_roots(spark, sf))
    return G.limit_documents(found, 300).select("root_ord", "path")


@query
def first_documents_ingested(spark, sf):
    """The limit and the reuse of texts are decided on the listing; only the texts of the files that
    are then to be read are joined."""
    copies = X.reuse_listing(spark, sf).where(F.contains("path", F.lit("extracted_text")))
    files = G.union_roots([X.page_listing(spark, sf).unionByName(copies, allowMissingColumns=True)])
    chosen = PG.chosen_documents(files.drop("text"), 100).withColumn("file", F.coalesce("source", "path"))
    blank = F.when(F.col("page_id") % 9 == 4, " ").otherwise(F.col("text"))
    texts = files.select(F.col("path").alias("file"), blank.alias("text"))
    read = lookup_join(chosen.drop("length"), texts, ["file"], ["path"], "left", wide=True)
    out = G.ingestion_outcome(read.select("path", "method", "text"))
    return out.select("path", "method", "success", "text_length", F.md5("text").alias("text_md5"))


@query
def reuse_index(spark, sf):
    return G.reuse_index(X.reuse_listing(spark, sf).drop("text"))


@query
def reuse_text_join(spark, sf):
    listed = G.discover_documents(X.page_listing(spark, sf))
    docs = listed.withColumn("method", G.extractor_route(F.col("extension")))
    joined = G.attach_reused_text(docs, X.reuse_listing(spark, sf))
    return joined.select("path", "method", "reused_path", fingerprint("text").alias("text_md5"))


@query
def ingestion_flow(spark, sf):
    """Stage 1 over a listing of pages, of which some could not be read or are blank."""
    listing = X.page_listing(spark, sf)
    texts = listing.selectExpr(
        "path", "CASE WHEN page_id % 6 = 0 THEN ' ' ELSE text END AS text",
        "CASE WHEN page_id % 10 = 3 THEN 'decoder failed' END AS error",
    )
    files = listing.select("root", "path", "length")
    flow = PG.ingestion_flow(files, texts, X.reuse_listing(spark, sf), max_size_mb=0.01)
    return flow.select("path", "method", "success", "text_length", "error", fingerprint("text").alias("text_md5"))


@query
def choose_longer_text(spark, sf):
    texts = X.table(spark, sf, "documents").selectExpr(
        "doc_id",
        "CASE WHEN lang = 'en' THEN text ELSE concat(source, ' ', lang, ' ') END AS direct",
        "CASE WHEN lang = 'de' THEN lang ELSE concat(text, chr(10)) END AS ocr",
    )
    chosen = T.choose_longer(F.col("direct"), F.col("ocr"), rules.SHORT_TEXT_CHARS)
    return texts.select("doc_id", chosen.alias("text")).select(
        "doc_id", F.length("text").alias("chars"), fingerprint("text").alias("text_md5")
    )


def _outcome(spark, sf):
    return G.ingestion_outcome(X.ingested(spark, sf))


@query
def ingestion_metrics(spark, sf):
    return G.ingestion_metrics(_outcome(spark, sf))


@query
def ingestion_summary(spark, sf):
    return R.ingestion_summary(_outcome(spark, sf))


@query
def method_distribution(spark, sf):
    return R.counts_by(_outcome(spark, sf), "method", "docs")


@query
def run_summary_methods(spark, sf):
    return R.run_summary(_outcome(spark, sf), "2024-01-02T03:04:05").select(
        "run_timestamp", "docs_total", "success", "fail", "success_rate_pct",
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries("method_distribution")),
                lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
            ),
            ",",
        ).alias("methods"),
    )


@query
def ingestion_log_lines(spark, sf):
    return G.ingestion_log_lines(_outcome(spark, sf))


@query
def stage_tracker(spark, sf):
    one = K.with_run(G.ingestion_tracker(_outcome(spark, sf)), "01_Ingestion", RUN_TS)
    typed = C.classify_with_rules(X.named_documents(spark, sf))
    two = K.with_run(C.classification_tracker(typed), "02_Classification", RUN_TS)
    three = K.with_run(R.extraction_tracker(_states(spark, sf)), "03_Extraction", RUN_TS)
    return one.unionByName(two, allowMissingColumns=True).unionByName(three, allowMissingColumns=True)


@query
def stage_run_summaries(spark, sf):
    return R.stage_run_summaries(
        _outcome(spark, sf), _classified(spark, sf), _states(spark, sf), F.lit(X.TODAY).cast("timestamp_ntz")
    )


@query
def tracker_of_run(spark, sf):
    """The run named by the caller, in path order, instead of the latest one."""
    documents = G.ingestion_tracker(_outcome(spark, sf))
    runs = K.with_run(documents, "01_Ingestion", RUN_TS).unionByName(
        K.with_run(documents.where("status = 'FAILED'"), "01_Ingestion", "20240103_000000")
    )
    return RUN.tracker_rows(runs, "01_Ingestion", RUN_TS)


@query
def tracker_of_published_run(spark, sf):
    """The latest run that was published; a later one has rows, but was never finished."""
    documents = G.ingestion_tracker(_outcome(spark, sf))
    stages_ = {"20240102_000000": "SUCCESS", "20240103_000000": "FAILED"}
    runs = [K.with_run(documents.where(F.col("status") == s), "01_Ingestion", ts) for ts, s in stages_.items()]
    finished = X.runs(spark, sf).select("stage", "run_ts").unionByName(
        X.table(spark, sf, "region").selectExpr("'01_Ingestion' AS stage", "concat('2024010', r_regionkey % 3, '_000000') AS run_ts")
    )
    return RUN.tracker_rows(runs[0].unionByName(runs[1]), "01_Ingestion", published=finished)


@query
def listing_changes(spark, sf):
    """What a rerun has to read: new, changed, unchanged and gone documents against the last run."""
    listing = G.discover_documents(X.page_listing(spark, sf)).select(
        "path", F.col("path").alias("source"), "length", (F.col("page_id") % 4).alias("modified"), "page_id"
    )
    last = listing.where("page_id % 7 <> 3").withColumns({
        "path": F.when(F.col("page_id") % 11 == 5, F.concat("path", F.lit(".old"))).otherwise(F.col("path")),
        "length": F.when(F.col("page_id") % 5 == 0, F.col("length") + 1).otherwise(F.col("length")),
        "modified": F.when(F.col("page_id") % 13 == 2, None).otherwise(F.col("modified")),
        "text_run": F.concat(F.lit("run_"), F.col("page_id") % 3),
    }).drop("page_id")
    return G.listing_changes(listing.drop("page_id"), last).select("path", "change", "text_run")


@query
def latest_run_per_stage(spark, sf):
    return RUN.latest_runs(X.runs(spark, sf), "has_text")


@query
def latest_run_rows(spark, sf):
    runs = X.runs(spark, sf)
    views = RUN.rows_of_run(runs, "view").groupBy("stage", "run_ts").agg(F.count(F.lit(1)).alias("n"))
    prefixed = RUN.latest_run_with_prefix(runs, "p").withColumn("n", F.lit(0).cast("bigint"))
    return views.unionByName(prefixed)


# --- classification ---------------------------------------------------------------------


@query
def classify_by_filename(spark, sf):
    return C.classify_by_filename(X.named_documents(spark, sf)).select(
        "doc_id", "predicted_type", "confidence", "method"
    )


@query
def content_keyword_scores(spark, sf):
    scored = C.content_keyword_scores(X.named_documents(spark, sf))
    return scored.select("doc_id", *(f"score_{t}" for t in rules.CONTENT_KEYWORDS))


@query
def classify_by_content(spark, sf):
    return C.classify_by_content(X.named_documents(spark, sf)).select(
        "doc_id", "predicted_type", "confidence", "method"
    )


def _ruled(spark, sf, rule_set=rules.FULL_RULES):
    return C.classify_with_rules(X.named_documents(spark, sf), rule_set)


@query
def classify_large_rule_set(spark, sf):
    """Documents by the passages they hold: every run of up to five words of a reference passage is
    a keyword, thousands in all."""
    words = F.split(F.lower(F.trim("text")), "\\s+")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(5)), lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - n + 1)),
        lambda i: F.array_join(F.slice("words", i, n), " "))))
    items = X.table(spark, sf, "benchmark").select(
        F.format_string("set_%02d", (F.col("item_id") % 12).cast("int")).alias("type"), words.alias("words")
    )
    listed = items.select("type", F.explode(runs).alias("keyword")).where(F.length("keyword") >= 8)
    rule_set = rules.RuleSet(filename=rules.FULL_RULES.filename, content=KW.keywords_of(listed))
    typed = C.classify_by_content(X.table(spark, sf, "documents").select("doc_id", "text"), rule_set)
    return typed.select("doc_id", "predicted_type", "confidence", "method")


@query
def classify_cascade(spark, sf):
    return _ruled(spark, sf).select(
        "doc_id", "status", "predicted_type", "confidence", "method", "reasoning"
    )


@query
def classify_cascade_compact(spark, sf):
    return _ruled(spark, sf, rules.COMPACT_RULES).select(
        "doc_id", "status", "predicted_type", "confidence", "method"
    )


@query
def classify_route_counts(spark, sf):
    return R.classify_route_counts(_ruled(spark, sf))


@query
def classify_error_rows(spark, sf):
    return _ruled(spark, sf).where(F.col("status") == "error").select(
        "document_name", *C.RESULT_COLUMNS
    )


@query
def classification_requests(spark, sf):
    return C.classification_requests(_ruled(spark, sf)).select(
        "doc_id", F.length("request").alias("chars"), fingerprint("request").alias("request_md5")
    )


def _classified(spark, sf):
    return PS.classify_documents(X.named_documents(spark, sf), X.document_answers(spark, sf))


@query
def classification_metrics(spark, sf):
    return C.classification_metrics(_classified(spark, sf))


@query
def type_distribution(spark, sf):
    return R.counts_by(_classified(spark, sf), "predicted_type", "docs")


@query
def classification_summary(spark, sf):
    return R.classification_summary(_classified(spark, sf))


@query
def ordered_keyword_class(spark, sf):
    return X.prefixed_texts(spark, sf).select(
        "doc_id", C.ordered_keyword_class(F.col("text")).alias("document_class")
    )


@query
def truncate_head_tail(spark, sf):
    docs = X.table(spark, sf, "documents").select(
        "doc_id",
        T.truncate_head_tail(F.col("text"), rules.CLASSIFY_TEXT_LIMIT).alias("a"),
        T.truncate_head_tail(F.col("text"), rules.CLASSIFY_TEXT_LIMIT_COMPACT).alias("b"),
        T.truncate_head_tail(F.col("text"), rules.EXTRACT_TEXT_LIMIT).alias("c"),
    )
    return docs.select(
        "doc_id", *(F.length(c).alias(f"chars_{c}") for c in "abc"),
        *(fingerprint(c).alias(f"md5_{c}") for c in "abc"),
    )


@query
def parse_model_response(spark, sf):
    return C.parse_classification_responses(X.classification_answers(spark, sf)).select(
        "doc_id", *C.RESULT_COLUMNS
    )


# --- extraction -------------------------------------------------------------------------


def _ruled_fields(spark, sf):
    return E.extract_fields(X.typed_texts(spark, sf).where(F.col("text").isNotNull()))


def _fields_of(df, doc_type, fields):
    values = F.map_from_entries(F.transform("rule_fields", lambda f: F.struct(f["field"], f["value"])))
    found = df.where(F.col("document_type") == doc_type).withColumn("_v", values)
    columns = [
        (F.element_at("_v", f).try_cast("double") if E.is_number_field(f) else F.element_at("_v", f)).alias(f)
        for f in fields
    ]
    return found.select("document_name", *columns)


@query
def regex_fields_invoice(spark, sf):
    return _fields_of(_ruled_fields(spark, sf), "invoice", rules.FIELD_PATTERNS["invoice"])


@query
def regex_fields_receipt(spark, sf):
    return _fields_of(_ruled_fields(spark, sf), "receipt", rules.FIELD_PATTERNS["receipt"])


@query
def field_provenance(spark, sf):
    return E.field_provenance(_ruled_fields(spark, sf))


@query
def missing_fields(spark, sf):
    return E.missing_fields(_ruled_fields(spark, sf)).select("document_name", "missing")


@query
def gap_fill_requests(spark, sf):
    return E.gap_fill_requests(_ruled_fields(spark, sf)).select(
        "doc_id", "missing_schema", fingerprint("request").alias("request_md5")
    )


def _states(spark, sf):
    return PS.extract_states(X.typed_texts(spark, sf), X.extraction_answers(spark, sf))


def _extracted(spark, sf):
    return PS.extract_records(X.typed_texts(spark, sf), X.extraction_answers(spark, sf))


@query
def extraction_status(spark, sf):
    return _states(spark, sf).select("document_name", "extraction_status", "error", "reason")


@query
def repeated_answers(spark, sf):
    """Answers that were asked for again, an older one and a failed one beside the last."""
    last = X.extraction_answers(spark, sf).withColumns({"answered_at": F.lit(3), "error": F.lit(None).cast("string")})
    older = last.withColumns({"answered_at": F.lit(1), "response": F.lit('{"vendor_name":"old"}')})
    failed = last.withColumns({"answered_at": F.lit(2), "error": F.lit("timeout")})
    records = PS.extract_records(X.typed_texts(spark, sf), older.unionByName(failed).unionByName(last))
    return records.select("document_name", "extraction_status", "error", "reason")


@query
def merge_gap_fill(spark, sf):
    return E.field_provenance(_extracted(spark, sf), "fields")


@query
def extraction_wide(spark, sf):
    return E.extraction_summary_rows(E.record_wide(_extracted(spark, sf)))


@query
def extraction_run_summary(spark, sf):
    return R.extraction_run_summary(_extracted(spark, sf))


@query
def distinct_field_names(spark, sf):
    return E.distinct_field_names(_extracted(spark, sf))


# --- invoices ---------------------------------------------------------------------------


@query
def invoice_header_fields(spark, sf):
    return I.header_fields(X.invoice_texts(spark, sf), this_year=X.THIS_YEAR).select(
        "doc_id", *I.HEADER_PATTERNS,
        *(F.round(f"{f}_confidence", 4).alias(f"{f}_confidence") for f in I.HEADER_PATTERNS),
    )


@query
def invoice_fields_in_prose(spark, sf):
    """Invoices that stand between the paragraphs of a long document, and documents without one."""
    prose = X.table(spark, sf, "documents").selectExpr("doc_id", "text AS prose")
    texts = prose.join(X.invoice_texts(spark, sf).select("doc_id", "text"), "doc_id", "left")
    around = bind(texts.withColumn("text", F.concat_ws("\n", "prose", "text", "prose")), ["text"])
    return I.header_fields(around, this_year=X.THIS_YEAR).select(
        "doc_id", "invoice_number", "total_amount",
        *(F.round(f"{f}_confidence", 4).alias(f"{f}_confidence") for f in ("invoice_number", "total_amount")),
    )


@query
def invoice_line_items(spark, sf):
    items = X.invoice_texts(spark, sf).select(
        "doc_id", F.explode(I.line_items(F.col("text"))).alias("i")
    )
    return items.select(
        "doc_id", "i.description", "i.quantity", "i.unit_price", "i.total_price",
        F.round("i.confidence", 4).alias("confidence"),
    )


@query
def invoice_confidence(spark, sf):
    return I.confident(I.parse_invoices(X.invoice_texts(spark, sf), this_year=X.THIS_YEAR)).select(
        "doc_id", F.round("overall_confidence", 6).alias("overall_confidence"),
        F.size("line_items").alias("lines"),
    )


@query
def tax_amount(spark, sf):
    text = (
        f"CASE o_orderkey % 4 WHEN 0 THEN concat('Sales Tax (8.25%): $', format_number({X.PRICE}, 2)) "
        f"WHEN 1 THEN concat('VAT (19%) : ', format_number({X.PRICE}, 2)) "
        f"WHEN 2 THEN concat('tax ', CAST(o_custkey AS STRING)) ELSE 'no charges' END"
    )
    texts = X.table(spark, sf, "orders").selectExpr("o_orderkey AS doc_id", f"{text} AS text")
    return I.tax_amount(texts).select(
        "doc_id", "tax_amount", F.round("tax_confidence", 4).alias("tax_confidence")
    )


def _lines(spark, sf):
    """All line items as rows, with a unit price rounded to cents and untidy descriptions."""
    return X.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"concat('  ', {X.GOODS}, chr(9), ' ', l_partkey) AS description",
        "l_quantity * CASE WHEN l_returnflag = 'R' THEN 250 ELSE 1 END AS quantity",
        "CAST(floor(l_extendedprice / l_quantity * 100) AS DOUBLE) / 100 AS unit_price",
        "l_extendedprice AS total_price",
    )


@query
def line_item_ranges(spark, sf):
    return V.check_line_items(_lines(spark, sf)).select(
        "l_orderkey", "l_linenumber", "description", "quantity", "unit_price", "valid",
        F.size("warnings").alias("warning_count"), F.array_join("warnings", "; ").alias("warnings"),
    )


@query
def line_item_correction(spark, sf):
    return V.check_line_items(_lines(spark, sf)).select(
        "l_orderkey", "l_linenumber", "quantity", "unit_price", "total_price", "price_corrected"
    )


@query
def line_item_dedup(spark, sf):
    lines = X.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", f"{X.GOODS} AS description", "l_quantity", "l_linenumber"
    )
    return V.dedup_line_items(lines, ["l_orderkey", "description", "l_quantity", "l_linenumber"])


def _validated(spark, sf):
    return PI.validated_invoices(X.invoice_texts(spark, sf), X.THIS_YEAR)


@query
def invoice_validation(spark, sf):
    return _validated(spark, sf).select(
        "doc_id", "validation.passed", F.array_join("validation.errors", ",").alias("errors"),
        F.array_join(F.array_sort("validation.warnings"), ",").alias("warnings"),
        F.size("line_items").alias("kept_lines"), F.size("dropped_items").alias("dropped_lines"),
    )


@query
def consolidated_invoices(spark, sf):
    return V.consolidated_invoices(_validated(spark, sf))


@query
def consolidated_line_items(spark, sf):
    return V.consolidated_line_items(_validated(spark, sf)).withColumn(
        "confidence", F.round("confidence", 4)
    )


@query
def consolidation_summary(spark, sf):
    outcomes = PI.invoice_outcomes(X.invoice_texts(spark, sf), X.THIS_YEAR)
    return R.consolidation_summary(outcomes, F.lit(X.TODAY).cast("timestamp_ntz"))


# --- joins between stages ---------------------------------------------------------------


def _types(spark, sf):
    return X.records(spark, sf).select("doc_id", "document_name", "document_type")


@query
def classified_text_join(spark, sf):
    texts = X.typed_texts(spark, sf).where(F.col("text").isNotNull())
    joined = SR.join_classified_text(_types(spark, sf), texts)
    return joined.select(
        "document_name", "document_type",
        F.when(F.col("text").isNull(), "failed").otherwise("found").alias("state"),
    )


def _existing_records(spark, sf):
    """Records that extraction leaves behind: types with a target schema."""
    return X.record_json(spark, sf).where(F.col("document_type").isin(*rules.TARGET_SCHEMAS))


@query
def classified_record_join(spark, sf):
    parsed = SR.parse_records(_existing_records(spark, sf).select("doc_id", "json"))
    return SR.join_classified_records(_types(spark, sf), parsed).select(
        "document_name", "document_type", "extraction_status", "vendor_name"
    )


@query
def unextracted_documents(spark, sf):
    return SR.unextracted_documents(_types(spark, sf), _existing_records(spark, sf)).select(
        "document_name", "document_type"
    )


@query
def json_record_scan(spark, sf):
    parsed = SR.parse_records(X.record_json(spark, sf))
    return parsed.select(
        "document_name", "extraction_status", "error", "vendor_name", "invoice_number",
        M.parse_money(F.col("total_amount")).alias("total_amount"), "termination_date",
        "contracting_parties",
    )


@query
def record_to_json(spark, sf):
    rows = X.records(spark, sf).select(
        "document_name", "extraction_status", "invoice_number", "vendor_name"
    )
    return E.record_to_json(rows)


# --- findings and reports ---------------------------------------------------------------


@query
def duplicate_invoices(spark, sf):
    return A.duplicate_invoices(X.rebilled_records(spark, sf)).select(
        "vendor_name", "invoice_number", "amount", "document_count", "document_name"
    )


@query
def duplicate_group_lists(spark, sf):
    return A.duplicate_group_lists(X.rebilled_records(spark, sf)).select(
        "vendor_name", "invoice_number", "amount", "list_number", "lists", "documents"
    )


@query
def duplicate_alert_rows(spark, sf):
    return A.duplicate_alert_rows(X.rebilled_records(spark, sf))


@query
def vendor_net_spend(spark, sf):
    return A.vendor_net_spend(X.records(spark, sf))


@query
def top_vendor(spark, sf):
    return R.top_vendor(A.vendor_net_spend(X.records(spark, sf)))


@query
def dashboard_kpis(spark, sf):
    return R.dashboard_kpis(X.rebilled_records(spark, sf), X.TODAY)


@query
def summary_request(spark, sf):
    records = X.rebilled_records(spark, sf)
    return R.summary_request(R.dashboard_kpis(records, X.TODAY), A.vendor_net_spend(X.records(spark, sf)))


@query
def expiring_contracts(spark, sf):
    return A.expiring_contracts(X.records(spark, sf), X.TODAY)


@query
def unparsable_dates(spark, sf):
    return A.unparsable_dates(X.records(spark, sf))


@query
def data_quality_flags(spark, sf):
    return A.data_quality_flags(X.records(spark, sf))


# --- scalar functions -------------------------------------------------------------------


@query
def date_normalize(spark, sf):
    d, m, y = "day(o_orderdate)", "month(o_orderdate)", "year(o_orderdate)"
    text = f"""CASE o_orderkey % 7 WHEN 0 THEN concat({m}, '/', {d}, '/', {y})
      WHEN 1 THEN concat({d}, ' ', {X._MON}, ' ', {y}) WHEN 2 THEN concat({X._MON}, ' ', {d}, ', ', {y})
      WHEN 3 THEN {X.DAY} WHEN 4 THEN concat({m}, '.', {d}, '.', lpad(CAST({y} % 100 AS STRING), 2, '0'))
      WHEN 5 THEN CASE WHEN {d} > 12 THEN concat({d}, '-', {m}, '-', {y}) ELSE concat({m}, '-', {d}, '-', {y}) END
      ELSE concat('13-13-', {y}) END"""
    return X.table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS s").select(
        "o_orderkey", D.loose_date(F.col("s"), X.THIS_YEAR).alias("day")
    )


@query
def date_among_words(spark, sf):
    """Order dates with weekdays, ordinals, times and words around them, and as week dates."""
    d, m, y = "day(o_orderdate)", "month(o_orderdate)", "year(o_orderdate)"
    ending = f"CASE WHEN {d} IN (1, 21, 31) THEN 'st' WHEN {d} IN (2, 22) THEN 'nd' WHEN {d} IN (3, 23) THEN 'rd' ELSE 'th' END"
    weekday = "element_at(array('Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'), weekday(o_orderdate) + 1)"
    week = "extract(YEAROFWEEK FROM o_orderdate), '-W', lpad(CAST(weekofyear(o_orderdate) AS STRING), 2, '0')"
    text = f"""CASE o_orderkey % 8 WHEN 0 THEN concat({weekday}, ', ', {d}, ' ', {X._MON}, ' ', {y})
      WHEN 1 THEN concat('the ', {d}, {ending}, ' of ', {X._MON}, ', ', {y}) WHEN 2 THEN concat('due on ', {X.DAY}, 'T10:30:00')
      WHEN 3 THEN concat({week}, '-', weekday(o_orderdate) + 1) WHEN 4 THEN concat('(', {m}, '/', {d}, '/', {y}, ', 8:05 pm)')
      WHEN 5 THEN concat({y}, ' ', {X._MON}, ' ', {d}) WHEN 6 THEN replace({X.DAY}, '-', '')
      ELSE concat('order ', o_orderkey, ' of ', {d}, ' ', {X._MON}, ' ', {y}) END"""
    return X.table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS s").select(
        "o_orderkey", D.loose_date(F.col("s"), X.THIS_YEAR).alias("day")
    )


@query
def title_case(spark, sf):
    text = "concat('o''', upper(p_name), '-', lower(p_type), ' 3d & ', p_brand)"
    return X.table(spark, sf, "part").selectExpr("p_partkey", f"{text} AS s").select(
        "p_partkey", T.title_case(F.col("s")).alias("title")
    )


@query
def money_parse(spark, sf):
    text = f"""CASE o_orderkey % 8 WHEN 0 THEN concat('$', format_number({X.PRICE}, 2))
      WHEN 1 THEN concat(' ', CAST({X.PRICE} AS STRING), ' ') WHEN 2 THEN 'n/a' WHEN 3 THEN NULL
      WHEN 4 THEN concat(o_custkey, 'e3') WHEN 5 THEN concat(o_custkey, 'd') WHEN 6 THEN 'nan'
      ELSE concat('-$', o_custkey, '_0') END"""
    return X.table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS s").select(
        "o_orderkey", M.money_or_zero(F.col("s")).alias("amount")
    )


@query
def text_normalize(spark, sf):
    text = "concat(chr(9), ' ', upper(p_name), chr(10), ' ', chr(160), p_type, '  ', p_brand, chr(13))"
    return X.table(spark, sf, "part").selectExpr("p_partkey", f"{text} AS s").select(
        "p_partkey",
        F.lower(T.strip(F.col("s"))).alias("stripped"),
        T.collapse_whitespace(F.col("s")).alias("collapsed"),
        T.is_blank(F.col("s")).alias("blank"),
    )


# --- organising -------------------------------------------------------------------------


def _manifest(spark, sf):
    listing = X.page_listing(spark, sf)
    ingested = G.discover_documents(listing.drop("text")).select("path", "document_name")
    typed = G.path_parts(
        X.table(spark, sf, "pages").selectExpr(f"{X.PAGE_PATH} AS path", f"{X.PAGE_LABEL} AS predicted_type")
    ).select("path", F.col("document_name_stem").alias("document_name"), "predicted_type")
    return O.organize_manifest(ingested, typed)


@query
def organize_manifest_by_name(spark, sf):
    listing = X.page_listing(spark, sf).drop("text")
    ingested = G.discover_documents(listing).select("path", "document_name")
    typed = G.path_parts(
        X.table(spark, sf, "pages").selectExpr(f"{X.PAGE_PATH} AS path", f"{X.PAGE_LABEL} AS predicted_type")
    ).select("path", F.col("document_name_stem").alias("document_name"), "predicted_type")
    return O.organize_manifest_by_name(ingested, typed)


@query
def organize_manifest(spark, sf):
    return _manifest(spark, sf)


@query
def organize_summary(spark, sf):
    still_there = X.table(spark, sf, "pages").where("NOT contains(url, '#')").selectExpr(
        f"{X.PAGE_PATH} AS path"
    )
    return O.organize_summary(O.with_presence(_manifest(spark, sf), still_there))


@query
def files_by_bytes(spark, sf):
    """How the documents of each source fill files of 64 kB: none beyond that and the row that fills
    it, none but the first and last of a source below it."""
    docs, limit = X.table(spark, sf, "documents"), 65536
    packed = K.packed_by_bytes(docs, "source", limit).withColumn("bytes", K.row_bytes(docs))
    files = packed.groupBy("source", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("widest")
    )
    return files.groupBy("source").agg(
        F.sum("n").alias("documents"),
        F.sum("bytes").alias("bytes"),
        F.bool_and(F.col("bytes") <= limit + F.col("widest")).alias("none_too_large"),
        (F.count(F.lit(1)) <= F.ceil(F.sum("bytes") / limit) + 1).alias("none_too_many"),
    )


# --- results that go through files ------------------------------------------------------


def _through(spark, write, read):
    """What `read` makes of what `write` wrote into a new shared folder, which goes when it is read."""
    folder = f"{shared_folder(spark)}/through-{uuid.uuid4().hex}"
    write(folder)
    out = cut_lineage(read(folder))
    remove_folder(spark, folder)
    return out


@query
def pdf_discovery(spark, sf):
    found = G.discover_documents(X.page_listing(spark, sf).drop("text"), suffixes=[".pdf"], max_size_mb=None)
    return found.select("path", "document_name", "length")


@query
def classification_csv_round_trip(spark, sf):
    """Results of stage 2 as the flat file that stage 3 reads."""
    results = C.classification_metrics(_classified(spark, sf))
    return _through(
        spark, lambda at: K.write_csv(results, at), lambda at: SR.read_classification_csv(spark, at)
    )


@query
def analysis_round_trip(spark, sf):
    """The four tables of stage 4 as stage 5 reads them: rows of each, and what they add up to."""
    tables = PS.analyze_records(X.records(spark, sf), X.TODAY)
    tables["duplicate_invoices"] = A.duplicate_invoices(X.rebilled_records(spark, sf))

    def read(at):
        back = SR.read_analysis(spark, at)
        total = {"duplicate_invoices": "document_count", "expiring_contracts": "days_to_expiry", "vendor_spend": "doc_count"}
        rows = [
            df.select(
                F.lit(name).alias("name"),
                (F.col(total[name]) if name in total else F.length("issue")).cast("bigint").alias("n"),
            )
            for name, df in back.items()
        ]
        every = reduce(DataFrame.unionByName, rows)
        return every.groupBy("name").agg(F.count(F.lit(1)).alias("rows_"), F.sum("n").alias("total"))

    return _through(spark, lambda at: K.write_analysis(tables, at), read)


@query
def text_table_round_trip(spark, sf):
    """The texts of a published run, as stage 2 reads them: one row per document, in path order."""
    outcome = _outcome(spark, sf).where("success").select("path", "document_name", "text")

    def write(at):
        K.write_run(outcome, at, "01_Ingestion", RUN_TS)
        # a later run that was never finished
        K.write_stage(outcome.limit(1), at, "01_Ingestion", "20250101_000000")

    def read(at):
        texts = spark.read.parquet(at)
        return RUN.tracker_rows(texts, "01_Ingestion", published=RUN.read_published(spark, at))

    return _through(spark, write, read).select("path", "document_name", "run_ts", fingerprint("text").alias("text_md5"))
