import json

from foliospark import rules
from foliospark.operators import extract as E
from foliospark.plans.staged import extract_records
from foliospark.sinks import stages as K

SCHEMA = "doc_id LONG, document_name STRING, document_type STRING, text STRING"


def documents(spark, rows):
    return spark.createDataFrame([(i, f"d{i}", t, x) for i, (t, x) in enumerate(rows)], SCHEMA)


def fields_of(row, column="rule_fields"):
    return {f.field: (f.value, f.method) for f in row[column]}


def test_typed_fields(spark):
    rows = [
        ("invoice", "invoice notification for you"),
        ("invoice", "Total Amount: $68,443.44"),
        ("receipt", "date 3/4/24 and total 7.00"),
        ("bank_statement", "total 7.00"),
        ("credit_note", "invoice no 12345"),
    ]
    got = E.extract_fields(documents(spark, rows)).orderBy("doc_id").collect()
    assert [fields_of(r) for r in got] == [
        {"invoice_number": ("tification", "regex")},
        {"total_amount": ("68443.44", "regex")},
        {"transaction_date": ("3/4/24", "regex"), "total_amount": ("7.00", "regex")},
        {},
        {},
    ]
    missing = E.missing_fields(E.extract_fields(documents(spark, rows))).orderBy("doc_id").collect()
    assert missing[3].missing == list(rules.TARGET_SCHEMAS["bank_statement"])
    assert missing[4].missing is None


def test_status_and_merge(spark):
    rows = [
        ("invoice", None),
        ("credit_note", "x"),
        ("invoice", "invoice no: ABC-123"),
        ("invoice", "invoice no: ABC-123"),
        ("invoice", "invoice no: ABC-123"),
        ("contract", "x"),
    ]
    answers = spark.createDataFrame(
        [
            (2, None, "timeout"),
            (3, 'ok {"invoice_number":null,"vendor_name":"V","odd":1}', None),
            (4, "nothing", None),
            (5, '{"contracting_parties":["A","B"],"contract_title":"T"}', None),
        ],
        "doc_id LONG, response STRING, error STRING",
    )
    got = extract_records(documents(spark, rows), answers).orderBy("doc_id").collect()
    assert [(r.extraction_status, r.error, r.reason) for r in got] == [
        ("failed", "source text file not found", None),
        ("skipped", None, "No schema for credit_note"),
        ("failed_llm", "timeout", None),
        ("success_hybrid", None, None),
        ("success_hybrid", None, None),
        ("success_hybrid", None, None),
    ]
    assert fields_of(got[2], "fields") == {"invoice_number": ("ABC-123", "regex")}
    assert fields_of(got[3], "fields") == {
        "invoice_number": (None, "llm_fallback"), "vendor_name": ("V", "llm_fallback"),
    }
    assert fields_of(got[4], "fields") == {"invoice_number": ("ABC-123", "regex")}
    wide = E.record_wide(extract_records(documents(spark, rows), answers)).orderBy("doc_id").collect()
    assert wide[5].contracting_parties == ["A", "B"] and wide[5].contract_title == "T"


def test_complete_document_needs_no_answer(spark):
    schemas = {"receipt": {"total_amount": "number"}}
    patterns = {"receipt": {"total_amount": rules.FIELD_PATTERNS["receipt"]["total_amount"]}}
    df = E.extract_fields(documents(spark, [("receipt", "total 7.00")]), patterns)
    df = E.with_has_text(df).selectExpr("*", "CAST(NULL AS STRING) AS response")
    row = E.merge_gap_fill(E.extraction_status(df, schemas), schemas, patterns).first()
    assert row.extraction_status == "success_regex"
    assert fields_of(row, "fields") == {"total_amount": ("7.00", "regex")}


def test_requests(spark):
    df = E.extract_fields(documents(spark, [("receipt", "total 7.00 " + "x" * 9000), ("other", "y")]))
    rows = E.gap_fill_requests(df).collect()
    assert len(rows) == 1
    assert list(json.loads(rows[0].missing_schema)) == [
        "vendor_name", "transaction_date", "payment_method", "vat_number",
    ]
    assert "x\n...\nx" in rows[0].request and len(rows[0].request) < 8500


def test_flat_summary(spark, tmp_path):
    answers = spark.createDataFrame([(0, '{"contracting_parties":["A"]}')], "doc_id LONG, response STRING")
    wide = E.record_wide(extract_records(documents(spark, [("contract", "x")]), answers))
    flat = E.extraction_summary_rows(wide)
    assert flat.columns == sorted(flat.columns) and "contracting_parties" not in flat.columns
    K.write_extraction_summary(wide, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == flat.columns
    assert json.loads(E.record_to_json(wide).first().json)["contracting_parties"] == ["A"]


def test_long_text_without_tail_is_linear(spark):
    # many leads and no amount: a search that restarts at every lead would not end in time
    text = "total balance due vat no date " * 30000
    row = E.extract_fields(documents(spark, [("invoice", text), ("receipt", text)])).collect()
    assert [fields_of(r) for r in row] == [{}, {}]
