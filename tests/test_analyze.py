import re

from pyspark.sql import functions as F

from foliospark.functions import money as M
from foliospark.operators import analyze as A
from foliospark.operators import report as R
from foliospark.plans.staged import analyze_records, report_tables
from foliospark.sinks import stages as K
from foliospark.sources import records as SR

SCHEMA = (
    "doc_id LONG, document_name STRING, document_type STRING, extraction_status STRING, error STRING, "
    "vendor_name STRING, invoice_number STRING, total_amount STRING, transaction_date STRING, "
    "effective_date STRING, termination_date STRING, contracting_parties ARRAY<STRING>"
)
NOW = "2024-06-01 12:00:00"


def records(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(
            doc_id=i, document_name=f"d{i}", document_type="invoice", extraction_status="success_hybrid",
            error=None, vendor_name=None, invoice_number=None, total_amount=None, transaction_date=None,
            effective_date=None, termination_date=None, contracting_parties=None,
        )
        full.append(tuple({**base, **r}.values()))
    return spark.createDataFrame(full, SCHEMA)


def invoice(vendor, number, amount, **more):
    return dict(vendor_name=vendor, invoice_number=number, total_amount=amount, **more)


def test_duplicates(spark):
    df = records(
        spark,
        [
            invoice(" ACME ", "X1", "$1,200.00"), invoice("acme", "x1 ", "1200"),
            invoice(None, "X2", "5"), invoice(None, "X2", "5"),
            invoice("UNKNOWN", "X3", "5"), invoice("unknown", "X3", "5"),
            invoice("a", "X4", "nan"), invoice("a", "X4", "nan"),
            invoice("a|b", "X5", "7"), invoice("A|B", "X5", "7.0"),
            invoice("acme", "X1", "1200", extraction_status="failed_llm"),
            invoice("acme", "X1", "1200", extraction_status=None),
        ],
    )
    groups = A.duplicate_group_lists(df).orderBy("vendor_name").collect()
    assert [(g.vendor_name, g.invoice_number, g.amount, g.documents) for g in groups] == [
        ("acme", "x1", 1200.0, ["d0", "d1"]), ("a|b", "x5", 7.0, ["d8", "d9"]),
    ]
    alerts = A.duplicate_alert_rows(df).orderBy("alert_group", "document_name").collect()
    assert [(a.alert_group, a.document_name) for a in alerts] == [
        ("GROUP 1", "d0"), ("GROUP 1", "d1"), ("GROUP 2", "d8"), ("GROUP 2", "d9"),
    ]


def test_net_spend(spark):
    df = records(
        spark,
        [
            invoice("V", "1", "100"), invoice("V", "2", "50.005", document_type="receipt"),
            invoice("V", "3", "30", document_type="credit_note"), invoice("v", "4", "$1,000.10"),
            invoice("V", "5", "-5"), invoice("", "6", "5"), invoice("W", "7", "n/a"),
            invoice("V", "8", "9", document_type="contract"),
        ],
    )
    spend = A.vendor_net_spend(df)
    assert [tuple(r) for r in spend.collect()] == [("v", 1000.1, 1), ("V", 120.01, 3)]
    assert tuple(R.top_vendor(spend).first()) == ("v", 1000.1)
    assert R.top_vendor(spend.limit(0)).first().top_vendor == "N/A"


def contract(**more):
    return dict(document_type="contract", **more)


def test_expiry(spark):
    ends = [
        "2024-06-01", "2024-06-02", "2024-08-31", "2024-09-01", "2024-06-10T00:00:00+01:00", "soon",
        None, "", "2024-06-10T00:00:00Z",
    ]
    df = records(spark, [contract(termination_date=e) for e in ends])
    got = A.expiring_contracts(df, NOW).collect()
    assert [(r.document_name, r.days_to_expiry, r.parties) for r in got] == [
        ("d1", 0, []), ("d8", 8, []), ("d2", 90, []),
    ]
    assert [r.document_name for r in A.unparsable_dates(df).orderBy("document_name").collect()] == ["d4", "d5"]


def test_quality_flags(spark):
    df = records(
        spark,
        [
            invoice("V", None, "0"), invoice("V", "1", "$5.00"),
            contract(contracting_parties=["A"]), contract(effective_date="x", contracting_parties=["A", "B"]),
            invoice("V", None, "0", extraction_status="failed_llm", error="timeout"),
            invoice("V", None, "0", extraction_status=None),
            dict(document_type="receipt", total_amount="1"),
        ],
    )
    got = sorted((r.document_name, r.issue, r.details) for r in A.data_quality_flags(df).collect())
    assert got == [
        ("d0", "Invalid Value", "Total amount is zero or missing."),
        ("d0", "Missing Field", "Invoice number is missing."),
        ("d2", "Invalid Value", "Fewer than two contracting parties were found."),
        ("d2", "Missing Field", "Effective date is missing."),
        ("d4", "Extraction Failed", "timeout"),
        ("d5", "Extraction Failed", "Unknown error"),
        ("d6", "Missing Field", "Transaction date is missing."),
    ]


def test_report_and_hand_off(spark, tmp_path):
    df = records(spark, [invoice("V", "1", "10"), invoice("v ", "1", "10"), contract(termination_date="2024-06-02")])
    tables = report_tables(df, NOW)
    written = K.write_report(tables, str(tmp_path / "report"))
    assert written == list(tables)
    kpis = spark.read.option("header", True).csv(str(tmp_path / "report/dashboard_summary")).collect()
    assert [int(r.value) for r in kpis] == [1, 1, 2, 2]
    empty = report_tables(df.limit(0), NOW)
    assert K.write_report(empty, str(tmp_path / "empty")) == ["dashboard_summary"]
    K.write_analysis(analyze_records(df, NOW), str(tmp_path / "analysis"))
    back = SR.read_analysis(spark, str(tmp_path / "analysis"))
    assert back["expiring_contracts"].first().days_to_expiry == 0
    assert back["duplicate_invoices"].count() == 2


def test_json_records(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.b.json").write_text(
        '{\n "vendor_name": null, "total_amount": 12.50, "contracting_parties": "Solo", "odd": {"x": 1},'
        ' "extraction_status": "success_regex"}'
    )
    (tmp_path / "j" / "bad.json").write_text("{nope")
    got = {r.document_name: r for r in SR.read_records(spark, str(tmp_path / "j")).collect()}
    assert got["a.b"].contracting_parties == ["Solo"] and got["a.b"].vendor_name is None
    assert float(got["a.b"].total_amount) == 12.5
    assert got["bad"].extraction_status is None and got["bad"].data is None


def test_spend_keeps_amounts_of_any_size(spark):
    amounts = ["1000000000000000000.00", "5.00", "0.0000001", "1e30", "-3", "n/a", "0"]
    rows = [(i, f"d{i}", "invoice", "success_hybrid", None, "v", a) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(
        rows, "doc_id LONG, document_name STRING, document_type STRING, extraction_status STRING, error STRING, "
        "vendor_name STRING, total_amount STRING")
    row = A.vendor_net_spend(df).first()
    assert row.doc_count == 4 and row.net_spend == 1e30 + 1e18 + 5


def test_numbers_of_a_million_characters(spark):
    n = 1_000_000
    texts = ["1" + "_1" * (n // 2), "9" * n, "1_" * (n // 2), "1." + "0_" * (n // 2), "1e" + "1_1" * (n // 3), "_" * n,
             "1_000.5_0", "1__0", "_1", "1_", "1_.5", "1._5", ".5", "5.", "1e1_0", "1e_1", "1_e1", "+1_0", "+_1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = {r.i: r.x for r in df.select("i", M.parse_number(F.col("t")).alias("x")).collect()}
    want = {}
    for i, t in enumerate(texts):

        ok = re.fullmatch(r"[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?", t[:50] if i >= 6 else "")
        want[i] = float(t) if ok else None
    assert {i: got[i] for i in range(6, len(texts))} == {i: want[i] for i in range(6, len(texts))}
    assert got[0] == got[1] == float("inf") and all(got[i] is None for i in (2, 3, 5))
