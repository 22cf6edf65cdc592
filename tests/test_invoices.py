import random
import re

import pytest
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.catalog import derive as X
from foliospark.functions import patterns as P
from foliospark.operators import invoices as I
from foliospark.operators import validate as V
from foliospark.plans import invoices as PI


def frame(spark, texts):
    return spark.createDataFrame(
        [(i, f"f{i}.pdf", t) for i, t in enumerate(texts)], "doc_id INT, source_file STRING, text STRING"
    )


TOKENS = [
    "Widget deluxe", "Blue (large) part", "x", "ab", " ", "  ", "   ", "\n", "\t", "2", "3.5", "10",
    "$", "3.50", "1,000.00", "7.", ",", "@", " @ ", "  2  $3.50  $7.00", " 4 @ $1.00 $4.00", "é", "-", "&",
    "mail@host 7", "\x01", "Items 0",
]


def expected_items(text):
    items = []
    for rank, pattern in enumerate(rules.LINE_ITEM_PATTERNS):
        for m in re.findall(pattern, text, re.MULTILINE | re.IGNORECASE):
            try:
                q, u, t = float(m[1]), float(m[2].replace(",", "")), float(m[3].replace(",", ""))
            except ValueError:
                continue
            if q > 0 and u > 0 and t > 0:
                items.append((m[0].strip().title(), q, u, t, 0.9 - rank * 0.1))
    return items


def test_line_items_equal_plain_find_all(spark):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(TOKENS) for _ in range(rnd.randint(1, 30))) for _ in range(3000)]
    rows = frame(spark, texts).select("doc_id", I.line_items(F.col("text")).alias("x")).collect()
    got = {r.doc_id: [(i.description, i.quantity, i.unit_price, i.total_price, i.confidence) for i in r.x] for r in rows}
    want = {i: expected_items(t) for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 1000
    assert got == want


def test_one_at_line(spark):
    r = frame(spark, ["Widget deluxe 2 @ $3.50 $7.00"]).select(I.line_items(F.col("text")).alias("x")).first()
    assert [(i.description, i.quantity, i.confidence) for i in r.x] == [("Widget Deluxe", 2.0, 0.8)]


def test_long_single_line_is_linear(spark):
    text = "word me@host 5 and " * 20000 + " 5 @ x"
    r = frame(spark, [text]).select(I.line_items(F.col("text")).alias("x")).first()
    assert r.x == []


def test_header(spark):
    text = "Inv #: A-7\nDate: 25/12/2024\nAmount due: $1,200.50\nfrom: o'neil\nVendor: acme 3d-x trading 9"
    r = I.header_fields(frame(spark, [text, ""])).orderBy("doc_id").collect()
    assert (r[0].invoice_number, r[0].invoice_date, r[0].total_amount) == ("A-7", "2024-12-25", 1200.5)
    assert r[0].invoice_number_confidence == pytest.approx(0.9)
    assert r[1].vendor_name is None and r[1].vendor_name_confidence is None


def test_overall_confidence(spark):
    df = spark.createDataFrame([(0.9, 0.9), (0.8, 0.0), (0.0, 0.9), (0.0, 0.0)], "h DOUBLE, l DOUBLE")
    got = [r.c for r in df.select(I.overall_confidence(F.col("h"), F.col("l")).alias("c")).collect()]
    assert got == pytest.approx([0.9, 0.8, 0.9, 0.0])


def parsed(spark, number, date, total, lines):
    schema = (
        "source_file STRING, basic_fields STRUCT<invoice_number: STRING, invoice_date: STRING, "
        "total_amount: DOUBLE, vendor_name: STRING, confidence_scores: MAP<STRING, DOUBLE>>, "
        "line_items ARRAY<STRUCT<description: STRING, quantity: DOUBLE, unit_price: DOUBLE, "
        "total_price: DOUBLE, confidence: DOUBLE, price_corrected: BOOLEAN>>"
    )
    items = [(*line, 0.9, False) for line in lines]
    return spark.createDataFrame([("f.pdf", (number, date, total, "V", {}), items)], schema)


def test_validation(spark):
    lines = [
        ("A  b", 2.0, 10.0, 20.05), ("C", 2.0, 10.0, 20.01), ("D", 20000.0, 1.0, 20000.0), ("E", 1.0, 0.001, 5.0),
    ]
    r = V.validate_invoices(parsed(spark, "N1", "2024-01-01", 5.0, lines)).first()
    assert r.validation.passed and r.validation.errors == []
    assert r.validation.warnings == ["Invalid quantity for item 'D'", "Invalid unit price for item 'E'"]
    assert [(i.description, i.total_price, i.price_corrected) for i in r.line_items] == [
        ("A b", 20.0, True), ("C", 20.01, False),
    ]
    assert [i.description for i in r.dropped_items] == ["D", "E"]


def test_missing_fields_fail(spark):
    r = V.validate_invoices(parsed(spark, None, None, -1.0, [])).first()
    assert r.validation.errors == ["Missing invoice number", "Missing invoice date", "Negative total amount"]
    loose = V.validate_invoices(parsed(spark, None, None, 1.0, []), strict=False)
    assert loose.first().validation.passed
    lines = V.consolidated_line_items(
        V.validate_invoices(parsed(spark, None, None, 1.0, [("A", 1.0, 1.0, 1.0)]), strict=False)
    )
    assert lines.first().invoice_number == "N/A"


def test_outcomes(spark):
    good = "Invoice No: X-1\nDate: 1/2/2024\nItems 0\nBlue widgets  2  $3.00  $6.00\nTotal: 6.00"
    texts = [good, "Credit note " + good, "", "an invoice", good.replace("Date: 1/2/2024", "1")]
    got = {r.source_file: r.outcome for r in PI.invoice_outcomes(frame(spark, texts)).collect()}
    assert got == {
        "f0.pdf": "valid", "f1.pdf": "other_type", "f2.pdf": "no_text", "f3.pdf": "low_confidence",
        "f4.pdf": "invalid",
    }
    rows = V.consolidated_invoices(PI.validated_invoices(frame(spark, texts))).collect()
    assert [(r.source_file, r.line_items_count) for r in rows] == [("f0.pdf", 1)]


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 2.0), (2, "a", 2.0)], "inv INT, d STRING, q DOUBLE")
    assert V.dedup_line_items(df, ["inv", "d", "q"]).count() == 2


def test_matches_hold_their_groups(spark):
    text = "Items 0\nBlue widgets  2  $3.00  $6.00\nnothing here 4\nRed widgets  7  $1,000.00  $7,000.00"
    at = "Blue widgets 2 @ $3.00 $6.00\nno total 2 @ $3.00"
    r = frame(spark, [text, at]).select(I._matches(F.col("text"), 0).alias("a"), I._matches(F.col("text"), 1).alias("b"))
    columns, ats = r.collect()
    assert columns.a == [["Blue widgets", "2", "3.00", "6.00"], ["Red widgets", "7", "1,000.00", "7,000.00"]]
    assert columns.b is None and ats.a is None and ats.b == [["Blue widgets", "2", "3.00", "6.00"]]


def test_unused_checks_are_left_out(spark):
    valid = PI.validated_invoices(frame(spark, ["Invoice No: X-1"]))
    for df in (V.consolidated_line_items(valid), V.consolidated_invoices(valid)):
        assert "Invalid unit price" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert "Invalid unit price" in valid._jdf.queryExecution().optimizedPlan().toString()


def test_first_letters_are_looked_at(spark):
    assert P.look_at_first_letter("(?:bill|from)x") == "(?=[bf])(?:bill|from)x"
    assert P.look_at_first_letter("(?:due)?total") == "(?=[dt])(?:due)?total"
    for plain in (r"invoice\d", r"(\d|Jan)x", r"^\s*(A|B)", r"(?:A|\$)x", r"(?:a|b)?\d"):
        assert P.look_at_first_letter(plain) == plain
    found = P.with_ranked_search(
        frame(spark, ["at ſep 5, 2024", "5 of JULY 4 2024", "x"]), "text", {"day": rules.INVOICE_DATE_PATTERNS}
    )
    assert [r.day for r in found.orderBy("doc_id").collect()] == ["ſep 5, 2024", "JULY 4 2024", None]


def test_rendered_lines(spark, tmp_path):
    prices = [(3, 1, 0.05), (3, 2, 1234567.89), (3, 3, -7.5), (4, 1, 100.0)]
    spark.createDataFrame(
        [(k, 1, 1, n, 2.0, p, "A", "O") for k, n, p in prices],
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_returnflag STRING, l_linestatus STRING",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    df = X.invoice_lines(spark, str(tmp_path))
    assert {r.o_orderkey: r.lines for r in df.collect()} == {
        3: "Accepted open goods 2 @ $-3.74 $-7.49\nAccepted open goods 2 @ $0.03 $0.05\n"
        "Accepted open goods 2 @ $617,283.95 $1,234,567.89",
        4: "Accepted open goods  2  $50.00  $100.00",
    }
    assert "collect_list(line" in df._jdf.queryExecution().optimizedPlan().toString()
