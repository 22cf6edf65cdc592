import re

from pyspark.sql import functions as F

from foliospark import rules
from foliospark.operators import classify as C
from foliospark.operators import extract as E
from foliospark.plans.staged import classify_documents, extract_records, records_of_texts

FIELDS = ("status", "predicted_type", "confidence", "method")


def classify(spark, rows, rule_set=rules.FULL_RULES):
    df = spark.createDataFrame(
        [(i, n, n.rsplit(".", 1)[0], t) for i, (n, t) in enumerate(rows)],
        "doc_id LONG, file_name STRING, document_name STRING, text STRING",
    )
    got = C.classify_with_rules(df, rule_set).orderBy("doc_id").collect()
    return [tuple(r[f] for f in FIELDS) for r in got]


def test_rule_cascade(spark):
    rows = [
        ("INV-77.txt", "any"),
        ("expo-2024.txt", "any"),
        ("invoice-receipt.txt", "any"),
        ("a.txt", "Invoice ... bill to ... remittance"),
        ("a.txt", "carrier and shipper"),
        ("a.txt", "symbol only"),
        ("a.txt", "agreement parties shipper carrier"),
        ("a.txt", " \n\t "),
        ("INV-1.txt", ""),
        ("a.txt", None),
    ]
    assert classify(spark, rows) == [
        ("resolved", "invoice", 0.98, "rules_filename"),
        ("resolved", "purchase_order", 0.98, "rules_filename"),
        ("resolved", "invoice", 0.98, "rules_filename"),
        ("resolved", "invoice", 0.95, "rules_content_high"),
        ("resolved", "bill_of_lading", 0.6, "rules_content_low"),
        ("unresolved", "other", 0.0, "rules_failed"),
        ("resolved", "contract", 0.6, "rules_content_low"),
        ("error", "ERROR", 0.0, "rules_error"),
        ("error", "ERROR", 0.0, "rules_error"),
        ("error", "ERROR", 0.0, "rules_error"),
    ]


def test_compact_rules_and_threshold(spark):
    text = [("a.txt", "packing slip, packing list, item description, quantity shipped")]
    assert classify(spark, text)[0][2] == 0.95
    assert classify(spark, text, rules.COMPACT_RULES)[0][2] == 0.6
    low = rules.RuleSet(rules.FILENAME_KEYWORDS, rules.CONTENT_KEYWORDS, threshold=0.4)
    assert classify(spark, [("a.txt", "symbol")], low)[0][1:3] == ("bill_of_lading", 0.4)


def test_model_answers(spark):
    cases = [
        ('Sure: {"predicted_type":"Bank Statement","confidence":0.91234}', "bank statement", 0.9123, ""),
        ("{}", "llm_parse_error", 0.5, ""),
        ("no braces", "llm_parse_error", 0.5, ""),
        ("{broken}", "llm_connection_error", 0.0, "invalid JSON in response"),
        ('{"predicted_type":null}', "llm_parse_error", 0.5, ""),
        ('{"predicted_type":"A","confidence":"0.25"}', "a", 0.25, ""),
        ('{"predicted_type":"A","confidence":null}', "llm_connection_error", 0.0, "invalid confidence in response"),
        (None, "llm_connection_error", 0.0, "no response"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id LONG, response STRING")
    got = C.parse_classification_responses(df).orderBy("doc_id").collect()
    assert [(r.predicted_type, r.confidence, r.error) for r in got] == [c[1:] for c in cases]
    other = C.parse_classification_responses(df, "api").orderBy("doc_id").collect()
    assert other[1].predicted_type == "api_parse_error"


def test_fallback_only_fills_unresolved(spark):
    texts = spark.createDataFrame(
        [(1, "inv-1.txt", "inv-1", "x"), (2, "a.txt", "a", "x"), (3, "b.txt", "b", "x")],
        "doc_id LONG, file_name STRING, document_name STRING, text STRING",
    )
    answers = spark.createDataFrame(
        [(1, '{"predicted_type":"Memo"}'), (2, '{"predicted_type":"Memo","key_indicators":["k"]}')],
        "doc_id LONG, response STRING",
    )
    got = {r.doc_id: r for r in classify_documents(texts, answers).collect()}
    assert got[1].predicted_type == "invoice" and got[1].method == "rules_filename"
    assert (got[2].predicted_type, got[2].key_indicators) == ("memo", '["k"]')
    assert (got[3].predicted_type, got[3].error) == ("llm_connection_error", "no response")


def test_ordered_class(spark):
    cases = {
        "Credit Note for invoice 7": "credit_note",
        "remittance advice, purchase order": "remittance_advice",
        "PURCHASE ORDER for invoice": "purchase_order",
        "My Invoice": "invoice",
        "inv no: 77": "invoice",
        "bill # abc": "unknown",
        "reference no. -9": "invoice",
        "hello": "unknown",
    }
    df = spark.createDataFrame([(k,) for k in cases], "text STRING")
    got = df.select("text", C.ordered_keyword_class(F.col("text")).alias("c")).collect()
    assert {r.text: r.c for r in got} == cases


def test_labels(spark):
    df = spark.createDataFrame([(" Bank Statement",)], "s STRING")
    assert df.select(C.label_to_type(F.col("s")).alias("r")).first().r == "bank_statement"


def test_rules_accept_a_stream(spark, tmp_path):
    spark.createDataFrame(
        [(1, "inv-1.txt", "x"), (2, "a.txt", "carrier, shipper")], "doc_id LONG, file_name STRING, text STRING"
    ).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id LONG, file_name STRING, text STRING").parquet(str(tmp_path / "in"))
    q = (
        C.classify_with_rules(stream).writeStream.format("memory").queryName("typed_docs")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = {r.doc_id: r.predicted_type for r in spark.table("typed_docs").collect()}
    assert got == {1: "invoice", 2: "bill_of_lading"}


def _flow_inputs(spark):
    words = ["Invoice no: INV-77777", "total due 12.50", "receipt 01/02/2024", "nothing at all", "shipper", "vat 4123456789", ""]
    rows = [(i, f"d{i}", ["a.txt", "invoice.txt", "receipt 1.txt", None][i % 4], " ".join(words[i % 7 : i % 7 + 1 + i % 3])) for i in range(60)]
    rows.append((60, "none", "x.txt", None))
    texts = spark.createDataFrame(rows, "doc_id INT, document_name STRING, file_name STRING, text STRING")
    kinds = ["invoice", "Receipt", "Letter", "contract", None]
    answers = [(i, None if i % 6 == 5 else f'{{"predicted_type":"{kinds[i % 5]}","confidence":0.5}}') for i in range(0, 60, 1) if i % 9]
    fields = [(i, f'{{"vendor_name":"V{i}","total_amount":"{i}.5"}}') for i in range(0, 60, 2)]
    shape = "doc_id INT, response STRING"
    return texts, spark.createDataFrame(answers, shape), spark.createDataFrame(fields, shape)


def test_records_of_texts_equal_the_stages_one_by_one(spark):
    texts, answers, fields = _flow_inputs(spark)
    typed = classify_documents(texts, answers).select("doc_id", "document_name", F.col("predicted_type").alias("document_type"), "text")
    want = E.record_wide(extract_records(typed, fields)).orderBy("doc_id").collect()
    got = E.record_wide(records_of_texts(texts, answers, fields)).orderBy("doc_id").collect()
    assert got == want and len(got) == 61
    assert len({r.document_type for r in got}) > 4 and len({r.extraction_status for r in got}) > 3


def test_no_text_below_a_join(spark):
    texts, answers, fields = _flow_inputs(spark)
    plan = records_of_texts(texts, answers, fields)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if re.search(r"\bJoin\b", line)]
    assert len(joins) == 2
    # what a join reads is what the nodes right below it hand on
    for i in joins:
        below = next(line for line in lines[i + 1 :] if re.search(r"(Project|Generate|Join|Aggregate)", line))
        assert not re.search(r"(\[|, )text#\d+(,|\])", below), below
