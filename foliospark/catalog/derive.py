"""Document collections derived from the business tables, for queries over real volumes.

Each is a whole-table projection (or a join and a bounded aggregation), so the work of a
query grows with the tables. Layouts, gaps and errors are chosen per row by its keys.

The expressions named in upper case are plain SQL that Spark and other engines read alike.
Rendered texts are bound: a query sees them as a stored column and renders each one once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.binding import bind
from foliospark.functions.dates import compact_stamp
from foliospark.operators.skew import rows_of_groups

TODAY = "2001-05-03 12:00:00"
THIS_YEAR = 2024

# --- shared expressions over orders -----------------------------------------------------

ORDER_DOC = "concat('doc-', o_orderkey)"
ORDER_TYPE = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'invoice' WHEN '2-HIGH' THEN 'receipt' "
    "WHEN '3-MEDIUM' THEN 'contract' WHEN '4-NOT SPECIFIED' THEN 'credit_note' "
    "ELSE 'bank_statement' END"
)
STATUS = (
    "CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'failed_llm' "
    "WHEN o_orderstatus = 'P' THEN 'success_regex' ELSE 'success_hybrid' END"
)
ERROR = "CASE WHEN o_orderkey % 14 = 0 THEN 'timeout' END"
VENDOR = (
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '' "
    "ELSE concat('Customer#', lpad(concat('', o_custkey), 9, '0')) END"
)
NUMBER = "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('INV-', lpad(concat('', o_orderkey), 8, '0')) END"
PRICE = "CAST(o_totalprice AS DECIMAL(18, 2))"
AMOUNT = (
    f"CASE WHEN o_orderkey % 19 = 0 THEN 0 WHEN o_orderkey % 23 = 0 THEN NULL ELSE {PRICE} END"
)
DAY = "concat('', CAST(o_orderdate AS DATE))"
TRANSACTION_DATE = f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {DAY} END"
EFFECTIVE_DATE = f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {DAY} END"
TERMINATION_DATE = (
    "CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'soon' "
    f"WHEN o_orderkey % 37 = 0 THEN concat({DAY}, 'T00:00:00+01:00') "
    f"WHEN o_orderkey % 3 = 0 THEN concat({DAY}, 'T00:00:00Z') ELSE {DAY} END"
)

# --- shared expressions over invoices ---------------------------------------------------

NUMBER_RANK = "CASE WHEN o_custkey % 6 < 4 THEN o_custkey % 6 WHEN o_custkey % 6 = 4 THEN 0 END"
DATE_RANK = "CASE WHEN o_orderkey % 5 < 4 THEN o_orderkey % 5 END"
TOTAL_RANK = "CASE WHEN o_orderkey % 4 < 3 THEN o_orderkey % 4 END"
VENDOR_RANK = "CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 7 < 3 THEN 1 ELSE 0 END"
LETTERS = "translate(concat('', o_custkey), '0123456789', 'ABCDEFGHIJ')"
AT_LAYOUT = "o_orderkey % 3 = 0"
IS_CREDIT = "o_orderpriority = '4-NOT SPECIFIED'"
GOODS = (
    "concat(CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' ELSE 'New' END, "
    "CASE l_linestatus WHEN 'O' THEN ' open goods' ELSE ' final goods' END)"
)

# --- shared expressions over documents and pages ----------------------------------------

DOC_FILE = (
    "concat(CASE doc_id % 12 WHEN 0 THEN 'INV-' WHEN 1 THEN 'receipt_' WHEN 2 THEN 'expo-' "
    "WHEN 3 THEN 'credit_note ' WHEN 4 THEN 'bank-statement-' WHEN 5 THEN 'Balance Sheet ' "
    "WHEN 6 THEN 'P&L ' WHEN 7 THEN 'service agreement ' WHEN 8 THEN 'quotation ' "
    "ELSE 'scan ' END, doc_id, '.txt')"
)
PHRASE = (
    "CASE doc_id % 10 WHEN 0 THEN 'Invoice, bill to and REMITTANCE' WHEN 1 THEN 'Carrier and shipper' "
    "WHEN 2 THEN 'symbol' WHEN 3 THEN 'agreement parties shipper carrier' "
    "WHEN 4 THEN 'Bank statement: account summary, statement period' WHEN 5 THEN 'cash sale' "
    "WHEN 6 THEN 'resume, education, skills' WHEN 7 THEN 'packing list, quantity shipped' "
    "WHEN 8 THEN 'utility bill, gas bill' ELSE '' END"
)
DOC_TEXT = (
    f"CASE WHEN doc_id % 29 = 0 THEN concat('  ', chr(10), chr(9)) "
    f"ELSE concat(text, chr(10), {PHRASE}) END"
)
DOC_PATH = (
    "concat('/data/', lang, '/', source, '/Doc_', doc_id, CASE doc_id % 4 WHEN 0 THEN '.PDF' "
    "WHEN 1 THEN '.txt' WHEN 2 THEN '.jpeg' ELSE '.eml' END)"
)
DOC_METHOD = (
    "CASE doc_id % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'pdf_text' WHEN 2 THEN 'ocr' "
    "WHEN 3 THEN 'reused' ELSE 'failed' END"
)
DOC_FAILURE = "CASE WHEN doc_id % 15 = 4 THEN 'decoder failed' END"
DOC_PAGES = "1 + n_chars % 7"
PAGE_URL = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '')"
PAGE_ROOT = "regexp_replace(url, '^(https?://[^/]+/[a-z]+)/.*$', '{1}')"
PAGE_NAME = (
    "concat('Doc', page_id % 40, CASE page_id % 8 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PNG' "
    "WHEN 2 THEN '.txt' WHEN 3 THEN '.docx' WHEN 4 THEN '' WHEN 5 THEN '.xyz' "
    "WHEN 6 THEN '.Jpeg' ELSE '.a.eml' END)"
)
PAGE_PATH = f"concat({PAGE_URL}, '/p', page_id, '/', {PAGE_NAME})"
PAGE_LABEL = (
    "CASE page_id % 7 WHEN 0 THEN 'invoice' WHEN 1 THEN 'Bank: statement/2024' "
    "WHEN 2 THEN 'what?' WHEN 3 THEN 'contract' ELSE 'a<b>|\"c\"*' END"
)
REUSE_FOLDER = "CASE page_id % 3 WHEN 0 THEN 'run1_extracted_text' WHEN 1 THEN 'extracted_text_v2' ELSE 'notes' END"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def page_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Listing of one file per page: root, path, length (bytes), page_id, text."""
    root = PAGE_ROOT.replace("{1}", "$1")
    return table(spark, sf, "pages").selectExpr(
        f"{root} AS root", f"{PAGE_PATH} AS path", "octet_length(html) AS length", "page_id",
        "html AS text",
    )


def reuse_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Text copies of all pages, some of them in folders with extracted text."""
    root = PAGE_ROOT.replace("{1}", "$1")
    return table(spark, sf, "pages").selectExpr(
        f"{root} AS root",
        f"concat({root}, '/', {REUSE_FOLDER}, '/', page_id, '/DOC', page_id % 40, '.txt') AS path",
        "octet_length(html) AS length", "concat('reused ', html) AS text",
    )


def ingested(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction results of all documents: path, text, method, ocr_pages, error."""
    texts = table(spark, sf, "documents").selectExpr(
        f"{DOC_PATH} AS path",
        "CASE WHEN doc_id % 29 = 0 THEN ' ' ELSE text END AS text",
        f"{DOC_METHOD} AS method", f"{DOC_PAGES} AS ocr_pages", f"{DOC_FAILURE} AS error",
    )
    return bind(texts, ["text"])


def named_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with a file name and some business phrases: doc_id, file_name, text."""
    texts = table(spark, sf, "documents").selectExpr(
        "doc_id", f"{DOC_FILE} AS file_name", f"regexp_replace({DOC_FILE}, '[.]txt$', '') AS document_name",
        f"{DOC_TEXT} AS text",
    )
    return bind(texts, ["file_name", "document_name", "text"])


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Run history: stage, run_ts, has_text."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("stage"),
        compact_stamp(F.col("ts")).alias("run_ts"),
        (F.col("value") > 20).alias("has_text"),
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    """One extracted record per order; amounts as written on the document."""
    amount = (
        f"CASE WHEN o_orderkey % 19 = 0 THEN '0.00' WHEN o_orderkey % 23 = 0 THEN 'n/a' "
        f"ELSE concat('$', format_number({PRICE}, 2)) END"
    )
    parties = (
        "CASE WHEN o_orderkey % 43 = 0 THEN NULL "
        "ELSE slice(array('Party A', 'Party B', 'Party C'), 1, CAST(o_orderkey % 4 AS INT)) END"
    )
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS doc_id", f"{ORDER_DOC} AS document_name", f"{ORDER_TYPE} AS document_type",
        f"{STATUS} AS extraction_status", f"{ERROR} AS error", f"{VENDOR} AS vendor_name",
        f"{NUMBER} AS invoice_number", f"{amount} AS total_amount",
        f"{TRANSACTION_DATE} AS transaction_date", f"{EFFECTIVE_DATE} AS effective_date",
        f"{TERMINATION_DATE} AS termination_date", f"{parties} AS contracting_parties",
        "o_orderstatus",
    )


def rebilled_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records, and a second copy of every final order's invoice in another spelling."""
    base = records(spark, sf)
    again = base.where("document_type = 'invoice' AND o_orderstatus = 'F'").withColumns(
        {
            "doc_id": -F.col("doc_id") - 1,
            "document_name": F.concat(F.lit("copy-"), "document_name"),
            "vendor_name": F.concat(F.lit("  "), F.upper("vendor_name"), F.lit(" \t")),
            "total_amount": F.translate("total_amount", "$,", ""),
        }
    )
    return base.unionByName(again)


def record_json(spark: SparkSession, sf: str) -> DataFrame:
    """The records as JSON text per document: doc_id, document_name, document_type, json."""
    base = records(spark, sf)
    data = [c for c in base.columns if c not in ("doc_id", "document_name", "document_type", "o_orderstatus")]
    texts = base.select(
        "doc_id", "document_name", "document_type", F.to_json(F.struct(*data)).alias("json")
    )
    return bind(texts, ["json"])


# A large order has several invoices, each with about as many of its lines.
LINES_PER_INVOICE = 8
PART = "CAST((l_partkey + l_suppkey + l_linenumber) % CAST(ceil({n} / 8.0) AS BIGINT) AS BIGINT)"
INVOICE_ID = "o_orderkey + part * 10000000000"
INVOICE_FILE = "concat('order-', o_orderkey, '-', part, '.pdf')"
_MONEY = (  # whole numbers, as decimal divisions cost more than all else of a line
    "CASE WHEN {0} >= 0 THEN concat(format_number({0} div 100, 0), '.', lpad(concat('', {0} % 100), 2, '0')) "
    "ELSE format_number(CAST({0} AS DECIMAL(20, 2)) / 100, 2) END"
)
_PART_OF_LINE = PART.replace("CAST(ceil({n} / 8.0) AS BIGINT)", "((group_rows + 7) div 8)")


def invoice_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Per invoice (o_orderkey, part), the text of all its lines, one row of text for each line of
    the order. Lines of an order are dealt to parts by their keys, so that no list grows with it."""
    lines = rows_of_groups(
        table(spark, sf, "lineitem").where("l_orderkey IS NOT NULL"), ["l_orderkey"], ["l_partkey", "l_suppkey"], 1
    )
    cents = "CAST(l_extendedprice * 100 + 0.5D AS BIGINT)"
    lines = lines.selectExpr(
        "l_orderkey AS o_orderkey", f"{_PART_OF_LINE} AS part", f"{GOODS} AS goods",
        "CAST(l_quantity AS BIGINT) AS q", f"{cents} AS c",
    ).withColumn("u", F.expr("(2 * c + q) div (2 * q)"))
    unit, total = _MONEY.format("u"), _MONEY.format("c")
    text = (
        f"CASE WHEN {AT_LAYOUT} THEN concat(goods, ' ', q, ' @ $', {unit}, ' $', {total}) "
        f"ELSE concat(goods, '  ', q, '  $', {unit}, '  $', {total}) END"
    )
    # bound: an aggregate would take the rendering in and run it uncompiled, row by row
    rendered = bind(lines.selectExpr("o_orderkey", "part", f"{text} AS line"), ["line"])
    return rendered.groupBy("o_orderkey", "part").agg(
        F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("lines")
    )


_MON = "element_at(array('Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'), month(o_orderdate))"


def invoice_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Rendered invoices (or credit notes) of every order: doc_id, source_file, text."""
    d, m, y = "day(o_orderdate)", "month(o_orderdate)", "year(o_orderdate)"
    number = "concat('INV-', lpad(concat('', o_orderkey), 8, '0'))"
    text = f"""concat_ws(chr(10),
      CASE WHEN {IS_CREDIT} THEN 'CREDIT NOTE 1' ELSE 'INVOICE 1' END,
      CASE {NUMBER_RANK} WHEN 0 THEN concat('Invoice No: ', {number})
        WHEN 1 THEN concat('Inv #: ', {number}) WHEN 2 THEN concat('Bill No: ', {number})
        WHEN 3 THEN concat('Reference #: ', {number}) END,
      CASE {DATE_RANK}
        WHEN 0 THEN CASE WHEN o_orderstatus = 'P' AND {d} > 12
          THEN concat('Date: ', {d}, '/', {m}, '/', {y}) ELSE concat('Date: ', {m}, '/', {d}, '/', {y}) END
        WHEN 1 THEN concat('Issued ', {d}, ' ', {_MON}, ' ', {y})
        WHEN 2 THEN concat('Issued ', {_MON}, ' ', {d}, ', ', {y})
        WHEN 3 THEN concat('Issued ', {DAY}) END,
      CASE {VENDOR_RANK} WHEN 0 THEN concat('Vendor: Vendor ', {LETTERS}, ' 1')
        WHEN 1 THEN concat('TRADING HOUSE ', {LETTERS}) END,
      'Items 0', lines,
      CASE {TOTAL_RANK} WHEN 0 THEN concat('Total Amount: $', format_number({PRICE}, 2))
        WHEN 1 THEN concat('Amount Due: ', format_number({PRICE}, 2))
        WHEN 2 THEN concat('Balance due: $', format_number({PRICE}, 2)) END)"""
    # both sides are as large as the orders: partition both by the key, never broadcast
    orders = table(spark, sf, "orders")
    invoices = orders.join(invoice_lines(spark, sf).hint("merge"), "o_orderkey", "left").withColumn(
        "part", F.coalesce("part", F.lit(0).cast("bigint"))
    )
    texts = invoices.selectExpr(
        f"{INVOICE_ID} AS doc_id", f"{INVOICE_FILE} AS source_file", f"{text} AS text",
        "o_orderpriority", "o_orderstatus",
    )
    return bind(texts, ["text"])


def prefixed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Invoice texts with phrases that change their type; low-priority orders have short notes."""
    text = """CASE o_orderpriority
      WHEN '1-URGENT' THEN concat('Credit Memo for invoice 7', chr(10), text)
      WHEN '2-HIGH' THEN concat('REMITTANCE ADVICE', chr(10), text)
      WHEN '3-MEDIUM' THEN concat('Purchase Order', chr(10), text)
      WHEN '4-NOT SPECIFIED' THEN concat('Your invoice', chr(10), replace(text, 'CREDIT NOTE', 'COPY'))
      ELSE CASE o_orderstatus WHEN 'F' THEN concat('Bill # ', doc_id)
        WHEN 'O' THEN concat('Bill # X', doc_id) ELSE concat('Delivery slip ', doc_id) END END"""
    texts = invoice_texts(spark, sf).selectExpr("doc_id", f"{text} AS text")
    return bind(texts, ["text"])


VAT = "concat('4', lpad(concat('', o_orderkey), 9, '0'))"
MDY = "concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))"
HAS_TEXT = "o_orderkey % 47 <> 0"


def typed_texts(spark: SparkSession, sf: str) -> DataFrame:
    """One classified text per order: doc_id, document_name, document_type, text (or NULL)."""
    money = f"format_number({PRICE}, 2)"
    text = f"""CASE WHEN NOT ({HAS_TEXT}) THEN NULL
      WHEN o_orderpriority = '1-URGENT' THEN concat_ws(chr(10),
        CASE WHEN o_orderkey % 3 = 0 THEN 'Invoice reference pending'
          ELSE concat('Invoice No: INV-', lpad(concat('', o_orderkey), 8, '0')) END,
        'Supplier 1',
        CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('Due Date: ', {DAY})
          ELSE concat('due-date ', {MDY}) END,
        CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('Balance due: $', {money})
          ELSE concat('TOTAL AMOUNT: ', {money}) END,
        CASE WHEN o_orderkey % 6 <> 0 THEN concat('VAT No: ', {VAT}) END)
      WHEN o_orderpriority = '2-HIGH' THEN concat_ws(chr(10), 'Receipt',
        CASE WHEN o_orderkey % 4 <> 0 THEN concat('Date: ', {MDY}) END,
        CASE WHEN o_orderkey % 5 <> 0 THEN concat('Total $', {money}) END,
        CASE WHEN o_orderkey % 6 <> 0 THEN concat('vat registration ', {VAT}) END)
      ELSE concat({ORDER_TYPE}, ' text ', o_orderkey) END"""
    texts = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS doc_id", f"{ORDER_DOC} AS document_name", f"{ORDER_TYPE} AS document_type",
        f"{text} AS text",
    )
    return bind(texts, ["text"])


def extraction_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A model's answer per order: missing, without JSON, broken, or usable; doc_id, response."""
    response = """CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'no answer'
      WHEN 2 THEN '{"vendor_name": }'
      WHEN 3 THEN concat('Here it is: {"vendor_name":"Vendor ', o_custkey,
        '","payment_method":"card","contract_title":"Lease ', o_orderkey,
        '","contracting_parties":["A","B"],"bank_name":"Bank 1","ending_balance":"$1,200.00","extra":1} Bye')
      ELSE concat('{"vendor_name":null,"invoice_number":"X-', o_orderkey, '","total_amount":12.5}') END"""
    texts = table(spark, sf, "orders").selectExpr("o_orderkey AS doc_id", f"{response} AS response")
    return bind(texts, ["response"])


def classification_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A model's answer per order about its type: doc_id, response."""
    response = """CASE o_orderkey % 8
      WHEN 0 THEN concat('Sure: {"predicted_type":"Bank Statement","confidence":0.',
        lpad(concat('', o_custkey % 10000), 4, '0'), '1,"reasoning":"order ', o_orderkey,
        '","key_indicators":["a","b"]} done')
      WHEN 1 THEN '{}' WHEN 2 THEN 'no json here' WHEN 3 THEN '{"predicted_type": }'
      WHEN 4 THEN '{"predicted_type":null,"confidence":0.7}'
      WHEN 5 THEN concat('{"predicted_type":"Invoice ', o_custkey, '"}')
      WHEN 6 THEN '{"predicted_type":"Receipt","confidence":"high"}' END"""
    texts = table(spark, sf, "orders").selectExpr("o_orderkey AS doc_id", f"{response} AS response")
    return bind(texts, ["response"])


def document_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A model's answer per document: doc_id, response."""
    texts = table(spark, sf, "documents").selectExpr(
        "doc_id",
        "CASE doc_id % 4 WHEN 0 THEN concat('{\"predicted_type\":\"Letter ', lang, '\",\"confidence\":0.8}') "
        "WHEN 1 THEN 'none' WHEN 2 THEN '{\"predicted_type\":\"Memo\",\"confidence\":\"x\"}' END AS response",
    )
    return bind(texts, ["response"])