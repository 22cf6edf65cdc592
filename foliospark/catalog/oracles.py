"""What each query must return, as ANSI SQL over the same tables.

Expected values come straight from the tables: the documents are neither rendered nor parsed
here, so an oracle shares only the layout choices (`derive`) and rule values with its query.
"""

from __future__ import annotations

from foliospark import rules
from foliospark.catalog import derive as X
from foliospark.catalog.queries import RUN_TS
from foliospark.operators import classify as C
from foliospark.operators import extract as E
from foliospark.operators import report as R


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strings(values) -> str:
    return ", ".join(text(v) for v in values)


ORACLES: dict[str, str] = {}
ROOT = X.PAGE_ROOT.replace("{1}", r"\1")
SUFFIXES = strings(rules.SUPPORTED_SUFFIXES)

# --- ingestion --------------------------------------------------------------------------

_PARTS = f"""
pages_ AS (SELECT page_id, {ROOT} AS root, {X.PAGE_PATH} AS path, {X.PAGE_NAME} AS document_name,
    CAST(strlen(html) AS BIGINT) AS length, html FROM pages),
parts AS (SELECT *,
    CASE WHEN document_name LIKE '%.%' THEN regexp_replace(document_name, '[.][^.]*$', '')
      ELSE document_name END AS document_name_stem,
    lower(regexp_extract(document_name, '[.][^.]*$')) AS extension,
    substr(path, 1, length(path) - length(document_name) - 1) AS source_folder
  FROM pages_)"""

ORACLES["discover_documents"] = f"""WITH {_PARTS}
SELECT path, document_name, extension, length FROM parts
WHERE extension IN ({SUFFIXES}) AND length <= 10485 ORDER BY path"""

ORACLES["path_parts"] = f"""WITH {_PARTS}
SELECT path, document_name, document_name_stem, extension, source_folder FROM parts"""

ORACLES["extractor_route"] = f"""WITH {_PARTS}
SELECT path, CASE extension WHEN '.txt' THEN 'text' WHEN '.pdf' THEN 'pdf' ELSE 'image' END AS route
FROM parts WHERE extension IN ({SUFFIXES})"""

_ROOTS = f"""{_PARTS},
roots AS (SELECT 0 AS root_ord, root, path, length FROM parts WHERE extension IN ({SUFFIXES})
  UNION ALL SELECT 1, '/data', {X.DOC_PATH}, strlen(text) FROM documents)"""

ORACLES["multi_root_union"] = f"""WITH {_ROOTS}
SELECT CAST(root_ord AS BIGINT) AS root_ord, root, path, CAST(length AS BIGINT) AS length FROM roots"""

ORACLES["max_docs_limit"] = f"""WITH {_ROOTS}
SELECT CAST(root_ord AS BIGINT) AS root_ord, path FROM roots ORDER BY root_ord, path LIMIT 300"""

_REUSE = f"""
copies AS (SELECT {ROOT} AS root, concat('doc', page_id % 40) AS stem_key,
    concat({ROOT}, '/', {X.REUSE_FOLDER}, '/', page_id, '/DOC', page_id % 40, '.txt') AS path, html
  FROM pages WHERE page_id % 3 < 2),
reuse AS (SELECT root, stem_key, max(path) AS reused_path FROM copies GROUP BY root, stem_key)"""

ORACLES["reuse_index"] = f"WITH {_REUSE} SELECT root, stem_key, reused_path FROM reuse"

ORACLES["reuse_text_join"] = f"""WITH {_PARTS}, {_REUSE}
SELECT p.path,
  CASE WHEN r.reused_path IS NOT NULL THEN 'reused' WHEN extension = '.txt' THEN 'text'
    WHEN extension = '.pdf' THEN 'pdf' ELSE 'image' END AS method,
  r.reused_path,
  md5(CASE WHEN r.reused_path IS NOT NULL THEN concat('reused ', c.html) ELSE p.html END) AS text_md5
FROM parts p LEFT JOIN reuse r ON p.root = r.root AND lower(p.document_name_stem) = r.stem_key
LEFT JOIN copies c ON c.path = r.reused_path
WHERE extension IN ({SUFFIXES})"""

ORACLES["ingestion_flow"] = f"""WITH {_PARTS}, {_REUSE},
flow AS (SELECT p.path, r.reused_path IS NOT NULL AS again,
    CASE WHEN r.reused_path IS NOT NULL THEN 'reused' WHEN extension = '.txt' THEN 'text'
      WHEN extension = '.pdf' THEN 'pdf' ELSE 'image' END AS method,
    CASE WHEN r.reused_path IS NOT NULL THEN concat('reused ', c.html) WHEN page_id % 6 = 0 THEN ' ' ELSE p.html END AS text,
    CASE WHEN r.reused_path IS NULL AND page_id % 10 = 3 THEN 'decoder failed' END AS failure
  FROM parts p LEFT JOIN reuse r ON p.root = r.root AND lower(p.document_name_stem) = r.stem_key
  LEFT JOIN copies c ON c.path = r.reused_path WHERE extension IN ({SUFFIXES}) AND length <= 10485),
judged AS (SELECT *, failure IS NULL AND text <> ' ' AS success FROM flow)
SELECT path, method, success, CAST(CASE WHEN success THEN length(text) ELSE 0 END AS BIGINT) AS text_length,
  CASE WHEN success THEN '' ELSE coalesce(failure, 'No text extracted') END AS error, md5(text) AS text_md5
FROM judged"""

ORACLES["first_documents_ingested"] = f"""WITH {_PARTS}, {_REUSE},
first_ AS (SELECT * FROM parts WHERE extension IN ({SUFFIXES}) ORDER BY path LIMIT 100),
flow AS (SELECT p.path,
    CASE WHEN r.reused_path IS NOT NULL THEN 'reused' WHEN extension = '.txt' THEN 'text'
      WHEN extension = '.pdf' THEN 'pdf' ELSE 'image' END AS method,
    CASE WHEN r.reused_path IS NOT NULL THEN concat('reused ', c.html) WHEN page_id % 9 = 4 THEN ' ' ELSE p.html END AS text
  FROM first_ p LEFT JOIN reuse r ON p.root = r.root AND lower(p.document_name_stem) = r.stem_key
  LEFT JOIN copies c ON c.path = r.reused_path)
SELECT path, method, text <> ' ' AS success, CAST(CASE WHEN text <> ' ' THEN length(text) ELSE 0 END AS BIGINT) AS text_length,
  md5(text) AS text_md5
FROM flow"""

ORACLES["choose_longer_text"] = """WITH t AS (SELECT doc_id,
    CASE WHEN lang = 'en' THEN text ELSE concat(source, ' ', lang, ' ') END AS direct,
    CASE WHEN lang = 'de' THEN lang ELSE concat(text, chr(10)) END AS ocr,
    CASE WHEN lang = 'en' THEN length(trim(text, concat(' ', chr(9), chr(10), chr(13)))) ELSE 0 END AS n
  FROM documents),
c AS (SELECT doc_id, CASE WHEN n < 150 AND length(ocr) > length(direct) THEN ocr ELSE direct END AS t FROM t)
SELECT doc_id, CAST(length(t) AS BIGINT) AS chars, md5(t) AS text_md5 FROM c"""

_OUTCOME = f"""
outcome AS (SELECT {X.DOC_PATH} AS path, {X.DOC_METHOD} AS method,
    ({X.DOC_FAILURE}) IS NULL AND doc_id % 29 <> 0 AND length(trim(text)) > 0 AS success,
    length(text) AS len, {X.DOC_PAGES} AS pages, {X.DOC_FAILURE} AS failure, doc_id, lang, source
  FROM documents)"""
_OK_LEN = "CAST(CASE WHEN success THEN len ELSE 0 END AS BIGINT)"

ORACLES["ingestion_metrics"] = f"""WITH {_OUTCOME}
SELECT path AS file_path, method, success, {_OK_LEN} AS text_length,
  CAST(CASE WHEN success AND method = 'ocr' THEN pages ELSE 0 END AS BIGINT) AS ocr_pages,
  CASE WHEN success THEN '' ELSE coalesce(failure, 'No text extracted') END AS error
FROM outcome"""

_SUMMARY = """CAST(count(*) AS BIGINT) AS docs_total,
  CAST(count(*) FILTER (success) AS BIGINT) AS success,
  CAST(count(*) FILTER (NOT success) AS BIGINT) AS fail,
  round(count(*) FILTER (success) / count(*) * 100.0::DOUBLE, 2) AS success_rate_pct"""

ORACLES["ingestion_summary"] = f"WITH {_OUTCOME} SELECT {_SUMMARY} FROM outcome"

ORACLES["method_distribution"] = f"""WITH {_OUTCOME}
SELECT method, CAST(count(*) AS BIGINT) AS docs FROM outcome GROUP BY method"""

ORACLES["run_summary_methods"] = f"""WITH {_OUTCOME},
m AS (SELECT method, count(*) AS n FROM outcome GROUP BY method)
SELECT '2024-01-02T03:04:05' AS run_timestamp, {_SUMMARY},
  (SELECT string_agg(concat(method, '=', n), ',' ORDER BY method) FROM m) AS methods
FROM outcome"""

ORACLES["ingestion_log_lines"] = f"""WITH {_OUTCOME}
SELECT concat(path, ' | ', method, ' | success=', CASE WHEN success THEN 'True' ELSE 'False' END,
  ' | len=', {_OK_LEN}) AS line FROM outcome"""

ORACLES["tracker_of_run"] = f"""WITH {_OUTCOME}
SELECT concat('Doc_', doc_id, regexp_extract(path, '[.][^.]*$')) AS document_name,
  concat('/data/', lang, '/', source) AS source_folder, path,
  lower(regexp_extract(path, '[.][^.]*$')) AS extension, upper(method) AS method,
  CASE WHEN success THEN 'SUCCESS' ELSE 'FAILED' END AS status, '01_Ingestion' AS stage, '{RUN_TS}' AS run_ts
FROM outcome ORDER BY path"""

ORACLES["tracker_of_published_run"] = (
    ORACLES["tracker_of_run"].replace(RUN_TS, "20240102_000000").replace("FROM outcome ORDER", "FROM outcome WHERE success ORDER")
)

ORACLES["listing_changes"] = f"""WITH {_PARTS},
now_ AS (SELECT path, length, page_id % 4 AS modified, page_id FROM parts WHERE extension IN ({SUFFIXES})),
last_ AS (SELECT CASE WHEN page_id % 11 = 5 THEN path || '.old' ELSE path END AS path,
    page_id % 5 <> 0 AND page_id % 13 <> 2 AS same, concat('run_', page_id % 3) AS text_run
  FROM now_ WHERE page_id % 7 <> 3)
SELECT coalesce(n.path, l.path) AS path,
  CASE WHEN n.path IS NULL THEN 'gone' WHEN l.path IS NULL THEN 'new' WHEN same THEN 'unchanged' ELSE 'changed' END AS change,
  CASE WHEN n.path IS NOT NULL AND same THEN text_run END AS text_run
FROM now_ n FULL JOIN last_ l ON n.path = l.path"""

ORACLES["latest_run_per_stage"] = """SELECT event_type AS stage,
  max(strftime(ts, '%Y%m%d_%H%M%S')) AS run_ts FROM events WHERE value > 20 GROUP BY event_type"""

ORACLES["latest_run_rows"] = """WITH r AS (SELECT event_type AS stage, strftime(ts, '%Y%m%d_%H%M%S') AS run_ts FROM events)
SELECT stage, run_ts, CAST(count(*) AS BIGINT) AS n FROM r WHERE stage = 'view'
  AND run_ts = (SELECT max(run_ts) FROM r WHERE stage = 'view') GROUP BY stage, run_ts
UNION ALL SELECT stage, max(run_ts), CAST(0 AS BIGINT) FROM r WHERE stage LIKE 'p%' GROUP BY stage"""

# --- classification ---------------------------------------------------------------------

_NAMED = f"""
named AS (SELECT doc_id, {X.DOC_FILE} AS file_name, {X.DOC_TEXT} AS text, lang FROM documents),
low AS (SELECT doc_id, file_name, text, lang, lower(file_name) AS f, lower(text) AS t,
  doc_id % 29 = 0 AS blank, regexp_replace(file_name, '[.]txt$', '') AS document_name FROM named)"""


def _contains(column: str, words) -> str:
    return " OR ".join(f"contains({column}, {text(w)})" for w in words)


def _by_name(rule_set) -> str:
    cases = " ".join(f"WHEN {_contains('f', ws)} THEN {text(t)}" for t, ws in rule_set.filename.items())
    return f"CASE {cases} END"


def _score(words) -> str:
    return " + ".join(f"CAST(contains(t, {text(w)}) AS BIGINT)" for w in words)


def _scored(rule_set) -> str:
    scores = ", ".join(f"{_score(ws)} AS score_{t}" for t, ws in rule_set.content.items())
    every = ", ".join(f"score_{t}" for t in rule_set.content)
    first = " ".join(f"WHEN score_{t} = top THEN {text(t)}" for t in rule_set.content)
    return f"""{_NAMED},
scores AS (SELECT *, {scores} FROM low),
tops AS (SELECT *, greatest({every}) AS top FROM scores),
best AS (SELECT *, CASE {first} END AS best_type, {_by_name(rule_set)} AS by_name FROM tops),
ruled AS (SELECT *, CASE WHEN top >= 3 THEN 0.95::DOUBLE WHEN top = 2 THEN 0.6::DOUBLE END AS content_conf,
    CASE WHEN top >= 3 THEN 'rules_content_high' WHEN top = 2 THEN 'rules_content_low' END AS content_method
  FROM best),
cascade AS (SELECT doc_id, document_name, text, lang,
    CASE WHEN blank THEN 'error' WHEN by_name IS NOT NULL OR top >= 2 THEN 'resolved' ELSE 'unresolved' END AS status,
    CASE WHEN blank THEN 'ERROR' WHEN by_name IS NOT NULL THEN by_name WHEN top >= 2 THEN best_type ELSE 'other' END AS predicted_type,
    CASE WHEN blank THEN 0.0::DOUBLE WHEN by_name IS NOT NULL THEN 0.98::DOUBLE ELSE coalesce(content_conf, 0.0::DOUBLE) END AS confidence,
    CASE WHEN blank THEN 'rules_error' WHEN by_name IS NOT NULL THEN 'rules_filename' ELSE coalesce(content_method, 'rules_failed') END AS method,
    CASE WHEN blank THEN '' WHEN by_name IS NOT NULL OR top >= 2 THEN 'Classified by keyword rules.'
      ELSE 'Rules failed and LLM fallback is disabled.' END AS reasoning,
    CASE WHEN blank THEN 'Empty text file' ELSE '' END AS error
  FROM ruled)"""


_FULL, _COMPACT = _scored(rules.FULL_RULES), _scored(rules.COMPACT_RULES)

ORACLES["classify_by_filename"] = f"""WITH {_NAMED}, c AS (SELECT doc_id, {_by_name(rules.FULL_RULES)} AS predicted_type FROM low)
SELECT doc_id, predicted_type, CASE WHEN predicted_type IS NOT NULL THEN 0.98::DOUBLE END AS confidence,
  CASE WHEN predicted_type IS NOT NULL THEN 'rules_filename' END AS method FROM c"""

ORACLES["content_keyword_scores"] = f"""WITH {_FULL}
SELECT doc_id, {", ".join(f"score_{t}" for t in rules.CONTENT_KEYWORDS)} FROM scores"""

ORACLES["classify_by_content"] = f"""WITH {_FULL}
SELECT doc_id, CASE WHEN top >= 2 THEN best_type END AS predicted_type, content_conf AS confidence,
  content_method AS method FROM ruled"""

ORACLES["classify_large_rule_set"] = """WITH items AS (
  SELECT printf('set_%02d', item_id % 12) AS type, regexp_split_to_array(lower(trim(text)), '\\s+') AS words FROM benchmark),
runs AS (SELECT type, words, unnest(range(1, 6)) AS n FROM items),
starts AS (SELECT type, words, n, unnest(range(1, greatest(1, len(words) - n + 1) + 1)) AS i FROM runs),
keywords AS (SELECT DISTINCT type, array_to_string(words[i:i + n - 1], ' ') AS keyword FROM starts),
lowered AS (SELECT doc_id, lower(text) AS text FROM documents),
hits AS (SELECT doc_id, type, count(*) AS score FROM lowered, keywords
  WHERE length(keyword) >= 8 AND contains(text, keyword) GROUP BY doc_id, type),
best AS (SELECT doc_id, max(score) AS top, arg_min(type, (-score, type)) AS type FROM hits GROUP BY doc_id)
SELECT doc_id, CASE WHEN top >= 2 THEN type END AS predicted_type,
  CASE WHEN top >= 3 THEN 0.95::DOUBLE WHEN top = 2 THEN 0.6::DOUBLE END AS confidence,
  CASE WHEN top >= 3 THEN 'rules_content_high' WHEN top = 2 THEN 'rules_content_low' END AS method
FROM documents LEFT JOIN best USING (doc_id)"""

ORACLES["classify_cascade"] = f"""WITH {_FULL}
SELECT doc_id, status, predicted_type, confidence, method, reasoning FROM cascade"""

ORACLES["classify_cascade_compact"] = f"""WITH {_COMPACT}
SELECT doc_id, status, predicted_type, confidence, method FROM cascade"""

ORACLES["classify_route_counts"] = f"""WITH {_FULL}
SELECT status, CAST(count(*) AS BIGINT) AS docs FROM cascade GROUP BY status"""

ORACLES["classify_error_rows"] = f"""WITH {_FULL}
SELECT document_name, predicted_type, confidence, method, reasoning, '[]' AS key_indicators, error
FROM cascade WHERE status = 'error'"""


def _short(column: str, limit: tuple[int, float, float]) -> str:
    n, head, tail = limit
    return (
        f"CASE WHEN length({column}) <= {n} THEN {column} ELSE concat(left({column}, {int(n * head)}), "
        f"chr(10), '...', chr(10), right({column}, {int(n * tail)})) END"
    )


ORACLES["classification_requests"] = f"""WITH {_FULL},
r AS (SELECT doc_id, concat({text(C.INSTRUCTION)}, {_short("text", rules.CLASSIFY_TEXT_LIMIT)}) AS request
  FROM cascade WHERE status = 'unresolved')
SELECT doc_id, CAST(length(request) AS BIGINT) AS chars, md5(request) AS request_md5 FROM r"""

_ANSWERED = f"""{_FULL},
answered AS (SELECT document_name,
    CASE WHEN status <> 'unresolved' THEN predicted_type WHEN doc_id % 4 = 0 THEN concat('letter ', lower(lang))
      WHEN doc_id % 4 = 1 THEN 'llm_parse_error' ELSE 'llm_connection_error' END AS predicted_type,
    CASE WHEN status <> 'unresolved' THEN confidence WHEN doc_id % 4 = 0 THEN 0.8::DOUBLE
      WHEN doc_id % 4 = 1 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS confidence,
    CASE WHEN status <> 'unresolved' THEN method ELSE 'llm_generative' END AS method,
    CASE WHEN status <> 'unresolved' THEN reasoning ELSE '' END AS reasoning,
    '[]' AS key_indicators,
    CASE WHEN status <> 'unresolved' THEN error WHEN doc_id % 4 = 2 THEN 'invalid confidence in response'
      WHEN doc_id % 4 = 3 THEN 'no response' ELSE '' END AS error
  FROM cascade)"""

ORACLES["classification_metrics"] = f"""WITH {_ANSWERED}
SELECT document_name, predicted_type, confidence, method, reasoning, key_indicators, error FROM answered"""

ORACLES["type_distribution"] = f"""WITH {_ANSWERED}
SELECT predicted_type, CAST(count(*) AS BIGINT) AS docs FROM answered GROUP BY predicted_type"""

ORACLES["classification_summary"] = f"""WITH {_ANSWERED}
SELECT CAST(count(*) AS BIGINT) AS docs_total,
  CAST(count(*) FILTER (contains(method, 'llm')) AS BIGINT) AS llm_fallbacks_used FROM answered"""

ORACLES["stage_tracker"] = f"""WITH {_FULL}, {_OUTCOME}
SELECT concat('Doc_', doc_id, regexp_extract(path, '[.][^.]*$')) AS document_name,
  concat('/data/', lang, '/', source) AS source_folder, path,
  lower(regexp_extract(path, '[.][^.]*$')) AS extension, upper(method) AS method,
  CASE WHEN success THEN 'SUCCESS' ELSE 'FAILED' END AS status, '01_Ingestion' AS stage,
  '{RUN_TS}' AS run_ts, NULL::VARCHAR AS predicted_type, NULL::DOUBLE AS confidence,
  NULL::VARCHAR AS reasoning, NULL::VARCHAR AS document_type, NULL::VARCHAR AS error FROM outcome
UNION ALL SELECT document_name, NULL, NULL, NULL, method, NULL, '02_Classification', '{RUN_TS}',
  predicted_type, confidence, reasoning, NULL, NULL FROM cascade
UNION ALL (WITH {{STATE}} SELECT document_name, NULL, NULL, NULL, NULL, extraction_status, '03_Extraction', '{RUN_TS}',
  NULL, NULL, NULL, document_type, error FROM state)"""

_INVOICES = f"""
dealt AS (SELECT *, {X.PART.format(n="count(*) OVER (PARTITION BY l_orderkey)")} AS part FROM lineitem WHERE l_orderkey IS NOT NULL),
invoices AS (SELECT o.*, coalesce(d.part, 0) AS part
  FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, part FROM dealt) d ON o.o_orderkey = d.l_orderkey)"""

ORACLES["ordered_keyword_class"] = f"""WITH {_INVOICES}
SELECT {X.INVOICE_ID} AS doc_id, CASE o_orderpriority
  WHEN '1-URGENT' THEN 'credit_note' WHEN '2-HIGH' THEN
    'remittance_advice' WHEN '3-MEDIUM' THEN 'purchase_order' WHEN '4-NOT SPECIFIED' THEN 'invoice'
  ELSE CASE o_orderstatus WHEN 'F' THEN 'invoice' ELSE 'unknown' END END AS document_class FROM invoices"""

_LIMITS = {
    "a": rules.CLASSIFY_TEXT_LIMIT, "b": rules.CLASSIFY_TEXT_LIMIT_COMPACT, "c": rules.EXTRACT_TEXT_LIMIT,
}
ORACLES["truncate_head_tail"] = f"""WITH t AS (SELECT doc_id,
  {", ".join(f"{_short('text', lim)} AS {k}" for k, lim in _LIMITS.items())} FROM documents)
SELECT doc_id, {", ".join(f"CAST(length({k}) AS BIGINT) AS chars_{k}, md5({k}) AS md5_{k}" for k in "abc")} FROM t"""

ORACLES["parse_model_response"] = """SELECT o_orderkey AS doc_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'bank statement' WHEN 1 THEN 'llm_parse_error'
    WHEN 2 THEN 'llm_parse_error' WHEN 4 THEN 'llm_parse_error'
    WHEN 5 THEN concat('invoice ', o_custkey) ELSE 'llm_connection_error' END AS predicted_type,
  CASE o_orderkey % 8 WHEN 0 THEN (o_custkey % 10000) / 10000 WHEN 1 THEN 0.5 WHEN 2 THEN 0.5
    WHEN 4 THEN 0.7 WHEN 5 THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence,
  'llm_generative' AS method,
  CASE WHEN o_orderkey % 8 = 0 THEN concat('order ', o_orderkey) ELSE '' END AS reasoning,
  CASE WHEN o_orderkey % 8 = 0 THEN '["a","b"]' ELSE '[]' END AS key_indicators,
  CASE o_orderkey % 8 WHEN 3 THEN 'invalid JSON in response' WHEN 6 THEN 'invalid confidence in response'
    WHEN 7 THEN 'no response' ELSE '' END AS error FROM orders"""

# --- extraction -------------------------------------------------------------------------

_MDY = "concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))"
_TYPED = f"""
typed AS (SELECT o_orderkey AS k, o_custkey, {X.ORDER_DOC} AS document_name, {X.ORDER_TYPE} AS document_type,
    o_orderkey % 47 <> 0 AS has_text, o_orderkey % 5 AS answer, o_orderkey % 3 AS m3, o_orderkey % 4 AS m4,
    o_orderkey % 5 AS m5, o_orderkey % 6 AS m6, {X.PRICE}::DOUBLE AS price, {X.DAY} AS day,
    {_MDY} AS mdy, {X.VAT} AS vat,
    concat('INV-', lpad(concat('', o_orderkey), 8, '0')) AS inv FROM orders),
ruled AS (SELECT *,
    CASE WHEN has_text AND document_type = 'invoice' AND m3 <> 0 THEN inv END AS r_invoice_number,
    CASE WHEN has_text AND document_type = 'invoice' AND m4 = 1 THEN day
      WHEN has_text AND document_type = 'invoice' AND m4 > 1 THEN mdy END AS r_due_date,
    CASE WHEN has_text AND document_type IN ('invoice', 'receipt') AND m5 <> 0 THEN price END AS r_total_amount,
    CASE WHEN has_text AND document_type IN ('invoice', 'receipt') AND m6 <> 0 THEN vat END AS r_vat_number,
    CASE WHEN has_text AND document_type = 'receipt' AND m4 <> 0 THEN mdy END AS r_transaction_date
  FROM typed)"""

ORACLES["regex_fields_invoice"] = f"""WITH {_TYPED}
SELECT document_name, r_invoice_number AS invoice_number, r_due_date AS due_date,
  r_total_amount AS total_amount, r_vat_number AS vat_number FROM ruled WHERE has_text AND document_type = 'invoice'"""

ORACLES["regex_fields_receipt"] = f"""WITH {_TYPED}
SELECT document_name, r_transaction_date AS transaction_date, r_total_amount AS total_amount,
  r_vat_number AS vat_number FROM ruled WHERE has_text AND document_type = 'receipt'"""

_RULE_FIELDS = ("invoice_number", "due_date", "total_amount", "vat_number", "transaction_date")
_AS_TEXT = {f: f"r_{f}" for f in _RULE_FIELDS} | {
    "total_amount": "CAST(CAST(r_total_amount AS DECIMAL(18, 2)) AS VARCHAR)"
}
_FOUND = " UNION ALL ".join(
    f"SELECT k, document_name, document_type, answer, '{f}' AS field, {_AS_TEXT[f]} AS value FROM ruled WHERE r_{f} IS NOT NULL"
    for f in _RULE_FIELDS
)

ORACLES["field_provenance"] = f"""WITH {_TYPED}, found AS ({_FOUND})
SELECT document_name, document_type, field, value, 'regex' AS method FROM found"""


def _missing(t: str) -> str:
    parts = [
        f"CASE WHEN r_{f} IS NULL THEN '{f}' END" if f in _RULE_FIELDS else f"'{f}'"
        for f in rules.TARGET_SCHEMAS[t]
    ]
    return f"WHEN '{t}' THEN concat_ws(',', {', '.join(parts)})"


_MISSING = f"CASE document_type {' '.join(_missing(t) for t in rules.TARGET_SCHEMAS)} END"

ORACLES["missing_fields"] = f"""WITH {_TYPED}
SELECT document_name, {_MISSING} AS missing FROM ruled WHERE has_text"""


def _layout(t: str) -> str:
    parts = []
    for f, kind in rules.TARGET_SCHEMAS[t].items():
        entry = text(f'"{f}":"{kind}"')
        parts.append(f"CASE WHEN r_{f} IS NULL THEN {entry} END" if f in _RULE_FIELDS else entry)
    return f"WHEN '{t}' THEN concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


_RENDERED = f"""CASE document_type
  WHEN 'invoice' THEN concat_ws(chr(10), CASE WHEN m3 = 0 THEN 'Invoice reference pending' ELSE concat('Invoice No: ', inv) END,
    'Supplier 1', CASE WHEN m4 = 1 THEN concat('Due Date: ', day) WHEN m4 > 1 THEN concat('due-date ', mdy) END,
    CASE WHEN m5 = 1 THEN concat('Balance due: $', money) WHEN m5 > 1 THEN concat('TOTAL AMOUNT: ', money) END,
    CASE WHEN m6 <> 0 THEN concat('VAT No: ', vat) END)
  WHEN 'receipt' THEN concat_ws(chr(10), 'Receipt', CASE WHEN m4 <> 0 THEN concat('Date: ', mdy) END,
    CASE WHEN m5 <> 0 THEN concat('Total $', money) END,
    CASE WHEN m6 <> 0 THEN concat('vat registration ', vat) END)
  ELSE concat(document_type, ' text ', k) END"""

ORACLES["gap_fill_requests"] = f"""WITH {_TYPED},
m AS (SELECT *, format('{{:,.2f}}', price) AS money,
  CASE document_type {' '.join(_layout(t) for t in rules.TARGET_SCHEMAS)} END AS missing_schema
  FROM ruled WHERE has_text AND document_type IN ({strings(rules.TARGET_SCHEMAS)}))
SELECT k AS doc_id, missing_schema,
  md5(concat({text(E.INSTRUCTION)}, missing_schema, chr(10), chr(10), {_RENDERED})) AS request_md5 FROM m"""

_STATE = f"""{_TYPED},
state AS (SELECT *,
    CASE WHEN NOT has_text THEN 'failed' WHEN document_type = 'credit_note' THEN 'skipped'
      WHEN answer IN (1, 3, 4) THEN 'success_hybrid' ELSE 'failed_llm' END AS extraction_status,
    CASE WHEN NOT has_text THEN 'source text file not found' WHEN document_type = 'credit_note' THEN NULL
      WHEN answer = 0 THEN 'no response' WHEN answer = 2 THEN 'invalid JSON in response' END AS error,
    CASE WHEN has_text AND document_type = 'credit_note' THEN 'No schema for credit_note' END AS reason
  FROM ruled)"""

ORACLES["stage_tracker"] = ORACLES["stage_tracker"].replace("{STATE}", _STATE)

ORACLES["repeated_answers"] = f"""WITH {_STATE}
SELECT document_name, extraction_status, error, reason FROM state"""

ORACLES["stage_run_summaries"] = f"""WITH {_OUTCOME}, {_ANSWERED}
SELECT stage, '{X.TODAY.replace(" ", "T")}' AS run_timestamp, CAST(docs_total AS BIGINT) AS docs_total, counted, CAST(n AS BIGINT) AS n
FROM (SELECT '01_Ingestion' AS stage, count(*) AS docs_total, 'success' AS counted, count(*) FILTER (success) AS n FROM outcome
  UNION ALL SELECT '02_Classification', count(*), 'llm_fallbacks_used', count(*) FILTER (contains(method, 'llm')) FROM answered
  UNION ALL (WITH {_STATE} SELECT '03_Extraction', count(*), 'successful_extractions',
    count(*) FILTER (contains(extraction_status, 'success')) FROM state))"""

ORACLES["extraction_status"] = f"""WITH {_STATE}
SELECT document_name, extraction_status, error, reason FROM state"""

# field → (answer 3, answer 4): value in the model's answer, or None where the key is absent
_ANSWERS: dict[str, tuple[str | None, str | None]] = {
    "vendor_name": ("concat('Vendor ', o_custkey)", "NULL"),
    "payment_method": ("'card'", None),
    "contract_title": ("concat('Lease ', k)", None),
    "contracting_parties": ("'[\"A\",\"B\"]'", None),
    "bank_name": ("'Bank 1'", None),
    "ending_balance": ("'$1,200.00'", None),
    "invoice_number": (None, "concat('X-', k)"),
    "total_amount": (None, "'12.5'"),
}


def _merged_rows() -> str:
    selects = []
    for field in E.all_fields():
        types = strings(t for t, fields in rules.TARGET_SCHEMAS.items() if field in fields)
        three, four = _ANSWERS.get(field, (None, None))
        answered = [f"(extraction_status = 'success_hybrid' AND answer = {n})" for n, v in ((3, three), (4, four)) if v]
        value = " ".join(
            f"WHEN extraction_status = 'success_hybrid' AND answer = {n} THEN {v}" for n, v in ((3, three), (4, four)) if v
        )
        found = f"r_{field} IS NOT NULL" if field in _RULE_FIELDS else "FALSE"
        rule_value = _AS_TEXT.get(field, "NULL")
        is_answered = " OR ".join(answered) or "FALSE"
        selects.append(
            f"SELECT document_name, document_type, '{field}' AS field, "
            f"CASE {value or 'WHEN FALSE THEN NULL'} ELSE {rule_value} END AS value, "
            f"CASE WHEN {is_answered} THEN 'llm_fallback' ELSE 'regex' END AS method "
            f"FROM state WHERE document_type IN ({types}) "
            f"AND extraction_status IN ('success_hybrid', 'failed_llm') AND (({is_answered}) OR {found})"
        )
    return " UNION ALL ".join(selects)


_MERGED = f"{_STATE}, merged AS ({_merged_rows()})"

ORACLES["merge_gap_fill"] = f"""WITH {_MERGED}
SELECT document_name, document_type, field, value, method FROM merged"""

_WIDE_TEXT = [f for f in E.all_fields() if not E.is_number_field(f) and f != "contracting_parties"]
_WIDE = ", ".join(f"max(value) FILTER (field = '{f}') AS {f}" for f in _WIDE_TEXT)

ORACLES["extraction_wide"] = f"""WITH {_MERGED},
wide AS (SELECT document_name, {_WIDE},
    max(TRY_CAST(replace(replace(value, '$', ''), ',', '') AS DOUBLE)) FILTER (field = 'total_amount') AS total_amount,
    max(TRY_CAST(replace(replace(value, '$', ''), ',', '') AS DOUBLE)) FILTER (field = 'ending_balance') AS ending_balance
  FROM merged GROUP BY document_name)
SELECT s.k AS doc_id, s.document_name, s.document_type, s.extraction_status, s.error, s.reason,
  {", ".join(f"w.{f}" for f in _WIDE_TEXT)}, w.total_amount, w.ending_balance
FROM state s LEFT JOIN wide w ON s.document_name = w.document_name"""

ORACLES["extraction_run_summary"] = f"""WITH {_STATE}
SELECT CAST(count(*) AS BIGINT) AS docs_processed,
  CAST(count(*) FILTER (contains(extraction_status, 'success')) AS BIGINT) AS successful_extractions FROM state"""

ORACLES["distinct_field_names"] = f"""WITH {_MERGED}, n AS (SELECT DISTINCT field FROM merged)
SELECT field AS name FROM n UNION ALL SELECT concat(field, '_method') FROM n"""

# --- invoices ---------------------------------------------------------------------------

_TITLED = f"concat(substr({X.LETTERS}, 1, 1), lower(substr({X.LETTERS}, 2)))"
_HEADER = f"""{_INVOICES},
header AS (SELECT {X.INVOICE_ID} AS doc_id, {X.INVOICE_FILE} AS source_file, {X.IS_CREDIT} AS credit,
    CASE WHEN ({X.NUMBER_RANK}) IS NOT NULL THEN concat('INV-', lpad(concat('', o_orderkey), 8, '0')) END AS invoice_number,
    CASE WHEN ({X.DATE_RANK}) IS NOT NULL THEN {X.DAY} END AS invoice_date,
    CASE WHEN ({X.TOTAL_RANK}) IS NOT NULL THEN {X.PRICE}::DOUBLE END AS total_amount,
    CASE {X.VENDOR_RANK} WHEN 0 THEN concat('Vendor ', {_TITLED}) WHEN 1 THEN concat('Trading House ', {_TITLED}) END AS vendor_name,
    {X.NUMBER_RANK} AS rn, {X.DATE_RANK} AS rd, {X.TOTAL_RANK} AS rt, {X.VENDOR_RANK} AS rv FROM invoices)"""

_FIELDS = (("invoice_number", "rn"), ("invoice_date", "rd"), ("total_amount", "rt"), ("vendor_name", "rv"))
ORACLES["invoice_header_fields"] = f"""WITH {_HEADER}
SELECT doc_id, {", ".join(f for f, _ in _FIELDS)},
  {", ".join(f"round(1.0::DOUBLE - {r} * 0.1::DOUBLE, 4) AS {f}_confidence" for f, r in _FIELDS)} FROM header"""

ORACLES["invoice_fields_in_prose"] = f"""WITH {_HEADER}
SELECT d.doc_id, invoice_number, total_amount, round(1.0::DOUBLE - rn * 0.1::DOUBLE, 4) AS invoice_number_confidence,
  round(1.0::DOUBLE - rt * 0.1::DOUBLE, 4) AS total_amount_confidence
FROM documents d LEFT JOIN header h ON h.doc_id = d.doc_id"""

_GOODS_TITLE = (
    "concat(CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' ELSE 'New' END, "
    "CASE l_linestatus WHEN 'O' THEN ' Open Goods' ELSE ' Final Goods' END)"
)
_ITEMS = f"""
priced AS (SELECT l_orderkey AS o_orderkey, part, {_GOODS_TITLE} AS description, CAST(l_quantity AS BIGINT) AS q,
    CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * 100 AS BIGINT) AS cents FROM dealt
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
items AS (SELECT {X.INVOICE_ID} AS doc_id, description, q::DOUBLE AS quantity,
    ((2 * cents + q) // (2 * q)) / 100::DOUBLE AS unit_price, cents / 100::DOUBLE AS total_price,
    CASE WHEN o_orderkey % 3 = 0 THEN 0.8::DOUBLE ELSE 0.9::DOUBLE END AS confidence FROM priced),
checked AS (SELECT *, quantity BETWEEN 0.001 AND 10000 AS q_ok, unit_price BETWEEN 0.01 AND 100000 AS p_ok,
    abs(total_price - quantity * unit_price) > 0.02::DOUBLE AS fix FROM items)"""

ORACLES["invoice_line_items"] = f"""WITH {_INVOICES}, {_ITEMS}
SELECT doc_id, description, quantity, unit_price, total_price, confidence FROM items"""

_CONF = f"""{_HEADER}, {_ITEMS},
hc AS (SELECT *, (coalesce(1 - rn * 0.1::DOUBLE, 0) + coalesce(1 - rd * 0.1::DOUBLE, 0) + coalesce(1 - rt * 0.1::DOUBLE, 0)
      + coalesce(1 - rv * 0.1::DOUBLE, 0)) AS s,
    (rn IS NOT NULL)::INT + (rd IS NOT NULL)::INT + (rt IS NOT NULL)::INT + (rv IS NOT NULL)::INT AS n FROM header),
lc AS (SELECT doc_id, count(*) AS lines, avg(confidence) AS c, count(*) FILTER (q_ok AND p_ok) AS kept,
    string_agg(CASE WHEN NOT q_ok THEN concat('Invalid quantity for item ''', description, '''') END, ',' ORDER BY description) AS wq,
    string_agg(CASE WHEN NOT p_ok THEN concat('Invalid unit price for item ''', description, '''') END, ',' ORDER BY description) AS wp
  FROM checked GROUP BY doc_id),
conf AS (SELECT h.*, coalesce(l.lines, 0) AS lines, coalesce(l.kept, 0) AS kept, wq, wp,
    CASE WHEN n > 0 AND lines > 0 THEN s / n * 0.4::DOUBLE + c * 0.6::DOUBLE
      WHEN n > 0 THEN s / n WHEN lines > 0 THEN c ELSE 0.0::DOUBLE END AS overall
  FROM hc h LEFT JOIN lc l ON h.doc_id = l.doc_id),
valid AS (SELECT *, invoice_number IS NOT NULL AND invoice_date IS NOT NULL AS passed FROM conf
  WHERE NOT credit AND overall >= 0.5)"""

ORACLES["invoice_confidence"] = f"""WITH {_CONF}
SELECT doc_id, round(overall, 6) AS overall_confidence, CAST(lines AS BIGINT) AS lines FROM conf WHERE overall >= 0.5"""

ORACLES["tax_amount"] = f"""SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 4 < 2 THEN {X.PRICE}::DOUBLE
    WHEN o_orderkey % 4 = 2 THEN o_custkey::DOUBLE END AS tax_amount,
  CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.9 WHEN 2 THEN 1.0 END::DOUBLE AS tax_confidence FROM orders"""

_ROWS = f"""
raw AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, concat({X.GOODS}, ' ', l_partkey) AS description,
    concat('  ', {X.GOODS}, chr(9), ' ', l_partkey) AS untidy,
    l_quantity * CASE WHEN l_returnflag = 'R' THEN 250 ELSE 1 END AS quantity,
    CAST(floor(l_extendedprice / l_quantity * 100) AS DOUBLE) / 100 AS unit_price, l_extendedprice AS total_price
  FROM lineitem),
rows_ AS (SELECT *, quantity >= 0.001 AND quantity <= 10000 AS q_ok, unit_price >= 0.01 AND unit_price <= 100000 AS p_ok,
    abs(total_price - quantity * unit_price) > 0.02::DOUBLE AS fix FROM raw)"""

ORACLES["line_item_ranges"] = f"""WITH {_ROWS}
SELECT l_orderkey, l_linenumber, description, quantity, unit_price, q_ok AND p_ok AS valid,
  CAST((NOT q_ok)::INT + (NOT p_ok)::INT AS BIGINT) AS warning_count,
  concat_ws('; ', CASE WHEN NOT q_ok THEN concat('Invalid quantity for item ''', untidy, '''') END,
    CASE WHEN NOT p_ok THEN concat('Invalid unit price for item ''', untidy, '''') END) AS warnings FROM rows_"""

ORACLES["line_item_correction"] = f"""WITH {_ROWS}
SELECT l_orderkey, l_linenumber, quantity, unit_price,
  CASE WHEN fix THEN round(quantity * unit_price, 2) ELSE total_price END AS total_price, fix AS price_corrected FROM rows_"""

ORACLES["line_item_dedup"] = f"""SELECT DISTINCT l_orderkey, {X.GOODS} AS description, l_quantity,
  CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem"""

ORACLES["invoice_validation"] = f"""WITH {_CONF}
SELECT doc_id, passed, concat_ws(',', CASE WHEN invoice_number IS NULL THEN 'Missing invoice number' END,
    CASE WHEN invoice_date IS NULL THEN 'Missing invoice date' END) AS errors,
  concat_ws(',', wq, wp) AS warnings,
  CAST(kept AS BIGINT) AS kept_lines, CAST(lines - kept AS BIGINT) AS dropped_lines FROM valid"""

ORACLES["consolidated_invoices"] = f"""WITH {_CONF}
SELECT source_file, invoice_number, invoice_date, vendor_name, total_amount, CAST(kept AS BIGINT) AS line_items_count
FROM valid WHERE passed"""

ORACLES["consolidated_line_items"] = f"""WITH {_CONF}
SELECT c.description, c.quantity, c.unit_price,
  CASE WHEN fix THEN round(c.quantity * c.unit_price, 2) ELSE c.total_price END AS total_price, c.confidence,
  fix AS price_corrected, v.invoice_number
FROM valid v JOIN checked c ON v.doc_id = c.doc_id WHERE v.passed AND q_ok AND p_ok"""

ORACLES["consolidation_summary"] = f"""WITH {_CONF}
SELECT '{X.TODAY.replace(" ", "T")}' AS processing_time, CAST(count(*) AS BIGINT) AS total_files_found,
  CAST(count(*) FILTER (NOT credit AND overall >= 0.5) AS BIGINT) AS total_files_processed,
  (SELECT CAST(count(*) FILTER (passed) AS BIGINT) FROM valid) AS successful_invoices,
  (SELECT CAST(count(*) FILTER (NOT passed) AS BIGINT) FROM valid) AS failed_or_skipped_invoices,
  CAST(0 AS BIGINT) AS skipped_no_text, CAST(count(*) FILTER (credit) AS BIGINT) AS skipped_other_type,
  CAST(count(*) FILTER (NOT credit AND overall < 0.5) AS BIGINT) AS skipped_low_confidence FROM conf"""

# --- joins between stages, findings -----------------------------------------------------

_AMOUNT = f"CAST({X.AMOUNT} AS DOUBLE)"
_PARTIES = """CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_orderkey % 4 END"""
_PARTY_TEXT = (
    "CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'Party A' "
    "WHEN o_orderkey % 4 = 2 THEN 'Party A,Party B' ELSE 'Party A,Party B,Party C' END"
)
_RECORDS = f"""
recs AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, {X.ORDER_DOC} AS document_name, {X.ORDER_TYPE} AS document_type,
    {X.STATUS} AS extraction_status, {X.ERROR} AS error, {X.VENDOR} AS vendor_name, {X.NUMBER} AS invoice_number,
    {_AMOUNT} AS amount, {X.AMOUNT} AS exact_amount, {X.TRANSACTION_DATE} AS transaction_date, {X.EFFECTIVE_DATE} AS effective_date,
    {X.TERMINATION_DATE} AS termination_date, {_PARTIES} AS parties_n, {_PARTY_TEXT} AS parties,
    coalesce(({X.STATUS}) LIKE 'success%', FALSE) AS ok FROM orders)"""

ORACLES["classified_text_join"] = f"""SELECT {X.ORDER_DOC} AS document_name, {X.ORDER_TYPE} AS document_type,
  CASE WHEN o_orderkey % 47 = 0 THEN 'failed' ELSE 'found' END AS state FROM orders"""

ORACLES["classified_record_join"] = f"""WITH {_RECORDS}
SELECT document_name, document_type, extraction_status, vendor_name FROM recs
WHERE document_type IN ({strings(rules.TARGET_SCHEMAS)})"""

ORACLES["unextracted_documents"] = f"""WITH {_RECORDS}
SELECT document_name, document_type FROM recs WHERE document_type NOT IN ({strings(rules.TARGET_SCHEMAS)})"""

ORACLES["json_record_scan"] = f"""WITH {_RECORDS}
SELECT document_name, extraction_status, error, vendor_name, invoice_number, amount AS total_amount,
  termination_date, parties AS contracting_parties FROM recs"""

ORACLES["record_to_json"] = f"""WITH {_RECORDS}
SELECT document_name, concat('{{', concat_ws(',', '"extraction_status":"' || extraction_status || '"',
  '"invoice_number":"' || invoice_number || '"', '"vendor_name":"' || vendor_name || '"'), '}}') AS json FROM recs"""

_DUPLICATES = f"""{_RECORDS},
inv AS (SELECT document_name, lower(vendor_name) AS vendor_name, lower(invoice_number) AS invoice_number, amount, o_orderstatus
  FROM recs WHERE document_type = 'invoice' AND ok AND vendor_name IS NOT NULL AND invoice_number IS NOT NULL AND amount > 0),
billed AS (SELECT document_name, vendor_name, invoice_number, amount FROM inv
  UNION ALL SELECT concat('copy-', document_name), vendor_name, invoice_number, amount FROM inv WHERE o_orderstatus = 'F'),
grp AS (SELECT vendor_name, invoice_number, amount, CAST(count(*) AS BIGINT) AS document_count FROM billed
  GROUP BY vendor_name, invoice_number, amount HAVING count(*) > 1)"""

ORACLES["duplicate_invoices"] = f"""WITH {_DUPLICATES}
SELECT vendor_name, invoice_number, amount, document_count, document_name FROM billed JOIN grp USING (vendor_name, invoice_number, amount)"""

ORACLES["duplicate_group_lists"] = f"""WITH {_DUPLICATES}
SELECT vendor_name, invoice_number, amount, CAST(0 AS BIGINT) AS list_number, CAST(1 AS BIGINT) AS lists,
  string_agg(document_name, ',' ORDER BY document_name) AS documents
FROM billed JOIN grp USING (vendor_name, invoice_number, amount) GROUP BY vendor_name, invoice_number, amount"""

ORACLES["duplicate_alert_rows"] = f"""WITH {_DUPLICATES},
numbered AS (SELECT *, dense_rank() OVER (ORDER BY vendor_name, invoice_number, amount) AS g FROM grp)
SELECT concat('GROUP ', g) AS alert_group, document_name, vendor_name, invoice_number, amount
FROM billed JOIN numbered USING (vendor_name, invoice_number, amount)"""

_SPEND = f"""
spend AS (SELECT vendor_name,
    CAST(sum(CASE WHEN document_type = 'credit_note' THEN -CAST(exact_amount AS DECIMAL(18, 2)) ELSE CAST(exact_amount AS DECIMAL(18, 2)) END) AS DOUBLE) AS net_spend,
    CAST(count(*) AS BIGINT) AS doc_count FROM recs
  WHERE document_type IN ({strings(rules.SPEND_TYPES)}) AND ok AND vendor_name <> '' AND exact_amount > 0 GROUP BY vendor_name)"""

ORACLES["vendor_net_spend"] = f"""WITH {_RECORDS}, {_SPEND}
SELECT vendor_name, net_spend, doc_count FROM spend ORDER BY net_spend DESC, vendor_name"""

ORACLES["top_vendor"] = f"""WITH {_RECORDS}, {_SPEND}
SELECT vendor_name AS top_vendor, net_spend FROM spend ORDER BY net_spend DESC, vendor_name LIMIT 1"""

_EXPIRING = f"""
dated AS (SELECT *, floor((epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) - epoch(TIMESTAMP '{X.TODAY}')) / 86400) AS days
  FROM recs WHERE document_type = 'contract' AND ok AND termination_date IS NOT NULL),
expiring AS (SELECT * FROM dated WHERE termination_date <> 'soon' AND NOT contains(termination_date, '+') AND days BETWEEN 0 AND 90)"""

ORACLES["expiring_contracts"] = f"""WITH {_RECORDS}, {_EXPIRING}
SELECT document_name, termination_date, CAST(days AS BIGINT) AS days_to_expiry, coalesce(parties, '') AS parties
FROM expiring ORDER BY days_to_expiry, document_name"""

ORACLES["unparsable_dates"] = f"""WITH {_RECORDS}
SELECT document_name, termination_date FROM recs WHERE document_type = 'contract' AND ok
  AND (termination_date = 'soon' OR contains(termination_date, '+'))"""

_NO_AMOUNT = "coalesce(amount, 0) <= 0"
_RULES = (
    ("invoice", "invoice_number IS NULL", "Missing Field", "Invoice number is missing."),
    ("invoice", _NO_AMOUNT, "Invalid Value", "Total amount is zero or missing."),
    ("receipt", "transaction_date IS NULL", "Missing Field", "Transaction date is missing."),
    ("receipt", _NO_AMOUNT, "Invalid Value", "Total amount is zero or missing."),
    ("contract", "effective_date IS NULL", "Missing Field", "Effective date is missing."),
    ("contract", "coalesce(parties_n, 0) < 2", "Invalid Value", "Fewer than two contracting parties were found."),
)


def _flags(source: str) -> str:
    broken = " UNION ALL ".join(
        f"SELECT document_name, document_type, '{issue}' AS issue, '{details}' AS details FROM {source} "
        f"WHERE ok AND document_type = '{t}' AND {test}"
        for t, test, issue, details in _RULES
    )
    return (
        f"SELECT document_name, document_type, 'Extraction Failed' AS issue, coalesce(error, 'Unknown error') AS details "
        f"FROM {source} WHERE NOT ok UNION ALL {broken}"
    )


ORACLES["data_quality_flags"] = f"WITH {_RECORDS} {_flags('recs')}"

ORACLES["dashboard_kpis"] = f"""WITH {_DUPLICATES}, {_EXPIRING},
again AS (SELECT * FROM recs UNION ALL SELECT * FROM recs WHERE document_type = 'invoice' AND o_orderstatus = 'F'),
flags AS ({_flags('again')}),
vendors AS (SELECT DISTINCT vendor_name FROM recs WHERE document_type IN ({strings(rules.SPEND_TYPES)}) AND ok
    AND vendor_name <> '' AND amount > 0
  UNION SELECT concat('  ', upper(vendor_name), ' ', chr(9)) FROM recs WHERE document_type = 'invoice' AND o_orderstatus = 'F'
    AND ok AND vendor_name IS NOT NULL AND amount > 0)
SELECT 'CRITICAL ALERTS (Duplicate Payments)' AS metric, (SELECT CAST(count(*) AS BIGINT) FROM grp) AS value
UNION ALL SELECT 'UPCOMING RISKS (Expiring Contracts)', (SELECT CAST(count(*) AS BIGINT) FROM expiring)
UNION ALL SELECT 'Data Quality Issues Flagged', (SELECT CAST(count(*) AS BIGINT) FROM flags)
UNION ALL SELECT 'Unique Vendors Analyzed', (SELECT CAST(count(*) AS BIGINT) FROM vendors)"""

ORACLES["summary_request"] = f"""WITH kpis AS ({ORACLES["dashboard_kpis"]}), top AS ({ORACLES["top_vendor"]}),
facts AS (SELECT concat('{{"counts":{{', (SELECT string_agg(concat('"', metric, '":', value), ',' ORDER BY metric) FROM kpis),
  '}},"top_vendor":"', top_vendor, '","net_spend":', CAST(net_spend AS DECIMAL(38, 2)), '}}') AS facts FROM top)
SELECT facts, concat({text(R.SUMMARY_INSTRUCTION)}, facts) AS request FROM facts"""

# --- scalar functions -------------------------------------------------------------------

ORACLES["date_among_words"] = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 7 THEN {X.DAY} END AS day FROM orders"""

ORACLES["date_normalize"] = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE {X.DAY} END AS day FROM orders"""


def _title(word: str) -> str:
    return f"concat(upper(substr({word}, 1, 1)), lower(substr({word}, 2)))"


_W1, _W2 = "string_split(p_name, ' ')[1]", "string_split(p_name, ' ')[2]"
ORACLES["title_case"] = f"""SELECT p_partkey, concat('O''', {_title(_W1)}, ' ', {_title(_W2)}, '-', {_title('p_type')},
  ' 3D & ', {_title('p_brand')}) AS title FROM part"""

ORACLES["money_parse"] = f"""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN {X.PRICE}::DOUBLE WHEN 1 THEN {X.PRICE}::DOUBLE
  WHEN 4 THEN o_custkey * 1000.0::DOUBLE WHEN 7 THEN -10.0::DOUBLE * o_custkey ELSE 0.0::DOUBLE END AS amount FROM orders"""

ORACLES["text_normalize"] = """SELECT p_partkey,
  lower(concat(p_name, chr(10), ' ', chr(160), p_type, '  ', p_brand)) AS stripped,
  concat(upper(p_name), ' ', p_type, ' ', p_brand) AS collapsed, FALSE AS blank FROM part"""

# --- organising -------------------------------------------------------------------------

_MANIFEST = f"""{_PARTS},
labelled AS (SELECT *, {X.PAGE_LABEL} AS predicted_type FROM parts),
manifest AS (SELECT path, document_name_stem, predicted_type,
    regexp_replace(predicted_type, '[<>:"/\\\\|?*]', '_', 'g') AS folder
  FROM labelled WHERE extension IN ({SUFFIXES}))"""

ORACLES["organize_manifest_by_name"] = f"""WITH {_MANIFEST},
named AS (SELECT document_name_stem, arg_max(predicted_type, path) AS predicted_type,
    min(predicted_type) <> max(predicted_type) AS conflict FROM labelled GROUP BY document_name_stem)
SELECT m.path, m.document_name_stem, n.predicted_type, n.conflict,
  regexp_replace(n.predicted_type, '[<>:"/\\\\|?*]', '_', 'g') AS folder
FROM manifest m JOIN named n ON m.document_name_stem = n.document_name_stem"""

ORACLES["organize_manifest"] = f"""WITH {_MANIFEST}
SELECT path, document_name_stem, predicted_type, folder FROM manifest"""

ORACLES["organize_summary"] = f"""WITH {_MANIFEST}, there AS (SELECT {X.PAGE_PATH} AS path FROM pages WHERE NOT contains(url, '#'))
SELECT CAST(count(*) FILTER (path IN (SELECT path FROM there)) AS BIGINT) AS copied,
  CAST(count(*) FILTER (path NOT IN (SELECT path FROM there)) AS BIGINT) AS failed FROM manifest"""

ORACLES["files_by_bytes"] = """SELECT source, CAST(count(*) AS BIGINT) AS documents,
  CAST(sum(coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0) + 16) AS BIGINT) AS bytes,
  true AS none_too_large, true AS none_too_many
FROM documents GROUP BY source"""

# --- results that go through files ------------------------------------------------------

ORACLES["pdf_discovery"] = f"""WITH {_PARTS}
SELECT path, document_name, length FROM parts WHERE extension = '.pdf'"""

ORACLES["classification_csv_round_trip"] = ORACLES["classification_metrics"]

_FINDINGS = (
    ("duplicate_invoices", "duplicate_invoices", "document_count"), ("expiring_contracts", "expiring_contracts", "days_to_expiry"),
    ("vendor_spend", "vendor_net_spend", "doc_count"), ("data_quality_flags", "data_quality_flags", "length(issue)"),
)
ORACLES["analysis_round_trip"] = " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST(count(*) AS BIGINT) AS rows_, CAST(sum({total}) AS BIGINT) AS total FROM ({ORACLES[query]})"
    for name, query, total in _FINDINGS
)

ORACLES["text_table_round_trip"] = f"""WITH {_OUTCOME}
SELECT o.path, concat('Doc_', o.doc_id, regexp_extract(o.path, '[.][^.]*$')) AS document_name, '{RUN_TS}' AS run_ts,
  md5(d.text) AS text_md5
FROM outcome o JOIN documents d ON o.doc_id = d.doc_id WHERE success ORDER BY o.path"""
