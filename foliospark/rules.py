"""Rule values: plain data that the operators compile to column expressions.

Everything a user may want to extend (types, keywords, patterns, target schemas, limits)
is a value here or a parameter of an operator; nothing is registered globally.
"""

from __future__ import annotations

from dataclasses import dataclass

Keywords = dict[str, tuple[str, ...]]


@dataclass(frozen=True)
class RuleSet:
    """Ordered keyword rules per document type; earlier types win ties."""

    filename: Keywords
    content: Keywords
    filename_confidence: float = 0.98
    high_score: int = 3
    high_confidence: float = 0.95
    two_hit_confidence: float = 0.6
    one_hit_confidence: float = 0.4
    threshold: float = 0.5


# --- Fixed values -----------------------------------------------------------------------
# These must equal the documented behaviour for results to match: document types, keyword
# lists (their order decides ties), patterns, target schemas, limits and message texts.

FILENAME_KEYWORDS: Keywords = {
    "invoice": ("invoice", "inv-"),
    "receipt": ("receipt",),
    "purchase_order": ("purchase-order", "po-"),
    "credit_note": ("credit-note", "credit_note"),
    "bank_statement": ("bank_statement", "bank-statement"),
    "balance_sheet": ("balance sheet", "balance_sheet"),
    "profit_and_loss": ("profit and loss", "p&l"),
    "contract": ("contract", "agreement"),
    "quotation": ("quote", "quotation"),
}

CONTENT_KEYWORDS: Keywords = {
    "invoice": ("invoice", "bill to", "remittance", "invoice number", "amt due"),
    "receipt": ("receipt", "cash sale", "payment confirmation", "paid", "credit card"),
    "purchase_order": ("purchase order", "po number", "ship to", "vendor"),
    "credit_note": ("credit note", "credit memo", "adjustment note"),
    "bank_statement": ("bank statement", "account summary", "statement period", "ending balance"),
    "balance_sheet": ("balance sheet", "assets", "liabilities", "equity", "total assets"),
    "profit_and_loss": ("profit and loss", "income statement", "revenue", "net income", "cogs"),
    "contract": ("agreement", "contract", "parties", "whereas", "indemnification"),
    "resume": ("resume", "curriculum vitae", "experience", "education", "skills"),
    "bill_of_lading": ("bill of lading", "bol", "carrier", "shipper", "consignee"),
    "packing_slip": ("packing slip", "packing list", "item description", "quantity shipped"),
    "utility_bill": ("utility bill", "gas bill", "electric bill", "water bill", "usage"),
}

COMPACT_CONTENT_KEYWORDS: Keywords = {
    "invoice": ("invoice", "bill to", "remittance"),
    "receipt": ("receipt", "cash sale", "payment confirmation"),
    "purchase_order": ("purchase order", "po number", "ship to"),
    "credit_note": ("credit note", "credit memo"),
    "bank_statement": ("bank statement", "account summary"),
    "balance_sheet": ("balance sheet", "assets", "liabilities"),
    "profit_and_loss": ("profit and loss", "income statement"),
    "contract": ("agreement", "contract", "parties"),
    "resume": ("resume", "curriculum vitae"),
    "bill_of_lading": ("bill of lading", "bol"),
    "packing_slip": ("packing slip", "packing list"),
    "utility_bill": ("utility bill", "gas bill"),
}

SUPPORTED_SUFFIXES = (
    ".pdf", ".png", ".jpg", ".jpeg", ".tiff", ".bmp", ".txt", ".docx", ".doc", ".pptx",
    ".ppt", ".heic", ".webp", ".eml", ".msg",
)
MAX_FILE_SIZE_MB = 50
REUSE_FOLDER_MARK = "extracted_text"

FIELD_PATTERNS: dict[str, dict[str, str]] = {
    "invoice": {
        "invoice_number": r"invoice[\s_.-]*(?:number|no|num|#)\.?[\s\S]*?([A-Z0-9-]{5,})",
        "due_date": r"due[\s_.-]*date[\s\S]*?(\d{4}-\d{2}-\d{2}|\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
        "total_amount": r"(?:total|balance)[\s_.-]*(?:amount|due)?[\s\S]*?\$?([\d,]+\.\d{2})",
        "vat_number": r"vat[\s_.-]*(?:no|num|number|#|registration)?[\s\S]*?(\b4\d{9}\b)",
    },
    "receipt": {
        "transaction_date": r"date[\s\S]*?(\d{4}-\d{2}-\d{2}|\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
        "total_amount": r"total[\s\S]*?\$?([\d,]+\.\d{2})",
        "vat_number": r"vat[\s_.-]*(?:no|num|number|#|registration)?[\s\S]*?(\b4\d{9}\b)",
    },
}

TARGET_SCHEMAS: dict[str, dict[str, str]] = {
    "invoice": {
        "invoice_number": "string", "vendor_name": "string", "total_amount": "number",
        "due_date": "YYYY-MM-DD", "vat_number": "string",
    },
    "receipt": {
        "vendor_name": "string", "transaction_date": "YYYY-MM-DD", "total_amount": "number",
        "payment_method": "string", "vat_number": "string",
    },
    "contract": {
        "contract_title": "string", "effective_date": "YYYY-MM-DD",
        "termination_date": "YYYY-MM-DD", "contracting_parties": "array",
    },
    "bank_statement": {
        "bank_name": "string", "account_holder": "string", "statement_period": "string",
        "ending_balance": "number",
    },
}

INVOICE_NUMBER_PATTERNS = (
    r"invoice\s*(?:no\.?|number|#)\s*:?\s*([A-Z0-9\-_]+)",
    r"inv\.?\s*(?:no\.?|#)\s*:?\s*([A-Z0-9\-_]+)",
    r"bill\s*(?:no\.?|#)\s*:?\s*([A-Z0-9\-_]+)",
    r"reference\s*(?:no\.?|#)\s*:?\s*([A-Z0-9\-_]+)",
)
INVOICE_DATE_PATTERNS = (
    r"(?:invoice\s*)?date\s*:?\s*(\d{1,2}[\/\-\.]\d{1,2}[\/\-\.]\d{2,4})",
    r"(\d{1,2}\s(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s\d{4})",
    r"((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4})",
    r"(\d{4}[\/\-\.]\d{1,2}[\/\-\.]\d{1,2})",
)
INVOICE_TOTAL_PATTERNS = (
    r"(?:grand\s*)?total\s*(?:amount)?\s*:?\s*\$?\s*([0-9,]+\.\d{2})",
    r"amount\s*due\s*:?\s*\$?\s*([0-9,]+\.\d{2})",
    r"balance\s*due\s*:?\s*\$?\s*([0-9,]+\.\d{2})",
)
VENDOR_PATTERNS = (
    r"(?:from|bill\s*to|vendor|company)\s*:?\s*([A-Za-z][A-Za-z\s&\.,\-]{5,50})",
    r"^\s*([A-Z][A-Z\s&\.,\-]{10,50})\s*$",
)
LINE_ITEM_PATTERNS = (
    r"([A-Za-z][A-Za-z\s\-&\(\)]{5,50}?)\s{2,}(\d+(?:\.\d+)?)\s{2,}\$?\s*([0-9,]+\.?\d{0,2})\s{2,}\$?\s*([0-9,]+\.?\d{0,2})",
    r"([A-Za-z].*?)\s+(\d+)\s+@\s+\$?([\d,]+\.\d{2})\s+\$?([\d,]+\.\d{2})",
)
TAX_PATTERNS = (
    r"(?:sales\s*)?tax\s*(?:\([0-9.%]+\))?\s*:?\s*\$?\s*([0-9,]+\.?\d{0,2})",
    r"vat\s*(?:\([0-9.%]+\))?\s*:?\s*\$?\s*([0-9,]+\.?\d{0,2})",
)

# (type, phrases that decide it), tested in this order
ORDERED_TYPE_PHRASES = (
    ("credit_note", ("credit note", "credit memo")),
    ("remittance_advice", ("remittance advice",)),
    ("purchase_order", ("purchase order",)),
    ("invoice", ("invoice",)),
)

RANK_STEP = 0.1  # confidence lost per pattern rank
LINE_BASE_CONFIDENCE = 0.9
HEADER_WEIGHT = 0.4
LINE_WEIGHT = 0.6
MIN_INVOICE_CONFIDENCE = 0.5
MIN_QUANTITY, MAX_QUANTITY = 0.001, 10000.0
MIN_UNIT_PRICE, MAX_UNIT_PRICE = 0.01, 100000.0
TOTAL_TOLERANCE = 0.02
SHORT_TEXT_CHARS = 150
CONTRACT_EXPIRY_DAYS = 90

# Truncation of the text in a model request: (characters, share of head, share of tail)
CLASSIFY_TEXT_LIMIT = (4000, 0.6, 0.4)
CLASSIFY_TEXT_LIMIT_COMPACT = (8000, 0.6, 0.4)
EXTRACT_TEXT_LIMIT = (8000, 0.7, 0.3)
TRUNCATION_MARK = "\n...\n"

SPEND_TYPES = ("invoice", "receipt", "credit_note")

# Texts in results
REASON_BY_RULES = "Classified by keyword rules."
REASON_NO_FALLBACK = "Rules failed and LLM fallback is disabled."
ERROR_EMPTY_TEXT = "Empty text file"
ERROR_NO_TEXT = "No text extracted"
ERROR_NO_SOURCE = "source text file not found"
REASON_NO_SCHEMA = "No schema for "
ERROR_NO_NUMBER = "Missing invoice number"
ERROR_NO_DATE = "Missing invoice date"
ERROR_NEGATIVE_TOTAL = "Negative total amount"
ISSUE_FAILED = "Extraction Failed"
ISSUE_MISSING = "Missing Field"
ISSUE_INVALID = "Invalid Value"
DETAIL_UNKNOWN = "Unknown error"
DETAIL_NUMBER = "Invoice number is missing."
DETAIL_TOTAL = "Total amount is zero or missing."
DETAIL_TRANSACTION_DATE = "Transaction date is missing."
DETAIL_EFFECTIVE_DATE = "Effective date is missing."
DETAIL_PARTIES = "Fewer than two contracting parties were found."
KPI_LABELS = {
    "duplicates": "CRITICAL ALERTS (Duplicate Payments)",
    "expiring": "UPCOMING RISKS (Expiring Contracts)",
    "flags": "Data Quality Issues Flagged",
    "vendors": "Unique Vendors Analyzed",
}

# --- End of fixed values ----------------------------------------------------------------

FULL_RULES = RuleSet(FILENAME_KEYWORDS, CONTENT_KEYWORDS)
COMPACT_RULES = RuleSet(FILENAME_KEYWORDS, COMPACT_CONTENT_KEYWORDS)
