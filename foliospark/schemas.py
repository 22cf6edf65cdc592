"""Table schemas, as DDL strings that ``spark.read.schema`` and ``from_json`` accept."""

LISTING = "root STRING, path STRING, length BIGINT"
CLASSIFICATION = (
    "document_name STRING, predicted_type STRING, confidence DOUBLE, method STRING, "
    "reasoning STRING, key_indicators STRING, error STRING"
)
EXPIRING = (
    "document_name STRING, termination_date STRING, days_to_expiry INT, parties ARRAY<STRING>"
)
VENDOR_SPEND = "vendor_name STRING, net_spend DOUBLE, doc_count BIGINT"
QUALITY_FLAGS = "document_name STRING, document_type STRING, issue STRING, details STRING"
TRACKER = (
    "document_name STRING, source_folder STRING, path STRING, extension STRING, method STRING, "
    "status STRING, predicted_type STRING, confidence DOUBLE, reasoning STRING, "
    "document_type STRING, error STRING, stage STRING, run_ts STRING"
)
