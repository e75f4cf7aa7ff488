"""Fixed values shared by the operators.

Everything in this module is a value that results depend on literally: names, word lists, limits and
message texts. It holds no logic.
"""

# Declared input layout and types of the known order columns.
DECLARED_TYPES = {
    "order_id": "string",
    "order_date": "string",
    "product": "string",
    "revenue": "double",
}
ORDER_TYPES = {
    "customer_id": "bigint",
    "unit_price": "double",
    "quantity": "bigint",
    "revenue": "double",
}

# File acceptance.
REQUIRED_COLUMNS = ["order_id", "order_date"]
SUPPORTED_EXTENSIONS = [".csv", ".json"]
GATE_RATIO = 0.5

# Header recognition and names for files that have no header.
HEADER_KEYWORDS = ["id", "order", "date", "revenue", "product", "amount"]
HEADERLESS_NARROW = ["order_id", "order_date", "product", "revenue"]
HEADERLESS_WIDE = ["order_id", "customer_id", "product", "unit_price", "quantity", "order_date"]
EXTRA_COLUMN_PREFIX = "extra_col_"

# Column aliases.
ALIASES = {
    "product_name": "product",
    "date": "order_date",
    "event_timestamp": "order_date",
    "id": "order_id",
    "name": "product",
}
ALIAS_CANDIDATES = {
    "order_id": ["id", "order id", "orderid"],
    "revenue": ["amount", "price", "total", "revenue_value"],
    "order_date": ["date", "event_timestamp", "timestamp"],
}
ISO_DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
GOLD_INPUT_COLUMNS = ["order_id", "order_date", "revenue", "unit_price", "quantity"]

# Gold display names, their defaults and types.
GOLD_DISPLAY_NAMES = {
    "order_date": "date",
    "total_orders_per_day": "total_orders",
    "total_revenue_per_day": "total_revenue",
}
DEFAULT_RANGE_YEAR = 2026

# File issue markers and reasons.
ISSUE_UNSUPPORTED = (
    "N/A", "Unsupported File Format: File extension '%s' is not supported. Use .csv or .json only.")
ISSUE_BAD_JSON = ("CRITICAL", "Corrupted JSON: File could not be parsed. Error: %s")
ISSUE_EMPTY = ("EMPTY", "Corrupted Data: File is empty or has no rows.")
ISSUE_BAD_CSV = ("PARSE_ERROR", "Corrupted CSV: %s")
ISSUE_TOO_NARROW = "Inconsistent columns: Expected at least 2 (order_id, order_date), found %d"
ISSUE_SCHEMA = (
    "SCHEMA_ERROR", "Validation Failed: Missing required columns (order_id, order_date).")
ISSUE_UNREADABLE = ("IO_ERROR", "Access Error: File could not be read. Error: %s")
ISSUE_FILLER = "N/A"

# Row level issue reasons.
REASON_DUPLICATE = (
    "Duplicate Error: Found %d entries for this ID. %d will be filtered.")
REASON_MISSING = "Validation Failed: %s is missing or null"
REASON_NEGATIVE = "Quality Alert: Negative value detected in %s"
REASON_FUTURE = "Temporal Error: Record date is set in the future"
MISSING_CHECK_COLUMNS = ["id", "name", "order_id", "order_date"]
NEGATIVE_CHECK_COLUMNS = ["quantity", "unit_price", "revenue", "price"]
ISSUE_COLUMNS = ["order_id", "Occurrences", "source_file", "product", "order_date", "Reason"]

# Layers of the batch report and the columns each must have.
LAYERS = ["bronze", "quarantine", "validated", "silver", "gold"]
LAYER_REQUIRED = {
    "bronze": ["order_id", "order_date", "ingestion_timestamp", "source_file"],
    "quarantine": ["order_id", "order_date", "rejection_reason"],
    "validated": ["order_id", "order_date", "ingestion_timestamp", "source_file"],
    "silver": ["order_id", "order_date", "processing_timestamp"],
    "gold": ["order_date", "total_orders_per_day"],
}
BATCH_NULL_COLUMNS = ["order_id", "order_date", "customer_id"]
BATCH_NULL_LIMIT_PCT = 5
BATCH_RANGE_COLUMNS = ["unit_price", "quantity"]
BATCH_DATE_COLUMNS = ["order_date", "event_timestamp"]
UNIQUE_LAYERS = ["silver", "gold"]

# Messages of the batch checks.
MSG_PATH_MISSING = "Path does not exist: %s"
MSG_READ_FAILED = "Cannot read Delta table: %s"
READ_ERROR_LENGTH = 200
MSG_EMPTY = "Table is empty (0 rows)"
MSG_ROWS = "%s rows"
MSG_NO_NULLS = "No nulls in %s"
MSG_NULLS = "%d nulls in %s (%s%%)"
MSG_NULLS_OVER = "%d nulls in %s (%s%%) — exceeds 5%% threshold"
MSG_NO_DUPLICATES = "No duplicate order_ids"
MSG_DUPLICATES_BAD = "%d duplicate order_id(s) (%s%%) — unexpected at this layer"
MSG_DUPLICATES_OK = "%d duplicate order_id(s) (%s%%) — expected in Bronze"
MSG_RANGE_OK = "All %s values > 0"
MSG_RANGE_BAD = "%d row(s) with %s <= 0"
MSG_DATES_OK = "All %s values parse as valid dates"
MSG_DATES_BAD = "%d row(s) with unparseable %s"
MSG_NO_FUTURE = "No future-dated records"
MSG_FUTURE = "%d row(s) with future %s"
MSG_SCHEMA_OK = "All required columns present"
MSG_SCHEMA_BAD = "Missing required columns: [%s]"
MSG_REASONS_OK = "All quarantined records have rejection reasons"
MSG_REASONS_BAD = "%d quarantine records missing rejection reason"
MSG_CLEAN_OK = "No rejection reasons found in validated records"
MSG_CLEAN_BAD = "%d validated records still have rejection reasons"
MSG_SILVER_ROWS = "Silver has %s rows (duplicates removed from validated)"

# Names, columns and messages of the live checks.
LIVE_NEGATIVE_COLUMNS = ["unit_price", "quantity", "revenue"]
LIVE_SAMPLE_IDS = 5
LIVE_CHECKS = {
    "formats": "File Formats",
    "integrity": "Data Integrity",
    "rows": "Row Count",
    "columns": "Required Columns Present",
    "duplicates": "No Duplicate Order IDs",
    "nulls": "No Null Critical Fields",
    "negatives": "No Negative Numeric Values",
    "dates": "Valid Date Format",
    "future": "No Future Dates",
    "dedup": "Deduplication Applied",
}
LIVE_FORMATS_OK = "All files use supported .csv format."
LIVE_FORMATS_BAD = "%d file(s) follow unsupported formats."
LIVE_INTEGRITY_OK = "No corrupted CSVs detected."
LIVE_INTEGRITY_BAD = "%d corrupted file(s) found in input folder."
LIVE_ROWS_OK = "%s rows found."
LIVE_ROWS_BAD = "Table is empty — no data loaded."
LIVE_COLUMNS_OK = "All required columns found."
LIVE_COLUMNS_BAD = "Missing columns: %s"
LIVE_DUPLICATES_OK = "No duplicates found."
LIVE_DUPLICATES_BAD = "%d duplicate rows for IDs: %s%s"
LIVE_DUPLICATES_MORE = " … and %d more"
LIVE_NULLS_OK = "All critical fields populated."
LIVE_NULLS_PART = "%s: %d null/empty"
LIVE_NEGATIVES_OK = "All numeric values are non-negative."
LIVE_NEGATIVES_PART = "%s: %d negative value(s)"
LIVE_PART_SEPARATOR = " | "
LIVE_DATES_OK = "All dates parse correctly."
LIVE_DATES_BAD = "%d row(s) have unparsable dates."
LIVE_FUTURE_OK = "No future dates detected."
LIVE_FUTURE_BAD = "%d row(s) have dates set in the future."
LIVE_DEDUP = "%d duplicate row(s) removed (%s%% of Bronze). %s unique records remain."

# Commit history display and version audit.
HISTORY_COLUMNS = [
    "version", "timestamp", "operation", "operationParameters", "userName", "isBlindAppend",
    "engineInfo",
]
PENDING_BRONZE = {
    "version": "Pending", "timestamp": "Real-time", "operation": "INGESTION",
    "operationParameters": "Scanning raw CSVs", "userName": "System", "isBlindAppend": True,
    "engineInfo": "Hybrid RT",
}
ASOF_TOLERANCE_MS = 180000
TREND_VERSIONS = 5

# Log scan.
LOG_KEYWORDS = ["ERROR", "CRITICAL", "EXCEPTION", "SPARK", "FAILED", "JAVA", "PYTHON"]
LOG_SCAN_LINES = 500
LOG_HIGHLIGHTS = 15
LOG_TAIL_LINES = 40

# Synthetic orders.
SYNTHETIC_PRODUCTS = [
    "Cloud Service", "Quantum Core", "Smart Widget", "Bio-Sensor", "Neural Bridge"]
SYNTHETIC_DATE = "2024-03-14"
SYNTHETIC_FIRST_ID = 1000
SYNTHETIC_REVENUE_RANGE = (50.0, 500.0)

# Display formats.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT = "HH:mm:ss"
MONTH_FORMAT = "MMM yyyy"
