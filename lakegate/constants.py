"""Fixed values the behaviour depends on (kept together, in natural order)."""

# --- fixed values: error codes of file-level gates -------------------------
CODE_BAD_NAME_OR_DATE = "000000001"
CODE_DUPLICATE_FILE = "000000002"
CODE_FILE_ORDER = "000000003"
CODE_COLUMN_COUNT = "000000006"
CODE_FAIL_FAST = "000000007"
FAIL_FAST_STOP = "FAIL_FAST_STOP"   # reason of the files behind one that failed fast

# --- fixed values: cell values that mean "not set" in a configuration sheet -
NULL_TOKENS = ("", "nan", "none", "null")

# --- fixed values: date patterns tried when a DATE column has none ----------
DEFAULT_DATE_PATTERNS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)

# --- fixed values: configured type name -> Spark SQL type --------------------
TYPE_MAPPING = {
    "STRING": "string",
    "INTEGER": "int",
    "INT": "int",
    "LONG": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
    "DECIMAL": "decimal(18,2)",
    "BOOLEAN": "boolean",
    "DATE": "timestamp_ntz",
    "TIMESTAMP": "timestamp_ntz",
}

# --- fixed values: error actions, ingestion modes, header modes -------------
ACTION_ICT = "ICT_DRIVEN"
ACTION_REJECT = "REJECT"
ACTION_LOG = "LOG_ONLY"
ERROR_ACTIONS = (ACTION_ICT, ACTION_REJECT, ACTION_LOG)

MODE_FULL_SNAPSHOT = "FULL_SNAPSHOT"
MODE_DELTA_FROM_FLOW = "DELTA_FROM_FLOW"
MODE_UPSERT = "DELTA_FROM_NON_HISTORIZED"
MODE_HISTORIZED = "DELTA_FROM_HISTORIZED"
MODE_FULL_KEY_REPLACE = "FULL_KEY_REPLACE"
INGESTION_MODES = (
    MODE_FULL_SNAPSHOT,
    MODE_DELTA_FROM_FLOW,
    MODE_UPSERT,
    MODE_HISTORIZED,
    MODE_FULL_KEY_REPLACE,
)

HEADER_DEFAULT = ""
HEADER_FIRST_LINE = "FIRST_LINE"
HEADER_USE = "HEADER_USE"

SPECIAL_MERGE_KEY = "ismergekey"
SPECIAL_START_VALIDITY = "isstartvalidity"

# --- fixed values: row-level error codes -------------------------------------
ERR_TYPE_MISMATCH = "TYPE_MISMATCH"
ERR_DATE_PARSE = "DATE_PARSE_ERROR"
ERR_NULL_VALUE = "NULL_VALUE"

# --- fixed values: supported landing formats by extension --------------------
FORMAT_BY_EXTENSION = {
    "csv": "csv",
    "txt": "csv",
    "parquet": "parquet",
    "json": "json",
    "jsonl": "json",
}

# --- fixed values: technical columns written first in every target table ----
TECHNICAL_COLUMNS = (
    "FILE_LINE_ID",
    "FILE_NAME_RECEIVED",
    "FILE_EXTRACTION_DATE",
    "FILE_PROCESS_DATE",
)

# --- fixed values: partition schemes of the history table --------------------
PARTITION_SCHEMES = {
    "yyyy": ("yyyy",),
    "yyyy/mm": ("yyyy", "mm"),
    "yyyy/mm/dd": ("yyyy", "mm", "dd"),
    "yyyy/mm/dd/hhmmss": ("yyyy", "mm", "dd", "hhmmss"),
}

# --- fixed values: date patterns in file names, in this order; the first that matches decides ----
FILE_DATE_RULES = (
    (r"(\d{8})_(\d{6})", "concat", "yyyyMMddHHmmss"),
    (r"(\d{8})", "one", "yyyyMMdd"),
    (r"(\d{4})-(\d{2})-(\d{2})", "concat3", "yyyyMMdd"),
    (r"(\d{4})_(\d{2})_(\d{2})", "concat3", "yyyyMMdd"),
)
