"""The texts and numbers that results must carry exactly.

Nothing in this module is logic.  Each group is plain text in its natural
order, and every operator takes its values from here.
"""

# --- tier labels, batch path -------------------------------------------------
MISS = "MISS"
TIER_1 = "TIER_1_XBRL"
TIER_2 = "TIER_2"
TIER_3_URL = "TIER_3_URL"
TIER_3_LLM = "TIER_3_LLM"

# --- tier labels, verification path ------------------------------------------
NONE = "NONE"
TIER_1_CACHE = "tier_1_cache"
TIER_2_SCRAPER = "tier_2_scraper"
TIER_3_MODEL = "tier_3_llm"
API_CHECK_FAILED = "api_check_failed"
FAILED = "failed"

# --- value sentinels ---------------------------------------------------------
YEAR_NOT_FOUND = "YEAR_NOT_FOUND"
METRIC_ROW_NOT_FOUND = "METRIC_ROW_NOT_FOUND"
TABLE_NOT_FOUND = "TABLE_NOT_FOUND"
NO_TABLES = "NO_TABLES"
DOWNLOAD_FAILED = "DOWNLOAD_FAILED"
TIER_3_FAILED = "TIER_3_FAILED"
METRIC_NOT_FOUND = "METRIC_NOT_FOUND"
PARSE_ERROR = "PARSE_ERROR"
LLM_ERROR = "LLM_ERROR"
MISSING_YEAR = "MISSING_YEAR"

# --- url sentinels -----------------------------------------------------------
NO_FILINGS_FOUND = "NO_FILINGS_FOUND"
NO_FILING_EXISTS = "NO_FILING_EXISTS"
API_ERROR = "API_ERROR"
URL_SENTINELS = (NO_FILING_EXISTS, NO_FILINGS_FOUND, API_ERROR)

# --- defaults ----------------------------------------------------------------
UNKNOWN = "UNKNOWN"
NOT_AVAILABLE = "N/A"
UNKNOWN_CIK = "UNKNOWN_CIK"
UNKNOWN_COMPANY = "UNKNOWN_COMPANY"
MISSING_TEXT = "nan"  # how a missing text cell prints in a result
CURRENCY = "USD"
AUDIT_STATUS = "UNVERIFIED"
SNIPPET_PREFIX = "xbrl.csv -> Column: "
ANNUAL_FORM = "10-K"

# Values that send a batch row on to the third tier (together with null).
BATCH_RETRY = (
    "MISS",
    "DOWNLOAD_FAILED",
    "invalid_url",
    "METRIC_ROW_NOT_FOUND",
    "UNKNOWN",
)

# Second-tier values that do not count as a win when verifying.
VERIFY_NOT_WON = (
    "METRIC_ROW_NOT_FOUND",
    "YEAR_NOT_FOUND",
    "TABLE_NOT_FOUND",
)

# --- metric catalogue used when no catalogue file is given --------------------
METRIC_COLUMNS = {
    "ResearchAndDevelopment": "ResearchAndDevelopmentExpense",
    "SalesRevenueNet": "SalesRevenueNet",
    "NetIncomeLoss": "NetIncomeLoss",
}

VERIFY_METRICS = ("SalesRevenueNet", "NetIncomeLoss", "ResearchAndDevelopment")

# Row-label aliases per metric, highest priority first.
ROW_ALIASES = {
    "SalesRevenueNet": (
        "total revenues",
        "total net revenues",
        "total net sales",
        "net revenues",
        "net sales",
        "sales",
        "collaboration revenue",
        "revenue",
    ),
    "NetIncomeLoss": (
        "net income (loss) attributable",
        "net loss attributable",
        "net income attributable",
        "net income (loss)",
        "net loss",
        "net income",
    ),
    "ResearchAndDevelopment": (
        "total research and development",
        "research and development expenses",
        "research and development",
        "r&d",
    ),
}

# A row label holding one of these is never the metric's own row.
POISON_WORDS = (
    "before",
    "per share",
    "basic",
    "diluted",
    "comprehensive",
    "in-process",
    "purchased",
)

# --- statement table ---------------------------------------------------------
STATEMENT_ANY_OF = (("net income", "net loss"), ("revenue", "sales"))
STATEMENT_NONE_OF = ("cash flows from",)
STATEMENT_MIN_ROWS = 11
HEADER_ROWS = 15
FIRST_DATA_ROW = 5
YEAR_CELL_PATTERN = r"(?U)\b(201\d|202\d)\b"
SCALES = (
    ("in millions", 1_000_000.0),
    ("in thousands", 1_000.0),
    ("in billions", 1_000_000_000.0),
)
FOOTNOTE_PATTERN = r"\([a-zA-Z0-9]\)$"
DASHES = ("-", "—")

# --- facts -------------------------------------------------------------------
CIK_COLUMNS = ("entitycentralindexkey", "EntityCentralIndexKey")
FISCAL_YEAR_COLUMNS = ("documentfiscalyearfocus", "DocumentFiscalYearFocus")
END_DATE_COLUMNS = ("end_date", "period_end_date", "ddate", "periodOfReport")
START_DATE_COLUMNS = ("start_date", "period_start_date")

# Texts a delimited file uses for "no value" (the usual data-frame set).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- text, retrieval, prompts --------------------------------------------------
CHUNK_WORDS = 800
CHUNK_OVERLAP = 150
TOP_CHUNKS = 3
CHUNK_SEPARATOR = "\n\n---\n\n"
QUESTION_FORMAT = "Total consolidated %s for the entire fiscal year %s"
CHUNK_ID_PREFIX = "chunk_"
COLLECTION_PREFIX = "sec_10k_"
ANSWER_KEYS = (
    "line_item_found",
    "raw_reported_number",
    "unit_scale",
    "calculated_total_dollars",
    "metric_found",
)
ANSWER_SCALES = ("thousands", "millions", "exact")

# --- addresses ---------------------------------------------------------------
FILING_HOST = "https://www.sec.gov"
ARCHIVE_ROOT = "https://www.sec.gov/Archives/edgar/data"
INDEX_PAGE_MARK = "-index.htm"

# --- verification ------------------------------------------------------------
SAMPLE_ROWS = 200
SAMPLE_SEED = 42
REVIEW_COLUMN = "verified_correct?"

# --- result record, in order ---------------------------------------------------
RESULT_COLUMNS = (
    "extraction_id",
    "cik",
    "ticker",
    "company_name",
    "document_fiscal_year",
    "metric_fiscal_year",
    "period_start_date",
    "period_end_date",
    "metric_name",
    "extracted_value",
    "currency",
    "winning_tier",
    "source_snippet",
    "accession_no",
    "edgar_url",
    "audit_status",
    "audit_notes",
)
PREVIEW_COLUMNS = (
    "extraction_id",
    "company_name",
    "document_fiscal_year",
    "period_start_date",
    "period_end_date",
    "metric_name",
    "extracted_value",
    "winning_tier",
)
