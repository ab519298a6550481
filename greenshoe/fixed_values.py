"""They must equal the specification's for results to be right.

Regular expressions are written in the usual ``\\s \\d \\b`` notation; ``functions.dialect``
turns them into expressions for Spark.
"""

# --- offering types and extraction methods -------------------------------------------------
IPO = "ipo"
SPAC = "spac"
FOLLOW_ON = "follow_on"
UNKNOWN = "unknown"
OFFERING_TYPES = [IPO, SPAC, FOLLOW_ON, UNKNOWN]

METHOD_REGEX = "regex"
METHOD_FALLBACK = "llm"
METHOD_FALLBACK_UNPARSED = "llm_parse_error"
METHOD_ERROR = "error"

# --- forms ---------------------------------------------------------------------------------
PROSPECTUS_FORM = "424B4"
REGISTRATION_FORM = "S-1"

# --- signals looked for in the lower-cased cover --------------------------------------------
SPAC_SIGNALS = [
    "trust account",
    "per public share",
    "initial business combination",
    "blank check company",
    "founder shares",
]
SPAC_SIGNALS_NEEDED = 2

FOLLOW_ON_SIGNALS = [
    "our common stock is listed",
    "our shares are listed",
    "our common stock is traded",
    "currently listed on",
    "currently traded on",
    "shares are currently listed",
    "our ordinary shares are listed",
    "traded on the nyse",
    "traded on nasdaq",
    "listed on the nasdaq",
    "listed on the nyse",
    "supplement to the prospectus",
    "is a direct offering",
]

IPO_SIGNALS = [
    "this is an initial public offering",
    "no public market for our common stock",
    "no established public trading market",
    "prior to this offering, there has been no",
    "no public market has existed",
    "no prior public market",
    "no public trading market currently exists",
]

UNDERWRITING_PATTERN = r"underwriting discounts? and commissions?"
NO_MARKET_PATTERN = r"no .{0,30} public market"

# --- price patterns, tried in this order ----------------------------------------------------
PRICE_RANGE_PATTERNS = [
    r"\$\s*(\d+\.?\d{0,2})\s+(?:to|and|-)\s+\$\s*(\d+\.?\d{0,2})\s+per\s+share",
    r"between\s+\$\s*(\d+\.?\d{0,2})\s+and\s+\$\s*(\d+\.?\d{0,2})",
    r"price\s+range\s+of\s+\$\s*(\d+\.?\d{0,2})\s+(?:to|-)\s+\$\s*(\d+\.?\d{0,2})",
]
RANGE_LOW_BOUNDS = (1, 500)

SINGLE_PRICE_PATTERNS = [
    r"initial public offering price per share is \$\s*(\d+(?:\.\d{1,2})?)",
    r"(?:initial public offering price|price to (?:the )?public)[^$\n]{0,80}\$\s*(\d+(?:\.\d{1,2})?)",
    r"combined offering price of \$\s*(\d+(?:\.\d{1,2})?)\s+per\s+share",
    r"public offering price of \$\s*(\d+(?:\.\d{1,2})?)\s+per\s+share",
    r"offering price of \$\s*(\d+(?:\.\d{1,2})?)\s+per\s+(?:share|unit)",
    r"per\s+share\s+\$\s*(\d+(?:\.\d{1,2})?)",
    r"^\$\s*(\d+(?:\.\d{1,2})?)$",
]
SINGLE_PRICE_BOUNDS = (0.01, 500)

# --- share-count patterns, tried in this order ------------------------------------------------
SHARE_PATTERNS = [
    r"we\s+are\s+offering\s+([\d,]+)(?:\s+of(?:\s+our)?)?\s+(?:ordinary\s+|class\s+[a-z]\s+)?shares",
    r"we\s+are\s+offering[^,\d]{0,60},\s*([\d,]+)\s+(?:ordinary\s+|class\s+[a-z]\s+)?shares",
    r"([\d,]+)\s+(?:american\s+depositary\s+shares|adss?)\b",
    r"([\d,]{5,})\s+(?:ordinary\s+|class\s+[a-z]\s+)?shares?\b",
]
SHARE_BOUNDS = (10_000, 1_000_000_000)

WHITESPACE_PATTERN = r"\s+"

# --- cover page -------------------------------------------------------------------------------
COVER_TAGS = ["p", "div", "span", "td"]
COVER_CHARS = 15_000
FALLBACK_CHARS = 4_000
SAMPLE_CHARS = 3_000
PREVIEW_CHARS = 500
SHARE_PREVIEW_CHARS = 800

FALLBACK_PROMPT = """Extract offering terms from this prospectus cover page.
Return ONLY a raw JSON object — no markdown, no explanation.
Keys (use null if not found):
  offering_type: one of "ipo", "spac", "follow_on", "unknown"
  shares_offered: integer or null
  price_low: number or null
  price_high: number or null

Cover page:
"""
FENCE_START_PATTERN = r"^```(?:json)?\s*"
FENCE_END_PATTERN = r"\s*```$"

# --- phrases for profiling ----------------------------------------------------------------------
DOLLAR_PHRASE_PATTERN = r"\$\s*[\d,\.]+[^\n]{0,60}"
SHARE_PHRASE_PATTERN = r"[\d,]{5,}\s+(?:ordinary\s+)?(?:class\s+[a-z]\s+)?shares?"
NUMBER_PATTERN = r"[\d,]+"
DIGIT_PATTERN = r"\d"
SHARE_PHRASES_KEPT = 10
FREQUENT_PHRASES_KEPT = 30
FREQUENCY_MASK_CHARS = 70
DISTINCT_MASK_CHARS = 60
PHRASE_SHOWN_CHARS = 80

# --- company facts --------------------------------------------------------------------------------
REVENUE_TAGS = [
    "Revenues",
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "SalesRevenueNet",
    "SalesRevenueGoodsNet",
]
SHARE_COUNT_TAGS = ["CommonStockSharesOutstanding", "EntityCommonStockSharesOutstanding"]
SHARE_COUNT_NAMESPACES = ["us-gaap", "dei"]
FISCAL_YEAR_TAG = "Revenues"
ANNUAL_FORM_PREFIX = "10-K"
ANNUAL_PERIOD = "FY"
ENRICHMENT_AGE_MONTHS = 6
LOOKUP_KEY_WIDTH = 10

# --- sectors: first matching (low, high, sector) rule over the code as a string ---------------------
SECTOR_RULES = [
    ("7370", "7379", "Software & IT Services"),
    ("2830", "2839", "Pharmaceuticals"),
    ("8731", "8731", "Biotech R&D"),
    ("3840", "3849", "Medical Devices"),
    ("6020", "6029", "Banks"),
    ("6311", "6411", "Insurance"),
    ("3670", "3679", "Semiconductors"),
    ("5800", "5899", "Restaurants & Retail"),
    ("1311", "1389", "Oil & Gas"),
    ("4812", "4899", "Telecom"),
    ("6798", "6798", "REITs"),
    ("6726", "6726", "Investment Funds"),
]
OTHER_SECTOR = "Other"

# --- valuation flags ----------------------------------------------------------------------------------
RICH_FACTOR = 1.5
CHEAP_FACTOR = 0.7
FLAG_NO_REVENUE = "No revenue data"
FLAG_RICH = "Richly valued"
FLAG_CHEAP = "Cheaply valued"
FLAG_IN_LINE = "In line with sector"

# --- data quality bounds --------------------------------------------------------------------------------
PRICE_RANGE = (0.01, 500)
SHARES_RANGE = (10_000, 1_000_000_000)
