"""Fixed values that must equal the source system's for results to match.

Everything in this module is data, not logic: word lists, rule tables,
thresholds and column lists.  They are stated plainly and in their natural
order so that they can be checked against the behaviour they reproduce.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — report layout
# ---------------------------------------------------------------------------

#: Header markers: a row whose (lower-cased) cell equals one of these is the header.
SALES_HEADER_MARKERS = ("date", "receipt", "time")
PRODUCT_HEADER_MARKERS = ("date", "receipt", "product", "item")
#: Only the first N grid rows are searched for the header.
HEADER_SEARCH_ROWS = 10
#: Header row index used when no marker row is found.
DEFAULT_HEADER_ROW = 4

#: File-name substrings that route a report to its dataset.
SALES_FILE_TAG = "Sales Transaction List"
PRODUCT_FILE_TAG = "Sales Report by Product"
ACCEPTED_EXTENSIONS = (".csv", ".xlsx")

#: Columns dropped from the sales (receipt) report when present.
SALES_DROP_COLUMNS = (
    "Posted", "Price Level", "Branch", "TM#", "Customer ID", "Customer Name",
    "Cashier", "Serviced By", "Dine In", "Take Out", "Local Tax", "Amusement Tax",
    "EWT", "NAC", "Solo Parent", "Service", "Feedback Rating", "Diplomat",
)
#: Columns dropped from the by-product (line) report when present.
PRODUCT_DROP_COLUMNS = (
    "Lot/Serial", "Posted", "TM#", "Unit", "Discount ID", "Discount",
    "% Discount", "Price ID", "Branch", "Customer ID", "Customer",
)

#: Fact column order: these first (when present), the rest after.
FACT_PRIORITY_COLUMNS = (
    "date", "time_id", "receipt_no", "product_id", "product_name",
    "qty", "price", "line_total", "net_total",
)

#: Warehouse fact columns (DDL order).
FACT_COLUMNS = (
    "date", "time_id", "receipt_no", "product_id", "product_name", "qty", "price",
    "line_total", "net_total", "discount", "evat", "pwd", "senior", "tax",
    "total_gross", "void", "base_qty", "take_out",
)

#: Price sanity range (inclusive) applied when the line report has a time column.
PRICE_MIN = 0
PRICE_MAX = 50000

# ---------------------------------------------------------------------------
# FIXED VALUES — product standardisation rules (applied in order; first match
# wins).  Each rule: (from_ids, from_names, to_id, to_name).
# ---------------------------------------------------------------------------
STANDARDIZATION_RULES = (
    (("FDS-2017-0024-W-DCS-BLMW",), ("DOUBLE CHOCOLATE AND STRAWBERRIES",), "2024waffles4", "DOUBLE CHOCS AND STRAWBERRIES"),
    (("FDS-2017-0020-W-BN2-BLMW",), ("BANANA NUTELLA WAFFLES",), "2024waffles2", "BANANA NUTELLA"),
    (("FDS-2017-0028-S-BCT-BLMW",), ("BACON, COLESLAW AND TOMATO",), "2024Breads7", "CLASSIC BACON COLESLAW N TOMATO"),
    (("FDS-2017-0029-S-TCS-BLMW",), ("THE CLUB SANDWICH",), "2024breads", "THE CKUB"),
    (("DKS-2018-0034-COOL-PEACH-16-BLMW",), ("PEACH",), "DKS-2018-0025-SH-CAMPCH-16-BLMW", "CAMOMILE PEACH"),
    (("DKS-2017-0025-SH-16-BLMW",), ("CHAMOMILE PEACH",), "DKS-2018-0020-FRAPPE-PCHLUCK-16-BLMW", "PEACHIEST LUCK"),
    (("FDS-2018-0001-GARLICBRD--BLMW",), ("GARLIC BREAD EXTRA",), "2024BREads9", "GALIC BREAD ALA CARTE"),
    (("FDS-2018-0001-BEF-KOR-BLMW",), ("KOREAN BEEF BBQ",), "2024lrgplates13", "K POP BBQ BEEF"),
    (("2024FDPIZSCREAM",), ("SPINACH & CREAM PIZZA",), "2024pizza3", "SPINACH N CREAM PIZZA"),
    (("2024PromobundleChix steak",), ("CHICKEN STEAK PROMO BUNDLE",), "2024PromoChixsteak", "CHICKEN STEAK PROMO"),
    (("FDS-2017-0030-PBB-LONG-BLMW",), ("LONGANISA PBB",), "2024FilBfast4", "FIL BFAST LONGGANISA"),
    (("FDS-2018-0001-MOJOS-BLMW",), ("MOJOS",), "2024smlplates2", "MOJOJOJOS"),
    (("FFDS-2020-VM-DANGGIT-BLMW", "FDS-2017-0030-PBB-DNGGT-BLMW"), ("DANGGIT", "DANGGIT PBB"), "2024FilBFast3", "FIL BREAKFAST DANGGIT"),
    (("FDSS-2018-001-EGG-EXT-BLMW",), ("EXTRA EGG",), "ING-EGG", "EGG"),
    (
        ("FDS-2017-009-SPAMFRT-BLMW", "FDS-2017-009-SPAMRI-BLMW", "FDS-2017-009-SPAMRI-BLMW"),
        ("SPAM, FRENCH TOAST, EGGS AND HASH BROWN", "SPAM, RICE, EGGS, HASH BROWN", "SPAM, WAFFLES, EGGS, HASH BROWN"),
        "FDS-2017-0010-ADB-S-BLMW", "SPAM WITH RICE OR WAFFLES OR FRENCH TOAST",
    ),
    (
        ("FDS-2017-009-HUNGFRT-BLMW", "FDS-2017-009-HUNGRI-BLMW", "FDS-2017-009-HUNGRI-BLMW"),
        ("HUNGARIAN SAUSAGE, FRENCH TOAST, EGGS AND HASH BROWN", "HUNGARIAN SAUSAGE, RICE, EGGS, HASH BROWN",
         "HUNGARIAN SAUSAGE, WAFFLES, EGGS AND HASH BROWN"),
        "FDS-2017-0011-ADB-HS-BLMW", "HUNGARIAN SAUSAGE WITH RICE OR WAFFLES OR FRENCH TOAST",
    ),
    (
        ("FDS-2017-009-GERFRT-BLMW", "FDS-2017-009-GERRI-BLMW", "FDS-2017-009-GERWAF-BLMW"),
        ("GERMAN FRANKS, FRENCH TOAST, EGGS AND HASH BROWN", "GERMAN FRANKS, RICE, EGGS AND HASH BROWN",
         "GERMAN FRANKS, WAFFLES, EGGS AND HASH BROWN"),
        "FDS-2017-0012-ADB-GF-BLMW", "GERMAN FRANKS WITH RICE OR WAFFLES OR FRENCH TOAST",
    ),
    (
        ("FDS-2017-009-CBFRT-BLMW", "FDS-2017-009-CBRI-BLMW", "FDS-2017-009-CBWAF-BLMW"),
        ("CORNED BEEF, FRENCH TOAST, EGGS AND HASH BROWN", "CORNED BEEF, RICE, EGGS, AND HASH BROWN",
         "CORNED BEEF, WAFFLES, EGGS, HASH BROWN"),
        "FDS-2017-0013-ADB-CB-BLMW", "CORNED BEEF WITH RICE OR WAFFLES OR FRENCH TOAST",
    ),
    (
        ("FDS-2017-009-BAFRT-BLMW", "FDS-2017-009-BARI-BLMW", "FDS-2017-009-BAWA-BLMW"),
        ("BACON, FRENCH TOAST, EGGS, HASH BROWN", "BACON, RICE, EGGS AND HASH BROWN", "BACON, WAFFLES, EGGS, HASH BROWN"),
        "FDS-2017-009-ADB-B-BLMW", "BACON WITH RICE OR WAFFLES OR FRENCH TOAST",
    ),
)

# ---------------------------------------------------------------------------
# FIXED VALUES — product classification
# ---------------------------------------------------------------------------

#: A name token from this set makes a product a DRINK.
DRINK_KEYWORDS = (
    "ICED", "ICE", "HOT", "8OZ", "12OZ", "16OZ", "COLD",
    "TEA", "LATTE", "SHAKE", "FRAPPE", "MOCHA", "GLASS", "PITCHER", "WATER",
)
#: Substrings / whole words that classify a product as OTHERS.
OTHERS_SUBSTRINGS = ("CHARGING",)
OTHERS_WORDS = ("TAKE",)
#: Substrings / whole words that classify a product as EXTRA.
EXTRA_SUBSTRINGS = ("BOTTLED WATER", "PLAIN RICE")
EXTRA_WORDS = ("EGG", "DIJON", "EXTRA")
#: Product-id substrings that force DRINK (over FOOD only).
DRINK_ID_MARKERS = ("DRNKS", "DKS")

#: Parent-SKU rule: temperature tokens, size values, and trailing variant digits.
PARENT_SKU_TRIGGER_TOKENS = ("ICED", "ICE", "HOT", "COLD")
PARENT_SKU_SIZES = ("8", "12", "16")
PARENT_SKU_TRAILING_DIGITS = ("1", "2", "3")

#: Categories left out of mining.
EXCLUDED_CATEGORIES = ("EXTRA", "OTHERS")

# ---------------------------------------------------------------------------
# FIXED VALUES — mining, pricing and forecasting parameters (library defaults)
# ---------------------------------------------------------------------------
MIN_SUPPORT = 0.003
MIN_CONFIDENCE = 0.15
MIN_LIFT = 1.0
SCORE_LIFT_WEIGHT = 0.7
SCORE_SUPPORT_WEIGHT = 30.0
TOP_RULES_PER_RUN = 5
RUN_PREFIX = {"FOOD": "BF", "DRINK": "BD", "MEAL": "BM"}
TOP_BUNDLES = 15

DEFAULT_COGS_MULTIPLIER = 0.60
MIN_DISCOUNT_PCT = 0.10
SCENARIO_DISCOUNT_RATE = 0.05
SUMMARY_DISCOUNT_RATE = 0.10

HW_ALPHA = 0.2
HW_BETA = 0.2
HW_GAMMA = 0.2
SEASON_LENGTH = 4
HORIZON = 4

#: Outlier flagging (IQR) default multiplier and the flag count that removes a row.
IQR_K = 1.5
OUTLIER_MIN_FLAGS = 2

#: Trend label band (relative change of last vs first value).
TREND_BAND = 0.05

#: Costing-sheet score: minimum accepted score, sizes checked, name length threshold.
COST_MATCH_MIN_SCORE = 2
COST_MATCH_SIZES = ("8", "12", "16")
COST_MATCH_MIN_NAME_LEN = 4
