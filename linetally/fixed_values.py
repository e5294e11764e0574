"""Names, codes and limits that results must agree on."""

# --- fixed values: source CSV headers, both spellings -> column name --------
CSV_HEADERS = {
    "Invoice": "invoice_no",
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "UnitPrice": "unit_price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}
CSV_ENCODING = "ISO-8859-1"

# --- fixed values: where a line came from -----------------------------------
BATCH = "batch_historical"
STREAM = "stream_live"
REFERENCE_API = "worldbank_api"

# --- fixed values: line types, first match wins ------------------------------
LINE_TYPES = ("normal", "cancellation", "negative_adjustment", "zero_or_negative_price")

# --- fixed values: reference indicators --------------------------------------
GDP = "NY.GDP.MKTP.CD"
POPULATION = "SP.POP.TOTL"
DEFAULT_INDICATOR_YEAR = "2010"
AGGREGATE_REGION = "NA"

# --- fixed values: mapping and segment labels --------------------------------
MAPPING_TYPES = ("exact", "alias", "assumed", "unmappable")
SEGMENTS = {1: "low_value", 2: "mid_value", 3: "high_value"}

# --- fixed values: calendar spine, end exclusive ------------------------------
CALENDAR_START = "2009-12-01"
CALENDAR_END = "2012-01-31"

# --- fixed values: duplicate-rate limits --------------------------------------
DUPLICATE_RATE_LIMIT = 0.05
DUPLICATE_RATE_EXCEPTIONS = {"2010-12": 0.45}
REVENUE_TOLERANCE = 0.01

# --- fixed values: freshness limits in days -----------------------------------
FRESH_WARN_DAYS = 7
FRESH_ERROR_DAYS = 30

# --- fixed values: country mapping, (retail country, ISO3, confidence, note) ---
COUNTRY_MAPPING = [
    ("United Kingdom", "GBR", "exact", None),
    ("EIRE", "IRL", "alias", "EIRE is the Irish-language name for Ireland"),
    ("Germany", "DEU", "exact", None),
    ("France", "FRA", "exact", None),
    ("Netherlands", "NLD", "exact", None),
    ("Spain", "ESP", "exact", None),
    ("Switzerland", "CHE", "exact", None),
    ("Belgium", "BEL", "exact", None),
    ("Portugal", "PRT", "exact", None),
    ("Australia", "AUS", "exact", None),
    ("Channel Islands", "CHI", "exact", "World Bank carries Channel Islands as a distinct entity"),
    ("Italy", "ITA", "exact", None),
    ("Norway", "NOR", "exact", None),
    ("Sweden", "SWE", "exact", None),
    ("Cyprus", "CYP", "exact", None),
    ("Finland", "FIN", "exact", None),
    ("Austria", "AUT", "exact", None),
    ("Denmark", "DNK", "exact", None),
    ("Greece", "GRC", "exact", None),
    ("Japan", "JPN", "exact", None),
    ("USA", "USA", "alias", "Abbreviation of United States"),
    ("Poland", "POL", "exact", None),
    ("United Arab Emirates", "ARE", "exact", None),
    ("Israel", "ISR", "exact", None),
    ("Hong Kong", "HKG", "alias", "World Bank name is Hong Kong SAR China"),
    ("Singapore", "SGP", "exact", None),
    ("Malta", "MLT", "exact", None),
    ("Iceland", "ISL", "exact", None),
    ("Canada", "CAN", "exact", None),
    ("Lithuania", "LTU", "exact", None),
    ("RSA", "ZAF", "alias", "Republic of South Africa"),
    ("Bahrain", "BHR", "exact", None),
    ("Brazil", "BRA", "exact", None),
    ("Thailand", "THA", "exact", None),
    (
        "Korea",
        "KOR",
        "assumed",
        "Ambiguous between Republic of Korea and DPRK; assumed South Korea on commercial plausibility",
    ),
    ("Lebanon", "LBN", "exact", None),
    (
        "West Indies",
        None,
        "unmappable",
        "Historic regional term covering multiple Caribbean states; no single World Bank entity",
    ),
    ("Bermuda", "BMU", "exact", None),
    ("Nigeria", "NGA", "exact", None),
    ("Czech Republic", "CZE", "alias", "World Bank renamed this to Czechia"),
    ("Saudi Arabia", "SAU", "exact", None),
    ("European Community", None, "unmappable", "Political aggregate rather than a country"),
    ("Unspecified", None, "unmappable", "Placeholder in the source data"),
]
