"""Canonical tables, header spellings and text conventions."""

from __future__ import annotations

from pyspark.sql import types as T

ALL_SERIES = "ALL"
DEFAULT_SKU = "DEFAULT_SKU"
DEFAULT_UNITS = 1
DEFAULT_PRICE = 100.0
DEFAULT_PROMO = 0

N_IN = 30          # days in a model input window
N_OUT = 7          # days in a model output block
SEASON = 7         # weekly season of the linear model
DAYS_PER_QUARTER = 91

CANONICAL = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("units_sold", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("promotion_flag", T.IntegerType()),
])

# Header spellings accepted for each canonical column, in order of preference.
WIDE_ALIASES = {
    "date": ["date", "ds", "datetime", "time"],
    "sku_id": ["sku_id", "sku", "product_id", "item_id", "product", "category"],
    "units_sold": ["units_sold", "units", "quantity", "qty", "sales", "demand", "y"],
    "price": ["price", "unit_price", "avg_price", "cost", "amount"],
    "promotion_flag": ["promotion_flag", "promo_flag", "promo", "promotion", "is_promo",
                       "on_promotion", "promotion-ids"],
    "status": ["status"],
}

# The forecast entry point knows fewer spellings.
_NOT_IN_NARROW = {"category", "amount", "promotion-ids", "status"}
NARROW_ALIASES = {
    target: [name for name in names if name not in _NOT_IN_NARROW]
    for target, names in WIDE_ALIASES.items() if target != "status"
}

# Order states that count as a sale.
SOLD_STATUSES = ["shipped", "shipped - delivered to buyer", "delivered"]

# CSV cells read as missing (the pandas defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Spellings read as booleans.
BOOL_TOKENS = ["True", "TRUE", "true", "False", "FALSE", "false"]

# Plain decimal or scientific notation. Excludes what a JVM cast accepts besides ('3d', 'NaN').
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# A time of day behind a date; only the day is kept.
TIME_SUFFIX = r"[T ]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([AaPp][Mm])?\s*(Z|[+-]\d{2}:?\d{2})?$"

# Accepted notations of a day: numeric with the year first or last, year and month, eight digits, named
# month with or without a weekday before it.
NUMERIC_DAY = r"^(\d{4}([-/.])\d{1,2}\2\d{1,2}|\d{1,2}([-/.])\d{1,2}\3(\d{4}|\d{2})|\d{4}-\d{2}|\d{8})$"
WEEKDAY_PREFIX = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? +"
NAMED_DAY = r"^([A-Za-z]{3,9}[- ]\d{1,2},?[- ](\d{4}|\d{2})|\d{1,2}[- ][A-Za-z]{3,9},?[- ](\d{4}|\d{2}))$"

# Days outside the range of 64-bit nanoseconds count as missing.
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-11"

LINEAR_REGRESSORS = ["avg_price", "promo_any", "dow_sin", "doy_sin"]
CALENDAR_FEATURES = ["dow_sin", "dow_cos", "doy_sin", "doy_cos"]
WINDOW_FEATURES = ["avg_price", "promo_any", *CALENDAR_FEATURES]
