"""Table schemas and the fixed values that must equal the reference's."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results).
# --------------------------------------------------------------------------
VALID_EVENT_TYPES = ["view", "add_to_cart", "purchase"]
# canonical city spellings checked on *raw* rows by the anomaly reasons
RAW_VALID_CITIES = ["Delhi", "Mumbai", "Kolkata", "Bangalore"]
# alias lists of the cleaning step, matched on lower(trim(city)), in order
CITY_ALIASES = [
    ("Delhi", ["del", "delhi", "dilli"]),
    ("Mumbai", ["mum", "mumbai", "bombay"]),
    ("Kolkata", ["kol", "kolkata", "calcutta"]),
    ("Bengaluru", ["blr", "bangalore", "bengaluru"]),
]
OTHER_CITY = "Others"
UNKNOWN = "Unknown"
MISSING_USER = "-1"
MAX_PRICE = 80000
MAX_QUANTITY = 10
RAW_MAX_QUANTITY = 3
ALERT_THRESHOLD = 15.0
CONTAMINATION = 0.10
N_TREES = 100
MAX_SAMPLES = 256
SEED = 42
REVENUE_SIGMA = 2.0
# reason texts, in the order the reference assigns them (later wins)
R_NORMAL = "Normal"
R_NEG_PRICE = "Negative Price"
R_ZERO_PRICE = "Zero Price"
R_PRICE_OUTLIER = "Price Outlier (Currency Mismatch)"
R_ZERO_QTY = "Zero Quantity (Bot Traffic)"
R_QTY_OUTLIER = "Quantity Outlier (Data Entry Error)"
R_UNKNOWN_CITY = "Unknown City (Corrupt/Missing)"
R_INVALID_EVENT = "Invalid Event Type (Schema Drift)"
R_MISSING_PAYMENT = "Missing Payment Method"
R_HIGH_REVENUE = "Unusually High Revenue"
R_ML_PATTERN = "ML Pattern Anomaly"
LABEL_NORMAL = "Normal"
LABEL_ANOMALY = "Anomaly"
INSIGHT_METRICS = ["Top Category", "Peak Hour", "Conversion Rate",
                   "Top City", "Total Orders", "Total Revenue"]

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------
# Event JSON is read all-string and cast afterwards: missing keys -> null,
# extra keys ignored, an int user id reads as its text.
EVENT_JSON_FIELDS = ["order_id", "user_id", "product_id", "prod_id", "product_name",
                     "category", "price", "quantity", "event_type", "timestamp",
                     "payment_method", "city"]
EVENT_JSON = T.StructType([T.StructField(f, T.StringType()) for f in EVENT_JSON_FIELDS])

RAW_COLS = ["id", "order_id", "user_id", "product_id", "product_name", "category",
            "price", "quantity", "event_type", "timestamp", "payment_method", "city"]
RAW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("order_id", T.IntegerType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("city", T.StringType()),
])

CLEANED_COLS = ["order_id", "user_id", "product_id", "product_name", "category", "price",
                "quantity", "event_type", "event_timestamp", "payment_method", "city",
                "revenue"]

FEATURE_COLS = ["price_clean", "quantity_clean", "revenue_clean", "category_encoded",
                "city_encoded", "event_type_encoded", "payment_encoded"]

ANOMALY_COLS = ["order_id", "user_id", "product_id", "product_name", "category",
                "price_raw", "price_clean", "quantity_raw", "quantity_clean", "revenue",
                "event_type", "timestamp", "payment_method", "city", "anomaly_label",
                "anomaly_reason", "anomaly_score", "isolation_score"]

ALERT = T.StructType([
    T.StructField("alert_time", T.TimestampType()),
    T.StructField("anomaly_rate", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("anomaly_count", T.LongType()),
    T.StructField("message", T.StringType()),
])
