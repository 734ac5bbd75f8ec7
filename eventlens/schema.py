"""Schemas of the event envelope, its payload and the two JSON-lines logs."""

from pyspark.sql import types as T

# The five funnel stages, in order.
FUNNEL_STAGES = ["page_view", "product_click", "add_to_cart", "checkout_start", "purchase"]

PURCHASE = "purchase"
REFUND = "refund"
SEARCH = "search_query"

# Payload keys differ per event type, so every field is nullable.
PAYLOAD = T.StructType([
    T.StructField("page", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("cart_size", T.IntegerType()),
    T.StructField("cart_value", T.DoubleType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("items", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("device", T.StringType()),
])

# The payload as it came, beside the typed one: it has the keys that are not listed here, too.
RAW_PAYLOAD = "data_json"

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("data", PAYLOAD),
    T.StructField("partition_key", T.StringType()),
])

# One line of a partition log. `timestamp` is epoch seconds on disk.
LOG_SCHEMA = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("data", PAYLOAD),
    T.StructField("partition_key", T.StringType()),
])
LOG_REQUIRED = ["offset", "event_id", "event_type", "timestamp", "user_id", "session_id", "data"]

# One line of the state-mutation log.
STATE_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.DoubleType()),
    T.StructField("op", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("data", PAYLOAD),
])
STATE_LOG_OP = "event"

# The flat relation the metric operators read: one row per delivered event.
FLAT_COLUMNS = [
    "event_id", "event_type", "ts", "ingest_ts", "user_id",
    "country", "device", "product_name", "category", "query", "amount",
]
