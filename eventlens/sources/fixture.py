"""Binding of the test tables to the commerce-event shape (see FIXTURES.md)."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlens.schema import FLAT_COLUMNS, PURCHASE, REFUND, SEARCH
from eventlens.session import use_utc

# Fixed values of the fixture.
PRODUCT_TYPES = ["product_click", "add_to_cart", "purchase"]
RESEND_EVERY = 500
RESEND_DELAYS = {1: 10, 2: 45}


# Schemas of the tables read here; stating them saves a footer-reading job per table.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_type string",
}
GEO_COLUMNS, PRODUCT_COLUMNS = ["country", "device"], ["product_name", "category"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def _event_type() -> Column:
    kind, k = F.col("kind"), F.col("k")
    return (
        F.when(kind == "view", F.when(k < 70, "page_view").otherwise("search_query"))
        .when(kind == "click", "product_click")
        .when(kind == "signup", F.when(k < 60, "add_to_cart").otherwise("checkout_start"))
        .when(kind == "purchase", PURCHASE)
        .when(kind == "error", REFUND)
    )


def commerce_events(spark: SparkSession, sf_dir: str, columns: list[str] = FLAT_COLUMNS) -> DataFrame:
    """One row per event of the `events` table, in the flat commerce shape.

    Only the dimensions whose columns are asked for are joined. The join strategy is
    left to Spark: it broadcasts what its statistics allow and shuffles otherwise.
    """
    use_utc(spark)
    base = _read(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.col("event_type").alias("kind"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "value",
    ).withColumns({
        "event_type": _event_type(),
        "ingest_ts": F.timestamp_micros(F.unix_micros("ts") + F.col("event_id") * 37 % 1000 * 1000),
    })
    if set(columns) & set(GEO_COLUMNS):
        base = (
            base
            .join(_read(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"), "left")
            .join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .withColumnsRenamed({"n_name": "country", "c_mktsegment": "device"})
        )
    if set(columns) & set(PRODUCT_COLUMNS):
        has_product = F.col("event_type").isin(PRODUCT_TYPES)
        base = (
            base
            .join(_read(spark, sf_dir, "part"), has_product & (F.col("k") == F.col("p_partkey")), "left")
            .withColumnsRenamed({"p_name": "product_name", "p_type": "category"})
        )
    derived = {
        "query": F.when(F.col("event_type") == SEARCH, F.concat(F.lit("q"), F.col("k").cast("string"))),
        "amount": F.when(F.col("event_type").isin(PURCHASE, REFUND), F.col("value")),
    }
    return base.select(*[derived[c].alias(c) if c in derived else c for c in columns])


def resent(
    spark: SparkSession, sf_dir: str, late_copies: bool = True, columns: list[str] = FLAT_COLUMNS,
) -> DataFrame:
    """`commerce_events` plus repeated deliveries of 1 event in 500.

    ``copy=1`` arrives 10 s after the original, ``copy=2`` (other events) 45 s after.
    One scan: each row is expanded into the deliveries it has.
    """
    place = F.col("event_id") % RESEND_EVERY
    copies = F.when(place == 0, F.array(F.lit(0), F.lit(1)))
    if late_copies:
        copies = copies.when(place == 1, F.array(F.lit(0), F.lit(2)))
    delay_us = F.lit(0)
    for copy, seconds in RESEND_DELAYS.items():
        delay_us = F.when(F.col("copy") == copy, F.lit(seconds * 1_000_000)).otherwise(delay_us)
    return (
        commerce_events(spark, sf_dir, columns)
        .withColumn("copy", F.explode(copies.otherwise(F.array(F.lit(0)))))
        .withColumn("ingest_ts", F.timestamp_micros(F.unix_micros("ingest_ts") + delay_us))
    )


def to_envelope(flat: DataFrame) -> DataFrame:
    """Flat rows as log envelopes (string ids, nested payload); other columns pass through."""
    envelope = [
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("s_"), F.col("user_id").cast("string")).alias("session_id"),
        F.struct(
            "query", "product_name", "category", F.col("amount").cast("double").alias("amount"),
            "country", "device",
        ).alias("data"),
        F.concat(F.lit("u_"), F.col("user_id").cast("string")).alias("partition_key"),
    ]
    extra = [c for c in ("ingest_ts", "copy") if c in flat.columns]
    return flat.select(*envelope, *extra)
