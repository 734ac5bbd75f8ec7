"""Rates, shares and health bands computed from the metric tables.

The unpartitioned windows here run on top-k or stage tables of at most ten rows.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.functions import health_band, lag_percent, percent
from eventlens.operators import metrics

# Rows shown, alert and band thresholds.
SHOWN_COUNTRIES, SHOWN_PRODUCTS = 6, 8
LAG_FULL, LAG_RED_PCT, LAG_YELLOW_PCT = 10_000, 70, 30
SHARD_RED, SHARD_YELLOW = 5_000, 1_000
TOTAL_LAG_ALERT = 50_000


def funnel_conversion(stages: DataFrame) -> DataFrame:
    """Conversion from the previous stage and share of the largest stage, in percent."""
    in_order = W.orderBy("stage_no")
    previous = F.lag("event_count").over(in_order)
    divisor = F.when(previous > 0, previous).otherwise(1)
    largest = F.greatest(F.max("event_count").over(W.partitionBy()), F.lit(1))
    count = F.col("event_count").cast("double")
    return stages.select(
        "stage_no", "stage", "event_count",
        F.when(F.col("stage_no") > 1, F.round(count / divisor * 100, 1)).alias("step_pct"),
        (count / largest * 100).alias("pct_of_max"),
    )


def geo_share(df: DataFrame, k: int = metrics.TOP_COUNTRIES, shown: int = SHOWN_COUNTRIES) -> DataFrame:
    """Share of the top-k total of the leading countries."""
    top = metrics.geo_distribution(df, k)
    total = F.sum("event_count").over(W.partitionBy())
    return (
        top.withColumn("share_pct", percent(F.col("event_count"), total))
        .orderBy(F.desc("event_count"), F.asc("first_seen"), F.asc("country"))
        .limit(shown)
        .select("country", "event_count", "share_pct")
    )


def device_share(df: DataFrame) -> DataFrame:
    """Share of each device among all events with a device."""
    counts = metrics.device_distribution(df)
    total = counts.agg(F.sum("event_count")).scalar()
    return counts.select(
        "device", "event_count", percent(F.col("event_count"), total).alias("share_pct")
    )


def product_relative(df: DataFrame, shown: int = SHOWN_PRODUCTS) -> DataFrame:
    """Leading products relative to the first one, in percent."""
    leader = F.max("event_count").over(W.partitionBy())
    return metrics.top_products(df, shown).select(
        "product_name", "event_count",
        (F.col("event_count").cast("double") / leader * 100).alias("pct_of_leader"),
    )


def refund_rate(df: DataFrame) -> DataFrame:
    """Refunds per order in percent."""
    return metrics.kpi_totals(df).select(
        "refunds", "total_orders",
        percent(F.col("refunds"), F.col("total_orders")).alias("refund_rate_pct"),
    )


def broker_totals(stats: DataFrame, alert_above: int = TOTAL_LAG_ALERT) -> DataFrame:
    """Totals over the partition statistics, with the lag alert; backpressure events where the
    statistics count them."""
    def total(col: str) -> Column:
        return F.coalesce(F.sum(col), F.lit(0))

    held = [total(c).alias(c) for c in ("backpressure_events",) if c in stats.columns]
    return stats.agg(
        total("total_produced").alias("total_produced"),
        total("total_consumed").alias("total_consumed"),
        total("lag").alias("queue_lag"),
        (total("lag") > alert_above).alias("lag_alert"),
        *held,
    )


def shard_rollup(stats: DataFrame, shards: int, n_partitions: int, errors: DataFrame | None = None) -> DataFrame:
    """Partition statistics per shard; partition i belongs to shard i % shards.

    ``errors`` (partition_id, errors) counts quarantined rows.
    """
    shards = max(1, min(shards, n_partitions))
    if errors is not None:
        stats = stats.join(errors, "partition_id", "left")
    else:
        stats = stats.withColumn("errors", F.lit(0))
    return stats.groupBy(F.pmod("partition_id", F.lit(shards)).alias("shard_id")).agg(
        F.count("*").alias("partitions"),
        F.sum("total_consumed").alias("processed"),
        F.sum(F.coalesce("errors", F.lit(0))).alias("errors"),
        F.sum("lag").alias("queue_lag"),
    )


def partition_health(stats: DataFrame) -> DataFrame:
    pct = lag_percent(F.col("lag"), LAG_FULL)
    return stats.select(
        "partition_id", "lag", pct.alias("lag_pct"),
        health_band(pct, LAG_RED_PCT, LAG_YELLOW_PCT).alias("band"),
    )


def shard_health(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "shard_id", "queue_lag",
        lag_percent(F.col("queue_lag"), LAG_FULL).alias("lag_pct"),
        health_band(F.col("queue_lag"), SHARD_RED, SHARD_YELLOW).alias("band"),
    )
