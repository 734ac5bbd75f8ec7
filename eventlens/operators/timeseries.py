"""Bucketed series, rolling rates and latency ranks.

The bucket time is a parameter: ``ingest_ts`` counts events when they were
processed, ``ts`` when they happened.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from eventlens.functions import latency_ms
from eventlens.operators.metrics import is_purchase, money, total_of
from eventlens.operators.numbering import dense_number

# Ring lengths and refresh step of the served series.
RECENT_MINUTES, RECENT_SECONDS, RETAINED_BUCKETS = 20, 30, 60
RATE_BUCKETS = 5
LATENCY_SAMPLES, LATENCY_REFRESH = 500, 250
# Buckets per task of the full rolling series.
ROLLING_BLOCK = 100_000


def per_minute(df: DataFrame, time_col: str = "ingest_ts") -> DataFrame:
    """Revenue and orders of every minute that has any event (no order: 0)."""
    return df.groupBy(F.date_trunc("minute", time_col).alias("minute")).agg(
        money(total_of(is_purchase())).alias("revenue"),
        F.count_if(is_purchase()).alias("orders"),
    )


def revenue_per_minute(df: DataFrame, time_col: str = "ingest_ts") -> DataFrame:
    return per_minute(df, time_col).select("minute", "revenue")


def orders_per_minute(df: DataFrame, time_col: str = "ingest_ts") -> DataFrame:
    return per_minute(df, time_col).select("minute", "orders")


def events_per_second(df: DataFrame, time_col: str = "ingest_ts") -> DataFrame:
    return df.groupBy(F.date_trunc("second", time_col).alias("second")).agg(
        F.count("*").alias("event_count")
    )


def recent_closed(buckets: DataFrame, bucket_col: str, n: int = RETAINED_BUCKETS) -> DataFrame:
    """The newest n buckets without the one still open, as a top-k."""
    return buckets.orderBy(F.desc(bucket_col)).offset(1).limit(n)


def current_rate(seconds: DataFrame, n: int = RATE_BUCKETS) -> DataFrame:
    """Count of the open second, and the mean over it and the closed ones before it."""
    newest = seconds.orderBy(F.desc("second")).limit(n)
    return newest.agg(
        F.coalesce(F.max_by("event_count", "second"), F.lit(0)).alias("current_eps"),
        F.coalesce(F.round(F.avg("event_count"), 2), F.lit(0.0)).alias("avg_eps_5s"),
    )


def rolling_rate(seconds: DataFrame, n: int = RATE_BUCKETS, block: int = ROLLING_BLOCK) -> DataFrame:
    """Rolling mean of the last n non-empty seconds, for every second.

    Buckets are numbered densely, cut into blocks of equal size, and the last n-1
    buckets of a block are repeated at the head of the next one, so each block is
    a bounded window partition of its own.
    """
    numbered = dense_number(seconds, ["second"], name="_rank").withColumn(
        "_block", F.expr(f"_rank div {block}")
    )
    tail = F.col("_rank") % block >= block - (n - 1)
    placed = numbered.withColumn("_copy", F.explode(
        F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )).withColumn("_block", F.col("_block") + F.col("_copy"))
    recent = W.partitionBy("_block").orderBy("_rank").rowsBetween(-(n - 1), 0)
    return (
        placed.withColumn("avg_eps_5s", F.round(F.avg("event_count").over(recent), 2))
        .where("_copy = 0")
        .select("second", "event_count", "avg_eps_5s")
    )


def newest_latencies(df: DataFrame, keep: int = LATENCY_SAMPLES + LATENCY_REFRESH - 1) -> DataFrame:
    """Latency of the newest arrivals: enough rows for any refresh position."""
    return (
        df.select("ingest_ts", "event_id", latency_ms().alias("latency_ms"))
        .orderBy(F.desc("ingest_ts"), F.desc("event_id"))
        .limit(keep)
    )


def latency_from_samples(samples: DataFrame, total: DataFrame) -> DataFrame:
    """p50, p99 and mean of the last 500 arrivals as of the last refresh.

    ``total`` has one row with ``n``, the number of arrivals. Figures move every
    250 arrivals: the n % 250 newest samples are not in yet; before 250 all are 0.
    The array below holds at most 749 samples.
    """
    ordered = F.reverse(F.array_sort(F.collect_list(F.struct("ingest_ts", "event_id", "latency_ms"))))
    skipped = (F.col("n") % LATENCY_REFRESH).cast("int")
    window = F.transform(F.slice("newest", skipped + 1, F.lit(LATENCY_SAMPLES)), lambda s: s["latency_ms"])
    m = F.size("xs")
    ready = (F.col("n") >= LATENCY_REFRESH) & (m > 0)

    def rank(share: float):
        place = F.least(F.floor(m * F.lit(share)), m - 1).cast("int") + 1
        return F.round(F.try_element_at("xs", place), 2)

    mean = F.aggregate("xs", F.lit(0.0), lambda a, x: a + x) / m
    return (
        samples.agg(ordered.alias("newest")).withColumn("n", total.select("n").scalar())
        .select("n", F.array_sort(window).alias("xs"))
        .select(
            F.when(ready, rank(0.50)).otherwise(0.0).alias("p50_latency_ms"),
            F.when(ready, rank(0.99)).otherwise(0.0).alias("p99_latency_ms"),
            F.when(ready, F.round(mean, 2)).otherwise(0.0).alias("avg_latency_ms"),
        )
    )


def latency_percentiles(df: DataFrame) -> DataFrame:
    return latency_from_samples(newest_latencies(df), df.agg(F.count("*").alias("n")))
