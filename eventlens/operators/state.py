"""Metric state as one mergeable table, and the snapshot served from it.

``partials`` holds everything the dashboard metrics need: one row per (kind, key,
bucket) with counts, money and first arrival. It is built in one pass (a row for each
key of an event: one scan, map-side combine, one shuffle) and any two tables merge by adding
up, so batches, restarts and compaction all give what one full pass gives.
``samples`` holds the newest arrivals for the latency ranks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from eventlens.functions import is_present
from eventlens.operators import metrics, timeseries as ts
from eventlens.schema import FUNNEL_STAGES, PURCHASE, SEARCH

# Kinds of state rows: keyed by text, by a moment, or without a key.
TEXT_KINDS = ["event_type", "product", "category", "country", "device", "query", "user"]
TIME_KINDS = ["second", "minute"]
TOTAL, DUPLICATES = "total", "duplicates"

PARTIAL_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("bucket", T.TimestampType()),
    T.StructField("events", T.LongType()),
    T.StructField("orders", T.LongType()),
    T.StructField("refunds", T.LongType()),
    T.StructField("revenue", T.DecimalType(38, 6)),
    T.StructField("refunded", T.DecimalType(38, 6)),
    T.StructField("first_seen", T.TimestampType()),
])


@dataclass(frozen=True)
class MetricState:
    partials: DataFrame
    samples: DataFrame


def build_state(accepted: DataFrame, time_col: str = "ingest_ts") -> MetricState:
    """State of a set of accepted deliveries."""
    return MetricState(_partials(accepted, time_col), ts.newest_latencies(accepted))


def empty_state(spark: SparkSession) -> MetricState:
    """State before the first event: every metric reads as 0 or as an empty list."""
    return MetricState(
        spark.createDataFrame([], PARTIAL_SCHEMA),
        spark.createDataFrame([], "ingest_ts timestamp, event_id string, latency_ms double"),
    )


def with_duplicates(state: MetricState, duplicates: DataFrame) -> MetricState:
    """Add the count of rejected deliveries, a one-row frame with ``duplicates_rejected``."""
    return MetricState(state.partials.unionByName(_duplicate_row(duplicates)), state.samples)


def event_keys() -> dict[str, Column]:
    """Key of an event in each text kind; null where the event does not count."""
    sold = F.col("event_type") == PURCHASE
    return {
        "event_type": F.col("event_type"),
        "product": F.when(sold & is_present("product_name"), F.col("product_name")),
        "category": F.when(sold & is_present("category"), F.col("category")),
        "country": F.col("country"),
        "device": F.col("device"),
        "query": F.when(F.col("event_type") == SEARCH, F.col("query")),
        "user": F.when(is_present("user_id"), F.col("user_id").cast("string")),
    }


def _partials(df: DataFrame, time_col: str) -> DataFrame:
    keys = event_keys() | {
        unit: F.unix_micros(F.date_trunc(unit, time_col)).cast("string") for unit in TIME_KINDS} | {TOTAL: F.lit("")}
    # Worked out here once a row, since the rows below are one for each key of an event. An event
    # without a key of some kind has no row there; the grand total has one for every event.
    keyed = df.select(
        *[value.alias(kind) for kind, value in keys.items()],
        F.col(time_col).alias("seen_at"), metrics.is_purchase().alias("sold"), metrics.is_refund().alias("returned"),
        metrics.amount_of(metrics.is_purchase()).alias("paid"), metrics.amount_of(metrics.is_refund()).alias("paid_back"),
    )
    grouped = (
        keyed.unpivot(["seen_at", "sold", "returned", "paid", "paid_back"], list(keys), "kind", "key")
        .where(F.col("key").isNotNull()).groupBy("kind", "key").agg(
            F.count("*").alias("events"),
            F.count_if("sold").alias("orders"),
            F.count_if("returned").alias("refunds"),
            metrics.sum_of("paid").alias("revenue"),
            metrics.sum_of("paid_back").alias("refunded"),
            F.min("seen_at").alias("first_seen"),
        ))
    bucket = F.timestamp_micros(F.when(F.col("kind").isin(TIME_KINDS), F.col("key")).cast("long"))
    text = F.when(F.col("kind").isin(TEXT_KINDS), F.col("key"))
    return _conform(grouped.select("kind", text.alias("key"), bucket.alias("bucket"), *_MEASURES))


_MEASURES = ["events", "orders", "refunds", "revenue", "refunded", "first_seen"]


def _conform(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PARTIAL_SCHEMA])


def _duplicate_row(duplicates: DataFrame) -> DataFrame:
    zero = F.lit(0)
    return _conform(duplicates.select(
        F.lit(DUPLICATES).alias("kind"), F.lit(None).alias("key"), F.lit(None).alias("bucket"),
        F.col("duplicates_rejected").alias("events"), zero.alias("orders"), zero.alias("refunds"),
        zero.alias("revenue"), zero.alias("refunded"), F.lit(None).alias("first_seen"),
    ))


def merge_partials(*parts: DataFrame) -> DataFrame:
    """Add up partial tables; the order and the way they were cut do not matter."""
    stacked = reduce(DataFrame.unionByName, parts)
    return _conform(
        stacked.groupBy("kind", "key", "bucket").agg(
            *[F.sum(c).alias(c) for c in _MEASURES[:-1]], F.min("first_seen").alias("first_seen"),
        )
    )


def merge_samples(*parts: DataFrame) -> DataFrame:
    keep = ts.LATENCY_SAMPLES + ts.LATENCY_REFRESH - 1
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.orderBy(F.desc("ingest_ts"), F.desc("event_id")).limit(keep)


def merge_states(*states: MetricState) -> MetricState:
    return MetricState(
        merge_partials(*[s.partials for s in states]), merge_samples(*[s.samples for s in states])
    )


# --- metrics read from state -------------------------------------------------

def of_kind(partials: DataFrame, kind: str) -> DataFrame:
    return partials.where(F.col("kind") == kind)


def kpis(partials: DataFrame) -> DataFrame:
    """One row of totals, also for empty state."""
    def total(col: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == TOTAL, F.col(col))), F.lit(0))

    sums = partials.where(F.col("kind").isin(TOTAL, DUPLICATES, "user")).agg(
        total("events").alias("total_events"), total("orders").alias("total_orders"),
        total("refunds").alias("refunds"), total("revenue").alias("revenue"),
        total("refunded").alias("refunded"),
        F.count_if(F.col("kind") == "user").alias("active_users"),
        F.coalesce(F.sum(F.when(F.col("kind") == DUPLICATES, F.col("events"))), F.lit(0))
        .alias("duplicates_rejected"),
    )
    return sums.select(
        metrics.money("revenue").alias("total_revenue"), "total_orders", "total_events",
        metrics.ratio_or_zero(metrics.money("revenue"), F.col("total_orders")).alias("avg_order_value"),
        "active_users", "refunds", metrics.money("refunded").alias("refund_amount"),
        "duplicates_rejected",
    )


def key_table(partials: DataFrame, kind: str) -> DataFrame:
    return of_kind(partials, kind).select("key", F.col("events").alias("event_count"), "first_seen")


def second_table(partials: DataFrame) -> DataFrame:
    return of_kind(partials, "second").select(
        F.col("bucket").alias("second"), F.col("events").alias("event_count")
    )


def minute_table(partials: DataFrame) -> DataFrame:
    return of_kind(partials, "minute").select(
        F.col("bucket").alias("minute"), metrics.money("revenue").alias("revenue"), "orders"
    )


def latency(state: MetricState) -> DataFrame:
    total = of_kind(state.partials, TOTAL).agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n"))
    return ts.latency_from_samples(state.samples, total)


SNAPSHOT_COLUMNS = ["metric", "rank", "key", "value"]


# Lists of the snapshot: state kind, length. One of the newest buckets is still open.
_LEADERS = {
    "product": ("top_products", metrics.TOP_PRODUCTS), "category": ("top_categories", metrics.TOP_CATEGORIES),
    "country": ("geo_distribution", metrics.TOP_COUNTRIES), "query": ("search_terms", metrics.TOP_TERMS),
}
_BUCKETS = {"second": ts.RECENT_SECONDS + 1, "minute": ts.RECENT_MINUTES + 1}
_LONGEST = max(*_BUCKETS.values(), *[k for _, k in _LEADERS.values()])


def snapshot(state: MetricState) -> DataFrame:
    """All 22 served metrics as rows (metric, rank, key, value).

    Reads ``partials`` several times: pass a written state. ``rank`` orders lists and
    is null for scalars and maps; the key of a bucket is its epoch second.
    """
    p = state.partials
    device = key_table(p, "device").select(
        F.lit("device_distribution").alias("metric"), F.lit(None).cast("int").alias("rank"),
        "key", F.col("event_count").cast("double").alias("value"),
    )
    rows = [
        _scalars(kpis(p)), _scalars(ts.current_rate(second_table(p))), _scalars(latency(state)),
        _lists(p), device, _stages(p),
    ]
    return reduce(DataFrame.unionByName, rows)


def _scalars(one_row: DataFrame) -> DataFrame:
    names = one_row.columns
    return (
        one_row.select(*[F.col(c).cast("double").alias(c) for c in names])
        .unpivot([], names, "metric", "value")
        .select("metric", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("key"), "value")
    )


def _lists(partials: DataFrame) -> DataFrame:
    """The four leader lists and the three recent series from one ranking per kind.

    Leaders go by count, buckets by time. The rank filter makes Spark keep at most
    the longest list per kind and task before the shuffle.
    """
    order = [F.desc("bucket"), F.desc("events"), F.asc("first_seen"), F.asc("key")]
    ranked = (
        partials.where(F.col("kind").isin(*_LEADERS, *_BUCKETS))
        .withColumn("place", F.row_number().over(W.partitionBy("kind").orderBy(*order)))
        .where(F.col("place") <= _LONGEST)
    )
    length = F.lit(0)
    for kind, n in {**{k: n for k, (_, n) in _LEADERS.items()}, **_BUCKETS}.items():
        length = F.when(F.col("kind") == kind, n).otherwise(length)
    # Series drop the open bucket (place 1) and run from old to new.
    shown = F.least(F.max("place").over(W.partitionBy("kind")), length)
    ranked = ranked.withColumn("shown", shown).where(
        (F.col("place") <= length) & (F.col("bucket").isNull() | (F.col("place") > 1))
    )

    def entry(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))

    entries = F.when(F.col("kind") == "second", F.array(entry("events_per_second", F.col("events"))))
    entries = entries.when(F.col("kind") == "minute", F.array(
        entry("revenue_per_minute", metrics.money("revenue")), entry("orders_per_minute", F.col("orders"))))
    for kind, (metric, _) in _LEADERS.items():
        entries = entries.when(F.col("kind") == kind, F.array(entry(metric, F.col("events"))))
    return ranked.select("*", F.explode(entries).alias("entry")).select(
        "entry.metric",
        F.when(F.col("bucket").isNull(), F.col("place")).otherwise(F.col("shown") - F.col("place") + 1).alias("rank"),
        F.coalesce("key", F.unix_seconds("bucket").cast("string")).alias("key"),
        "entry.value",
    )


def _stages(partials: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(s) for s in FUNNEL_STAGES])
    stages = partials.sparkSession.range(1).select(F.posexplode(names).alias("place", "stage"))
    counts = key_table(partials, "event_type")
    return stages.join(counts, F.col("stage") == F.col("key"), "left").select(
        F.lit("funnel").alias("metric"), (F.col("place") + 1).alias("rank"), F.col("stage").alias("key"),
        F.coalesce("event_count", F.lit(0)).cast("double").alias("value"),
    )


def snapshot_wide(state: MetricState) -> DataFrame:
    """The snapshot as one row: scalars as columns, lists as arrays of (key, value)."""
    tall = snapshot(state)
    scalars = ["total_revenue", "total_orders", "total_events", "avg_order_value", "active_users", "refunds",
               "refund_amount", "current_eps", "avg_eps_5s", "p50_latency_ms", "p99_latency_ms",
               "avg_latency_ms", "duplicates_rejected"]
    lists = ["revenue_per_minute", "orders_per_minute", "events_per_second", "top_products", "top_categories",
             "funnel", "geo_distribution", "device_distribution", "search_terms"]

    def entries(metric: str) -> Column:
        items = F.collect_list(F.when(F.col("metric") == metric, F.struct("rank", "key", "value")))
        return F.transform(F.array_sort(items), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))

    return tall.agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in scalars],
        *[entries(m).alias(m) for m in lists],
    )
