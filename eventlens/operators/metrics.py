"""Dashboard metrics over accepted deliveries, one aggregate each.

Every aggregate buffer is a fixed-width number, date or flag, so Spark combines
on the map side with hash aggregation and a hot key costs one row per task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from eventlens.functions import is_present
from eventlens.schema import FUNNEL_STAGES, PURCHASE, REFUND, SEARCH

# Served list lengths.
TOP_PRODUCTS, TOP_CATEGORIES, TOP_COUNTRIES, TOP_TERMS = 10, 8, 10, 8


def is_purchase() -> Column:
    return F.col("event_type") == PURCHASE


def is_refund() -> Column:
    return F.col("event_type") == REFUND


AMOUNT, TOTAL_AMOUNT = "decimal(28,6)", "decimal(38,6)"


def exact_amount() -> Column:
    """``amount`` to six decimals; null if it is missing, NaN, infinite or too large."""
    return F.col("amount").try_cast(AMOUNT)


def amount_of(condition: Column) -> Column:
    """``amount`` of matching rows, as `exact_amount`; null for others."""
    return F.when(condition, exact_amount())


def total_of(condition: Column) -> Column:
    """Exact sum of ``amount`` over matching rows; what is no amount counts as 0."""
    return F.coalesce(F.sum(amount_of(condition)), F.lit(0).cast(TOTAL_AMOUNT))


def sum_of(amounts: str) -> Column:
    """Sum of a column of exact amounts, 0 where there are none. The filter keeps Spark from taking
    the wide decimal out of the buffer and back for each row without an amount.

    A decimal sum does not depend on the order of the rows and is rounded only when
    it is read (`money`).
    """
    return F.coalesce(F.expr(f"sum({amounts}) FILTER (WHERE {amounts} IS NOT NULL)"), F.lit(0).cast(TOTAL_AMOUNT))


def money(total: str | Column) -> Column:
    """A total in units with two decimals."""
    return F.round(F.col(total) if isinstance(total, str) else total, 2).cast("double")


def rejected_amounts(df: DataFrame) -> DataFrame:
    """How many rows carry an amount that no total can take: NaN, infinite or too large."""
    return df.agg(F.count_if(F.col("amount").isNotNull() & exact_amount().isNull()).alias("rejected_amounts"))


def ratio_or_zero(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.when(whole > 0, F.round(part.cast("double") / whole, digits)).otherwise(F.lit(0.0))


def kpi_totals(df: DataFrame) -> DataFrame:
    """Events, revenue, orders, refunds and average order value, in one pass."""
    totals = df.agg(
        F.count("*").alias("total_events"),
        total_of(is_purchase()).alias("revenue"),
        F.count_if(is_purchase()).alias("total_orders"),
        F.count_if(is_refund()).alias("refunds"),
        total_of(is_refund()).alias("refunded"),
    )
    return totals.select(
        "total_events",
        money("revenue").alias("total_revenue"),
        "total_orders",
        ratio_or_zero(money("revenue"), F.col("total_orders")).alias("avg_order_value"),
        "refunds",
        money("refunded").alias("refund_amount"),
    )


def active_users(df: DataFrame) -> DataFrame:
    """Exact number of distinct users; blank ids do not count."""
    return df.where(is_present("user_id")).agg(F.count_distinct("user_id").alias("active_users"))


def active_users_approx(df: DataFrame, rsd: float = 0.01) -> DataFrame:
    """Sketch-based estimate: one fixed-size state per task instead of the user set."""
    return df.where(is_present("user_id")).agg(
        F.approx_count_distinct("user_id", rsd).alias("active_users_approx")
    )


def funnel(df: DataFrame, stages: list[str] = FUNNEL_STAGES) -> DataFrame:
    """Event count of each stage in order; stages without events count 0."""
    names = F.array(*[F.lit(s) for s in stages])
    dimension = df.sparkSession.range(1).select(F.posexplode(names).alias("stage_no", "stage"))
    counts = df.where(F.col("event_type").isin(stages)).groupBy("event_type").agg(
        F.count("*").alias("n")
    )
    return (
        dimension.join(counts, F.col("stage") == F.col("event_type"), "left")
        .select((F.col("stage_no") + 1).alias("stage_no"), "stage",
                F.coalesce("n", F.lit(0)).alias("event_count"))
    )


def key_counts(df: DataFrame, key: str, time_col: str = "ingest_ts") -> DataFrame:
    """Count and first arrival of each non-null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("event_count"), F.min(time_col).alias("first_seen")
    )


def top_k(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys; ties go to the key seen first, then to the smaller key."""
    return (
        counts.orderBy(F.desc("event_count"), F.asc("first_seen"), F.asc(key))
        .limit(k)
        .select(key, "event_count", "first_seen")
    )


def top_products(df: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    sold = df.where(is_purchase() & is_present("product_name"))
    return top_k(key_counts(sold, "product_name"), "product_name", k)


def top_categories(df: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    sold = df.where(is_purchase() & is_present("category"))
    return top_k(key_counts(sold, "category"), "category", k)


def geo_distribution(df: DataFrame, k: int = TOP_COUNTRIES) -> DataFrame:
    return top_k(key_counts(df, "country"), "country", k)


def device_distribution(df: DataFrame) -> DataFrame:
    return key_counts(df, "device").select("device", "event_count")


def top_search_terms(df: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    return top_k(key_counts(df.where(F.col("event_type") == SEARCH), "query"), "query", k)
