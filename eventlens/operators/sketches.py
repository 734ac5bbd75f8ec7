"""Metric state whose size does not grow with the number of keys: distinct users and frequent keys.

``user_sketches`` keeps one HyperLogLog sketch a bucket: minutes while they are young, days
afterwards. Any union of buckets is a distinct count of their users, within a stated error; how
the rows were cut into states can move an estimate inside that error.

``frequent_keys`` keeps at most ``capacity`` keys a kind. What does not fit is not forgotten but
bounded: the count of the first key that falls out is taken off all of them and added to the
kind's ``slack``. A key that is kept occurred from ``low`` to ``low + slack`` times, any other key
at most ``slack`` times, and slack is at most rows / (capacity + 1), however the rows were cut
into states and in whatever order these were merged. `proven_top_k` counts the kept
keys exactly and says of each place whether a key that is not kept could hold it.

Null users and null keys do not count. A state of no rows is an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.functions import is_present

LOG_SIZE = 12  # sketches have 2^12 registers of one byte
ERROR_SIGMAS = 3
YOUNG_DAYS = 2  # minutes of the newest days; older ones are rolled up
# Spark keeps this many rows of a kind and task before the shuffle as long as they are below 1,000.
CAPACITY = 512

USERS_SCHEMA = "unit string, bucket timestamp, events long, users binary"
KEYS_SCHEMA = "kind string, key string, low long, slack long"


# --- distinct users ----------------------------------------------------------------

def relative_error(log_size: int = LOG_SIZE) -> float:
    """The standard error of an estimate from merged sketches, as a share of the true number."""
    return 1.04 / 2 ** (log_size / 2)


def user_sketches(df: DataFrame, time_col: str = "ingest_ts", log_size: int = LOG_SIZE) -> DataFrame:
    """(unit, bucket, events, users): one row for each minute with a user."""
    present = df.where(is_present("user_id")).select(
        F.date_trunc("minute", time_col).alias("bucket"), F.col("user_id").cast("string").alias("user"))
    return present.groupBy("bucket").agg(
        F.count("*").alias("events"), F.hll_sketch_agg("user", log_size).alias("users")).select(
        F.lit("minute").alias("unit"), "bucket", "events", "users")


def merge_users(*states: DataFrame, young_days: int = YOUNG_DAYS) -> DataFrame:
    """The union of the states, with minutes older than the newest ``young_days`` days as days."""
    stacked = reduce(DataFrame.unionByName, states)
    newest = stacked.agg(F.max("bucket"))
    old = F.datediff(newest.scalar(), "bucket") >= young_days
    return (
        stacked.withColumns({
            "unit": F.when(old, "day").otherwise(F.col("unit")),
            "bucket": F.when(old, F.date_trunc("day", "bucket")).otherwise(F.col("bucket"))})
        .groupBy("unit", "bucket").agg(F.sum("events").alias("events"), F.hll_union_agg("users").alias("users"))
    )


def users_between(state: DataFrame, start: str, end: str) -> DataFrame:
    """One row (events, estimate, low, high) of the buckets from ``start`` to before ``end``; days
    that were rolled up count as a whole where they begin."""
    inside = state.where((F.col("bucket") >= F.lit(start).cast("timestamp")) & (F.col("bucket") < F.lit(end).cast("timestamp")))
    return inside.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("events"), F.hll_union_agg("users").alias("_u")).select(
        "events", *_estimate(F.coalesce(F.hll_sketch_estimate("_u"), F.lit(0))))


def users_of_last_days(state: DataFrame, days: int = 7) -> DataFrame:
    """(day, events, estimate, low, high): the users of each day and the ``days - 1`` before it, for
    each day that has a user. A day's sketches are united first, so a window unites days only."""
    daily = state.groupBy(F.to_date("bucket").alias("day")).agg(
        F.sum("events").alias("events"), F.hll_union_agg("users").alias("users"))
    seen = daily.select(F.col("day").alias("_day"))
    return _windows(daily, days).groupBy("day").agg(
        F.sum("events").alias("events"), F.hll_union_agg("users").alias("users")).join(
        seen, F.col("day") == F.col("_day"), "left_semi").select(
        "day", "events", *_estimate(F.hll_sketch_estimate("users")))


def exact_users_of_last_days(df: DataFrame, days: int = 7, time_col: str = "ingest_ts") -> DataFrame:
    """(day, users): what `users_of_last_days` estimates, counted."""
    daily = df.where(is_present("user_id")).select(F.to_date(time_col).alias("day"), "user_id").distinct()
    seen = daily.select(F.col("day").alias("_day")).distinct()
    return _windows(daily, days).distinct().groupBy("day").agg(F.count("*").alias("users")).join(
        seen, F.col("day") == F.col("_day"), "left_semi")


def _windows(daily: DataFrame, days: int) -> DataFrame:
    """Each row once for every day whose window it is in."""
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    return daily.withColumn("_ahead", ahead).withColumn("day", F.date_add("day", F.col("_ahead"))).drop("_ahead")


def _estimate(estimate: Column) -> list[Column]:
    """The estimate and the bounds of `ERROR_SIGMAS` standard errors."""
    off = ERROR_SIGMAS * relative_error()
    return [estimate.cast("long").alias("estimate"), F.floor(estimate / (1 + off)).cast("long").alias("low"),
            F.ceil(estimate / (1 - off)).cast("long").alias("high")]


# --- frequent keys -------------------------------------------------------------------

Keys = dict[str, str | Column]  # column or expression of each kind


def _entries(df: DataFrame, keys: Keys, *also: Column) -> DataFrame:
    """(kind, key) of each row for each kind in which it counts, and ``also``."""
    pairs = F.array(*[
        F.struct(F.lit(kind).alias("kind"), (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"))
        for kind, key in keys.items()])
    return df.select(F.inline(pairs), *also).where("key is not null")


def frequent_keys(df: DataFrame, keys: Keys, capacity: int = CAPACITY) -> DataFrame:
    """(kind, key, low, slack) of the rows; the row of a kind without key has its number of rows and
    its slack."""
    counts = _entries(df, keys).groupingSets([["kind", "key"], ["kind"]], "kind", "key").agg(F.count("*").alias("low"))
    return _kept(counts.withColumn("slack", F.lit(0).cast("long")), capacity)


def merge_keys(*states: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The state of all rows of the states."""
    summed = reduce(DataFrame.unionByName, states).groupBy("kind", "key").agg(
        F.sum("low").alias("low"), F.sum("slack").alias("slack"))
    return _kept(summed, capacity)


def _kept(counts: DataFrame, capacity: int) -> DataFrame:
    """The ``capacity`` most frequent keys of each kind, less the count of the next one."""
    order = W.partitionBy("kind").orderBy(F.col("key").isNotNull(), F.desc("low"), F.asc("key"))
    # the kind's own row comes first, the key that falls out last
    few = counts.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= capacity + 2)
    off = F.max(F.when(F.col("_place") == capacity + 2, F.col("low"))).over(W.partitionBy("kind"))
    few = few.withColumn("_off", F.coalesce(off, F.lit(0)))
    whole = F.col("key").isNull()
    return few.where(whole | (F.col("low") > F.col("_off"))).select(
        "kind", "key", F.when(whole, F.col("low")).otherwise(F.col("low") - F.col("_off")).alias("low"),
        F.when(whole, F.col("slack") + F.col("_off")).otherwise(F.lit(0)).cast("long").alias("slack"))


def bounds(state: DataFrame) -> DataFrame:
    """(kind, key, low, high, rows): between what counts each kept key lies, and the kind's rows."""
    kinds = state.where("key is null").select("kind", F.col("low").alias("rows"), F.col("slack").alias("_slack"))
    return state.where("key is not null").join(F.broadcast(kinds), "kind").select(
        "kind", "key", "low", (F.col("low") + F.col("_slack")).alias("high"), "rows")


def proven_top_k(
    df: DataFrame, keys: Keys, state: DataFrame, k: dict[str, int], time_col: str = "ingest_ts",
) -> DataFrame:
    """(kind, place, key, event_count, first_seen, proven) of the k best kept keys of each kind.

    ``state`` is of the rows of ``df``, which are read a second time: only rows of kept keys are
    counted, and these are at most kinds x capacity, so they are broadcast. Equal counts
    rank by first arrival, then by key. A place is proven if its count is above all that a key
    outside the state can have; then it is the exact one.
    """
    kept = state.where("key is not null").select("kind", "key")
    counted = _entries(df, keys, F.col(time_col).alias("seen_at")).join(F.broadcast(kept), ["kind", "key"]).groupBy(
        "kind", "key").agg(F.count("*").alias("event_count"), F.min("seen_at").alias("first_seen"))
    order = W.partitionBy("kind").orderBy(F.desc("event_count"), F.asc("first_seen"), F.asc("key"))
    wanted = F.lit(0)
    for kind, n in k.items():
        wanted = F.when(F.col("kind") == kind, n).otherwise(wanted)
    best = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= wanted)
    slack = state.where("key is null").select("kind", F.col("slack").alias("_slack"))
    return best.join(F.broadcast(slack), "kind").select(
        "kind", "place", "key", "event_count", "first_seen",
        ((F.col("_slack") == 0) | (F.col("event_count") > F.col("_slack"))).alias("proven"))
