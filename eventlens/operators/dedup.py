"""Removal of repeated deliveries by event id.

``first_delivery`` keeps the earliest row of each id, for good. ``dedup_window``
is the exact rolling rule: a delivery is rejected iff the last *accepted* one of
the same id is less than the window old; a rejected delivery does not renew it.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.session import broadcast_if_small, materialize

WINDOW_SECONDS = 30
# Ids with at most this many deliveries are folded as one array; busier ids are
# resolved by joins, so no array grows beyond this.
FOLD_LIMIT = 1_000
# Ids with more deliveries than this never go through a shuffled join: there are
# at most rows/BUSY_ROWS of them, so they are split off and joined by broadcast.
BUSY_ROWS = 5_000_000
# Group widths for the next-arrival search, in microseconds: 0.1 s, then 1000 s,
# then the whole time line. Distinct microseconds bound the first group, 10,000
# group minima the second, one row per 1000 s the third.
SEARCH_WIDTHS = (100_000, 1_000_000_000, None)


def _first_by(df: DataFrame, keys: list, order: list) -> DataFrame:
    """First row per key. The filter on row_number lets Spark drop all but one row
    per key and task before the shuffle, so a hot key costs one row per task."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def first_delivery(
    df: DataFrame, id_col: str = "event_id", time_col: str = "ingest_ts", tie_cols: list[str] = ("copy",),
) -> DataFrame:
    """Earliest delivery of each id (a dedup window without end).

    One lazy plan that shuffles the rows by id. For wide rows with few repeats
    ``dedup_window(window_seconds=None)`` gives the same rows in two passes that leave
    the payload where it is.
    """
    return _first_by(df, [id_col], [time_col, *[c for c in tie_cols if c in df.columns]])


def dedup_window(
    df: DataFrame,
    id_col: str = "event_id",
    time_col: str = "ingest_ts",
    window_seconds: float | None = WINDOW_SECONDS,
    tie_cols: list[str] = ("copy",),
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """Deliveries accepted under the rolling window (None: no end), all columns kept.

    Only ids delivered more than once can be rejected. They are found from the id
    and time columns alone (one narrow, map-side combined shuffle); every other
    row passes through a join against that set without its payload being
    shuffled, as long as the set is small enough to broadcast.
    """
    width = None if window_seconds is None else int(window_seconds * 1_000_000)
    timed = df.withColumn("_us", F.unix_micros(time_col))
    contested = materialize(
        timed.groupBy(F.col(id_col).alias("_cid"))
        .agg(F.count("*").alias("_n"), F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
        .where("_n > 1"),
        "contested",
    )
    long = F.lit(False) if width is None else F.col("_hi") - F.col("_lo") >= width
    sizes = contested.agg(
        F.count("*").alias("ids"),
        F.count_if(long & (F.col("_n") <= fold_limit)).alias("light"),
        F.count_if(long & (F.col("_n") > fold_limit)).alias("heavy"),
        F.count_if(F.col("_n") > BUSY_ROWS).alias("busy"),
    ).first()
    if not sizes.ids:
        return df
    ids = contested.select("_cid")
    busy = (contested.where(F.col("_n") > BUSY_ROWS).select("_cid"), sizes.busy)
    passed = join_ids(timed, id_col, ids, sizes.ids, "left_anti", busy)
    repeated = materialize(join_ids(timed, id_col, ids, sizes.ids, "left_semi", busy), "repeated")
    arrivals = repeated.select(F.col(id_col).alias("_id"), "_us")

    # Within one window span only the first delivery of an id can be accepted.
    accepted = contested.where(~long).select("_cid", F.col("_lo").alias("_t"))
    if sizes.light:
        light = contested.where(long & (F.col("_n") <= fold_limit)).select("_cid")
        accepted = accepted.unionByName(_fold(arrivals, light, sizes.light, width))
    if sizes.heavy:
        heavy = contested.where(long & (F.col("_n") > fold_limit)).select("_cid", F.col("_lo").alias("_t"))
        accepted = accepted.unionByName(_chain(arrivals, heavy, sizes.heavy, busy, width))

    ties = [c for c in tie_cols if c in df.columns]
    # Written, like all that decides: which of two equal deliveries stays must not change from
    # one read of the result to the next.
    settled = materialize(_first_by(repeated, [id_col, "_us"], ties or [F.lit(0)]).join(
        accepted, F.col(id_col).eqNullSafe(F.col("_cid")) & (F.col("_us") == F.col("_t")), "left_semi",
    ), "settled")
    return passed.unionByName(settled).drop("_us")


def join_ids(
    rows: DataFrame, id_col: str, ids: DataFrame, n_ids: int, how: str, busy: tuple[DataFrame, int],
) -> DataFrame:
    """Join rows to a written table of ``n_ids`` distinct ids ``_cid`` (anti, semi, inner or left).

    Broadcasts the ids if their count allows. Otherwise the join is shuffled by id,
    except for the ids in ``busy`` (table and count): a shuffle would bring all rows of
    one of those to a single task, so their rows stay where they are and meet a
    broadcast of those few ids.
    """
    def same(left: str) -> Column:
        return F.col(left).eqNullSafe(F.col("_cid"))

    ids, fits = broadcast_if_small(ids, n_ids)
    few, n_busy = busy
    if fits or n_busy == 0:
        return rows.join(ids, same(id_col), how)
    few, _ = broadcast_if_small(few, n_busy)
    hot_ids = ids.join(few.withColumnRenamed("_cid", "_bid"), F.col("_cid").eqNullSafe(F.col("_bid")), "left_semi")
    hot = rows.join(few, same(id_col), "left_semi").join(F.broadcast(hot_ids), same(id_col), how)
    rest = rows.join(few, same(id_col), "left_anti").join(ids, same(id_col), how)
    return hot.unionByName(rest)


def _fold(arrivals: DataFrame, ids: DataFrame, n_ids: int, width: int) -> DataFrame:
    """(_cid, _t): accepted times of ids with few arrivals, one array per id."""
    return (
        join_ids(arrivals, "_id", ids, n_ids, "inner", (ids, 0))
        .groupBy("_cid")
        .agg(F.array_sort(F.collect_list("_us")).alias("_times"))
        .select("_cid", F.explode(_fold_accept(F.col("_times"), width)).alias("_t"))
    )


def _fold_accept(times: Column, width: int) -> Column:
    """Accepted times of one id, from its sorted arrival times."""
    return F.aggregate(
        times,
        F.array().cast("array<bigint>"),
        lambda kept, t: F.when(
            (F.size(kept) == 0) | (t - F.element_at(kept, -1) >= width),
            F.concat(kept, F.array(t)),
        ).otherwise(kept),
    )


def _chain(
    arrivals: DataFrame, heads: DataFrame, n_ids: int, busy: tuple[DataFrame, int], width: int,
) -> DataFrame:
    """(_cid, _t): accepted times of busy ids; ``heads`` holds their first arrivals.

    Follows "first arrival at least ``width`` later" from each head. Jumps are
    doubled every round, so a chain of m accepted deliveries takes about log2(m)
    rounds. All joins are on (id, time), which is unique, so the rows of one busy
    id spread over all tasks.
    """
    arrivals = materialize(
        join_ids(arrivals, "_id", heads.select("_cid"), n_ids, "inner", busy)
        .select("_cid", F.col("_us").alias("_t")).distinct(),
        "arrivals",
    )
    queries = arrivals.select("_cid", (F.col("_t") + width).alias("_q"))
    jumps = materialize(
        next_arrival(arrivals, queries, SEARCH_WIDTHS)
        .where(F.col("_next").isNotNull())
        .select("_cid", (F.col("_q") - width).alias("_t"), "_next"),
        "jumps",
    )
    reached = heads
    while True:
        step = jumps.select(F.col("_cid").alias("_jc"), F.col("_t").alias("_jt"), "_next")
        new = materialize(
            reached.join(step, F.col("_cid").eqNullSafe(F.col("_jc")) & (F.col("_t") == F.col("_jt")))
            .select("_cid", F.col("_next").alias("_t")),
            "reached",
        )
        if new.isEmpty():
            return reached
        reached = materialize(reached.unionByName(new), "reached")
        onward = step.withColumnRenamed("_next", "_next2")
        jumps = materialize(
            jumps.join(onward, F.col("_cid").eqNullSafe(F.col("_jc")) & (F.col("_next") == F.col("_jt")))
            .select("_cid", "_t", F.col("_next2").alias("_next")),
            "jumps",
        )


def next_arrival(arrivals: DataFrame, queries: DataFrame, widths: tuple) -> DataFrame:
    """For each query (_cid, _q) the first arrival _t >= _q of that id, as ``_next``.

    Looks inside the time group of the query first; what is not found there is
    asked once per group among the minima of the later groups, one level up.
    """
    width, *wider = widths
    group = F.expr(f"(_at - pmod(_at, {width})) div {width}") if width else F.lit(0).cast("long")
    merged = (
        arrivals.select("_cid", F.col("_t").alias("_at"), F.lit(1).alias("_kind"), F.col("_t").alias("_hit"))
        .unionByName(
            queries.select("_cid", F.col("_q").alias("_at"), F.lit(0).alias("_kind"),
                           F.lit(None).cast("long").alias("_hit"))
        )
        .withColumn("_group", group)
    )
    # Walking backwards in time, the last arrival seen is the next one; on equal
    # times the arrival (kind 1) comes first, so a query finds itself.
    backwards = (
        W.partitionBy("_cid", "_group").orderBy(F.desc("_at"), F.desc("_kind"))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    asked = (
        merged.withColumn("_next", F.last("_hit", ignorenulls=True).over(backwards))
        .where("_kind = 0")
        .select("_cid", F.col("_at").alias("_q"), "_group", "_next")
    )
    if not wider:
        return asked.select("_cid", "_q", "_next")
    minima = (
        arrivals.withColumn("_at", F.col("_t")).withColumn("_group", group)
        .groupBy("_cid", "_group").agg(F.min("_t").alias("_t")).select("_cid", "_t")
    )
    open_groups = (
        asked.where(F.col("_next").isNull())
        .select("_cid", "_group").distinct()
        .select("_cid", ((F.col("_group") + 1) * width).alias("_q"))
    )
    above = next_arrival(minima, open_groups, tuple(wider)).select(
        F.col("_cid").alias("_ac"),
        F.expr(f"_q div {width} - 1").alias("_ag"),
        F.col("_next").alias("_later"),
    )
    return (
        asked.join(above, F.col("_cid").eqNullSafe(F.col("_ac")) & (F.col("_group") == F.col("_ag")), "left")
        .select("_cid", "_q", F.coalesce("_next", "_later").alias("_next"))
    )


def dedup_report(raw: DataFrame, accepted: DataFrame, injected: int | Column | None = None) -> DataFrame:
    """Totals of one dedup run: delivered, accepted, rejected and effectiveness.

    ``injected`` is the known number of repeats (a literal or an aggregate
    expression over ``raw``); effectiveness is null when it is absent or 0.
    """
    if injected is None:
        injected = F.lit(None).cast("long")
    elif isinstance(injected, int):
        injected = F.lit(injected).cast("long")
    kept = accepted.agg(F.count("*")).scalar()
    rejected = F.col("delivered") - F.col("accepted")
    ratio = F.round(rejected / F.col("duplicates_injected") * 100).cast("long")
    totals = raw.agg(F.count("*").alias("delivered"), injected.alias("duplicates_injected"))
    return totals.withColumn("accepted", kept).select(
        "delivered", "accepted", rejected.alias("duplicates_rejected"), "duplicates_injected",
        F.when(F.col("duplicates_injected") > 0, F.least(F.lit(100).cast("long"), ratio))
        .alias("dedup_effectiveness_pct"),
    )
