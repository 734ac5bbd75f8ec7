"""Exact order statistics of groups of any size.

No task holds the values of a group. A pass asks a mergeable sketch for values around the
wanted rank, counts exactly how many rows lie below and between them, and goes on between
them with the rest of the rank: about a twentieth of the rows are left after each pass, however they
are distributed. When few are left they are counted by value and the rank is read off. The
sketch only chooses where to look, so its error costs a pass and never the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.session import broadcast_if_small, materialize

FEW = 10_000  # values that are ranked in one task
STEPS = 64  # parts that the sketch cuts a group into
_ACCURACY = 2_000


def ranks_of(fractions: list[float]) -> Callable[[Column], list[Column]]:
    """Ranks, from 0, as the latency metrics take them: floor(n f), the last one at most."""
    return lambda n: [F.least(F.floor(n * f), n - 1).cast("long") for f in fractions]


def middle_ranks(n: Column) -> list[Column]:
    """The two ranks whose mean is the median."""
    return [F.expr("(n - 1) div 2"), F.expr("n div 2")]


def select_ranks(
    df: DataFrame, groups: list[str], value: str, ranks: Callable[[Column], list[Column]], few: int = FEW,
) -> DataFrame:
    """(groups, n, target, value): for each group its number of values that are not null, and
    the value at each of ``ranks(n)``, numbered by ``target``."""
    keys = [f"_g{i}" for i in range(len(groups))]
    rows = materialize(df.where(F.col(value).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(groups, keys)], F.col(value).alias("_v")), "values")
    kind = rows.schema["_v"].dataType
    none = F.lit(None).cast(kind)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    if not keys:
        counts = counts.where("n > 0")
    # A target looks for the rank `_r` among the `_left` values from `_lo` to `_hi`.
    targets = materialize(counts.select(*keys, "n", F.posexplode(F.array(*ranks(F.col("n")))).alias("target", "_r")).withColumns(
        {"_left": F.col("n"), "_lo": none, "_hi": none}), "targets")
    while True:
        wide = targets.where((F.col("_left") > few) & ~F.coalesce(F.col("_lo") == F.col("_hi"), F.lit(False)))
        if wide.isEmpty():
            break
        narrow = targets.join(wide.select(*_renamed(keys), F.col("target").alias("_t")), _same(keys, "target", "_t"), "left_anti")
        targets = materialize(narrow.unionByName(_narrowed(rows, wide, keys)), "targets")
    return _ranked(rows, targets, keys).select(*[F.col(k).alias(c) for k, c in zip(keys, groups)], "n", "target", "value")


def _renamed(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"_{k}") for k in keys]


def _same(keys: list[str], *equal: str) -> Column:
    same = F.lit(True) if not equal else F.col(equal[0]) == F.col(equal[1])
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return same


def _inside(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The rows between the bounds of each target of their group."""
    own = targets.select(*_renamed(keys), "n", "target", "_r", "_left", "_lo", "_hi")
    own, _ = broadcast_if_small(own, own.count())
    return rows.join(own, _same(keys)).where(
        F.coalesce(F.col("_v") >= F.col("_lo"), F.lit(True)) & F.coalesce(F.col("_v") <= F.col("_hi"), F.lit(True)))


def _narrowed(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The targets with bounds closer to their ranks."""
    inside = _inside(rows, targets, keys)
    grid = [i / STEPS for i in range(STEPS + 1)]
    place = F.floor(F.col("_r") * STEPS / F.col("_left")).cast("int")  # array places count from 1
    cuts = inside.groupBy(*keys, "target").agg(
        F.percentile_approx("_v", grid, _ACCURACY).alias("_cuts"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.first("_r").alias("_r"), F.first("_left").alias("_left")).select(
        *_renamed(keys), F.col("target").alias("_t"),
        F.when(place < 2, F.col("_min")).otherwise(F.try_element_at("_cuts", F.greatest(F.lit(1), place - 1))).alias("_a"),
        F.when(place > STEPS - 3, F.col("_max")).otherwise(F.try_element_at("_cuts", place + 4)).alias("_b"))
    cuts = materialize(cuts, "cuts")
    cuts, _ = broadcast_if_small(cuts, cuts.count())
    met = inside.drop(*[f"_{k}" for k in keys]).join(cuts, _same(keys, "target", "_t"))
    # Five parts in order. The values of the sketch are parts of their own: whatever the
    # distribution, what is between them gets smaller.
    v, a, b = F.col("_v"), F.col("_a"), F.col("_b")
    parts = [v < a, v == a, (v > a) & (v < b), (v == b) & (b > a), v > b]
    found = met.groupBy(*keys, "n", "target", "_r").agg(*[
        made.alias(f"_{name}{i}") for i, part in enumerate(parts) for name, made in
        (("count", F.count_if(part)), ("min", F.min(F.when(part, v))), ("max", F.max(F.when(part, v))))])
    chosen, before = F, F.lit(0)
    for i in range(len(parts)):
        here = F.struct(
            (F.col("_r") - before).alias("_r"), F.col(f"_count{i}").alias("_left"), F.col(f"_min{i}").alias("_lo"),
            F.col(f"_max{i}").alias("_hi"))
        before = before + F.col(f"_count{i}")
        chosen = chosen.when(F.col("_r") < before, here)
    return found.select(*keys, "n", "target", chosen.alias("_to")).select(*keys, "n", "target", "_to.*")


def _ranked(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """The value at each target's rank, of the few values or the one value left for it."""
    counted = _inside(rows, targets, keys).groupBy(*keys, "n", "target", "_r", "_v").agg(F.count("*").alias("_c"))
    order = W.partitionBy(*keys, "target").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    upto = counted.withColumn("_upto", F.sum("_c").over(order))
    return upto.where((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_c") <= F.col("_r"))).withColumnRenamed("_v", "value")


def medians(df: DataFrame, groups: list[str], value: str, few: int = FEW) -> DataFrame:
    """(groups, median, n): the mean of the two middle values of each group with values; without
    ``groups`` one row, of nulls if there is no value."""
    return select_ranks(df, groups, value, middle_ranks, few).groupBy(*groups).agg(
        F.avg("value").alias("median"), F.first("n").alias("n"))


def quantiles(df: DataFrame, groups: list[str], value: str, fractions: dict[str, float], few: int = FEW) -> DataFrame:
    """(groups, n, one column for each name of ``fractions``)."""
    picked = select_ranks(df, groups, value, ranks_of([*fractions.values()]), few)
    return picked.groupBy(*groups).agg(F.first("n").alias("n"), *[
        F.max(F.when(F.col("target") == i, F.col("value"))).alias(name) for i, name in enumerate(fractions)])
