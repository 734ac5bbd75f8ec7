"""Dense numbering of rows in arrival order without a single-task window."""

from pyspark.sql import DataFrame, Window as W, functions as F

from eventlens.session import broadcast_if_small, materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the task number above this bit


def dense_number(
    df: DataFrame,
    order_cols: list,
    group_cols: list[str] = (),
    name: str = "row_no",
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in ``order_cols`` order, per group if groups are given.

    Rows are range-partitioned on (group, order), so a group or a moment holding
    most of the rows is still cut into many tasks. Each row carries its task
    (chunk) and its place there; the start number of every (group, chunk) is a
    prefix sum over at most ``tasks + groups`` rows, broadcast if they are few when counted.
    A null group is a group.
    The tagged rows are written before they are counted: counts and rows must
    come from one and the same range split. ``order_cols`` should be unique in a group.
    """
    group_cols = list(group_cols)
    keys = [F.col(c) for c in group_cols] + [F.col(c) if isinstance(c, str) else c for c in order_cols]
    tagged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    tagged = materialize(tagged, "numbered").withColumns({
        "_chunk": F.shiftright("_id", _ROW_BITS),
        "_place": F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })
    sizes = tagged.groupBy(*group_cols, "_chunk").agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first")
    )
    before = W.partitionBy(*group_cols).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_cols)], F.col("_chunk").alias("_c"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    if group_cols:
        starts = materialize(starts, "starts")
        starts, _ = broadcast_if_small(starts, starts.count())
    else:
        starts = F.broadcast(starts)  # one row a task
    same = F.col("_chunk") == F.col("_c")
    for i, c in enumerate(group_cols):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return (
        tagged.join(starts, same)
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .select(*df.columns, name)
    )
