"""Continuous maintenance of the metric state from a stream of deliveries.

With a `RollingDedup` in front, the stream may hold repeats: each micro-batch adds its
accepted rows and the count of those rejected, and no first delivery is lost, however late.
Without one, the stream must be deduplicated already, or come from `dedup_in_order`: rows it
flags are counted as rejected and go no further.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.operators import state as st, timeseries as ts
from eventlens.session import delete_folder, materialize, read_or_none, stages
from eventlens.sources.snapshots import StateTable
from eventlens.streaming.exact_dedup import RollingDedup
from eventlens.streaming.stateful_dedup import FLAG

HISTORY_LENGTH = 60  # fixed value: samples of the served history
BATCHES_PER_BASE = 50


def fold_batches(
    table: StateTable, batches_per_base: int = BATCHES_PER_BASE, dedup: RollingDedup | None = None,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler: store the state of each micro-batch under its id.

    Every ``batches_per_base`` batches the stored ones are compacted, so readers
    merge a bounded number of tables.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with stages(batch.sparkSession):
            _fold(table, batch, batch_id, batches_per_base, dedup)

    return handle


def _fold(
    table: StateTable, batch: DataFrame, batch_id: int, batches_per_base: int, dedup: RollingDedup | None,
) -> bool:
    """Whether the batch had rows."""
    # Two aggregates read the batch; writing it first keeps the stateful part above
    # from running twice.
    rows = materialize(batch, "batch", spread=True)
    if rows.isEmpty():
        return False
    if FLAG in rows.columns:
        state = st.with_duplicates(
            st.build_state(rows.where(~F.col(FLAG)).drop(FLAG)),
            rows.agg(F.count_if(FLAG).alias("duplicates_rejected")))
    elif dedup is None:
        state = st.build_state(rows)
    else:
        accepted, rejected = dedup.accept(rows, batch_id)
        state = st.with_duplicates(st.build_state(accepted), rejected)
    table.write_batch(batch_id, state)
    if batch_id % batches_per_base == batches_per_base - 1:
        table.compact()
        table.drop_folded()
    return True


def publish_batches(
    table: StateTable, path: str, batches_per_base: int = BATCHES_PER_BASE, dedup: RollingDedup | None = None,
) -> Callable[[DataFrame, int], None]:
    """Like `fold_batches`, and publishes the full snapshot and one history sample
    per trigger that brought rows. Only recent publications are kept."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with stages(spark):
            if not _fold(table, batch, batch_id, batches_per_base, dedup):
                return
            merged = table.read()
            state = st.MetricState(
                materialize(merged.partials, "state"), materialize(merged.samples, "samples"))
            st.snapshot(state).write.mode("overwrite").parquet(f"{path}/snapshot/batch_id={batch_id}")
            history_sample(state).withColumn("published_at", F.current_timestamp()).write.mode(
                "overwrite").parquet(f"{path}/history/batch_id={batch_id}")
            for kind in ("snapshot", "history"):
                delete_folder(spark, f"{path}/{kind}/batch_id={batch_id - 2 * HISTORY_LENGTH}")

    return handle


def history_sample(state: st.MetricState) -> DataFrame:
    """One row: current and mean rate, p50 and p99."""
    rate = ts.current_rate(st.second_table(state.partials))
    ranks = st.latency(state).select(F.struct("p50_latency_ms", "p99_latency_ms")).scalar()
    return rate.withColumn("ranks", ranks).select("current_eps", "avg_eps_5s", "ranks.*")


def published_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest published snapshot."""
    published = read_or_none(spark, f"{path}/snapshot")
    if published is None:
        return None
    newest = published.agg(F.max("batch_id")).first()[0]
    return published.where(F.col("batch_id") == newest).select(*st.SNAPSHOT_COLUMNS)


def metric_history(spark: SparkSession, path: str, n: int = HISTORY_LENGTH) -> DataFrame | None:
    """The newest n published samples, oldest first."""
    history = read_or_none(spark, f"{path}/history")
    if history is None:
        return None
    return history.orderBy(F.desc("batch_id")).limit(n).orderBy("batch_id")
