"""Exact rolling-window dedup across micro-batches.

`dedup_stream` lets Spark's state store forget an id some time after the window;
this operator applies the rolling rule to the letter and counts what it rejects.
Each micro-batch runs the batch operator, so a busy id is spread over tasks; what
carries over are all accepted times of all ids, of which a batch reads its own time range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.operators.dedup import BUSY_ROWS, WINDOW_SECONDS, dedup_window, join_ids
from eventlens.session import BROADCAST_ROWS, delete_folder, materialize, read_or_none, stages, write_spread



class RollingDedup:
    """foreachBatch handler writing ``accepted/``, ``seen/`` and ``report/`` below ``path``.

    All three are keyed by batch id and overwritten on retry. A batch sees what the
    batches before it accepted. A first delivery is accepted however late it comes; a
    repeat is rejected if it lies within the window of any accepted delivery of its id,
    before or after it, however late. ``seen/`` has an id and a time for each accepted
    delivery and is never pruned: there is no bound on lateness.
    """

    def __init__(
        self, spark: SparkSession, path: str, id_col: str = "event_id", time_col: str = "ingest_ts",
        window_seconds: float = WINDOW_SECONDS, tie_cols: list[str] = ("copy",),
    ):
        self.spark, self.path = spark, path
        self.id_col, self.time_col = id_col, time_col
        self.window_seconds, self.tie_cols = window_seconds, tie_cols

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with stages(self.spark):
            self._handle(materialize(batch, "batch", spread=True), batch_id)

    def accept(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """(accepted rows, one row with ``duplicates_rejected``) of a written micro-batch, for
        a handler that goes on with them. The rows are no copy: they are read from the batch,
        by the columns asked for, until its files go; ``accepted/`` is not written."""
        accepted = self._decided(batch, batch_id)
        report = self.spark.read.parquet(f"{self.path}/report/batch_id={batch_id}")
        return accepted, report.select((F.col("delivered") - F.col("accepted")).alias("duplicates_rejected"))

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        self._decided(batch, batch_id, f"{self.path}/accepted/batch_id={batch_id}")

    def _decided(self, batch: DataFrame, batch_id: int, path: str | None = None) -> DataFrame:
        """The accepted rows of a written batch, at ``path`` if it is given; what the batch adds to
        ``seen/`` and ``report/`` is written."""
        us = F.unix_micros(self.time_col)
        times = batch.agg(F.min(us), F.max(us)).first()
        accepted = self._accepted_of(batch, batch_id, times)
        if path:
            accepted = write_spread(accepted, path)
        self._record(accepted, batch, batch_id, times)
        return accepted

    def _accepted_of(self, batch: DataFrame, batch_id: int, times: tuple) -> DataFrame:
        width = int(self.window_seconds * 1_000_000)
        us = F.unix_micros(self.time_col)
        seen = self._seen_before(batch_id, times, width)
        fresh = batch
        if seen is not None:
            slots = batch.withColumn("_slot", F.struct(F.col(self.id_col).alias("id"), F.floor(us / max(width, 1)).alias("n")))
            near = F.exists("_seen_us", lambda t: F.abs(us - t) < width)
            n_seen = seen.count()
            fresh = (
                join_ids(slots, "_slot", seen, n_seen, "left", self._busy(slots))
                .where(~F.coalesce(near, F.lit(False)))
                .select(*batch.columns)
            )
            if n_seen > BROADCAST_ROWS:  # a shuffled join, too dear to be run for every read
                fresh = materialize(fresh, "fresh", spread=True)
        return dedup_window(fresh, self.id_col, self.time_col, self.window_seconds, self.tie_cols)

    def _record(self, accepted: DataFrame, batch: DataFrame, batch_id: int, times: tuple) -> None:
        """Leave the accepted times and the counts of a batch. The folder of the times is named by
        their range, so that later batches find those near them without opening the others; the
        files are ranges of time too, a few of them however long the batch spans."""
        low, high = times
        delete_folder(self.spark, f"{self.path}/seen/batch_id={batch_id}")  # of a try that died
        if low is not None:
            accepted.select(F.col(self.id_col).alias("_cid"), F.unix_micros(self.time_col).alias("_seen_us")).repartitionByRange(
                "_seen_us", "_cid").sortWithinPartitions("_seen_us").write.parquet(
                f"{self.path}/seen/batch_id={batch_id}/low={low}/high={high}")
        batch.agg(F.count("*").alias("delivered")).withColumn(
            "accepted", accepted.agg(F.count("*")).scalar()
        ).write.mode("overwrite").parquet(f"{self.path}/report/batch_id={batch_id}")

    def _busy(self, slots: DataFrame) -> tuple[DataFrame, int]:
        """Slots that make up a large part of a batch; a batch below that size has none."""
        if slots.count() <= BUSY_ROWS:
            return slots.select(F.col("_slot").alias("_cid")), 0
        counts = slots.groupBy(F.col("_slot").alias("_cid")).agg(F.count("*").alias("_n"))
        busy = materialize(counts.where(F.col("_n") > BUSY_ROWS).select("_cid"), "busy")
        return busy, busy.count()

    def _seen_before(self, batch_id: int, times: tuple, width: int) -> DataFrame | None:
        """The accepted times that rows of the batch can be near to, by slot: id and number of
        the window-long stretch of time. An id has one accepted time in a stretch at most,
        so a slot has those of itself and its two neighbours."""
        seen = read_or_none(self.spark, f"{self.path}/seen")
        low, high = times
        if seen is None or low is None:
            return None
        low, high = low - width, high + width
        reached = seen.where(
            (F.col("batch_id") < batch_id) & (F.col("low") <= high) & (F.col("high") >= low)
            & F.col("_seen_us").between(low, high))
        stretch = F.floor(F.col("_seen_us") / max(width, 1))
        return materialize(
            reached.withColumn("n", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
            .groupBy(F.struct(F.col("_cid").alias("id"), "n").alias("_cid"))
            .agg(F.collect_list("_seen_us").alias("_seen_us")), "seen")

    def accepted(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/accepted").drop("batch_id")

    def report(self) -> DataFrame:
        """Deliveries, accepted and rejected rows over all batches."""
        return self.spark.read.parquet(f"{self.path}/report").agg(
            F.sum("delivered").alias("delivered"), F.sum("accepted").alias("accepted"),
            (F.sum("delivered") - F.sum("accepted")).alias("duplicates_rejected"),
        )
