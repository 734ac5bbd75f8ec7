"""Tumbling windows of a stream that late values correct.

A window is emitted when the stream's time passes its end, as revision 0. A value that comes
later emits the whole window again as the next revision, instead of a fragment or nothing.
Each micro-batch is reduced to one row per window before anything is kept, so a window
with most of a stream's rows costs one row per task and batch.

Layout below ``path``: ``partials/span=S/batch_id=B``, ``revisions/batch_id=B`` and
``marks/batch_id=B`` with the stream's time, written last. A repeated batch overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlens.session import broadcast_if_small, delete_folder, materialize, read_or_none, stages

SPANS_PER_FOLDER = 64  # windows of one folder of partial results


class RevisedWindows:
    """foreachBatch handler. ``aggregates`` maps a name to (aggregate over rows, aggregate that
    merges such results), e.g. ``{"result": (F.sum("amount"), F.sum)}``; the number of rows is
    kept as ``count``.

    The stream's time is the newest value of ``time_col`` so far, less ``delay_seconds``. State
    of a window is kept for ``keep_seconds`` after its end; values that come later still are
    counted in the mark of their batch as ``lost``.
    """

    def __init__(
        self, spark: SparkSession, path: str, window_seconds: int, aggregates: dict[str, tuple[Column, Callable]],
        time_col: str = "ingest_ts", delay_seconds: int = 0, keep_seconds: int | None = None,
    ):
        self.spark, self.path, self.time_col = spark, path, time_col
        self.width, self.delay = window_seconds, delay_seconds
        self.keep = None if keep_seconds is None else keep_seconds * 1_000_000
        self.aggregates = {**aggregates, "count": (F.count("*"), F.sum)}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with stages(self.spark):
            self._handle(batch, batch_id)

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        window = F.window(self.time_col, f"{self.width} seconds")
        partial = materialize(
            batch.groupBy(window.alias("w"))
            .agg(*[made.alias(name) for name, (made, _) in self.aggregates.items()], F.max(self.time_col).alias("newest"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "newest",
                    *self.aggregates), "partial")
        before = self._time_before(batch_id)
        newest = partial.agg(F.unix_micros(F.max("newest"))).first()[0]
        now = before if newest is None else max(x for x in (before, newest - self.delay * 1_000_000) if x is not None)
        end = F.unix_micros("window_end")
        gone = None if self.keep is None or before is None else before - self.keep
        lost = 0
        if gone is not None:
            lost = partial.where(end <= gone).agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
            partial = partial.where(end > gone)
        span = F.floor(F.unix_seconds("window_start") / (self.width * SPANS_PER_FOLDER))
        partial.drop("newest").withColumns({"span": span, "batch_id": F.lit(batch_id)}).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("span", "batch_id").parquet(f"{self.path}/partials")
        if now is not None:
            self._emit(partial, batch_id, before, now)
        self.spark.createDataFrame([(now, lost)], "us long, lost long").write.mode("overwrite").parquet(
            f"{self.path}/marks/batch_id={batch_id}")
        if gone is not None:
            self._forget(gone)

    def _time_before(self, batch_id: int) -> int | None:
        marks = read_or_none(self.spark, f"{self.path}/marks")
        return None if marks is None else marks.where(F.col("batch_id") < batch_id).agg(F.max("us")).first()[0]

    def _emit(self, partial: DataFrame, batch_id: int, before: int | None, now: int) -> None:
        """Write what closes with this batch, and what closed before it and got values in it."""
        every = read_or_none(self.spark, f"{self.path}/partials")
        if every is None:
            return
        end = F.unix_micros("window_end")
        known = every.where(F.col("batch_id") <= batch_id)
        folder = self.width * SPANS_PER_FOLDER * 1_000_000
        closing = known.where((end <= now) & (F.col("span") <= now // folder))
        if before is not None:
            closing = closing.where((end > before) & (F.col("span") >= before // folder - 1))
            late = partial.where(end <= before).select("window_start", F.floor(
                F.unix_seconds("window_start") / (self.width * SPANS_PER_FOLDER)).alias("span"))
            late, _ = broadcast_if_small(late, late.count())
            closing = closing.unionByName(known.join(late, ["span", "window_start"], "left_semi").select(*known.columns))
        merged = closing.groupBy("window_start", "window_end").agg(
            *[merge(name).alias(name) for name, (_, merge) in self.aggregates.items()])
        earlier = read_or_none(self.spark, f"{self.path}/revisions")
        number = F.lit(0).cast("long")
        if earlier is not None and before is not None:
            last = earlier.where(F.col("batch_id") < batch_id).join(late, "window_start", "left_semi").groupBy(
                "window_start").agg(F.max("revision").alias("last"))
            merged = merged.join(last, "window_start", "left")
            number = F.coalesce(F.col("last") + 1, number)
        merged.select("window_start", "window_end", number.alias("revision"), *self.aggregates).write.mode(
            "overwrite").parquet(f"{self.path}/revisions/batch_id={batch_id}")

    def _forget(self, gone: int) -> None:
        """Drop the folders whose windows all ended before ``gone``."""
        folder = self.width * SPANS_PER_FOLDER * 1_000_000
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/partials")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for f in fs.listStatus(root) if fs.exists(root) else []:
            name = f.getPath().getName()
            if name.startswith("span=") and (int(name.removeprefix("span=")) + 1) * folder <= gone:
                delete_folder(self.spark, f.getPath().toString())

    def revisions(self) -> DataFrame:
        """Every emitted (window_start, window_end, revision, aggregates)."""
        return self.spark.read.parquet(f"{self.path}/revisions").drop("batch_id")

    def current(self) -> DataFrame:
        """The newest revision of each window."""
        columns = ["window_end", "revision", *self.aggregates]
        newest = self.revisions().groupBy("window_start").agg(F.max_by(F.struct(*columns), "revision").alias("newest"))
        return newest.select("window_start", "newest.*")

    def lost(self) -> int:
        """Rows that came after the state of their window was dropped."""
        return self.spark.read.parquet(f"{self.path}/marks").agg(F.sum("lost")).first()[0]
