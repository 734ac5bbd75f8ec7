"""Streaming side of the event log: landing, bounded reads, stamps, dedup, sinks."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from eventlens.operators.dedup import WINDOW_SECONDS

REPORT_WAIT_S = 60  # for the reports of a query that has ended


def land(batches: list[DataFrame], path: str) -> None:
    """Append each frame to the landing folder, in order, as parquet files."""
    for frame in batches:
        frame.write.mode("append").parquet(path)


def split_by_time(df: DataFrame, n: int, time_col: str = "ingest_ts") -> list[DataFrame]:
    """Cut a frame into n consecutive equal time spans."""
    lo, hi = df.agg(F.min(F.unix_micros(time_col)), F.max(F.unix_micros(time_col))).first()
    if lo is None:  # no rows to cut
        return [df] * n
    us = F.unix_micros(time_col)
    edges = [lo + (hi - lo) * i // n for i in range(n)] + [hi + 1]
    return [df.where((us >= edges[i]) & (us < edges[i + 1])) for i in range(n)]


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType,
    max_files: int | None = None, max_bytes: int | None = None,
) -> DataFrame:
    """Stream over a landing folder. The two limits bound one micro-batch, so a
    burst waits in the folder instead of in memory."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def stamp_ingest(stream: DataFrame, time_col: str = "ingest_ts") -> DataFrame:
    """Processing time of each event; usable as the watermark column."""
    return stream.withColumn(time_col, F.current_timestamp())


def dedup_stream(
    stream: DataFrame, id_col: str = "event_id", time_col: str = "ingest_ts",
    window_seconds: int = WINDOW_SECONDS,
) -> DataFrame:
    """Drop repeats of an id seen within the window, across batches and restarts.

    State of an id is evicted by the watermark, so an id is remembered for at
    least the window.
    """
    return stream.withWatermark(time_col, f"{window_seconds} seconds").dropDuplicatesWithinWatermark([id_col])


def windowed_stream(
    stream: DataFrame, window_seconds: int, aggregates: list, time_col: str = "ingest_ts",
) -> DataFrame:
    """Tumbling windows of a stream that carries a watermark on ``time_col``. In append mode a window is emitted once, when the
    watermark passes its end; in update mode later events correct it."""
    w = F.window(time_col, f"{window_seconds} seconds")
    return stream.groupBy(w.alias("w")).agg(*aggregates, F.count("*").alias("count")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*"
    ).drop("w")


def run_to_file(stream: DataFrame, path: str, checkpoint: str, report: str | None = None) -> StreamingQuery:
    """Write everything available to a parquet folder, exactly once, and stop. With
    ``report``, every micro-batch leaves its row for `reported` in that folder."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if report is None:
        query = writer.start()
        query.awaitTermination()
        return query
    reports = _Reports(stream.sparkSession, report)
    stream.sparkSession.streams.addListener(reports)
    try:
        query = writer.queryName(reports.name).start()
        query.awaitTermination()
        reports.finish()
    finally:
        stream.sparkSession.streams.removeListener(reports)
    return query


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    output_mode: str = "append", every: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``handle(df, batch_id)``.

    Without ``every`` all available data is processed and the query ends; with
    it (e.g. "1 second") the query keeps running and is returned started.
    ``handle`` may see a batch again after a failure and must overwrite by batch id.
    """
    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint).foreachBatch(handle)
    )
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


_REPORT = ("batch_id long, input_rows long, input_rows_per_s double, processed_rows_per_s double, "
           "dropped long, late long")


def _report_row(p) -> tuple:
    repeated = sum(op["customMetrics"].get("numDroppedDuplicateRows", 0) for op in p["stateOperators"])
    late = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
    return (p["batchId"], p["numInputRows"], p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"),
            repeated, late)


class _Reports(StreamingQueryListener):
    """Writes the report of each micro-batch of the query ``name`` to a file of its batch id."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self.name, self._run, self._failure, self._done = f"reports-{uuid.uuid4().hex}", None, None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        if str(event.progress["runId"]) != self._run:
            return
        try:
            row = _report_row(event.progress)
            names = T.StructType.fromDDL(_REPORT).names
            file = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/batch-{row[0]}.json")
            out = file.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(file, True)
            out.write(bytearray(json.dumps(dict(zip(names, row))).encode()))
            out.close()
        except Exception as error:  # the listener bus would only log it
            self._failure = error

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self._done.set()

    def finish(self) -> None:
        """Wait for the last report; raise if one could not be written."""
        if not self._done.wait(REPORT_WAIT_S):
            raise TimeoutError(f"reports of {self.name} are not complete")
        if self._failure:
            raise self._failure


def reported(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch of all runs that reported to this folder, as `progress` has them.

    A batch whose process died between its end and its report has no row; batch ids are
    dense, so it shows as a gap.
    """
    return spark.read.schema(_REPORT).json(path)


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch: volumes, rates, rows ``dropped`` as repeated, and rows
    lost because they came ``late``, behind the watermark.

    Input far above the processed rate means the query falls behind its source.
    Spark keeps the last 100 reports of a query; `reported` has all.
    """
    return spark.createDataFrame([_report_row(p) for p in query.recentProgress], _REPORT)
