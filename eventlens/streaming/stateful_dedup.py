"""The rolling dedup rule on a stream with state of bounded size.

Deliveries wait in keyed state until the watermark has passed them. Then no earlier delivery
can come any more, and the rule is applied in order of time: what a stream decides is what
`dedup_window` decides over all its deliveries, in whatever order they came. Of an id the
state has the deliveries of the last ``lateness`` and the time of the last accepted one,
which goes a window later. So the state follows the rate of the stream and not its age.

A delivery that comes more than ``lateness`` behind the newest one of the batches before it is
left out by Spark and counted as late in the query's progress.

A row is packed into one text before it goes to Python and unpacked behind it; waiting rows are stored
as compressed bytes, so neither Python nor the state client handles their columns.

All deliveries of an id meet in one task. `RollingDedup` spreads busy ids instead, decides
at once and keeps the times of all accepted deliveries.
"""

from __future__ import annotations

import json
import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventlens.operators.dedup import WINDOW_SECONDS
from eventlens.session import session_settings

FLAG = "is_duplicate"
LATENESS_SECONDS = 300
BUCKETS = 512
PART_ROWS = 4096  # waiting rows of a bucket that are stored as one value at most
OUTPUT_ROWS = 10_000  # rows that are handed on at a time
# The state store that keyed timers need, writing changes instead of whole snapshots.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside use the state store that `dedup_in_order` needs. A query keeps
    the store it was started with."""
    with session_settings(spark, _STORE):
        yield


def _stored(value) -> bytes:
    return zlib.compress(pickle.dumps(value, pickle.HIGHEST_PROTOCOL), 1)


def _loaded(value):
    return pickle.loads(zlib.decompress(bytes(value)))


def _rank(row: tuple) -> list:
    """Order of deliveries of one id at one time, nulls first."""
    return [(v is not None, v) for v in json.loads(row[2]).values()]


class _InOrder(StatefulProcessor):
    """Keys are buckets of ids, so that a call to the store serves many ids.

    Rows are (time in microseconds, id, tie, row), all but the time as text. ``waiting`` has them in
    parts, by the first time in each: consecutive rows of one batch, so that calls to the store follow the
    volume and not the time that a batch spans. ``meta`` has the time of the last accepted delivery of each
    id that it can still reject, the time of the next timer and the number of parts so far.
    """

    def __init__(self, width: int):
        self._width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getMapState("waiting", "first long, part long", "rows binary")
        self._meta = handle.getValueState("meta", "recent binary, due long, parts long")

    def _read_meta(self) -> tuple[dict, int | None, int]:
        if not self._meta.exists():
            return {}, None, 0
        recent, due, parts = self._meta.get()
        return _loaded(recent), due, parts

    def _write_meta(self, recent: dict, wake: int | None, due: int | None, parts: int) -> None:
        """Store the times and see to a timer at ``wake``, unless one at ``due`` comes before."""
        if wake is not None and (due is None or wake < due):
            due = wake
            self._handle.registerTimer(-(-wake // 1000))
        self._meta.update((_stored(recent), due, parts))

    def handleInputRows(self, key, rows, timerValues):
        arrived = []
        for frame in rows:
            arrived += zip(frame["us"].tolist(), frame["id"], frame["tie"], frame["packed"])
        arrived.sort(key=lambda row: row[0])
        recent, due, parts = self._read_meta()
        for i in range(0, len(arrived), PART_ROWS):
            self._waiting.updateValue((arrived[i][0], parts), (_stored(arrived[i:i + PART_ROWS]),))
            parts += 1
        self._write_meta(recent, arrived[0][0], due, parts)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        last, due, parts = self._read_meta()
        if due is None or due > passed:
            return
        waiting = sorted(tuple(k) for k in self._waiting.keys())
        reached = [k for k in waiting if k[0] <= passed]
        wakes, ready = [first for first, _ in waiting[len(reached):][:1]], []
        for place, (first, part) in enumerate(reached):
            rows = _loaded(self._waiting.getValue((first, part))[0])
            self._waiting.removeKey((first, part))
            left = [row for row in rows if row[0] > passed]
            if left:
                self._waiting.updateValue((left[0][0], part), (_stored(left),))
                wakes.append(left[0][0])
            ready += rows[:len(rows) - len(left)]
            # what comes before the next part is complete
            end = reached[place + 1][0] if place + 1 < len(reached) else None
            yield from self._decided([row for row in ready if end is None or row[0] < end], last)
            ready = [row for row in ready if end is not None and row[0] >= end]
        recent = {name: us for name, us in last.items() if us + self._width > passed}
        wake = min(wakes) if wakes else max(recent.values()) + self._width if recent else None
        if wake is None:
            self._meta.clear()
        else:
            self._write_meta(recent, wake, None, parts)

    def _decided(self, rows: list[tuple], last: dict) -> Iterator[pd.DataFrame]:
        """Rows with their flags, in order; ``last`` moves on."""
        rows.sort(key=lambda row: row[:2])
        if any(a[:2] == b[:2] for a, b in zip(rows, rows[1:])):
            rows.sort(key=lambda row: (*row[:2], _rank(row)))
        packed, flags = [], []
        for us, name, _, row in rows:
            accepted = name not in last or us - last[name] >= self._width
            if accepted:
                last[name] = us
            packed.append(row)
            flags.append(not accepted)
        for i in range(0, len(rows), OUTPUT_ROWS):
            yield pd.DataFrame({"packed": packed[i:i + OUTPUT_ROWS], FLAG: flags[i:i + OUTPUT_ROWS]})


# Text that gives back what was written: times with microseconds, and an error for what can not be read.
_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _packed(schema: T.StructType) -> Column:
    """A row as one text, its times as microseconds."""
    return F.to_json(F.struct(*[
        (F.unix_micros(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name)
        for f in schema]), _TEXT)


def _unpacked(df: DataFrame, schema: T.StructType) -> DataFrame:
    plain = T.StructType([
        T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema])
    row = df.select(F.from_json("packed", plain, {**_TEXT, "mode": "FAILFAST"}).alias("_row"), FLAG)
    return row.select(*[
        (F.timestamp_micros(F.col("_row")[f.name]) if isinstance(f.dataType, T.TimestampType) else F.col("_row")[f.name])
        .alias(f.name) for f in schema], FLAG)


def dedup_in_order(
    stream: DataFrame, id_col: str = "event_id", time_col: str = "ingest_ts", lateness_seconds: float = LATENESS_SECONDS,
    window_seconds: float = WINDOW_SECONDS, tie_cols: list[str] = ("copy",), heartbeat: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """All deliveries of a stream with ``is_duplicate``, each once the watermark has passed it.

    ``heartbeat`` tells rows that only move the watermark, for sources that fall silent; they
    are not part of the result. Rows without a time are neither. ``buckets`` of ids share the
    work; their number stays what it was when the checkpoint was made. Start the query inside
    `keyed_state`, in append mode.
    """
    ties = [F.col(c) for c in tie_cols if c in stream.columns] or [F.lit(0).alias("none")]
    marked = stream.withWatermark(time_col, f"{round(lateness_seconds * 1000)} milliseconds")
    timed = F.col(time_col)
    if heartbeat is not None:  # one condition on the time column, or Spark would filter before it takes the watermark
        timed = F.when(~F.coalesce(heartbeat, F.lit(False)), timed)
    rows = marked.where(timed.isNotNull()).select(
        F.unix_micros(time_col).alias("us"), F.to_json(F.struct(F.col(id_col).alias("id")), _TEXT).alias("id"),
        F.to_json(F.struct(*ties), {**_TEXT, "ignoreNullFields": "false"}).alias("tie"), _packed(stream.schema).alias("packed"),
        F.pmod(F.xxhash64(id_col), F.lit(buckets)).alias("bucket"), F.col(time_col).alias("at"))
    processor = _InOrder(round(window_seconds * 1_000_000))
    out = T.StructType([T.StructField("packed", T.StringType()), T.StructField(FLAG, T.BooleanType(), False)])
    return _unpacked(
        rows.groupBy("bucket").transformWithStateInPandas(processor, out, outputMode="Append", timeMode="EventTime"),
        stream.schema)
