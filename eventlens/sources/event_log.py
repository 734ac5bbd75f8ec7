"""The partitioned event log: routing, offsets, append, scan, replay, retention, statistics."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventlens.functions import hash_partition, is_present, round_robin_partition, routing_key
from eventlens.operators.numbering import dense_number
from eventlens.schema import EVENT_SCHEMA, LOG_REQUIRED, LOG_SCHEMA, RAW_PAYLOAD, STATE_LOG_OP, STATE_LOG_SCHEMA
from eventlens.session import read_or_none

# Default replay length and log size cap.
REPLAY_LIMIT = 100
LOG_MAX_BYTES = 50 * 1024 * 1024

ARRIVAL = ["ingest_ts", "event_id", "copy"]


# --- routing and offsets -----------------------------------------------------

def route(events: DataFrame, n: int, arrival: list[str] = ARRIVAL, keyless: bool = True) -> DataFrame:
    """Add ``partition_id``: hash of the partition key, else of the user id, else by turn.

    The turn counts every send, so it takes a numbering of all rows. That is done
    only if some row has neither key, which costs a look at the two key columns;
    ``keyless=False`` states that there is none.
    """
    key = routing_key()
    has_key = F.coalesce(is_present(key), F.lit(False))
    if not keyless or events.where(~has_key).isEmpty():
        return events.withColumn("partition_id", hash_partition(key, n))
    numbered = dense_number(events, [c for c in arrival if c in events.columns], name="_send_no")
    turn = round_robin_partition(F.col("_send_no"), n)
    return numbered.withColumn(
        "partition_id", F.when(has_key, hash_partition(key, n)).otherwise(turn)
    ).drop("_send_no")


def route_round_robin(events: DataFrame, n: int, arrival: list[str] = ARRIVAL) -> DataFrame:
    """Add ``send_no`` (dense arrival number) and the partition whose turn it is."""
    return dense_number(events, arrival, name="send_no").withColumn(
        "partition_id", round_robin_partition(F.col("send_no"), n)
    )


def assign_offsets(
    routed: DataFrame, arrival: list[str] = ARRIVAL, ends: DataFrame | None = None,
) -> DataFrame:
    """Add ``offset``: dense and in arrival order inside each partition.

    ``ends`` (partition_id, end_offset) continues an existing log; it has one row
    per log partition.
    """
    order = [c for c in arrival if c in routed.columns]
    numbered = dense_number(routed, order, ["partition_id"], name="offset")
    if ends is None:
        return numbered
    return (
        numbered.join(F.broadcast(ends), "partition_id", "left")
        .withColumn("offset", F.col("offset") + F.coalesce("end_offset", F.lit(0)))
        .drop("end_offset")
    )


# --- JSON-lines files ---------------------------------------------------------

def scan_json_lines(
    spark: SparkSession, path: str, schema: T.StructType, required: list[str],
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines) of a JSON-lines log.

    A line is a row when every required field could be read; broken JSON and
    missing fields leave nulls and are rejected. Blank lines are neither. Rows of a schema
    with a payload also have it as it stands in the line, in the column `RAW_PAYLOAD`.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    keys = [c for c in lines.columns if c != "value"]  # partition folders
    parsed = lines.withColumn("row", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    complete = reduce(Column.__and__, [F.col(f"row.{name}").isNotNull() for name in required])
    complete = F.coalesce(complete, F.lit(False))
    raw = [F.from_json("value", "data string")["data"].alias(RAW_PAYLOAD)] if "data" in schema.names else []
    return (
        parsed.where(complete).select(*keys, "row.*", *raw),
        parsed.where(~complete).select(*keys, F.col("value").alias("line")),
    )


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """Events of a JSON-lines log folder; unreadable lines are skipped."""
    return _to_events(scan_json_lines(spark, path, LOG_SCHEMA, LOG_REQUIRED)[0])


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines `scan_log` skips, for a quarantine table."""
    return scan_json_lines(spark, path, LOG_SCHEMA, LOG_REQUIRED)[1]


def _to_events(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "timestamp": F.timestamp_micros(F.round(F.col("timestamp") * 1_000_000).cast("long")),
        "partition_key": F.coalesce("partition_key", F.lit("")),
    })


def flatten(events: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Envelopes as the flat rows the metric operators read; other columns pass through.

    ``ingest_time`` is the processing time of each event. Without it an existing
    ``ingest_ts`` column is used, else the event time.
    """
    if ingest_time is None:
        ingest_time = F.col("ingest_ts" if "ingest_ts" in events.columns else "timestamp")
    payload = ["country", "device", "product_name", "category", "query", "amount"]
    known = events.schema["data"].dataType.names
    envelope = {*EVENT_SCHEMA.names, "ingest_ts"}
    return events.select(
        "event_id", "event_type", F.col("timestamp").alias("ts"), ingest_time.alias("ingest_ts"), "user_id",
        *[(F.col(f"data.{c}") if c in known else F.lit(None)).alias(c) for c in payload],
        *[c for c in events.columns if c not in envelope],
    )


def log_lines(log: DataFrame) -> Column:
    """One log line per row: offset and envelope as JSON, times as epoch seconds. A payload
    that was read from a line is written as it was there, with all its keys."""
    fields = [f.name for f in LOG_SCHEMA]
    values = [
        (F.unix_micros("timestamp") / 1_000_000).alias("timestamp") if f == "timestamp" else F.col(f)
        for f in fields if f in log.columns
    ]
    line = F.to_json(F.struct(*values))
    if RAW_PAYLOAD not in log.columns:
        return line
    rest = F.to_json(F.struct(*[v for f, v in zip([f for f in fields if f in log.columns], values) if f != "data"]))
    whole = F.concat(rest.substr(F.lit(1), F.length(rest) - 1), F.lit(',"data":'), F.col(RAW_PAYLOAD), F.lit("}"))
    return F.coalesce(whole, line)


def scan_state_log(spark: SparkSession, path: str) -> DataFrame:
    """Event mutations of a state log; other operations and bad lines are skipped."""
    rows, _ = scan_json_lines(spark, path, STATE_LOG_SCHEMA, ["op"])
    return rows.where(F.col("op") == STATE_LOG_OP).drop("op").withColumn(
        "ts", F.timestamp_micros(F.round(F.col("ts") * 1_000_000).cast("long"))
    )


# --- append -------------------------------------------------------------------

def log_ends(spark: SparkSession, path: str) -> DataFrame | None:
    """(partition_id, end_offset) of a parquet log, None when it does not exist yet.

    Every append leaves its end offsets in a small side table, so the next one need
    not scan the log.
    """
    ends = read_or_none(spark, f"{path}/_ends", "partition_id int, end_offset long")
    return None if ends is None else _max_ends(ends)


def _max_ends(ends: DataFrame) -> DataFrame:
    return ends.groupBy("partition_id").agg(F.max("end_offset").alias("end_offset"))


def repair_ends(spark: SparkSession, path: str) -> None:
    """Recompute the end offsets from the log, after an append that died before
    recording them."""
    ends = read_log(spark, path).select("partition_id", (F.col("offset") + 1).alias("end_offset"))
    _max_ends(ends).write.mode("append").parquet(f"{path}/_ends")


def append_log(
    spark: SparkSession, events: DataFrame, path: str, n: int,
    arrival: list[str] = ARRIVAL, keyless: bool = True,
) -> None:
    """Route events, give them the next offsets of their partitions, and append them.

    Numbering leaves the rows ranged on (partition, arrival): a busy partition is
    written by many tasks and each file covers a narrow offset range, so replay can
    skip files. One writer per log at a time.
    """
    placed = assign_offsets(route(events, n, arrival, keyless), arrival, log_ends(spark, path))
    (
        placed.sortWithinPartitions("partition_id", "offset")
        .write.mode("append").partitionBy("partition_id").parquet(path)
    )
    # The numbered rows are a written intermediate: this reads three narrow columns.
    ends = placed.select("partition_id", (F.col("offset") + 1).alias("end_offset"))
    _max_ends(ends).write.mode("append").parquet(f"{path}/_ends")


def append_json_log(log: DataFrame, path: str) -> None:
    """Append rows that have partition and offset as JSON lines, a folder per partition."""
    (
        log.repartitionByRange("partition_id", "offset")
        .sortWithinPartitions("partition_id", "offset")
        .select("partition_id", log_lines(log).alias("value"))
        .write.mode("append").partitionBy("partition_id").text(path)
    )


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet log folder, None when nothing was appended yet. Appends may differ in
    whether they have raw payloads."""
    return read_or_none(spark, path, mergeSchema=True)


# --- replay, retention, statistics ---------------------------------------------

def replay(
    log: DataFrame, partition_id: int, from_offset: int = 0, limit: int | None = REPLAY_LIMIT,
    base_offset: int = 0,
) -> DataFrame:
    """Events of one partition from an offset on, not before the retained base."""
    rows = log.where(
        (F.col("partition_id") == partition_id) & (F.col("offset") >= max(from_offset, base_offset))
    ).orderBy("offset")
    return rows if limit is None else rows.limit(limit)


def retention_bases(log: DataFrame, max_bytes: int = LOG_MAX_BYTES) -> DataFrame:
    """(partition_id, base_offset): first offset to keep. Offsets are dense, so half of
    a partition is found by arithmetic; partitions below the cap keep all."""
    size = F.sum(F.octet_length(log_lines(log)) + 1)
    return log.groupBy("partition_id").agg(
        size.alias("bytes"), F.count("*").alias("n"), F.min("offset").alias("first")
    ).select(
        "partition_id",
        F.when((F.col("bytes") >= max_bytes) & (F.col("n") >= 2), F.col("first") + F.expr("n div 2"))
        .otherwise(F.col("first")).alias("base_offset"),
    )


def retain_newest_half(log: DataFrame, max_bytes: int = LOG_MAX_BYTES) -> DataFrame:
    """The log after rotating every partition that reached the cap."""
    bases = retention_bases(log, max_bytes)  # one row per log partition
    return (
        log.join(F.broadcast(bases), "partition_id")
        .where(F.col("offset") >= F.col("base_offset"))
        .drop("base_offset")
    )


def rotate_log(spark: SparkSession, path: str, new_path: str, max_bytes: int = LOG_MAX_BYTES) -> None:
    """Write the retained part of a log as a new log, which readers then switch to.

    Offsets go on where they were: the end offsets move along.
    """
    (
        retain_newest_half(read_log(spark, path), max_bytes)
        .sortWithinPartitions("partition_id", "offset")
        .write.partitionBy("partition_id").parquet(new_path)
    )
    log_ends(spark, path).write.parquet(f"{new_path}/_ends")


def partition_stats(log: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """End offset, committed offset, lag and volumes of each partition.

    ``committed`` has (partition_id, committed_offset); partitions without a row are at 0.
    """
    ends = log.groupBy("partition_id").agg(
        (F.max("offset") + 1).alias("end_offset"), F.min("offset").alias("base_offset")
    )
    if committed is None:
        ends = ends.withColumn("committed_offset", F.lit(0).cast("long"))
    else:
        ends = ends.join(committed, "partition_id", "left").withColumn(
            "committed_offset", F.coalesce("committed_offset", F.lit(0).cast("long"))
        )
    return ends.select(
        "partition_id", "base_offset", "end_offset", "committed_offset",
        (F.col("end_offset") - F.col("committed_offset")).alias("lag"),
        F.col("end_offset").alias("total_produced"),
        F.col("committed_offset").alias("total_consumed"),
    )
