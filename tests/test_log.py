import json

import pytest
from pyspark.sql import functions as F

from conftest import at, plan, rows
from eventlens.operators.numbering import dense_number
from eventlens.operators.pipeline import EventColumns
from eventlens.session import fresh_dir
from eventlens.sources import event_log as log
from eventlens.sources.fixture import to_envelope

N = 4


@pytest.fixture
def envelope(spark):
    def make(n, user=lambda i: "u_test", start=0):
        data = [(f"e_{i:04d}", "page_view", at(i), user(i), "s_test", user(i), at(i), 0, {"page": "/p"})
                for i in range(start, start + n)]
        schema = ("event_id string, event_type string, timestamp timestamp, user_id string, session_id string, "
                  "partition_key string, ingest_ts timestamp, copy int, data struct<page:string>")
        return spark.createDataFrame(data, schema)

    return make


def test_same_key_same_partition_and_dense_offsets(envelope):
    placed = log.assign_offsets(log.route(envelope(5), N))
    assert placed.select("partition_id").distinct().count() == 1
    assert rows(placed, "event_id", "offset") == [(f"e_{i:04d}", i) for i in range(5)]


def test_different_keys_spread(envelope):
    routed = log.route(envelope(50, lambda i: f"u_{i:04d}"), N)
    assert routed.select("partition_id").distinct().count() > 1


def test_offsets_of_a_busy_partition_follow_arrival(envelope):
    """One key holds most rows: offsets stay dense and ordered over all range tasks."""
    df = envelope(3000, lambda i: "hot" if i % 3 else f"u_{i}")
    placed = log.assign_offsets(log.route(df, N)).select("partition_id", "event_id", "offset").toPandas()
    for _, part in placed.groupby("partition_id"):
        ordered = part.sort_values("event_id")
        assert ordered["offset"].tolist() == list(range(len(part)))


def test_dense_number_over_equal_times(spark):
    """All rows arrive at one moment; the id breaks the tie."""
    df = spark.range(1000).select(F.lit(at(0)).alias("t"), "id")
    got = dense_number(df, ["t", "id"]).where("id <> row_no")
    assert got.count() == 0


def test_keyless_events_take_turns(envelope):
    """Every third event has no key; the turn counts all sends."""
    df = envelope(30, lambda i: "" if i % 3 == 0 else "u_key")
    placed = dict(rows(log.route(df, N), "event_id", "partition_id"))
    for i in range(0, 30, 3):
        assert placed[f"e_{i:04d}"] == i % N
    assert len({placed[f"e_{i:04d}"] for i in range(30) if i % 3}) == 1


def test_append_continues_offsets(spark, envelope):
    path = fresh_dir(spark, "t-append")
    for start in (0, 7):
        log.append_log(spark, envelope(7, lambda i: f"u_{i % 3}", start), path, N)
    table = log.read_log(spark, path)
    whole = log.assign_offsets(log.route(envelope(14, lambda i: f"u_{i % 3}"), N))
    assert rows(table, "event_id", "partition_id", "offset") == rows(whole, "event_id", "partition_id", "offset")
    log.repair_ends(spark, path)
    assert rows(log.log_ends(spark, path)) == rows(
        table.groupBy("partition_id").agg((F.max("offset") + 1)))


def test_replay_from_offset_and_limit(spark, envelope):
    path = fresh_dir(spark, "t-replay")
    log.append_log(spark, envelope(5), path, 1)
    table = log.read_log(spark, path)
    assert [r.event_id for r in log.replay(table, 0, 2).collect()] == ["e_0002", "e_0003", "e_0004"]
    assert [r.offset for r in log.replay(table, 0, 0, limit=2).collect()] == [0, 1]
    assert log.replay(table, 0, 0, limit=None).count() == 5
    assert "PartitionFilters: [isnotnull(partition_id" in plan(log.replay(table, 0, 2))


def test_rotation_keeps_newest_half_and_replay_clamps(spark, envelope):
    path, rotated = fresh_dir(spark, "t-log"), fresh_dir(spark, "t-rotated")
    log.append_log(spark, envelope(40), path, 1)
    log.rotate_log(spark, path, rotated, max_bytes=500)
    table = log.read_log(spark, rotated)
    assert table.agg(F.min("offset"), F.count("*")).first() == (20, 20)
    assert log.replay(table, 0, 0, limit=1).first().offset == 20
    log.append_log(spark, envelope(1, start=40), rotated, 1)
    assert log.read_log(spark, rotated).agg(F.max("offset")).first()[0] == 40


def test_rotation_below_the_cap_and_single_row(spark, envelope):
    small = log.assign_offsets(log.route(envelope(40), 1))
    assert log.retain_newest_half(small).count() == 40
    one = log.assign_offsets(log.route(envelope(1), 1))
    assert log.retain_newest_half(one, max_bytes=0).count() == 1


def test_stats_and_lag(spark, envelope):
    table = log.assign_offsets(log.route(envelope(4), 1))
    assert log.partition_stats(table).first().lag == 4
    committed = spark.createDataFrame([(0, 1)], "partition_id int, committed_offset long")
    stats = log.partition_stats(table, committed).first()
    assert (stats.lag, stats.total_produced, stats.total_consumed) == (3, 4, 1)


def test_scan_skips_what_cannot_be_read(spark, tmp_path):
    good = {"offset": 0, "event_id": "e", "event_type": "refund", "timestamp": 1000.123456, "user_id": "u",
            "session_id": "s", "data": {"amount": 1.5, "unknown": [1]}}
    lines = [json.dumps(good), "", "   ", "{broken", json.dumps(good)[:-5],
             *[json.dumps({k: v for k, v in good.items() if k != missing})
               for missing in ("offset", "event_id", "timestamp", "session_id", "data")],
             json.dumps({**good, "offset": 1, "partition_key": "k", "data": {}})]
    (tmp_path / "p.log").write_text("\n".join(lines) + "\n")
    scanned = log.scan_log(spark, str(tmp_path))
    assert rows(scanned, "offset", "partition_key", "data.amount") == [(0, "", 1.5), (1, "k", None)]
    assert scanned.select(F.unix_micros("timestamp")).first()[0] == 1_000_123_456
    assert log.rejected_lines(spark, str(tmp_path)).count() == 7


def test_json_round_trip(spark, events):
    flat = events({"event_type": "purchase", "amount": 9.99, "at": 0.123456}, {"at": 1})
    placed = log.assign_offsets(log.route(to_envelope(flat), 2))
    path = fresh_dir(spark, "t-json")
    log.append_json_log(placed, path)
    cols = ["partition_id", "offset", "event_id", "timestamp", "data.amount", "data.country"]
    assert rows(log.scan_log(spark, path), *cols) == rows(placed, *cols)


def test_state_log_keeps_event_entries(spark, tmp_path):
    entries = [{"ts": 1.5, "op": "event", "event_id": "a", "event_type": "page_view", "user_id": "u", "data": {}},
               {"ts": 2.0, "op": "other"}, {"event_id": "no op"}]
    (tmp_path / "state.log").write_text("\n".join([json.dumps(e) for e in entries] + ["{", ""]))
    assert rows(log.scan_state_log(spark, str(tmp_path)), "event_id") == [("a",)]


def test_metrics_from_a_replayed_log(spark, events):
    """Log, scan, flatten, deduplicate, aggregate: the same totals as from the flat events."""
    from eventlens.operators import dedup, metrics
    flat = events(*[{"event_type": "purchase", "amount": 5.25, "event_id": f"e_{i // 2}", "at": i} for i in range(10)])
    path = fresh_dir(spark, "t-flow")
    log.append_json_log(log.assign_offsets(log.route(to_envelope(flat), 3)), path)
    replayed = log.flatten(log.scan_log(spark, path))
    assert set(flat.columns) - {"copy"} <= set(replayed.columns)
    want = metrics.kpi_totals(dedup.dedup_window(flat)).first()
    assert want.total_orders == 5
    assert metrics.kpi_totals(dedup.dedup_window(replayed)).first() == want


def test_payload_keys_outside_the_schema_stay(spark, envelope):
    """Through scan, parquet append, rotation and JSON append; `get` reads them."""
    own = {"amount": 5.5, "coupon": "x \u00e9 \"q\"", "score": 7, "deep": {"a": [1, {"b": None}]}, "items": "many"}
    lines = [json.dumps({"offset": i, "event_id": f"e_{i}", "event_type": "purchase", "timestamp": 1.0 + i, "user_id": "u",
                         "session_id": "s", "data": d, "partition_key": "u"}) for i, d in enumerate([own, {"amount": 1.0}])]
    first, table, rotated, second = (fresh_dir(spark, "t-raw") for _ in range(4))
    spark.createDataFrame([(0, line) for line in lines], "partition_id int, value string").write.partitionBy(
        "partition_id").text(first)
    scanned = log.scan_log(spark, first).drop("partition_id", "offset")
    log.append_log(spark, envelope(3), table, N, arrival=["event_id"])
    log.append_log(spark, scanned, table, N, arrival=["event_id"])
    log.rotate_log(spark, table, rotated)
    log.append_json_log(log.read_log(spark, rotated), second)
    written = {e["event_id"]: e["data"] for e in map(json.loads, (r.value for r in spark.read.text(second).collect()))}
    assert written.pop("e_0") == own and written.pop("e_1") == {"amount": 1.0}
    assert list(written.values()) == [{"page": "/p"}] * 3
    again = log.scan_log(spark, second).where("event_id in ('e_0', 'e_1')")
    for frame in (again, log.flatten(again)):
        data = EventColumns(frame).data
        got = rows(frame, data.get("coupon"), data.get("score", 0), data.get("amount", 0.0), data.has("deep"))
        assert got == sorted([(own["coupon"], 7, 5.5, True), (None, 0, 1.0, False)], key=repr)
