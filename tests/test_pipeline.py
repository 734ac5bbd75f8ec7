import statistics

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from eventlens.operators.pipeline import MergeableAgg, Pipeline, python_map, python_predicate
from eventlens.schema import EVENT_SCHEMA


@pytest.fixture
def desk(events):
    return events({"event_type": "refund", "amount": 12.5, "at": 1}, {"event_type": "search_query", "at": 2},
                  {"event_type": "refund", "amount": 0.0, "at": 61}, {"event_type": "refund", "at": 62})


def test_empty_pipeline_passes_everything_to_the_sink(desk):
    received = []
    Pipeline().sink(received.append).process_batch(desk)
    assert rows(received[0]) == rows(desk)


def test_filter(desk):
    assert Pipeline().filter(lambda e: e.event_type == "refund").apply(desk).output.count() == 3
    assert Pipeline().filter(F.col("event_type") == "nothing").apply(desk).output.count() == 0


def test_map_replaces_the_event(desk):
    out = Pipeline().map(lambda e: e.event_type).apply(desk).output
    assert rows(out) == [("refund",), ("refund",), ("refund",), ("search_query",)]


def test_null_drops_and_zero_stays(desk):
    out = Pipeline().map(lambda e: e.data.get("amount").cast("double")).apply(desk).output
    assert rows(out) == [(0.0,), (12.5,)]


def test_filter_then_map(desk):
    pipeline = Pipeline().filter(lambda e: e.event_type == "refund").map(lambda e: e.data.get("amount", 0))
    assert sorted(float(r[0]) for r in pipeline.apply(desk).output.collect()) == [0.0, 0.0, 12.5]


def test_steps_after_a_map_see_the_value(desk):
    pipeline = Pipeline().map(lambda e: e.data.get("amount", 0)).filter(lambda v: v > 1).map(lambda v: v * 2)
    assert [float(r[0]) for r in pipeline.apply(desk).output.collect()] == [25.0]


def test_nested_payload(spark):
    df = spark.createDataFrame([("e", "refund", None, "u", "s", (None,) * 8 + (5.0,) + (None,) * 5, "")], EVENT_SCHEMA)
    pipeline = (Pipeline().filter(lambda e: e.data.has("amount")).filter(lambda e: ~e.data.has("country"))
                .map(lambda e: e.data["amount"]))
    assert rows(pipeline.apply(df).output) == [(5.0,)]


def test_absent_keys_give_the_default_on_both_shapes(spark, desk):
    nested = spark.createDataFrame([("e", "refund", None, "u", "s", (None,) * 14, "")], EVENT_SCHEMA)
    for df in (nested, desk):
        assert Pipeline().map(lambda e: e.data.get("voucher", "none")).apply(df).output.first()[0] == "none"


def test_no_sink_is_fine(desk):
    assert Pipeline().filter(lambda e: True).process_batch(desk).output.count() == 4


def test_aggregate_emits_windows_and_passes_values_on(desk):
    emitted = []
    pipeline = (Pipeline().filter(lambda e: e.event_type == "refund").map(lambda e: e.data.get("amount", 0))
                .aggregate(60, sum, emitted.append).filter(lambda v: v > 0))
    result = pipeline.process_batch(desk)
    assert [float(r.value) for r in result.output.collect()] == [12.5]
    got = emitted[0].orderBy("window_start").collect()
    assert [(float(r.result), r["count"]) for r in got] == [(12.5, 1), (0.0, 2)]
    assert [(r.window_end - r.window_start).seconds for r in got] == [60, 60]
    assert [r.window_start.second for r in got] == [0, 0]


@pytest.mark.parametrize("fn,want", [
    (len, [2, 2]), (min, [1.0, 3.0]), (max, [2.0, 5.0]), (statistics.mean, [1.5, 4.0]),
    (statistics.median, [1.5, 4.0]), (lambda v: F.max(v) - F.min(v), [1.0, 2.0]),
])
def test_window_functions(events, fn, want):
    df = events(*[{"amount": v, "at": t} for v, t in [(1.0, 0), (2.0, 59), (3.0, 60), (5.0, 61)]])
    table = Pipeline().map(lambda e: e.data["amount"].cast("double")).aggregate(60, fn).apply(df).windows[0]
    assert [r.result for r in table.orderBy("window_start").collect()] == want


def test_count_of_events_per_window(events):
    table = Pipeline().aggregate(60, len).apply(events({"at": 1}, {"at": 2}, {"at": 60})).windows[0]
    assert rows(table, "result", "count") == [(1, 1), (2, 2)]


def test_mergeable_aggregate(spark):
    """Geometric mean over windows spread across many tasks; one window holds a third of the rows."""
    df = spark.range(6000).select(
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 * 60)).alias("ingest_ts"),
        (F.col("id") % 7 + 1).cast("double").alias("value"),
    ).repartition(16)
    agg = MergeableAgg(
        "logs double, n long",
        partial=lambda v: (float(v.map(__import__("math").log).sum()), len(v)),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda s: __import__("math").exp(s[0] / s[1]),
    )
    got = Pipeline().map(lambda e: e.value).aggregate(60, agg).apply(df).windows[0]
    want = (df.groupBy(F.window("ingest_ts", "60 seconds").start.alias("window_start"))
            .agg(F.exp(F.avg(F.log("value"))).alias("want"), F.count("*").alias("n")))
    both = got.join(want, "window_start").collect()
    assert len(both) == got.count() == want.count() == 50
    assert all(r.result == pytest.approx(r.want) and r["count"] == r.n for r in both)


def test_python_escape_hatches(desk):
    pipeline = (Pipeline()
                .filter(python_predicate(lambda b: b["event_type"].str.startswith("r"), "event_type"))
                .map(python_map(lambda b: b["event_type"].str.len(), "int", "event_type")))
    assert rows(pipeline.apply(desk).output) == [(6,), (6,), (6,)]


def test_filter_and_projection_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("value", "amount")
    text = plan(Pipeline().filter(lambda e: e.event_type == "refund").map(lambda e: e.amount).apply(df).output)
    assert "EqualTo(event_type,refund)" in text and "IsNotNull(value)" in text
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert "Python" not in text


def test_event_time_of_flat_and_nested_events(spark, desk):
    flat = Pipeline().map(lambda e: F.unix_seconds(e.timestamp)).apply(desk).output
    nested = Pipeline().map(lambda e: F.unix_seconds(e.timestamp)).apply(desk.withColumnRenamed("ts", "timestamp")).output
    assert rows(flat) == rows(nested) and flat.count() == 4
