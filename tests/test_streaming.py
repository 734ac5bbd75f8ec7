import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from eventlens.operators import dedup, state as st
from eventlens.operators.pipeline import Pipeline
from eventlens.session import fresh_dir, materialize
from eventlens.sources.snapshots import StateTable
from eventlens.streaming import events as streams, maintain
from eventlens.streaming.exact_dedup import RollingDedup


class Feed:
    """A landing folder and the queries over it."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.work = spark, schema, fresh_dir(spark, "t-stream")

    def land(self, *frames):
        streams.land(list(frames), f"{self.work}/in")

    def stream(self, **limits):
        return streams.read_landed(self.spark, f"{self.work}/in", self.schema, **limits)

    def run(self, df, name="out"):
        return streams.run_to_file(df, f"{self.work}/{name}", f"{self.work}/{name}-ckpt")

    def out(self, name="out"):
        return self.spark.read.schema(self.schema).parquet(f"{self.work}/{name}")


@pytest.fixture
def feed(spark, events):
    return Feed(spark, events({}).schema)


def purchase(i, seconds, **more):
    return {"event_id": f"e_{i}", "event_type": "purchase", "amount": 10.0, "at": seconds, **more}


def test_bounded_reads(spark, events, feed):
    feed.land(*[events(purchase(i, i)).coalesce(1) for i in range(4)])
    query = feed.run(feed.stream(max_files=1))
    sizes = [r.input_rows for r in streams.progress(spark, query).orderBy("batch_id").collect() if r.input_rows]
    assert sizes == [1, 1, 1, 1]
    assert feed.out().count() == 4


def test_repeat_in_the_window_is_dropped_across_a_restart(spark, events, feed):
    feed.land(events(purchase(0, 0), purchase(1, 1)))
    feed.run(streams.dedup_stream(feed.stream()))
    feed.land(events(purchase(1, 5, copy=1), purchase(2, 6)))
    query = feed.run(streams.dedup_stream(feed.stream()))
    assert rows(feed.out(), "event_id", "copy") == [("e_0", 0), ("e_1", 0), ("e_2", 0)]
    assert streams.progress(spark, query).agg(F.sum("dropped")).first()[0] == 1


def test_every_batch_is_reported_and_late_rows_apart(spark, events, feed):
    """Over more micro-batches than Spark keeps reports of, with a restart."""
    cap = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(cap, "2")
    try:
        for part in ([0, 0, 1, 2, 3], [200], [4]):  # the last comes behind the watermark
            feed.land(*[events(purchase(i, i)).coalesce(1) for i in part])
            query = streams.run_to_file(
                streams.dedup_stream(feed.stream(max_files=1)), f"{feed.work}/out", f"{feed.work}/ckpt", f"{feed.work}/report")
            assert len(query.recentProgress) <= 2
    finally:
        spark.conf.unset(cap)
    report = streams.reported(spark, f"{feed.work}/report")
    assert rows(report.agg(F.sum("input_rows"), F.sum("dropped"), F.sum("late"))) == [(7, 1, 1)]
    ids = [r.batch_id for r in report.orderBy("batch_id").collect()]
    assert ids == list(range(len(ids))) and len(ids) >= 7


def test_pipeline_sink_on_a_stream(events, feed):
    feed.land(events(purchase(0, 0), {"event_type": "page_view"}))
    Pipeline().filter(lambda e: e.event_type == "purchase").sink(feed.run).process_batch(feed.stream())
    assert feed.out().count() == 1


def test_window_closes_once_and_late_rows_are_left_out(spark, events, feed):
    total = [F.sum("amount").cast("double").alias("result")]

    def run():
        stream = feed.stream().withWatermark("ingest_ts", "30 seconds")
        feed.run(streams.windowed_stream(stream, 60, total), "windows")

    feed.land(events(purchase(0, 1), purchase(1, 59), purchase(2, 61)))
    run()
    feed.land(events(purchase(3, 200)))
    run()
    feed.land(events(purchase(4, 2)))  # its window was emitted
    run()
    done = spark.read.parquet(f"{feed.work}/windows")
    assert rows(done, "result", "count") == [(10.0, 1), (20.0, 2)]


def test_exact_dedup_equals_batch(spark, events, feed):
    """Hot id over three batches, resends before and after the window ends."""
    times = [(f"hot" if i % 3 == 0 else f"e_{i % 40}", i * 1.7) for i in range(180)]
    frames = [events(*[{"event_id": k, "at": t, "copy": n} for n, (k, t) in enumerate(times) if n // 60 == b])
              for b in range(3)]
    handler = RollingDedup(spark, f"{feed.work}/exact")
    for frame in frames:
        feed.land(frame)
        streams.run_batches(feed.stream(), handler, f"{feed.work}/exact-ckpt")
    whole = frames[0].union(frames[1]).union(frames[2])
    want = rows(dedup.dedup_window(whole), "event_id", "copy")
    assert rows(handler.accepted(), "event_id", "copy") == want
    assert tuple(handler.report().first()) == (180, len(want), 180 - len(want))


def test_exact_dedup_of_an_original_after_its_resend(spark, events, feed):
    """The resend's batch has rows far newer than it; the original 10 s before it comes late."""
    handler = RollingDedup(spark, f"{feed.work}/exact")
    handler(events(purchase(0, 10, copy=1), purchase(1, 45, copy=2), purchase(2, 50_000)), 0)
    handler(events(purchase(3, 90_000)), 1)
    handler(events(purchase(0, 0), purchase(1, 0), purchase(4, 5)), 2)
    handler(events(purchase(1, 20), purchase(2, 50_029), purchase(3, 89_970)), 3)
    assert rows(handler.accepted(), "event_id", "copy") == [
        ("e_0", 1), ("e_1", 0), ("e_1", 2), ("e_2", 0), ("e_3", 0), ("e_3", 0), ("e_4", 0)]
    assert tuple(handler.report().first()) == (10, 7, 3)


def test_exact_dedup_retry_of_a_batch(spark, events, feed):
    handler = RollingDedup(spark, f"{feed.work}/exact")
    first, second = events(purchase(0, 0)), events(purchase(0, 10), purchase(1, 11))
    handler(first, 0)
    handler(second, 1)
    handler(second, 1)
    assert rows(handler.accepted(), "event_id") == [("e_0",), ("e_1",)]
    assert tuple(handler.report().first()) == (3, 2, 1)


def test_failed_batch_is_repeated_without_double_counting(spark, events, feed):
    table = StateTable(spark, f"{feed.work}/state")
    fold = maintain.fold_batches(table)

    def fails_after_writing(batch, batch_id):
        fold(batch, batch_id)
        raise RuntimeError("lost after the write")

    feed.land(events(purchase(0, 0), purchase(1, 1)))
    with pytest.raises(Exception, match="lost after the write"):
        streams.run_batches(streams.dedup_stream(feed.stream()), fails_after_writing, f"{feed.work}/ckpt")
    feed.land(events(purchase(1, 4, copy=1), purchase(2, 5)))
    streams.run_batches(streams.dedup_stream(feed.stream()), fold, f"{feed.work}/ckpt")
    kpi = st.kpis(table.read().partials).first()
    assert (kpi.total_events, kpi.total_revenue) == (3, 30.0)


def test_publishing(spark, events, feed):
    table = StateTable(spark, f"{feed.work}/state")
    publish = maintain.publish_batches(table, f"{feed.work}/published", batches_per_base=2)
    assert maintain.published_snapshot(spark, f"{feed.work}/published") is None
    for i in range(3):
        publish(events(purchase(i, i), purchase(i + 100, i)), i)
    publish(events({}).limit(0), 3)
    snap = {r.metric: r.value for r in maintain.published_snapshot(spark, f"{feed.work}/published").collect()}
    assert (snap["total_events"], snap["total_revenue"], snap["current_eps"]) == (6, 60.0, 2)
    history = maintain.metric_history(spark, f"{feed.work}/published", n=2).collect()
    assert [(r.batch_id, r.current_eps, r.avg_eps_5s) for r in history] == [(1, 2, 2.0), (2, 2, 2.0)]
    assert table.latest().high_water == 1


def test_ingest_stamp_and_processing_time_trigger(spark, events, feed):
    """The stamp carries a watermark; a timed query runs until it is stopped."""
    seen = []
    feed.land(events(purchase(0, 0)).coalesce(1))
    stamped = streams.stamp_ingest(feed.stream()).withWatermark("ingest_ts", "30 seconds")
    query = streams.run_batches(
        stamped, lambda df, _: seen.extend(df.select("event_id").collect()), f"{feed.work}/ckpt", every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert [r.event_id for r in seen] == ["e_0"]


def test_an_empty_frame_has_empty_slices(events):
    empty = events({}).limit(0)
    assert [part.count() for part in streams.split_by_time(empty, 3)] == [0, 0, 0]


def test_a_long_batch_leaves_few_files_and_is_spread_over_the_cores(spark, events, feed):
    """A hundred hours in one batch: no folder for each hour. What one task wrote, many can read."""
    handler = RollingDedup(spark, f"{feed.work}/exact")
    handler(events(*[purchase(n, 3600 * n) for n in range(100)]), 0)
    handler(events(purchase(5, 3600 * 5 + 10, copy=1), purchase(6, 3600 * 6 + 40, copy=1), purchase(200, 7)), 1)
    assert tuple(handler.report().first()) == (103, 102, 1)
    assert len(spark.read.parquet(f"{feed.work}/exact/seen/batch_id=0").inputFiles()) <= 8
    written = materialize(spark.range(0, 250_000, 1, 1), "batch", spread=True)
    assert written.count() == 250_000 and len(written.inputFiles()) == 3
