"""Windows that late values correct, over micro-batches in any order."""

import random

from pyspark.sql import functions as F

from conftest import at, rows
from eventlens.session import fresh_dir
from eventlens.streaming import events as streams
from eventlens.streaming.revised_windows import RevisedWindows


def total():
    return {"result": (F.sum("amount").cast("double"), F.sum), "least": (F.min("amount"), F.min)}


def sale(seconds, amount=10.0):
    return {"event_type": "purchase", "amount": amount, "at": seconds}


def emitted(handler):
    start = F.unix_seconds("window_start") - int(at(0).timestamp())
    return sorted(rows(handler.revisions(), start, "revision", "result", "count"))


def test_late_values_emit_the_whole_window_again(spark, events):
    handler = RevisedWindows(spark, fresh_dir(spark, "t-revised"), 60, total())
    handler(events(sale(1), sale(59), sale(61)), 0)
    assert emitted(handler) == [(0, 0, 20.0, 2)]
    handler(events(sale(2, 5.0), sale(62)), 1)  # its window was emitted
    handler(events(sale(3, 1.0), sale(4, 2.0), sale(200)), 2)
    handler(events(sale(3, 1.0), sale(4, 2.0), sale(200)), 2)  # a retry
    handler(events(sale(0)).limit(0), 3)
    assert emitted(handler) == [(0, 0, 20.0, 2), (0, 1, 25.0, 3), (0, 2, 28.0, 5), (60, 0, 20.0, 2)]
    assert rows(handler.current(), "revision", "result", "least") == rows(
        handler.current().where("revision in (0, 2)"), "revision", "result", "least")
    assert handler.current().where("revision = 2").first().least == 1 and handler.lost() == 0


def test_newest_first(spark, events):
    handler = RevisedWindows(spark, fresh_dir(spark, "t-revised"), 60, total())
    for number, start in enumerate((240, 120, 0)):
        handler(events(sale(start), sale(start + 70)), number)
    assert emitted(handler) == [(0, 0, 10.0, 1), (60, 0, 10.0, 1), (120, 0, 10.0, 1), (180, 0, 10.0, 1), (240, 0, 10.0, 1)]


def test_the_newest_revisions_are_the_batch_result(spark, events):
    rng = random.Random(2)
    given = [sale(rng.randrange(50_000), rng.randrange(9) * 1.0) for _ in range(300)] + [sale(60_000, 0.0)]
    work = fresh_dir(spark, "t-revised")
    handler = RevisedWindows(spark, f"{work}/windows", 60, total(), delay_seconds=30)
    schema = events({}).schema
    for part in (given[:120], given[120:121], given[121:]):
        streams.land([events(*part)], f"{work}/in")
        streams.run_batches(streams.read_landed(spark, f"{work}/in", schema), handler, f"{work}/ckpt")
    want = events(*given).groupBy(F.window("ingest_ts", "60 seconds").alias("w")).agg(
        F.sum("amount").cast("double").alias("result"), F.count("*").alias("count")).where(F.col("w.end") <= F.lit(at(59_970)))
    assert rows(handler.current(), "window_start", "result", "count") == rows(want, "w.start", "result", "count")
    assert handler.revisions().groupBy("window_start", "revision").count().where("count > 1").isEmpty()


def test_state_is_dropped_after_its_time(spark, events):
    handler = RevisedWindows(spark, fresh_dir(spark, "t-revised"), 60, total(), keep_seconds=600)
    for number, second in enumerate((0, 30_000, 60_000)):
        handler(events(sale(second), sale(second + 61)), number)
    handler(events(sale(1), sale(59_990)), 3)  # the first is lost, the second within the time
    assert handler.lost() == 1
    assert rows(handler.current().where("revision > 0"), "result") == []
    spans = {r.span for r in spark.read.parquet(f"{handler.path}/partials").select("span").collect()}
    assert len(spans) <= 2
