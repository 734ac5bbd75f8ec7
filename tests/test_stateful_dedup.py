"""The bounded stream dedup: any order of arrival, restarts, state that does not grow."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from eventlens.operators import dedup, state as st
from eventlens.session import fresh_dir
from eventlens.sources.snapshots import StateTable
from eventlens.streaming import events as streams, maintain
from eventlens.streaming.stateful_dedup import dedup_in_order, keyed_state


class Feed:
    def __init__(self, spark, events, lateness, **options):
        self.spark, self.events, self.work = spark, events, fresh_dir(spark, "t-ordered")
        self.lateness, self.options, self.schema = lateness, options, events({}).schema

    def run(self, *batches, **limits):
        """Land each list of rows as one file and run until the stream has read them."""
        for batch in batches:
            streams.land([self.events(*batch).coalesce(1)], f"{self.work}/in")
        stream = streams.read_landed(self.spark, f"{self.work}/in", self.schema, **limits)
        flagged = dedup_in_order(
            stream, lateness_seconds=self.lateness, heartbeat=F.col("event_type") == "heartbeat", buckets=4, **self.options)
        with keyed_state(self.spark):
            return streams.run_to_file(flagged, f"{self.work}/out", f"{self.work}/ckpt")

    def beat(self, seconds):
        return self.run([{"event_type": "heartbeat", "at": seconds}])

    def out(self):
        return self.spark.read.parquet(f"{self.work}/out")


def deliveries(seed, n=150):
    """Few ids, so that chains of accepted and rejected deliveries, and ties, are long."""
    rng = random.Random(seed)
    return [{"event_id": f"e_{rng.randrange(12)}", "at": rng.randrange(600) / 2, "copy": i, "amount": 1.5} for i in range(n)]


@pytest.mark.parametrize("order", ["in time", "newest first", "shuffled"])
def test_every_order_gives_the_batch_rule(spark, events, order):
    given = deliveries(5)
    arrived = sorted(given, key=lambda r: r["at"], reverse=order == "newest first") if order != "shuffled" else given
    feed = Feed(spark, events, lateness=400)
    feed.run(*[arrived[i:i + 50] for i in (0, 50)], max_files=1)
    feed.run(arrived[100:])
    feed.beat(2_000)
    want = dedup.dedup_window(events(*given))
    out = feed.out()
    assert rows(out.where("not is_duplicate"), "event_id", "copy", "ingest_ts", "amount") == rows(
        want, "event_id", "copy", "ingest_ts", "amount")
    assert out.count() == len(given)


def test_rows_wait_for_the_watermark_and_late_ones_are_reported(spark, events):
    feed = Feed(spark, events, lateness=60)
    feed.run([{"event_id": "a", "at": 100}, {"event_id": "b", "at": 170}])
    assert rows(feed.out(), "event_id") == [("a",)]  # b may still be preceded
    feed.run([{"event_id": "b", "at": 150}, {"event_id": "a", "at": 129}])
    query = feed.run([{"event_id": "c", "at": 50}])  # more than the bound behind: left out
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 1
    feed.beat(500)
    assert rows(feed.out(), "event_id", "ingest_ts", "is_duplicate") == rows(spark.createDataFrame(
        [("a", at(100), False), ("a", at(129), True), ("b", at(150), False), ("b", at(170), True)],
        "event_id string, ingest_ts timestamp, is_duplicate boolean"))


def test_state_does_not_grow_with_the_stream(spark, events):
    feed = Feed(spark, events, lateness=20)
    batches = [[{"event_id": f"e_{b}.{i}", "at": b * 10 + i % 10} for i in range(20)] for b in range(14)]
    query = feed.run(*batches, max_files=1)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(kept) >= 14 and max(kept[5:]) <= max(kept[:5]) + 4
    feed.beat(10_000)
    query = feed.beat(20_000)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0
    assert feed.out().where("not is_duplicate").count() == 280


def test_null_ids_are_one_id(spark, events):
    feed = Feed(spark, events, lateness=10)
    feed.run([{"event_id": None, "at": 1}, {"event_id": None, "at": 5}, {"event_id": "x", "at": 2}])
    feed.beat(500)
    assert rows(feed.out().where("not is_duplicate"), "event_id", "ingest_ts") == rows(spark.createDataFrame(
        [(None, at(1)), ("x", at(2))], "event_id string, ingest_ts timestamp"))


def test_the_state_of_metrics_behind_it(spark, events):
    feed = Feed(spark, events, lateness=10)
    table = StateTable(spark, f"{feed.work}/state")
    given = [{"event_id": f"e_{i % 7}", "event_type": "purchase", "amount": 10.0, "at": i} for i in range(20)]
    streams.land([events(*given), events({"event_type": "heartbeat", "at": 900})], f"{feed.work}/in")
    stream = streams.read_landed(spark, f"{feed.work}/in", feed.schema)
    with keyed_state(spark):
        streams.run_batches(
            dedup_in_order(stream, lateness_seconds=10, heartbeat=F.col("event_type") == "heartbeat"),
            maintain.fold_batches(table), f"{feed.work}/ckpt")
    kpi = st.kpis(table.read().partials).first()
    assert (kpi.total_events, kpi.total_revenue) == (7, 70.0)
    duplicates = table.read().partials.where("kind = 'duplicates'").agg(F.sum("events")).first()[0]
    assert duplicates == 13


class _Store:
    """State and timers of one key, counting the calls."""

    def __init__(self):
        self.values, self.meta, self.calls = {}, None, 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        store = self

        class Value:
            exists = staticmethod(lambda: store.meta is not None)
            get = staticmethod(lambda: store.meta)
            update = staticmethod(lambda value: setattr(store, "meta", value))
            clear = staticmethod(lambda: setattr(store, "meta", None))

        return Value

    def registerTimer(self, ms):
        pass

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key] = value

    def getValue(self, key):
        self.calls += 1
        return self.values[key]

    def removeKey(self, key):
        self.calls += 1
        del self.values[key]

    def keys(self):
        return iter(list(self.values))

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_calls_to_the_store_follow_the_rows_and_not_the_time_they_span(monkeypatch):
    import pandas as pd
    from eventlens.streaming import stateful_dedup

    monkeypatch.setattr(stateful_dedup, "PART_ROWS", 100)
    store, rng = _Store(), random.Random(3)
    processor = stateful_dedup._InOrder(30_000_000)
    processor.init(store)
    given = [(rng.randrange(10**6) * 1_000_000, f"e{rng.randrange(40)}", '{"copy":%d}' % i, str(i)) for i in range(1000)]
    given += [(us + 10_000_000, name, tie, packed + "x") for us, name, tie, packed in given[:300]]
    rng.shuffle(given)
    for part in (given[:650], given[650:]):
        frame = pd.DataFrame(part, columns=["us", "id", "tie", "packed"])
        processor.handleInputRows(("k",), iter([frame]), store)
    out = []
    for store.watermark in (0, 3 * 10**8, 10**9 + 10**5):
        out += [tuple(r) for f in processor.handleExpiredTimer(("k",), store, None) for r in f.itertuples(index=False)]
    want, last = [], {}
    for us, name, tie, packed in sorted(given, key=lambda r: (r[0], r[1], stateful_dedup._rank(r))):
        accepted = name not in last or us - last[name] >= 30_000_000
        last |= {name: us} if accepted else {}
        want.append((packed, not accepted))
    assert out == want and any(flag for _, flag in out)
    assert not store.values and store.calls < 60


def test_rows_come_back_as_they_were(spark):
    from eventlens.streaming.stateful_dedup import FLAG, _packed, _unpacked

    df = spark.sql("""SELECT * FROM VALUES
      (9007199254740993L, timestamp'2024-01-01 00:00:00.123456', timestamp_ntz'2024-01-01 00:00:00.123456', double('NaN'), 0.1D,
       cast('12345678901234.12' AS decimal(18,2)), 'a"\\\n\u00e9', named_struct('x', timestamp'1900-01-01 00:00:00.000001', 'y', X'00FF')),
      (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL), (1L, NULL, NULL, double('-Infinity'), 1e300D, 0.10, '', NULL)""")
    back = _unpacked(df.select(_packed(df.schema).alias("packed"), F.lit(False).alias(FLAG)), df.schema).drop(FLAG)
    assert [f.dataType.simpleString() for f in back.schema] == [f.dataType.simpleString() for f in df.schema]
    assert repr(rows(back)) == repr(rows(df))  # NaN is not equal to itself
