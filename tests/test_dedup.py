import random

import pytest
from pyspark.sql import functions as F

from conftest import at, plan, rows
from eventlens import session
from eventlens.operators import dedup


def deliveries(spark, arrivals):
    """arrivals: (id, microseconds, copy)"""
    df = spark.createDataFrame(arrivals, "event_id string, us long, copy int")
    return df.withColumn("ingest_ts", F.timestamp_micros("us"))


def expected(arrivals, width=30_000_000):
    """The rule, one delivery at a time."""
    last, kept = {}, []
    for key, us, copy in sorted(arrivals, key=lambda a: (a[1], a[0] or "", a[2])):
        if key not in last or us - last[key] >= width:
            last[key] = us
            kept.append((key, us, copy))
    return sorted(kept, key=repr)


def random_arrivals(seed, n=3000):
    """A third of all rows share one id, others come once or a few times; some at equal times."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice([f"e_{i}", f"few_{rng.randrange(200)}", None])
        us = rng.choice([rng.randrange(0, 3_600_000_000), rng.randrange(0, 120) * 15_000_000])
        out.append((key, us, i))
    return out


def accepted(df, **options):
    return rows(dedup.dedup_window(df, **options), "event_id", "us", "copy")


@pytest.mark.parametrize("fold_limit", [0, 5, 1000])
def test_matches_the_rule_on_skewed_data(spark, fold_limit):
    arrivals = random_arrivals(fold_limit)
    assert accepted(deliveries(spark, arrivals), fold_limit=fold_limit) == expected(arrivals)


def test_matches_the_rule_without_broadcast(spark, monkeypatch):
    """Large id sets: joins are shuffled and the busiest ids split off."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(dedup, "BUSY_ROWS", 100)
    arrivals = random_arrivals(7)
    assert accepted(deliveries(spark, arrivals), fold_limit=50) == expected(arrivals)


def test_times_before_the_epoch_and_far_gaps(spark):
    us = [-90_000_001, -70_000_000, -1, 0, 29_999_998, 29_999_999, 3_000_000_000, 5 * 10**15]
    arrivals = [("a", t, i) for i, t in enumerate(us)]
    assert accepted(deliveries(spark, arrivals), fold_limit=0) == expected(arrivals)


def test_window_is_anchored_at_the_accepted_delivery(spark):
    """20 s steps: a repeat does not renew the window, so every second one is accepted."""
    arrivals = [("a", i * 20_000_000, 0) for i in range(6)]
    assert [us for _, us, _ in accepted(deliveries(spark, arrivals))] == [0, 40_000_000, 80_000_000]


def test_exactly_the_window_is_accepted(spark):
    arrivals = [("a", 0, 0), ("a", 29_999_999, 1), ("a", 30_000_000, 2)]
    assert accepted(deliveries(spark, arrivals)) == [("a", 0, 0), ("a", 30_000_000, 2)]


def test_no_repeats_passes_everything(spark):
    arrivals = [(f"e_{i}", i, 0) for i in range(5)]
    assert accepted(deliveries(spark, arrivals)) == expected(arrivals)


def test_first_delivery_keeps_one_per_id(spark):
    df = deliveries(spark, [("a", 5, 1), ("a", 5, 0), ("a", 9, 2), ("b", 1, 0)])
    assert rows(dedup.first_delivery(df), "event_id", "us", "copy") == [("a", 5, 0), ("b", 1, 0)]


def test_first_delivery_drops_repeats_before_the_shuffle(spark):
    df = deliveries(spark, [("a", 5, 1)])
    text = plan(dedup.first_delivery(df))
    assert text.count("WindowGroupLimit") == 2


def test_report(spark):
    raw = deliveries(spark, [("a", 0, 0), ("a", 1, 1), ("b", 0, 0), ("b", 60_000_000, 2)])
    report = dedup.dedup_report(raw, dedup.dedup_window(raw), F.count_if(F.col("copy") > 0)).first()
    assert tuple(report) == (4, 3, 1, 2, 50)
    none = dedup.dedup_report(raw, dedup.dedup_window(raw), 0).first()
    assert none.dedup_effectiveness_pct is None
    over = dedup.dedup_report(raw, dedup.first_delivery(raw), 1).first()
    assert over.dedup_effectiveness_pct == 100


@pytest.mark.parametrize("seed", range(3))
def test_next_arrival_over_all_levels(spark, seed):
    """Narrow groups, so that the search has to climb."""
    rng = random.Random(seed)
    times = sorted(rng.sample(range(-5000, 100_000), 120))
    arrivals = spark.createDataFrame([("a", t) for t in times], "_cid string, _t long")
    asked = sorted(rng.sample(range(-6000, 110_000), 300))
    queries = spark.createDataFrame([("a", q) for q in asked], "_cid string, _q long")
    got = {r._q: r._next for r in dedup.next_arrival(arrivals, queries, (10, 500, None)).collect()}
    assert got == {q: next((t for t in times if t >= q), None) for q in asked}


def test_rows_delivered_once_are_not_shuffled(spark):
    """With few repeated ids the pass-through branch is a scan and a broadcast join."""
    source = session.materialize(deliveries(spark, [(f"e_{i // 2}", i, 0) for i in range(20)]))
    text = dedup.dedup_window(source)._jdf.queryExecution().executedPlan().toString()
    passed = text[: text.index("LeftAnti") + text[text.index("LeftAnti"):].index("LeftSemi")]
    assert "BroadcastHashJoin" in passed and "Exchange hashpartitioning" not in passed
    assert "CartesianProduct" not in text


def test_window_without_end_equals_first_delivery(spark):
    arrivals = random_arrivals(11)
    df = deliveries(spark, arrivals)
    first = rows(dedup.first_delivery(df), "event_id", "us", "copy")
    assert accepted(df, window_seconds=None) == first
