import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from conftest import at, plan, rows
from eventlens.operators import derived, metrics, timeseries as ts


def test_revenue_orders_and_average(events):
    df = events({"event_type": "purchase", "amount": 50.0}, {"event_type": "purchase", "amount": 75.0},
                {"event_type": "purchase"}, {"event_type": "page_view"})
    kpi = metrics.kpi_totals(df).first()
    assert (kpi.total_events, kpi.total_revenue, kpi.total_orders, kpi.avg_order_value) == (4, 125.0, 3, 41.67)


def test_refunds_do_not_reduce_revenue(events):
    df = events({"event_type": "purchase", "amount": 8.75}, {"event_type": "refund", "amount": 3.25})
    kpi = metrics.kpi_totals(df).first()
    assert (kpi.total_revenue, kpi.refunds, kpi.refund_amount) == (8.75, 1, 3.25)
    assert derived.refund_rate(df).first().refund_rate_pct == 100.0


def test_no_events_at_all(events):
    empty = events({}).limit(0)
    assert tuple(metrics.kpi_totals(empty).first()) == (0, 0.0, 0, 0.0, 0, 0.0)
    assert metrics.active_users(empty).first()[0] == 0
    assert [r.event_count for r in metrics.funnel(empty).collect()] == [0] * 5
    assert derived.refund_rate(empty).first().refund_rate_pct == 0.0
    assert tuple(ts.current_rate(ts.events_per_second(empty)).first()) == (0, 0.0)
    assert tuple(ts.latency_percentiles(empty).first()) == (0.0, 0.0, 0.0)


def test_active_users_skips_blank(events):
    df = events({"user_id": "u_1"}, {"user_id": "u_2"}, {"user_id": "u_1"}, {"user_id": ""}, {"user_id": None})
    assert metrics.active_users(df).first()[0] == 2
    assert metrics.active_users_approx(df).first()[0] == 2


def test_top_k_counts_present_purchases_only(events):
    df = events({"event_type": "purchase", "product_name": "b"}, {"event_type": "purchase", "product_name": "a"},
                {"event_type": "purchase", "product_name": ""}, {"event_type": "purchase"},
                {"event_type": "product_click", "product_name": "a"})
    assert [(r.product_name, r.event_count) for r in metrics.top_products(df).collect()] == [("b", 1), ("a", 1)]


def test_top_k_ties_go_to_the_first_seen(events):
    df = events(*[{"country": c} for c in ["DE", "US", "FR", "US", "FR", "JP"]])
    got = [(r.country, r.event_count) for r in metrics.geo_distribution(df, 3).collect()]
    assert got == [("US", 2), ("FR", 2), ("DE", 1)]


def test_devices_terms_and_nulls(events):
    df = events({"event_type": "search_query", "query": "q1"}, {"event_type": "page_view", "query": "q2"},
                {"device": None}, {"event_type": "search_query", "query": "q1", "device": "tablet"})
    assert [(r["query"], r.event_count) for r in metrics.top_search_terms(df).collect()] == [("q1", 2)]
    assert rows(metrics.device_distribution(df)) == [("kiosk", 2), ("tablet", 1)]


def test_funnel_conversion(events):
    df = events(*[{"event_type": t} for t in ["page_view"] * 3 + ["product_click"] * 4 + ["purchase"]])
    got = derived.funnel_conversion(metrics.funnel(df)).orderBy("stage_no").collect()
    assert [r.event_count for r in got] == [3, 4, 0, 0, 1]
    assert [r.step_pct for r in got] == [None, 133.3, 0.0, 0.0, 100.0]
    assert [r.pct_of_max for r in got] == [75.0, 100.0, 0.0, 0.0, 25.0]


def test_shares(events):
    df = events(*[{"country": c, "device": d, "event_type": "purchase", "product_name": c}
                  for c, d in [("US", "a")] * 2 + [("DE", "b")]])
    assert rows(derived.geo_share(df)) == [("DE", 1, 33.3), ("US", 2, 66.7)]
    assert rows(derived.geo_share(df, k=1)) == [("US", 2, 100.0)]
    assert rows(derived.device_share(df)) == [("a", 2, 66.7), ("b", 1, 33.3)]
    assert rows(derived.product_relative(df)) == [("DE", 1, 50.0), ("US", 2, 100.0)]


def test_shards(spark):
    stats = spark.createDataFrame([(i, 10 * i, 7 * i, 3 * i) for i in range(5)],
                                  "partition_id int, total_produced long, total_consumed long, lag long")
    errors = spark.createDataFrame([(3, 2)], "partition_id int, errors long")
    got = rows(derived.shard_rollup(stats, 2, 5, errors))
    assert got == [(0, 3, 42, 0, 18), (1, 2, 28, 2, 12)]
    assert derived.shard_rollup(stats, 99, 5).count() == 5
    assert derived.shard_rollup(stats, 0, 5).count() == 1
    assert tuple(derived.broker_totals(stats).first()) == (100, 70, 30, False)
    assert derived.broker_totals(stats, alert_above=29).first().lag_alert
    health = derived.shard_health(derived.shard_rollup(stats.withColumn("lag", F.col("lag") * 500), 2, 5))
    assert rows(health, "shard_id", "band") == [(0, "red"), (1, "red")]


# --- series ----------------------------------------------------------------------

def test_minutes_without_purchase_are_zero_and_empty_ones_absent(events):
    df = events({"at": 10, "event_type": "purchase", "amount": 5.0}, {"at": 70}, {"at": 250})
    got = [(r.minute.minute, r.revenue, r.orders) for r in ts.per_minute(df).orderBy("minute").collect()]
    assert got == [(0, 5.0, 1), (1, 0.0, 0), (4, 0.0, 0)]


def test_recent_closed_leaves_out_the_open_bucket(events):
    df = events(*[{"at": i} for i in range(100)])
    recent = ts.recent_closed(ts.events_per_second(df), "second", 60)
    assert recent.agg(F.min("second"), F.max("second"), F.count("*")).select(
        F.unix_seconds("min(second)") - F.unix_seconds(F.lit(at(0))),
        F.unix_seconds("max(second)") - F.unix_seconds(F.lit(at(0))), "count(1)").first() == (39, 98, 60)
    assert ts.recent_closed(ts.events_per_second(df.limit(1)), "second").count() == 0


def test_current_rate_averages_what_exists(events):
    df = events({"at": 0}, {"at": 0.5}, {"at": 7})
    assert tuple(ts.current_rate(ts.events_per_second(df)).first()) == (1, 1.5)


@pytest.mark.parametrize("block", [5, 7, 1000])
def test_rolling_rate_equals_the_plain_window(spark, events, block):
    rng = random.Random(block)
    seconds = ts.events_per_second(events(*[{"at": rng.randrange(400)} for _ in range(300)]))
    from pyspark.sql import Window as W
    last_five = W.orderBy("second").rowsBetween(-4, 0)
    plain = seconds.withColumn("avg_eps_5s", F.round(F.avg("event_count").over(last_five), 2))
    assert rows(ts.rolling_rate(seconds, block=block)) == rows(plain)


def ring_model(latencies):
    ring, figures = deque(maxlen=500), (0.0, 0.0, 0.0)
    for i, x in enumerate(latencies, 1):
        ring.append(x)
        if i % 250 == 0:
            s = sorted(ring)
            n = len(s)
            figures = (s[int(n * 0.5)], s[min(int(n * 0.99), n - 1)], sum(s) / n)
    return figures


@pytest.mark.parametrize("n", [100, 249, 250, 260, 500, 1130])
def test_latency_ranks_equal_the_ring(spark, n):
    rng = random.Random(n)
    latencies = [rng.randrange(1000) for _ in range(n)]
    data = [(f"e_{i}", at(i - ms / 1000), at(i)) for i, ms in enumerate(latencies)]
    df = spark.createDataFrame(data, "event_id string, ts timestamp, ingest_ts timestamp")
    assert tuple(ts.latency_percentiles(df).first()) == pytest.approx(ring_model(latencies), abs=0.006)


def test_plans_of_the_metrics(events):
    df = events({})
    for top in (metrics.top_products(df), metrics.geo_distribution(df), ts.newest_latencies(df),
                ts.recent_closed(ts.events_per_second(df), "second")):
        assert "TakeOrderedAndProject" in plan(top)
    for hashed in (metrics.kpi_totals(df), ts.per_minute(df), metrics.key_counts(df, "country")):
        text = plan(hashed)
        assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "Python" not in text


def test_small_amounts_add_up_before_they_are_rounded(spark):
    df = spark.range(1000).selectExpr("'purchase' AS event_type", "0.004D AS amount")
    assert metrics.kpi_totals(df).first().total_revenue == 4.0


def test_amounts_that_are_none_do_not_stop_a_total(spark):
    df = spark.createDataFrame(
        [("purchase", v) for v in (2.5, float("nan"), float("inf"), 1e300, None)], "event_type string, amount double")
    kpi = metrics.kpi_totals(df).first()
    assert (kpi.total_revenue, kpi.total_orders) == (2.5, 5)
    assert metrics.rejected_amounts(df).first()[0] == 3
