"""Exact ranks against sorting, with bounds so small that every step is taken."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventlens.operators import quantiles
from eventlens.operators.pipeline import Pipeline

rng = random.Random(4)
GROUPS = {
    "even": [rng.random() for _ in range(1_200)], "skewed": [10.0 ** rng.randrange(-300, 300) for _ in range(901)],
    "hot": [5.0] * 2_500 + [rng.random() * 10 for _ in range(500)], "one": [1.5], "two": [2.0, -2.0],
    "halves": [1.0] * 1_500 + [9.0] * 1_500 + [float(i) / 40 for i in range(41, 350)], "same": [7.0] * 900, None: [float(i % 37) for i in range(777)],
}


@pytest.fixture(scope="module")
def frame(spark):
    data = [(g, v, "x") for g, values in GROUPS.items() for v in values] + [("even", None, "x"), ("empty", None, "x")]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, v double, target string")


@pytest.mark.parametrize("few", [300, 10_000])
def test_medians(frame, few):
    got = {r.g: (r.median, r.n) for r in quantiles.medians(frame, ["g"], "v", few).collect()}
    assert got == {g: (pytest.approx(statistics.median(v)), len(v)) for g, v in GROUPS.items()}


@pytest.mark.parametrize("few", [300])
def test_quantiles_have_the_ranks_of_the_latency_metrics(frame, few):
    wanted = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for r in quantiles.quantiles(frame, ["g"], "v", wanted, few).collect():
        ordered = sorted(GROUPS[r.g])
        assert [r[name] for name in wanted] == [
            ordered[min(int(len(ordered) * f), len(ordered) - 1)] for f in wanted.values()], r.g


def test_a_wrong_sketch_costs_no_exactness(frame, monkeypatch):
    monkeypatch.setattr(quantiles, "_ACCURACY", 50)
    got = {r.g: r.median for r in quantiles.medians(frame, ["g"], "v", 300).collect()}
    assert got == {g: pytest.approx(statistics.median(v)) for g, v in GROUPS.items()}


def test_without_groups_and_without_rows(spark, frame):
    whole = [x for v in GROUPS.values() for x in v]
    assert quantiles.medians(frame, [], "v", 900).first().median == statistics.median(whole)
    assert quantiles.medians(frame.limit(0), ["g"], "v").count() == 0
    assert tuple(quantiles.medians(frame.where("g = 'empty'"), [], "v").first()) == (None, None)


def test_median_windows_of_a_pipeline(spark, events):
    given = [{"at": i * 7, "event_type": "purchase", "amount": float(i * i % 13)} for i in range(60)]
    df = events(*given)
    got = Pipeline().map(lambda e: e.data.get("amount")).aggregate(60, statistics.median).apply(df).windows[0]
    want = df.groupBy(F.window("ingest_ts", "60 seconds").alias("w")).agg(
        F.median(F.col("amount").cast("double")).alias("m"), F.count("*").alias("c"))
    assert rows(got, "window_start", "window_end", F.col("result").cast("double"), "count") == rows(want, "w.start", "w.end", "m", "c")
