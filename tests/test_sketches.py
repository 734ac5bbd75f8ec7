"""Bounded metric state against counting."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from eventlens.operators import sketches
from eventlens.streaming.folded_state import FoldedState

rng = random.Random(11)
ZIPF = [f"k{min(int(rng.paretovariate(1.1)), 400)}" for _ in range(6_000)]
FLAT = [f"k{i % 500}" for i in range(3_000)]
KEYS = {"zipf": "zipf", "flat": "flat"}


@pytest.fixture(scope="module")
def keyed(spark):
    data = [(i, z, FLAT[i] if i < len(FLAT) else None) for i, z in enumerate(ZIPF)]
    return spark.createDataFrame(data, "at long, zipf string, flat string").withColumn(
        "ingest_ts", F.timestamp_seconds(F.col("at") + 1_700_000_000)).repartition(5)


def _state(keyed, parts, capacity):
    states = [sketches.frequent_keys(keyed.where(F.col("at") % parts == i), KEYS, capacity) for i in range(parts)]
    state = states[0]
    for s in states[1:]:
        state = sketches.merge_keys(state, s, capacity=capacity)
    return state


@pytest.mark.parametrize("parts, capacity", [(1, 20), (4, 20), (3, 60), (2, 2_000)])
def test_counts_lie_in_their_bounds(keyed, parts, capacity):
    state = _state(keyed, parts, capacity)
    true = {"zipf": collections.Counter(ZIPF), "flat": collections.Counter(FLAT)}
    got = sketches.bounds(state).collect()
    whole = {r.kind: (r.low, r.slack) for r in state.where("key is null").collect()}
    assert {k: n for k, (n, _) in whole.items()} == {"zipf": len(ZIPF), "flat": len(FLAT)}
    for kind, (n, slack) in whole.items():
        assert slack <= n / (capacity + 1)
        kept = {r.key: r for r in got if r.kind == kind}
        assert len(kept) <= capacity
        assert all(r.low <= true[kind][key] <= r.high for key, r in kept.items())
        assert all(c <= slack for key, c in true[kind].items() if key not in kept)


@pytest.mark.parametrize("parts, capacity", [(3, 60), (2, 2_000)])
def test_proven_places_are_the_exact_ones(keyed, parts, capacity):
    got = sketches.proven_top_k(keyed, KEYS, _state(keyed, parts, capacity), {"zipf": 8, "flat": 5}).collect()
    for kind, values, k in (("zipf", ZIPF, 8), ("flat", FLAT, 5)):
        first = {}
        for i, v in enumerate(values):
            first.setdefault(v, i)
        want = sorted(collections.Counter(values).items(), key=lambda e: (-e[1], first[e[0]], e[0]))[:k]
        proven = {r.place: (r.key, r.event_count) for r in got if r.kind == kind and r.proven}
        assert proven == {p: want[p - 1] for p in proven}
        # equal counts beyond the capacity cannot be told apart, and none is claimed
        assert len(proven) == (0 if kind == "flat" and capacity < 500 else k)


def test_frequent_keys_are_cut_before_the_shuffle(keyed):
    assert "WindowGroupLimit" in plan(sketches.frequent_keys(keyed, KEYS))


def test_no_rows_and_no_keys(spark, keyed):
    none = sketches.frequent_keys(keyed.limit(0), KEYS)
    assert none.count() == 0
    assert sketches.merge_keys(none, none).count() == 0
    assert sketches.proven_top_k(keyed, KEYS, none, {"zipf": 3}).count() == 0
    nulls = sketches.frequent_keys(keyed.withColumn("zipf", F.lit(None)).limit(3), {"zipf": F.col("zipf")})
    assert nulls.count() == 0


@pytest.fixture(scope="module")
def visits(spark):
    """40 days of minutes; users come back after some days."""
    return spark.range(20_000).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("u"), (F.col("id") * 7919 % 4_000))).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 171 + 1_700_000_000).alias("ingest_ts"))


def _merged(visits, parts):
    cut = [sketches.user_sketches(visits.where(F.minute("ingest_ts") % parts == i)) for i in range(parts)]
    return sketches.merge_users(*cut)


def test_users_of_last_days_within_the_stated_error(visits):
    exact = {r.day: r.users for r in sketches.exact_users_of_last_days(visits).collect()}
    about = sketches.users_of_last_days(_merged(visits, 3)).collect()
    assert {r.day for r in about} == exact.keys() and len(exact) >= 39
    assert all(r.low <= exact[r.day] <= r.high for r in about)


def test_any_cut_gives_the_same_buckets(visits):
    once = sketches.merge_users(sketches.user_sketches(visits))
    columns = ("unit", "bucket", "events")
    assert rows(once, *columns) == rows(_merged(visits, 3), *columns)
    units = {r.unit: r.n for r in once.groupBy("unit").agg(F.count("*").alias("n")).collect()}
    assert units["day"] <= 40 and units["minute"] <= sketches.YOUNG_DAYS * 1_440


def test_users_between(spark, visits):
    state = sketches.user_sketches(visits)
    all_of_them = sketches.users_between(state, "2020-01-01", "2030-01-01").first()
    true = visits.select("user_id").where("user_id is not null").distinct().count()
    assert all_of_them.low <= true <= all_of_them.high
    assert tuple(sketches.users_between(state, "2030-01-01", "2031-01-01").first())[:2] == (0, 0)
    assert sketches.users_of_last_days(spark.createDataFrame([], sketches.USERS_SCHEMA)).count() == 0


def test_a_batch_that_comes_again_counts_once(spark, keyed, tmp_path):
    state = FoldedState(spark, str(tmp_path / "state"), sketches.KEYS_SCHEMA,
                        lambda df: sketches.frequent_keys(df, KEYS), sketches.merge_keys)
    assert state.read().count() == 0
    for number in (0, 1, 1, 2, 3, 3):
        state(keyed.where(F.col("at") % 4 == number), number)
    (tmp_path / "state" / "version-4").mkdir()  # a write that died
    assert state.versions() == [2, 3]
    assert rows(state.read()) == rows(sketches.frequent_keys(keyed, KEYS))
