import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan, rows
from eventlens.operators import metrics, state as st, timeseries as ts
from eventlens.plans import queries as q
from eventlens.session import fresh_dir, materialize
from eventlens.sources.snapshots import StateTable


@pytest.fixture(scope="module")
def accepted(spark):
    return materialize(q.accepted(spark, SMALL), "accepted")


def table(state):
    return rows(state.partials), rows(state.samples)


@pytest.mark.parametrize("seed,parts", [(1, 2), (2, 3), (3, 5)])
def test_any_split_merges_to_the_whole(accepted, seed, parts):
    share = F.pmod(F.xxhash64("event_id", F.lit(seed)), F.lit(parts))
    pieces = [st.build_state(accepted.where(share == i)) for i in range(parts)]
    random.Random(seed).shuffle(pieces)
    assert table(st.merge_states(*pieces)) == table(st.build_state(accepted))


def test_state_gives_the_single_metrics(accepted):
    p = st.build_state(accepted).partials
    kpi, direct = st.kpis(p).first(), metrics.kpi_totals(accepted).first()
    assert {c: kpi[c] for c in direct.asDict()} == direct.asDict()
    assert kpi.active_users == metrics.active_users(accepted).first()[0]
    assert rows(st.second_table(p)) == rows(ts.events_per_second(accepted))
    assert rows(st.minute_table(p)) == rows(ts.per_minute(accepted))


def test_one_scan_and_one_shuffle_build_the_partials(accepted):
    text = plan(st.build_state(accepted).partials)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Expand" in text
    assert "SortAggregate" not in text


def test_snapshot_of_nothing(spark):
    snap = {r.metric: r.value for r in st.snapshot(st.empty_state(spark)).collect() if r.key is None}
    assert len(snap) == 13 and set(snap.values()) == {0.0}
    assert st.snapshot(st.empty_state(spark)).where("metric = 'funnel'").count() == 5


def test_snapshot_has_all_metrics(accepted):
    state = q._written(st.build_state(accepted))
    names = {r[0] for r in st.snapshot(state).select("metric").distinct().collect()}
    wide = st.snapshot_wide(state).first()
    assert len(names) == 22 and names == set(wide.asDict())
    assert wide.total_events == accepted.count()
    assert [e.value for e in wide.top_products] == [
        float(r.event_count) for r in metrics.top_products(accepted).collect()]
    assert len(wide.revenue_per_minute) == 20 and len(wide.events_per_second) == 30


def test_recovery_from_snapshot_and_tail(spark, events):
    table_ = StateTable(spark, fresh_dir(spark, "t-state"))
    buy = [{"event_type": "purchase", "amount": 50.0, "event_id": f"e_{i}", "at": i} for i in range(4)]
    table_.write_base(st.build_state(events(*buy[:3])))
    table_.write_batch(0, st.build_state(events(buy[3])))
    kpi = st.kpis(StateTable(spark, table_.path).read().partials).first()
    assert (kpi.total_orders, kpi.total_revenue, kpi.avg_order_value) == (4, 200.0, 50.0)


def test_compaction_keeps_totals_and_drops_the_tail(spark, events):
    table_ = StateTable(spark, fresh_dir(spark, "t-state"))
    for i in range(3):
        table_.write_batch(i, st.build_state(events({"event_type": "purchase", "amount": 10.0})))
    before = table(table_.read())
    table_.compact()
    assert table(table_.read()) == before
    assert table_.latest().high_water == 2 and table_.batch_ids(2) == []
    table_.write_batch(2, st.build_state(events({})))  # late retry of a folded batch
    assert table(table_.read()) == before


def test_retried_batch_overwrites_itself(spark, events):
    table_ = StateTable(spark, fresh_dir(spark, "t-state"))
    for _ in range(2):
        table_.write_batch(0, st.build_state(events({"event_type": "purchase", "amount": 10.0})))
    assert st.kpis(table_.read().partials).first().total_revenue == 10.0


def test_half_written_versions_and_batches_are_not_read(spark, events):
    table_ = StateTable(spark, fresh_dir(spark, "t-state"))
    assert st.kpis(table_.read().partials).first().total_events == 0
    state = st.build_state(events({}))
    state.partials.write.parquet(f"{table_.path}/base/version=0-broken/partials")
    state.partials.write.parquet(f"{table_.path}/batches/batch_id=0/partials")
    assert st.kpis(table_.read().partials).first().total_events == 0


def test_compaction_cleans_up_behind_itself(spark, events):
    import os
    table_ = StateTable(spark, fresh_dir(spark, "t-state"))
    for i in range(6):
        table_.write_batch(i, st.build_state(events({"event_type": "purchase", "amount": 10.0})))
        if i % 2:
            table_.compact()
            table_.drop_folded()
    left = sorted(os.listdir(f"{table_.path.removeprefix('file:')}/batches"))
    assert left == ["batch_id=4", "batch_id=5"]  # the newest base covers them, the one before does not
    assert st.kpis(table_.read().partials).first().total_orders == 6


def test_stages_are_deleted_after_the_block(spark):
    from eventlens.session import read_or_none, stages
    with stages(spark):
        written = materialize(spark.range(3))
        path = written.inputFiles()[0].rsplit("/", 1)[0]
        assert read_or_none(spark, path).count() == 3
    assert read_or_none(spark, path) is None
