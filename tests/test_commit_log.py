"""Appends that are retried, die or race; polls of bounded size; retention from statistics."""

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from eventlens.session import fresh_dir
from eventlens.sources import event_log
from eventlens.sources.commit_log import CommitConflict, CommittedLog, Consumer


@pytest.fixture
def batch(spark):
    """Envelopes numbered from ``start``; their users decide the partition."""
    def make(start, n, users=5):
        data = [(f"e_{i:05d}", "page_view", at(i), f"u_{i % users}", "s", f"u_{i % users}", at(i), 0, {"page": "/p"})
                for i in range(start, start + n)]
        return spark.createDataFrame(data, (
            "event_id string, event_type string, timestamp timestamp, user_id string, session_id string, "
            "partition_key string, ingest_ts timestamp, copy int, data struct<page:string>"))

    return make


@pytest.fixture
def table(spark):
    return CommittedLog(spark, fresh_dir(spark, "t-commit"), 3)


def placed(df):
    return rows(df, "event_id", "partition_id", "offset")


def test_retries_and_dead_attempts_leave_the_log_of_one_run(spark, table, batch):
    assert table.read() is None and rows(table.ends()) == [(0, 0), (1, 0), (2, 0)]
    table.write_attempt(batch(0, 10))  # died before the commit
    assert table.read() is None
    assert table.append(batch(0, 10), 0) and not table.append(batch(0, 10), 0)
    table.write_attempt(batch(10, 7))
    assert table.append(batch(10, 7), 1) and not table.append(batch(10, 7), 1)
    assert table.append(batch(17, 0), 2) and not table.append(batch(17, 0), 2)  # a batch without rows
    whole = event_log.assign_offsets(event_log.route(batch(0, 17), 3))
    assert placed(table.read()) == placed(whole)
    assert table.drop_uncommitted() == 2 and placed(table.read()) == placed(whole)
    assert [r.number for r in table.commits().orderBy("number").collect()] == [0, 1, 2]


def test_batches_of_two_writers_are_told_apart(table, batch):
    assert table.append(batch(0, 3), 0, "a") and table.append(batch(3, 3), 0, "b") and not table.append(batch(0, 3), 0, "a")
    assert table.read().count() == 6


def test_of_two_racing_writers_one_is_refused(spark, table, batch, monkeypatch):
    table.append(batch(0, 5), 0)
    rival = CommittedLog(spark, table.path, 3)
    write = table.write_attempt

    def overtaken(*args):
        commit = write(*args)
        rival.append(batch(5, 5), 0, "rival")
        return commit

    monkeypatch.setattr(table, "write_attempt", overtaken)
    with pytest.raises(CommitConflict):
        table.append(batch(10, 5), 1)
    monkeypatch.undo()
    assert table.append(batch(10, 5), 1)
    offsets = table.read().groupBy("partition_id").agg(F.count("*"), F.min("offset"), F.max("offset") + 1)
    assert all(n == end and low == 0 for _, n, low, end in offsets.collect())
    assert table.read().count() == 15 and table.drop_uncommitted() == 0


def test_number_of_partitions_is_fixed(spark, table, batch):
    table.append(batch(0, 3))
    with pytest.raises(ValueError, match="3 partitions"):
        CommittedLog(spark, table.path, 4).ends()


def test_polls_are_bounded_and_repeat_after_a_crash(spark, table, batch):
    table.append(batch(0, 20, users=1))
    seen = []

    def handle(events, number):
        seen.append((number, sorted(r.offset for r in events.collect())))
        if len(seen) == 2:
            raise InterruptedError

    reader = Consumer(table, "r", max_events=6)
    with pytest.raises(InterruptedError):
        reader.run(handle)
    table.append(batch(20, 3, users=1))  # comes while the reader is down: the repeated poll keeps its range
    assert Consumer(table, "r", max_events=50).run(handle) == 2
    assert seen == [(0, [*range(6)]), (1, [*range(6, 12)]), (1, [*range(6, 12)]), (2, [*range(12, 23)])]
    assert not Consumer(table, "r").poll(handle)
    assert Consumer(table, "other").run(lambda events, number: None) == 1


def test_a_poll_reads_the_files_of_its_range(table, batch):
    for i in range(4):
        table.append(batch(10 * i, 10, users=1), i)
    reader = Consumer(table, "r", max_events=10)
    number, ranges = reader.plan()
    assert len(reader.rows(ranges).inputFiles()) == 1


def test_rotation_keeps_the_newest_half_without_reading_the_log(spark, table, batch):
    table.append(batch(0, 40, users=1))
    for start in (40, 50):
        table.append(batch(start, 10, users=1))
    busy = table.files().first().partition_id
    assert table.rotate(max_bytes=10**9)[busy] == 0
    assert table.rotate(max_bytes=100)[busy] == 30
    kept = table.read()
    assert kept.agg(F.min("offset"), F.count("*")).first() == (30, 30)
    assert table.rotate(max_bytes=100)[busy] == 45  # the first file goes
    assert len(table.read().inputFiles()) == 2
    table.append(batch(60, 1, users=1))
    stats = {r.partition_id: r for r in table.stats().collect()}
    assert (stats[busy].base_offset, stats[busy].end_offset) == (45, 61) and len(stats) == 3
    assert {p for p, r in stats.items() if r.end_offset == 0} == {0, 1, 2} - {busy}
    first = []
    Consumer(table, "r").poll(lambda events, number: first.append(events.agg(F.min("offset")).first()[0]))
    assert first == [45]


def test_lag_of_a_reader(table, batch):
    table.append(batch(0, 20, users=1))
    reader = Consumer(table, "r", max_events=5)
    for _ in range(2):
        reader.poll(lambda events, number: None)
    busy = max(table.stats("r").collect(), key=lambda r: r.end_offset)
    assert (busy.committed_offset, busy.lag, busy.total_produced) == (10, 10, 20)
    # each event that had to wait counts once, at the first poll that saw it
    assert busy.backpressure_events == 15
    table.append(batch(20, 20, users=1))
    reader.run(lambda events, number: None)
    table.append(batch(40, 3, users=1))
    reader.run(lambda events, number: None)
    caught_up = max(table.stats("r").collect(), key=lambda r: r.end_offset)
    assert (caught_up.lag, caught_up.backpressure_events) == (0, 35)


def test_a_round_hands_out_the_polls_one_by_one_would_bring(table, batch):
    table.append(batch(0, 300, users=4))
    single, rounds, calls = [], [], []

    def each(events, number):
        single.extend((number, r.partition_id, r.offset) for r in events.collect())

    def together(events, number):
        calls.append(number)
        rounds.extend((r.poll, r.partition_id, r.offset) for r in events.collect())
        if len(calls) == 2:
            rounds.clear()
            raise InterruptedError

    polls = Consumer(table, "single", max_events=7).run(each)
    reader = Consumer(table, "rounds", max_events=7)
    assert reader.poll_round(together, 1) == 1
    first = [*rounds]
    with pytest.raises(InterruptedError):
        reader.run_rounds(together, polls=8)
    # another size and length do not change what was planned
    assert Consumer(table, "rounds", max_events=50).poll_round(together, 2) == 8
    assert 1 + 8 + Consumer(table, "rounds", max_events=7).run_rounds(together, polls=8) == polls > 12
    assert sorted(first + rounds) == sorted(single)
    assert calls[:4] == [0, 1, 1, 9] and len(calls) < polls / 2
    assert rows(table.stats("rounds")) == rows(table.stats("single"))


def test_jobs_of_the_registered_polls_do_not_follow_their_number(spark, monkeypatch):
    from conftest import SMALL
    from eventlens.plans import queries

    monkeypatch.setattr(Consumer.__init__, "__defaults__", (5,))
    asked = []
    plan = Consumer.plan
    monkeypatch.setattr(Consumer, "plan", lambda self, *a: asked.append(1) or plan(self, *a))
    polls = queries.stream_bounded_events(spark, SMALL)
    assert polls.agg(F.max("poll")).first()[0] > 20 and polls.agg(F.max("events")).first()[0] == 5
    assert len(asked) <= 4


def test_tries_share_the_numbering_of_a_batch(table, batch, monkeypatch):
    from eventlens.sources import commit_log

    sorts = []
    assign = commit_log.assign_offsets
    monkeypatch.setattr(commit_log, "assign_offsets", lambda *a: sorts.append(1) or assign(*a))
    table.append(batch(0, 9))
    events = table.number(batch(9, 8))
    table.write_attempt(events, numbered=True)  # died
    assert table.append(events, 1, numbered=True) and not table.append(events, 1, numbered=True)
    assert len(sorts) == 2
    monkeypatch.undo()
    assert placed(table.read()) == placed(event_log.assign_offsets(event_log.route(batch(0, 17), 3)))
