"""The burst trie against a trie kept as a dictionary of paths."""

import random

import pytest

import brute
from eventlens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, low string, key int, rest string"


def nodes(spark, rows):
    frame = spark.createDataFrame([(*r, "l", 1, "r") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(frame).collect()), key=str)


def want(rows):
    return brute.trie(brute.rebuilt_conversations(rows))


@pytest.mark.parametrize("container, piece", [(2, 2), (12, 4096), (1000, 4096)])
def test_random_conversations(spark, monkeypatch, container, piece):
    monkeypatch.setattr(prefix_trie, "CONTAINER", container)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", piece)
    rng = random.Random(7)
    rows = [(c, t, "user", rng.choice("aé")) for c in range(0, 120, rng.choice([1, 2])) for t in range(rng.randrange(1, 12))]
    assert nodes(spark, rows) == want(rows)


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CONTAINER", 4)
    rows = [(c, t, "user", f"t{t}") for c in range(40, 60) for t in range(9)]  # one conversation many times
    rows += [(c, 0, None, None) for c in (3, 4, 61)]  # null and empty; without a base, turns can be used up
    rows += [(7, None, "user", "first"), (7, 2, "user", "x" * 70_000), (7, 1, "assistant", ""), (None, 0, "user", "lost")]
    rows += [(200, t, "user", str(t % 3)) for t in range(150)]  # a long one
    assert nodes(spark, rows) == want(rows)
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, None, None, None)]) == []


def test_repeated_rows_are_turns(spark):
    rows = [(10, 0, "user", "a"), (10, 0, "user", "a"), (10, 1, "user", "b"), (15, 0, "user", "a")]
    assert nodes(spark, rows) == want(rows)


def test_turns_of_one_number_have_one_order(spark):
    rows = [(10, 0, "user", "a"), (10, 0, "user", "b"), (11, 0, "user", "b"), (11, 0, "user", "a")]
    assert nodes(spark, rows) == nodes(spark, rows[::-1])


def test_shared_turns():
    record = [bytes([i]) * prefix_trie.TURN for i in range(200)]
    for n in (0, 1, 5, 64, 199):
        a, b = b"".join(record), b"".join(record[:n] + [b"\xff" * prefix_trie.TURN] * 3)
        assert prefix_trie._shared_turns(a, b) == n
    assert prefix_trie._shared_turns(b"", record[0]) == 0
