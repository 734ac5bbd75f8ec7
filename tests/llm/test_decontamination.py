"""Benchmark passages found by winnowing, against all windows compared one by one."""

import random

import pytest

import brute
from eventlens import session
from eventlens.llm import decontamination

DOCS = "doc_id long, text string, items string, key string, spans int, place string"
ITEMS = "item_id long, text string, print string, item int"


def found(docs, items):
    rows = decontamination.find_leaks(docs, items).collect()
    for r in rows:
        covered = [w for s in r.spans for w in range(s.first_word, s.last_word + 1)]
        assert len(covered) == len(set(covered)) == r.n_hit
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "i", "k", 1, "p") for d in docs], DOCS),
            spark.createDataFrame([(*i, "p", 2) for i in items], ITEMS))


def words(rng, n, letters):
    return " ".join(rng.choice(letters) + rng.choice("XyZ-é") + str(rng.randrange(3)) for _ in range(n))


@pytest.mark.parametrize("bound", [0, 200_000])
def test_random_texts(spark, monkeypatch, bound):
    """Few different words, so that short spans, overlaps and chance hits of fingerprints abound."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    rng = random.Random(11)
    items = [(i, words(rng, n, "abc")) for i, n in enumerate([1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 14, 40])]
    docs = []
    for i in range(60):
        text = words(rng, rng.randrange(60), "abcd")
        if i % 2:
            item = rng.choice(items)[1].split()
            a = rng.randrange(len(item))
            text += ". " + ";".join(item[a:a + rng.randrange(1, 15)]).upper() + " / " + words(rng, 5, "ab")
        docs.append((i, text))
    assert found(*frames(spark, docs, items)) == sorted(brute.leaks(docs, items), key=str)


@pytest.mark.parametrize("length", range(10, 15))
def test_every_shared_span_of_the_window_is_found(spark, length):
    rng = random.Random(length)
    item = [f"u{rng.randrange(10**6)}" for _ in range(30)]
    docs = [(a, " ".join([f"v{a}.{k}" for k in range(a)] + item[a:a + length] + ["tail"])) for a in range(30 - length)]
    docs += [(100 + a, " ".join(["head", *item[a:a + 9], "tail"])) for a in range(20)]
    assert found(*frames(spark, docs, [(1, " ".join(item))])) == sorted(brute.leaks(docs, [(1, " ".join(item))]), key=str)


def test_defined_cases(spark):
    item = " ".join(f"q{i}" for i in range(12))
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, " \n.,"), (4, item.upper()), (4, item.upper()), (5, f"{long} {item} {long}"), (None, item),
            (None, None), (6, "One Two"), (7, "one. two. one, two"), (8, "q1 q2 q3"), (9, f"{item} x {item}")]
    items = [(1, item), (1, item), (2, item + " more"), (None, "two. one"), (3, None), (4, "..."), (12, item), (None, item)]
    docs_frame, items_frame = frames(spark, docs, items)
    assert found(docs_frame, items_frame) == sorted(brute.leaks(docs, items), key=str)
    assert found(docs_frame.limit(0), items_frame) == []
    assert found(docs_frame, items_frame.limit(0)) == sorted(brute.leaks(docs, []), key=str)


def test_a_passage_in_many_documents_and_items(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"a{i} b{i} {passage} c{i}") for i in range(600)]
    items = [(i, f"item{i} {passage}") for i in range(50)]
    assert found(*frames(spark, docs, items)) == sorted(brute.leaks(docs, items), key=str)
