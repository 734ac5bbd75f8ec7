"""The Merkle manifest against trees built level by level in plain Python."""

import pytest
from pyspark.sql import functions as F

import brute
from eventlens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, place string, digest string, total int, path int"


def verified(spark, rows):
    frame = spark.createDataFrame([(*r, "p", "d", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.verified_manifest(frame).collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (1, 2), (16, 17, 256), (257, 15), (4_097,), (1,) * 40])
def test_trees_of_each_height(spark, sizes):
    rows = [(n * 5_000 + i, f"s{n:02}", "en", i, f"Text {i}") for n, size in enumerate(sizes) for i in range(size)]
    assert verified(spark, rows) == brute.merkle(rows)


def test_defined_cases(spark):
    rows = [(1, None, None, None, None), (2, "", "", 0, ""), (3, "é", "fr", 2, "É ABC"), (4, "z", "en", 3, "UP " * 50_000),
            (4, "z", "en", 3, "UP " * 50_000), (4, "z", "en", 3, "other"), (None, "z", "en", 1, "NO ID"), (None, None, None, None, None)]
    rows += [(i, "z", "en", 5, "ABC abc É") for i in range(100, 140)]
    got = verified(spark, rows)
    assert got == brute.merkle(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)
    assert verified(spark, []) == []


def test_wide_tables_of_paths_are_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PATH_ROWS", 0)
    rows = [(i, f"s{i % 3}", "en", 1, f"T{i}") for i in range(900)]
    assert verified(spark, rows) == brute.merkle(rows)


def test_one_changed_character_leads_to_another_root(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(300)]
    changed = [*rows[:77], (77, "s", "en", 1, "t77 "), *rows[78:]]
    assert {r[3] for r in verified(spark, rows)} != {r[3] for r in verified(spark, changed)}


def test_fold_and_proof(spark):
    path = F.array(F.struct(F.lit("a").alias("left"), F.lit("b").alias("right")),
                   F.struct(F.lit("").alias("left"), F.lit("c").alias("right")))
    got = spark.range(1).select(merkle.fold(F.lit("x"), path), merkle.proof(path)).first()
    assert tuple(got) == (brute.sha(brute.sha("axb") + "c"), brute.sha("abc"))
