"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

import brute
from eventlens.llm import (
    bpe, hamming, licenses, mixing, ngram_join, quality, sharding, substring, suffix, warc)
from eventlens.session import fresh_dir

LONG = " ".join(f"w{i % 977}" for i in range(40_000))
PASSAGE = " ".join(f"p{i}" for i in range(70))
DOCS = [
    (1, None, "s1"), (2, "", "s1"), (3, " \n\t ", None), (4, "one two", "s2"), (5, "one two", "s2"), (5, "one two", "s2"),
    (6, LONG, "s1"), (7, PASSAGE, "s1"), (8, f"before {PASSAGE} after", None), (9, f"{PASSAGE} end", "s3"), (10, "é ß 日本", "s3"),
]
SCHEMA = "doc_id long, text string, source string, key string, size string, taken int, words string, row string, node string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, "x", "y", 1, "z", "r", "n") for d in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def nulls(spark):
    return spark.createDataFrame([(None,) * 9, (None, PASSAGE, None, *[None] * 6), (1, PASSAGE, "s", *[None] * 6)], SCHEMA)


def unique(rows):
    return {i: t for i, t, _ in rows}


def test_quality(docs, nulls):
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    rows = {r.row.doc_id: r for r in quality.judge(docs).collect()}
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0 and rows[1].base_failed
    assert rows[6].n_repeat_words == 40_000 and rows[6].n_words == 40_000
    assert (rows[10].n_words, rows[10].word_chars) == (3, 4)
    assert quality.judge(nulls).count() == 3 and quality.judge(docs.limit(0)).count() == 0


def test_licenses(spark, nulls):
    cases = [(1, "Released under the MTI License."), (2, "Apache License, Version 3.0"), (3, None), (4, "GNU Generel Public License")]
    found = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    assert found[1].labels == "mit" and found[1].base_labels == "" and 0.8 < found[1].score < 1
    assert found[1].matches[0].first_word == 1 and found[1].matches[0].last_word == 4
    assert found[2].labels == "" and found[3].n_words == 0 and found[4].labels == "gpl"
    assert licenses.scan_licenses(nulls).count() == 3 and licenses.scan_licenses(nulls.limit(0)).count() == 0


def test_edits_up_to_the_bound_are_found():
    scanner = licenses.Scanner()
    for wrong in ("under the mit licens", "undr the mit licence", "under thhe mit license"):
        assert [n.label for *_, n, _ in scanner.fuzzy(licenses.word_form(f"foo {wrong} bar"))] == ["mit"]
    assert scanner.fuzzy(licenses.word_form("under no such thing")) == []


def test_edited_notices_are_found_where_an_unseeded_search_finds_them():
    """Random edits of every notice: the seeds lose no place, span or number of edits."""
    rng, scanner = random.Random(3), licenses.Scanner()
    for notice, _, pattern, digits in scanner.notices:
        for _ in range(150):
            text = list(notice.phrase)
            for _ in range(rng.randrange(notice.edits + 1)):
                at = rng.randrange(len(text))
                text[at:at + rng.randrange(2)] = rng.choice(["", "g", "xq"[:rng.randrange(1, 3)]])
            form = licenses.word_form(f"foo {''.join(text)} bar" if rng.randrange(2) else "".join(text))
            whole = pattern.search(form)
            if whole and [chr(c) for c in whole[0] if 48 <= c <= 57] != digits:
                continue
            own = [(a, b, e) for a, b, n, e in scanner.fuzzy(form) if n is notice]
            assert own == ([(*whole.span(), sum(whole.fuzzy_counts))] if whole else []), form


def test_license_places_in_a_long_text(spark):
    text = "Under the MIT License. " + "filler words " * 60_000 + "CC-BY-NC all rights reserved " * 3_000
    frame = spark.createDataFrame([(1, text, "m", 2), (1, text, "m", 2)], "doc_id long, text string, matches string, n_base int")
    for r in licenses.scan_licenses(frame).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(text, licenses.BASE)
        assert r.labels == "all-rights-reserved,cc-by-nc,mit" and r.score == 1.0
        spans = [(m.first_word, m.last_word) for m in r.matches if m.label == "all-rights-reserved"]
        assert spans == [(120_004 + 6 * i + 3, 120_004 + 6 * i + 5) for i in range(3_000)]


def test_ngram_join(docs, nulls):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.component_ids(docs).collect()}
    assert got == {(i, *v) for i, v in brute.components(unique(DOCS)).items()}
    assert ngram_join.component_ids(docs.limit(0)).count() == 0
    same = ngram_join.component_ids(nulls).collect()
    assert sorted(str(r.component_id) for r in same) == ["1", "1", "None"]
    kept = ngram_join.keep_one_per_group(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 10]
    assert {r.key for r in kept.collect()} == {"x"}


def test_one_row_of_a_component_stays(spark):
    """Null and equal ids: of near copies one row, whatever their ids; empty texts and repeats."""
    near = [PASSAGE, f"{PASSAGE} a", f"b {PASSAGE}", f"{PASSAGE} c d", f"e {PASSAGE} f"]
    rows = [*zip([1, 1, 2, None, None], near), (3, ""), (None, None), (None, None), (4, "alone here"), (4, "alone here")]
    kept = ngram_join.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "None"]
    assert [r.text for r in kept if r.doc_id == 1][0] in near[:2]
    rows = [(None, t) for t in near] + [(None, near[0])]
    assert ngram_join.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


def test_ngram_join_of_many_near_copies(spark):
    base = [f"b{i}" for i in range(300)]
    texts = {0: " ".join(base)}
    for i in range(1, 60):  # each is near the first one, but not near the others
        own = list(base)
        for k in range(6):
            own[(i * 5 + k * 50) % 300] = f"x{i}.{k}"
        texts[i] = " ".join(own)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.component_ids(frame).collect()}
    assert got == brute.components(texts)


def test_substring(docs, nulls):
    want = brute.window_dedup(unique(DOCS))
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_summary(docs).collect()}
    assert got == {(i, n, gone, brute.sha(kept)) for i, (n, gone, kept) in want.items()}
    assert substring.dedup_summary(docs.limit(0)).count() == 0
    left = substring.dedup_documents(docs)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect() if r.doc_id in (7, 8, 9)} == {7: PASSAGE, 8: "before after", 9: "end"}
    assert sorted(r.n_removed for r in substring.dedup_summary(nulls).collect()) == [0, 0, 70]


@pytest.mark.parametrize("group", [1, 1000])
def test_suffix(spark, nulls, group, monkeypatch):
    monkeypatch.setattr(suffix, "GROUP", group)
    body = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(900))
    rows = [(1, None), (2, ""), (3, body), (4, "x" + body[:500] + "y" + body[450:]), (5, "short"), (5, "short"),
            (6, "Q" * 900), (7, body[100:560] + "end"), (8, body[60:530] + "é"), (9, "copy" * 200), (9, "copy" * 200)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, mark int")
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.dedup_summary(frame).collect()]
    assert sorted(got) == sorted(brute.byte_dedup(rows))
    if group == 1000:
        assert suffix.dedup_summary(nulls).count() == 3 and suffix.dedup_summary(frame.limit(0)).count() == 0


def test_mixing(docs, nulls):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.taken <= 2 * r["size"] for r in rows) and {r.row["size"] for r in rows} == {"y"}
    assert mixing.mix(nulls).count() == 3 and mixing.mix(docs.limit(0)).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.filter("text = '' or text is null").isEmpty()


def test_apportionment_follows_the_highest_quotients(spark):
    votes = {"a": 53_000, "b": 24_000, "c": 23_000, "d": 400}
    frame = spark.createDataFrame([(0, k, float(v), 7) for k, v in votes.items()], "g int, name string, w double, seats long")
    got = {r.name: r.quota for r in mixing.apportion(frame, ["g"], "name", "w", "seats").collect()}
    best = sorted(((-v / (2 * i + 1), k) for k, v in votes.items() for i in range(8)))[:7]
    assert got == {k: sum(n == k for _, n in best) for k in votes}


def test_sharding(docs, nulls):
    rows = sharding.shard_rows(docs, sharding.equal(3)).collect()
    for shard in range(3):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {1}
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert sharding.shard_rows(nulls, sharding.equal(2)).count() == 3
    assert sharding.shard_rows(docs.limit(0), sharding.equal(2)).count() == 0


def test_weights_of_shards(spark):
    keys = spark.range(6000).select("id", sharding.rendezvous(F.col("id"), {0: 1.0, 1: 3.0}).alias("shard"))
    assert 0.72 < keys.filter("shard = 1").count() / 6000 < 0.78


def test_top_k(spark):
    rows = [(i, [float((i * j * 7919) % 11 - 5) for j in range(64)], "x") for i in range(60)]
    rows += [(100, None, None), (None, [1.0] * 64, None), (3, rows[3][1], "x"), (101, [float("nan")] * 64, None)] + [
        (200 + i, [1.0] * 64, None) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, ids string")
    got = hamming.top_k(frame, frame.filter("vec_id % 20 = 0 and vec_id < 300"), 5)
    codes = {i: sum((x > 0) << n for n, x in enumerate(v)) for i, v, _ in rows if i is not None and v is not None}
    for q in {i for i in codes if i % 20 == 0}:
        want = sorted((bin(codes[q] ^ c).count("1"), i) for i, c in codes.items() if i != q)[:5]
        assert [(r.distance, r.neighbor_id) for r in got.filter(F.col("query_id") == q).orderBy("rank").collect()] == want
    assert hamming.top_k(frame.limit(0), frame, 5).count() == 0
    assert hamming.top_k(frame.limit(3), frame.limit(3), 5).count() == 6


PAGES = [(1, "http://a", "x" * 120), (2, None, "x" * 120), (3, "http://c\r\nX: y", "x" * 99), (4, "u", "x" * 99), (5, "u", None),
         (6, "u", "WARC/1.1\r\n\r\n\r\n\r\n" * 20), (6, "u", "WARC/1.1\r\n\r\n\r\n\r\n" * 20), (None, "u", "x" * 120), (7, "u", "é" * 200_000)]


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "t") for p in PAGES], "page_id long, url string, html string, record_type string")
    archive = warc.archive_pages(spark, pages)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.resolve(
        warc.read_records(spark, archive)).collect()), key=str)
    size = len(PAGES[5][2])
    assert got == sorted([
        (1, 120, "response", None), (2, 120, "revisit", 1), (3, 99, "response", None), (4, 99, "response", None),
        (5, 0, "response", None), (6, size, "response", None), (6, size, "revisit", 6), (None, 120, "revisit", 1),
        (7, 400_000, "response", None)], key=str)
    kept = warc.read_records(spark, archive).filter("record_type = 'response'").collect()
    assert {bytes(r.payload).decode() for r in kept} == {p[2] or "" for p in PAGES}
    assert {r.target_uri for r in kept if r.page_id == 3} == {"http://c%0D%0AX: y"}
    assert warc.resolve(warc.read_records(spark, warc.archive_pages(spark, pages.limit(0)))).count() == 0


def test_bpe(docs, nulls):
    rows = bpe.encode(docs, path("word_bpe_49k.json")).collect()
    assert {r.doc_id: r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    assert all(len(r.ids) == r.n_tokens for r in rows)
    assert bpe.encode_digests(nulls, path("word_bpe_49k.json")).count() == 3
    assert bpe.encode(docs.limit(0), path("word_bpe_49k.json")).count() == 0
