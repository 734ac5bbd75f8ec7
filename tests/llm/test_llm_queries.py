"""The registered queries of the subpackage, over whole tables, against SQL or brute force."""

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import brute
from compare import compare, connect
from conftest import SMALL
from eventlens.llm import licenses
from eventlens.llm.registry import oracle_sql, queries


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, duck, name):
    assert compare(queries()[name](spark, SMALL), duck, oracle_sql()[name]) is None


def test_license_scan(spark, texts):
    for r in queries()["op1_license_scan"](spark, SMALL).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(
            texts[r.doc_id], licenses.BASE)
        assert {*r.base_labels.split(",")} - {""} <= {*r.labels.split(",")} and 0 <= r.score <= 1


def test_ngram_join(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries()["op2_ngram_join"](spark, SMALL).collect()}
    assert got == brute.components(texts)


def test_substring_dedup(spark, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries()["op4_substring_dedup"](spark, SMALL).collect()}
    assert got == {i: (n, gone, brute.sha(kept)) for i, (n, gone, kept) in brute.window_dedup(texts).items()}


def test_suffix_dedup(spark, texts):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries()["op9_suffix_dedup"](spark, SMALL).collect()]
    assert sorted(got) == sorted(brute.byte_dedup(texts.items()))


def test_bpe_codec(spark, texts):
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    for r in queries()["op10_bpe_codec"](spark, SMALL).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(library.decode(ids, skip_special_tokens=False))


def test_mix_comes_near_its_targets(spark):
    by_source = {}
    for r in queries()["op6_source_mixing"](spark, SMALL).collect():
        assert 0 <= r.taken <= 2 * r.size
        aimed, taken = by_source.get((r.source_size, r.target), (r.target, 0))
        by_source[r.source_size, r.target] = aimed, taken + r.taken
    assert all(abs(taken - aimed) <= max(32, 0.02 * aimed) for aimed, taken in by_source.values())


def test_one_shard_more_takes_rows_only_into_itself(spark):
    rows = queries()["op8_rendezvous_sharding"](spark, SMALL).collect()
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert 0 < sum(r.grown_shard == 8 for r in rows) < len(rows) / 4
