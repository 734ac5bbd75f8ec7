"""The stages one after another, each against brute force on its own input."""

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from conftest import SMALL
from eventlens.session import materialize


@pytest.fixture(scope="module")
def steps(spark):
    docs, made = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SMALL), "test")
        made.append((docs, after))
        docs = after
    return made


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(steps, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    before, after = map(texts, steps[0])
    assert all(before[i] == t for i, t in after.items())
    assert not [i for i in after if labels.get(i) == 0]


def test_near_duplicates(steps):
    before, after = map(texts, steps[1])
    assert after == {i: before[i] for i, (_, least) in brute.components(before).items() if i == least}


def test_substring(steps):
    before, after = map(texts, steps[2])
    want = {i: before[i] if not gone else kept for i, (_, gone, kept) in brute.window_dedup(before).items()}
    assert after == {i: t for i, t in want.items() if t}


def test_mixing(steps):
    before, after = texts(steps[3][0]), steps[3][1].collect()
    for r in after:
        whole = brute.WORD.findall(before[r.doc_id])
        part = brute.WORD.findall(r.text)
        assert part == whole[:len(part)] and r.n_chars == len(r.text)
    total = sum(len(brute.WORD.findall(t)) for t in before.values())
    assert sum(len(brute.WORD.findall(r.text)) for r in after) == pytest.approx(1.5 * total, rel=0.02)


def test_tokens(steps):
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    for r in steps[4][1].limit(40).collect():
        assert r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids)


def test_run_is_the_stages(spark, steps):
    columns = ["doc_id", "text", "n_tokens"]
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted(run.select(columns).collect()) == sorted(steps[-1][1].select(columns).collect())
