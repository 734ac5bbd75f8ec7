"""The n-gram join over words with A-Z in lower case."""

import brute
from conftest import SMALL
from eventlens.llm import ngram_join
from eventlens.llm.registry import queries

BASE = [f"word{i}" for i in range(80)]


def folded(texts):
    return brute.components({i: (t or "").translate(brute.LOWER) for i, t in texts.items()})


def edited(words, place):
    return [*words[:place], "Other", *words[place + 1:]]


CASES = {
    1: " ".join(BASE),
    2: " ".join(BASE).upper(),
    3: " ".join(w.title() if i % 2 else w for i, w in enumerate(edited(BASE, 40))),
    4: " ".join(edited(BASE, 20)).upper(),
    5: "One Two", 6: "one two", 7: "Same words here and There same words HERE AND there same words here and there",
    8: "\u00c9t\u00e9 un deux trois quatre cinq", 9: "\u00e9t\u00e9 un deux trois quatre cinq", 10: None,
}


def test_copies_that_differ_in_case(spark):
    docs = spark.createDataFrame(list(CASES.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.component_ids(docs).collect()}
    assert got == folded(CASES)
    assert {got[i][1] for i in (1, 2, 3, 4)} == {1} and got[6][1] == 5 and got[9][1] == 9
    assert sorted(r.doc_id for r in ngram_join.keep_one_per_group(docs).collect()) == [1, 5, 7, 8, 9, 10]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries()["op2_ngram_join"](spark, SMALL).collect()}
    assert got == folded(texts)
