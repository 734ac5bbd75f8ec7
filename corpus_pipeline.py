"""A corpus from raw documents to tokens, in stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of `documents`; `n_chars` follows the text where a stage
changes it.

1. quality rules: documents that a rule rejects go.
2. near duplicates: of each group linked by n-gram similarity the document of least id stays.
3. substring dedup: windows of 50 words that an earlier document has are cut out; a
   document that loses all its words goes.
4. mixing: sources are taken in proportion to their weights; a document is absent, once or
   twice in the result, or, at the end of a shard's quota, cut.
5. BPE: number of tokens, and digests of the ids and of what they decode to.
"""

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.llm import bpe, mixing, ngram_join, quality, substring
from eventlens.session import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """``docs`` with `n_chars` brought up to date, if ``like`` has it."""
    if "n_chars" not in like.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType)).select(*like.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_per_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(substring.dedup_documents(docs), docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed_documents(docs), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, TOKENIZER, keep_text=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of `documents`, each written and read again."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return reduce(lambda docs, stage: materialize(stage[1](spark, docs, sf_dir), "corpus"), STAGES, documents)


# The similarity join and the tokens are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None
