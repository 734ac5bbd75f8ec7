"""Rendezvous sharding: every key scores every shard and goes to its best one.

A shard's score for a key is an exponential draw made of the hash of (key, shard),
divided by the shard's weight; the smallest score wins. A shard therefore wins a share
of the keys in proportion to its weight, and adding one changes the place of only
those keys that the new shard wins.

Slots number the rows of a shard from 0 without gaps, in the order of a hash of key and
content. They are counted in buckets of that hash: a window holds one bucket of one
shard, and the buckets' start numbers are a prefix sum over their counts. So neither a
frequent key nor a frequent content gathers in one window, unless whole rows repeat.

Defined results: a null key is one key of its own; a null or empty text has size 1 and
checksum 0; repeated rows get slots of their own; a table without rows gives none; extra
columns pass through `shard_rows`, but one named like a column it adds gives way.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKET_ROWS = 100_000  # rows of a slot bucket, about


def _unit(key: Column, shard: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of (key, shard)."""
    digits = F.substring(F.md5(F.concat_ws(":", key, shard.cast("string"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard (int) of a key among ``{shard: weight}``."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("every shard needs a weight above 0")
    name = F.coalesce(key.cast("string"), F.lit("null"))
    scores = [
        F.struct((-F.ln(_unit(name, F.lit(shard))) / float(weight)).alias("score"), F.lit(shard).cast("int").alias("shard"))
        for shard, weight in sorted(weights.items())
    ]
    return F.array_min(F.array(*scores))["shard"]


def shard_rows(
    docs: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    key_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the text, plus ``size``, ``text_crc32``, ``shard``, ``slot`` and,
    if ``grown`` weights are given, ``grown_shard``, the shard under those."""
    text, added = F.coalesce(docs[text_col], F.lit("")), ("size", "text_crc32", "shard", "slot", "grown_shard")
    placed = docs.select(
        *[docs[c] for c in docs.columns if c != text_col and c not in added],
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(docs[key_col], weights).alias("shard"),
        (rendezvous(docs[key_col], grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    digits = 0
    rows = docs.count()
    while rows > BUCKET_ROWS * len(weights) * 16**digits:
        digits += 1
    place = F.md5(F.concat_ws(":", F.coalesce(F.col(key_col).cast("string"), F.lit("null")), F.col("text_crc32")))
    placed = placed.withColumn("_order", place).withColumn("_bucket", F.substring("_order", 1, digits))
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n")).select(
        "shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy("shard", "_bucket").orderBy("_order", key_col, "size")
    numbered = placed.withColumn("_place", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "_bucket"]).withColumn(
        "slot", (F.col("_start") + F.col("_place")).cast("long")
    ).drop("_order", "_bucket", "_place", "_start")


def equal(shards: int) -> dict[int, float]:
    return {shard: 1.0 for shard in range(shards)}
