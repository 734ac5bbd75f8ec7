"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The mix is cut into blocks of ``block_words`` words. Blocks go to the sources by the
highest quotients target / (2 seats + 1), and inside a source to its shards by the same
rule with the shards' sizes. A shard's documents lie end to end in a seeded order; its
quota takes whole rounds of them and then the first blocks of the next round, so all
documents but one per shard are taken whole, whole twice, or not at all.

Nothing is gathered per source: a shard holds about ``SHARD_WORDS`` words however large
its source is, and only (source, shard) totals meet in the apportionment.

Defined results: a null or empty text has size 0 and takes 0. Null is a source of its
own, last in order. Repeated rows are documents of their own. A table without rows gives
none. Extra columns pass through.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.session import broadcast_if_small

SEED = 17
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
REPEAT = 2  # a document is taken so often at most


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, null last, have the weights in turn and share ``share`` of all
    words; a target stops at ``repeat`` times its source's size and what is left goes to
    the others by weight. With the sources ordered by size / weight, those that stop are
    the first ones, so one running sum finds the level at which the rest is filled.
    One row per source.
    """
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    weighed = sizes.withColumn("_w", weight)
    order = [(F.col("source_size") / F.col("_w")), F.col("source").asc_nulls_last()]
    before, everything = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    stopped = F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left_weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * share - repeat * stopped) / left_weight
    fits = F.when(repeat * F.col("source_size") > level * F.col("_w"), level)
    leveled = weighed.withColumn("_level", fits).withColumn("_level", F.max("_level").over(everything))
    cap = (repeat * F.col("source_size")).cast("double")
    return leveled.select(
        "source", "source_size",
        F.coalesce(F.least(cap, F.col("_level") * F.col("_w")), cap).alias("target"))


def apportion(df: DataFrame, group: list[str], ident: str, weight: str, seats: str) -> DataFrame:
    """Add ``quota``: the ``seats`` of each group dealt by the highest quotients
    weight / (2 quota + 1), ties to the smaller ``ident``.

    With J members a member of share p gets between p (seats - J) - 1 and
    p (seats + J) + 1 seats. Only the quotients in that range are ranked, about five
    rows for each member.
    """
    members = W.partitionBy(*group)
    known = df.select(
        "*", (F.col(weight) / F.sum(weight).over(members)).alias("_p"), F.count("*").over(members).alias("_j"))
    sure = F.greatest(F.lit(0), F.floor(F.col("_p") * (F.col(seats) - F.col("_j")) - 1)).cast("long")
    most = F.ceil(F.col("_p") * (F.col(seats) + F.col("_j")) + 1).cast("long")
    bounds = known.withColumns({"_sure": sure, "_most": most}).withColumn(
        "_open", F.col(seats) - F.sum("_sure").over(members))
    bids = bounds.filter((F.col(weight) > 0) & (F.col(seats) > 0)).select(
        "*", F.explode(F.sequence("_sure", "_most")).alias("_i")
    ).withColumn("_quotient", F.col(weight) / (2 * F.col("_i") + 1))
    rank = F.row_number().over(members.orderBy(F.col("_quotient").desc(), F.col(ident).asc_nulls_last(), "_i"))
    won = bids.withColumn("_rank", rank).groupBy(*group, ident).agg(
        (F.first("_sure") + F.sum((F.col("_rank") <= F.col("_open")).cast("long"))).alias("quota"))
    won = won.select("quota", *[F.col(c).alias(f"_won_{c}") for c in [*group, ident]])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_won_{c}")) for c in [*group, ident]])
    return df.join(won, same, "left").select(*df.columns, F.coalesce("quota", F.lit(0)).alias("quota"))


def mix(docs: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, key_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """``row``, ``size``, ``source_size``, ``target`` and ``taken``, the words that the mix
    takes of the row (``taken // size`` whole copies, then its first words). ``row`` holds
    the columns of ``docs``, or those named in ``carry``."""
    size = word_count(docs[text_col])
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(docs[key_col].cast("string"), F.lit("null"))))
    sized = docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"), docs[key_col].alias("_key"),
        docs[source_col].alias("_from"), size.alias("size"), order.alias("_order"), F.xxhash64(docs[text_col]).alias("_tie"))
    by_source = sized.select(F.col("_from").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size"))
    total = F.sum("target").over(W.partitionBy())
    aimed = targets(by_source).withColumns({
        "_all": F.lit(0), "_seats": F.round(total / block_words).cast("long"),
        "_shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)).cast("long")})
    aimed = apportion(aimed, ["_all"], "source", "target", "_seats").select(
        F.col("source").alias("_source"), "source_size", "target", "_shards", F.col("quota").alias("_quota"))

    aimed, _ = broadcast_if_small(aimed, docs.select(source_col).distinct().count())
    placed = sized.join(aimed, F.col("_from").eqNullSafe(F.col("_source"))).withColumn(
        "_shard", F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % F.col("_shards"))
    shards = placed.groupBy("_source", "_shard").agg(
        F.sum("size").alias("_shard_size"), F.first("_quota").alias("_quota"))
    shards = apportion(shards, ["_source"], "_shard", "_shard_size", "_quota").select(
        F.col("_source").alias("_s"), F.col("_shard").alias("_h"), "_shard_size",
        F.least(F.col("quota") * block_words, REPEAT * F.col("_shard_size")).alias("_words"))

    lies = W.partitionBy("_source", "_shard").orderBy("_order", "_key", "size", "_tie")
    start = F.coalesce(F.sum("size").over(lies.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    laid = placed.withColumn("_start", start)
    on = laid["_source"].eqNullSafe(shards["_s"]) & (laid["_shard"] == shards["_h"])
    rounds = F.when(F.col("_shard_size") > 0, F.floor(F.col("_words") / F.col("_shard_size"))).otherwise(0)
    rest = F.col("_words") - rounds * F.col("_shard_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    return laid.join(shards, on).select(
        "row", "size", "source_size", "target", (rounds * F.col("size") + part).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = SEED, text_col: str = "text") -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for each whole copy that is
    taken and one, cut after its last word that is taken, for a part."""
    mixed = mix(docs, seed, text_col=text_col)
    text = F.col("row")[text_col]
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    whole, part = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    cut = F.when(part > 0, F.array(F.array_join(F.slice(words, F.lit(1), part), " "))).otherwise(
        F.array().cast("array<string>"))
    texts = F.concat(F.array_repeat(text, whole), cut)
    return mixed.filter("taken > 0").select(
        *[F.col("row")[c].alias(c) if c != text_col else F.explode(texts).alias(c) for c in docs.columns])
