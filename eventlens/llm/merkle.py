"""A Merkle manifest of a table: one hash tree for each source, and one over the sources.

Nodes of a level are numbered densely in their tree and cut into aligned blocks of 256. A
block keeps its level as one string of hexadecimal digests, 64 characters each. A parent is
the hash of a substring of 16 digests, so the levels above come from substrings of fixed
width; the siblings of a node are the substrings that flank it in its run of 16. A block
climbs two levels and leaves one node, its root; block roots are numbered by their block and
go through the same step, until each tree has one node left. The roots of the sources are
the leaves of the last tree, which recurses likewise.

A block is bounded, so a source with a third of all rows is many blocks. Texts are hashed
where they are scanned; what is shuffled are ids and digests. Sibling segments of the levels
above a block are kept once for each block, not for each row.

Defined results: rows of a source ascend by id, null first, and rows of equal id by leaf,
so repeated rows are leaves of their own. Null and empty values have different leaves. A
null source is a source of its own, first. Extra columns are ignored. A table without
rows gives none.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventlens.operators.numbering import dense_number
from eventlens.session import broadcast_if_small, materialize

FANOUT = 16
STEP = 2  # levels that a block climbs
BLOCK = FANOUT ** STEP
HEX = 64  # characters of a digest
PATH_ROWS = 8_000  # tables with a path a row (a few kB) are broadcast up to this many rows
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(values: dict[str, Column]) -> Column:
    """The digest of a row: each field as its byte count and value, ``-`` if null."""
    def piece(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return _sha(F.concat(*[piece(v) for v in values.values()]))


def tampered_leaf(values: dict[str, Column], whole: Column) -> Column:
    """The leaf after the tamper test, which lower-cases A-Z in the texts of some ids."""
    chosen = F.crc32(values["doc_id"].cast("string").cast("binary")) % TAMPER_EVERY == 0
    changed = values | {"text": F.translate(values["text"], _UPPER, _UPPER.lower())}
    return F.when(chosen, leaf(changed)).otherwise(whole)


def _with_paths(rows: DataFrame, paths: DataFrame, same: Column) -> DataFrame:
    return rows.join(F.broadcast(paths) if paths.count() <= PATH_ROWS else paths, same)


def _part(level: Column, first: Column, count: Column) -> Column:
    """``count`` digests of a level from place ``first`` on."""
    return F.substring(level, first * HEX + 1, count * HEX)


def _count(level: Column) -> Column:
    return (F.length(level) / HEX).cast("int")


def _parents(level: Column) -> Column:
    """The level above: the digest of each run of 16."""
    runs = F.sequence(F.lit(0), F.floor((_count(level) - 1) / FANOUT).cast("int"))
    return F.array_join(F.transform(runs, lambda i: _sha(_part(level, i * FANOUT, F.lit(FANOUT)))), "")


def _flanks(level: Column, place: Column) -> Column:
    """The siblings left and right of the node at ``place``."""
    start = place - place % FANOUT
    return F.struct(
        _part(level, start, place - start).alias("left"),
        _part(level, place + 1, start + FANOUT - 1 - place).alias("right"))


def _blocks(nodes: DataFrame, tree: list[str], carry: list[str]) -> DataFrame:
    """Nodes (tree, place, nodes of the level, digest) gathered by block: ``members`` in order,
    the block's levels, and the number of levels it climbs."""
    member = F.struct(F.col("place"), F.col("digest"), *[F.col(c) for c in carry])
    gathered = nodes.groupBy(*tree, F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(member)).alias("members"))
    return gathered.withColumn("level0", F.array_join(F.transform("members", lambda m: m["digest"]), "")).withColumn(
        "level1", F.when(F.col("total") > 1, _parents(F.col("level0")))).withColumn(
        "top", F.when(F.col("total") > FANOUT, _parents(F.col("level1"))).when(F.col("total") > 1, F.col("level1"))
        .otherwise(F.col("level0")))


def _segments() -> Column:
    """The flanks of a member of a block at the levels below the block's root."""
    at = (F.col("member.place") % BLOCK).cast("int")
    lower = F.when(F.col("total") > 1, F.array(_flanks(F.col("level0"), at))).otherwise(F.array())
    upper = F.when(F.col("total") > FANOUT, F.array(
        _flanks(F.col("level1"), F.floor(at / FANOUT).cast("int")))).otherwise(F.array())
    return F.concat(lower, upper)


def _paths(blocks: DataFrame, tree: list[str], above: DataFrame | None, carry: list[str]) -> DataFrame:
    """(tree, place, digest, path) of the members: their flanks up to the tree's root, and
    the root. ``above`` has those of the block roots."""
    if above is None:
        met = blocks.withColumns({"root": F.col("top"), "onward": F.array()})
    else:
        above = above.select(
            *[F.col(c).alias(f"_{c}") for c in tree], F.col("place").alias("block"), "root", F.col("path").alias("onward"))
        same = F.col("b.block") == F.col("u.block")
        for c in tree:
            same &= F.col(f"b.{c}").eqNullSafe(F.col(f"u._{c}"))
        met = _with_paths(blocks.alias("b"), above.alias("u"), same).select("b.*", "u.root", "u.onward")
    return met.select(*tree, "total", "level0", "level1", "root", "onward", F.explode("members").alias("member")).select(
        *tree, F.col("member.place").alias("place"), F.col("member.digest").alias("digest"),
        *[F.col(f"member.{c}").alias(c) for c in carry], "root", F.concat(_segments(), "onward").alias("path"))


def climb(nodes: DataFrame, tree: list[str], carry: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(paths, roots) of nodes (tree, place, digest, carry) numbered densely from 0 in each tree.

    ``paths`` adds to each node the ``root`` of its tree and ``path``, the siblings left and
    right at each level up to it; ``roots`` has (tree, root).
    """
    carry = list(carry)
    if tree:
        totals = nodes.groupBy(*[F.col(c).alias(f"_{c}") for c in tree]).agg((F.max("place") + 1).alias("total"))
        totals = materialize(totals, "trees")
        totals, _ = broadcast_if_small(totals, totals.count())
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in tree])
        level = nodes.join(totals, same).drop(*[f"_{c}" for c in tree])
    else:
        level = nodes.withColumn("total", F.lit(nodes.count()))
    steps = []
    while True:
        blocks = materialize(_blocks(level, tree, [] if steps else carry), "blocks")
        steps.append(blocks)
        if blocks.where(F.col("total") > BLOCK).isEmpty():
            break
        # A block root's tree has one node for each block of the level below.
        level = blocks.select(
            *tree, F.col("block").alias("place"), F.col("top").alias("digest"),
            F.ceil(F.col("total") / BLOCK).alias("total"))
    paths = None
    for i in reversed(range(len(steps))):
        paths = _paths(steps[i], tree, paths, [] if i else carry)
        if i:
            paths = materialize(paths, "paths")
    return paths, steps[-1].select(*tree, F.col("top").alias("root"))


def fold(start: Column, path: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(path, start, lambda node, s: _sha(F.concat(s["left"], node, s["right"])))


def proof(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return _sha(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, tampered leaf, subroot, root and ``path`` of each row; the path leads
    from the leaf through its source's tree to the root."""
    fields = {c: F.col(c) for c in FIELDS}
    hashed = docs.select(*FIELDS, leaf(fields).alias("digest")).select(
        "doc_id", "source", "digest", tampered_leaf(fields, F.col("digest")).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"))  # lets the range split cut rows that are all alike
    numbered = dense_number(hashed, ["doc_id", "digest", "tie"], ["source"], name="place")
    leaves, subroots = climb(numbered, ["source"], ["doc_id", "tampered"])
    sources = dense_number(subroots.withColumnRenamed("root", "digest"), ["source"], name="place")
    tops = climb(sources, [], ["source"])[0].select(
        F.col("source").alias("_source"), F.col("root").alias("_root"), F.col("path").alias("_path"))
    met = _with_paths(leaves, materialize(tops, "tops"), F.col("source").eqNullSafe(F.col("_source")))
    return met.select(
        "doc_id", "source", F.col("digest").alias("leaf"), "tampered", F.col("root").alias("subroot"),
        F.col("_root").alias("root"), F.concat("path", "_path").alias("path"))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest with proofs, and each row checked after the tamper test against the root."""
    rows = manifest(docs).withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
