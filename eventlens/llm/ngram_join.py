"""Documents whose sets of word n-grams are alike: a rare-first prefix-filtered join.

Two sets of Jaccard similarity t share an n-gram among the first |x| - ceil(t |x|) + 1 of
each, in any one order of all n-grams. That is used twice:

1. In the order of the n-grams' numbers, the first ones of all sets are counted. With
   k - 1 n-grams more than the prefix, similar sets share k of them, so a set of which
   fewer are found elsewhere is linked with nothing and is left at that. This needs no
   counts of all n-grams.
2. For the others, all n-grams are counted and ordered rare first. N-grams of one set only
   come first and match nothing, so only what follows them in the prefix is indexed.

Candidates that share an indexed n-gram pass the length filter, the positional filter
(what can still be shared after the places of the match) and the suffix filter (the sum
over cells of the number range of the lesser counts); each pair left is verified once on
the whole sets.

Equal sets are one node from the start. In an index list, all sets are first compared with
the one that has most of its n-grams elsewhere (for copies of one text: the text), and
only what is not yet connected is compared in pairs, so large groups of near copies do
not meet in all pairs; links that change no component are not looked for.

Defined results: words are compared with A-Z in lower case, other letters as they are; a null
or empty text has no n-grams and is linked with nothing; fewer than n words are one n-gram. Null ids take part, but name no component unless all ids of
it are null. Repeated rows are one node. Extra columns are ignored or, in
`keep_one_per_group`, pass through. A table without rows gives none.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from eventlens.llm.components import components
from eventlens.llm.rows import ROW, identified, with_text
from eventlens.llm.tokens import as_long, joined, list_of_longs, slices, window_numbers, word_numbers
from eventlens.session import broadcast_if_small, materialize, stages

WORDS = 5
PERCENT = 80
EXTRA = 20  # a set of n has n / EXTRA n-grams more than its prefix in the first count
CELLS = 16  # parts of the number range in the suffix filter
STAR_ROUNDS = 2
SLICE_BYTES = 1_000_000  # text handled at once in a task
HEAD = 32  # earlier n-grams that an entry carries when lists are compared in pairs


def _ngram_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct n-grams of each text in lower case (A-Z only), as signed numbers."""
    numbers, offsets = word_numbers(pc.ascii_lower(texts))
    grams = as_long(window_numbers(numbers, words))
    sets = []
    for a, b in zip(offsets, offsets[1:]):
        n = b - a
        if n >= words:
            sets.append(np.unique(grams[a:b - words + 1]))
        elif n:  # the whole sequence, told from windows by its length
            whole = window_numbers(numbers[a:b], int(n))
            sets.append(as_long(joined(whole, np.full(1, n, np.uint64), 1)))
        else:
            sets.append(np.empty(0, np.int64))
    return sets


def _required(n):
    """The least overlap of a set of n with any other that is similar enough."""
    return -(-PERCENT * n // 100)


def _ahead(n):
    """How many of the n-grams in the first count a set of n shares with a larger similar one."""
    return 1 + n // EXTRA


def _summaries(rows: DataFrame, words: int) -> DataFrame:
    """Per row: size and number of its set, and the first n-grams of it in number order."""

    def summarize(batches):
        for batch in slices(batches, size=SLICE_BYTES):
            sets = _ngram_sets(batch["text"], words)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            probes = [s[:len(s) - _required(len(s)) + _ahead(len(s))] if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["key"], batch["rid"], pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()), list_of_longs(probes)],
                names=["doc_id", "key", "rid", "n", "digest", "probes"])

    return rows.select("doc_id", "key", "rid", "text").mapInArrow(
        summarize, "doc_id long, key long, rid long, n long, digest binary, probes array<long>")


def _full_sets(chosen: DataFrame, words: int) -> DataFrame:
    """(node, n, grams, cells): whole sets, and how many n-grams lie in each cell."""

    def build(batches):
        for batch in slices(batches, size=SLICE_BYTES):
            sets = _ngram_sets(batch["text"], words)
            cells = [np.bincount((s >> 60) + 8, minlength=CELLS) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array([len(s) for s in sets], pa.int64()), list_of_longs(sets), list_of_longs(cells)],
                names=["node", "n", "grams", "cells"])

    return chosen.select("node", "text").mapInArrow(
        build, "node long, n long, grams array<long>, cells array<long>")


def _index(full: DataFrame) -> DataFrame:
    """(gram, node, n, place, known): the part of each set's rare-first prefix that other sets
    share; ``known`` is the share of its n-grams found elsewhere."""
    grams = full.select("node", F.explode("grams").alias("gram"))
    counts = grams.groupBy("gram").agg(F.count("*").alias("sets")).filter("sets > 1")
    own = W.partitionBy("node")
    # Written between the two shuffles, so that the files of the first are gone at the second.
    found = materialize(grams.join(counts, "gram"), "found")
    shared = found.select(
        "gram", "node", F.count("*").over(own).alias("elsewhere"),
        F.row_number().over(own.orderBy("sets", "gram")).alias("rank")).join(full.select("node", "n"), "node")
    place = F.col("n") - F.col("elsewhere") + F.col("rank") - 1
    prefix = F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1
    return shared.filter(100 * F.col("elsewhere") >= PERCENT * F.col("n")).select(
        "gram", "node", "n", place.alias("place"), (F.col("elsewhere") / F.col("n")).alias("known"),
    ).filter(F.col("place") < prefix)


def _enough(inter: Column, n: Column, m: Column) -> Column:
    return 100 * inter >= PERCENT * (n + m - inter)


def _possible() -> Column:
    """Length and positional filter of the entries x and y of one list."""
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    lengths = 100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n")
    earlier = F.least("x.place", "y.place")  # what the prefixes before the match can share
    return lengths & _enough(left + earlier, F.col("x.n"), F.col("y.n"))


def _suffix_filtered(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs (a, b) whose cells can hold the overlap they need."""
    sizes = full.select("node", "n", "cells")
    x = sizes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("cells").alias("ca"))
    y = sizes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cb"))
    most = F.aggregate(F.zip_with("ca", "cb", lambda c, d: F.least(c, d)), F.lit(0).cast("long"), lambda s, c: s + c)
    return pairs.join(x, "a").join(y, "b").filter(_enough(most, F.col("na"), F.col("nb"))).select("a", "b", "na", "nb")


def _verified(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) that are similar enough, each compared once."""
    left = _suffix_filtered(pairs.distinct(), full)
    x = full.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    y = full.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    inter = F.size(F.array_intersect("ga", "gb")).cast("long")
    return left.join(x, "a").join(y, "b").filter(_enough(inter, F.col("na"), F.col("nb"))).select("a", "b")


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each entry of a list with the list's centre, unless they are connected."""
    best = F.max_by(F.struct("node", "n", "place", "part"), F.struct("known", "n", "node"))
    centres = lists.groupBy("gram").agg(best.alias("c")).select("gram", "c.*")
    met = lists.alias("x").join(centres.alias("y"), (F.col("x.gram") == F.col("y.gram"))
                                & (F.col("x.part") != F.col("y.part")) & _possible())
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _all_pairs(lists: DataFrame) -> DataFrame:
    """The entries of each list with those of other components.

    A pair is meant to be made in the first list it shares: entries carry up to `HEAD` of
    their set's n-grams in earlier lists, and meet only if these have none in common. What
    can still be shared is then what follows, and what of the earlier ones is not carried.
    """
    own = W.partitionBy("node").orderBy("place")
    heads = lists.groupBy("node").agg(F.transform(
        F.slice(F.sort_array(F.collect_list(F.struct("place", "gram"))), 1, HEAD), lambda e: e["gram"]).alias("head"))
    ranked = lists.withColumn("before", F.row_number().over(own) - 1).join(heads, "node").select(
        "gram", "node", "n", "place", "part", F.slice("head", F.lit(1), F.least("before", F.lit(HEAD))).alias("head"),
        F.greatest(F.lit(0), F.col("before") - HEAD).alias("rest"))
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    still = _enough(left + F.col("x.rest") + F.col("y.rest"), F.col("x.n"), F.col("y.n"))
    met = ranked.alias("x").join(ranked.alias("y"), (F.col("x.gram") == F.col("y.gram"))
                                 & (F.col("x.node") < F.col("y.node")) & (F.col("x.part") != F.col("y.part"))
                                 & _possible() & still & ~F.arrays_overlap("x.head", "y.head"))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _open_lists(index: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The index with each entry's component, without the lists that lie in one component."""
    if roots is None:
        parted = index.withColumn("part", F.col("node"))
    else:
        parted = index.join(roots.withColumnRenamed("root", "_root"), "node", "left").withColumn(
            "part", F.coalesce("_root", "node")).drop("_root")
    several = parted.groupBy("gram").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high")
    return materialize(parted.join(several.select("gram"), "gram"), "lists")


def _sharing(summary: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes of which enough n-grams of the first count are found in other sets.

    48 bits of an n-gram do here: a chance agreement only lets a set stay. An n-gram of two
    sets names both in its aggregate; only those of more sets are looked up again.
    """
    copies = summary.select("id", "digest").join(nodes, "digest").filter("id <> node").select("id")
    copies, _ = broadcast_if_small(copies, copies.count())
    lone = summary.select("id", "probes").join(copies, "id", "left_anti")
    grams = lone.select("id", F.explode("probes").alias("gram")).select(
        "id", F.call_function("shiftrightunsigned", F.col("gram"), F.lit(16)).alias("gram"))
    counts = materialize(grams.groupBy("gram").agg(
        F.count("*").alias("sets"), F.min("id").alias("low"), F.max("id").alias("high")).filter("sets > 1"), "counts")
    two = counts.filter("sets = 2").select(F.explode(F.array("low", "high")).alias("id"))
    more = counts.filter("sets > 2").select("gram")
    more, _ = broadcast_if_small(more, more.count())
    met = two.unionByName(grams.join(more, "gram").select("id")).groupBy("id").agg(F.count("*").alias("met"))
    needed = 1 + F.floor(F.ceil(PERCENT * F.col("n") / 100) / EXTRA)  # of the smallest similar set
    return met.join(summary.select("id", "n", *ROW), "id").filter(F.col("met") >= needed).select(
        F.col("id").alias("node"), *ROW)


def _roots(rows: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """(node, root) of the connected ones among the nodes ``chosen`` that are not roots themselves."""
    full = materialize(_full_sets(with_text(chosen, rows), words), "grams")

    index = materialize(_index(full), "index")
    links, roots = None, None
    for step in range(STAR_ROUNDS + 1):
        lists = _open_lists(index, roots)
        if lists.isEmpty():
            break
        found = _verified(_star_pairs(lists) if step < STAR_ROUNDS else _all_pairs(lists), full)
        links = materialize(found if links is None else found.unionByName(links), "links")
        roots = components(links)
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return chosen.select("node", F.col("node").alias("root")).limit(0) if roots is None else roots


def linked_sets(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): the set of each row of (doc_id, text) as ``node`` with its size ``n``,
    and (node, root) of the connected nodes that are not roots themselves."""
    rows = identified(docs.select("doc_id", "text"))
    # Each block deletes what it wrote but does not hand on: first n-grams and their counts
    # before the whole sets are made, those sets and their lists before the result is joined.
    with stages(docs.sparkSession):
        probed = materialize(_summaries(rows, words).withColumn("id", F.monotonically_increasing_id()), "sets")
        summary = materialize(probed.drop("probes"), "summary", outlives=True)
        nodes = materialize(summary.groupBy("digest").agg(F.min("id").alias("node")), "nodes", outlives=True)
        chosen = materialize(_sharing(probed, nodes), "sharing", outlives=True)
    with stages(docs.sparkSession):
        roots = materialize(_roots(rows, chosen, words), "roots", outlives=True)
    return summary.join(nodes, "digest").select("doc_id", *ROW, "n", "node"), roots


def _groups(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, key, rid and set size ``n`` of each row, with the least id of its component, and
    ``first``, the component's least (key, rid)."""
    summary, roots = linked_sets(docs, words)
    least = [F.min("doc_id").alias("component_id"), F.min(F.struct(*ROW)).alias("first")]
    named = summary.groupBy("node").agg(*least).join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    groups = named.groupBy("root").agg(F.min("component_id").alias("component_id"), F.min("first").alias("first"))
    return summary.join(named.select("node", "root").join(groups, "root").drop("root"), "node")


def component_ids(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of each row, and its ``key`` and ``rid``."""
    empty = F.col("n") == 0
    return _groups(docs, words).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *ROW)


def keep_one_per_group(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without those that another row of their component precedes.

    The row of least id stays, a null id comes last, and a number of the text decides
    between equal ids. Rows without n-grams have no component and stay; of repeated rows one does.
    """
    dropped = _groups(docs, words).where((F.col("n") > 0) & (F.struct(*ROW) != F.col("first"))).select(ROW).distinct()
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = identified(docs.select("doc_id", "text", whole)).drop("doc_id", "text")
    return rows.join(dropped, ROW, "left_anti").dropDuplicates(ROW).select("row.*")
