"""Benchmark passages in documents, found by winnowed fingerprints.

Of each window of 10 words, in documents and in benchmark items, the 5-gram of least number
is kept. Two equal windows keep the same one, and neighbouring windows share theirs, so few
numbers stand for a text and still every shared span of 10 words or more has one in common.
Documents and items are joined on these numbers. Around each hit the windows that kept it
are formed in full, as 128-bit numbers, and joined with the items' windows: what is equal
there is an occurrence, and occurrences that touch are one span.

An item of fewer than 10 words is one window of its own length; each such length (at most
nine) is winnowed like the long one, with windows of that length.

No join pairs documents with items before a window is known to occur: windows name their set
of items by a number, and a document meets each set once. Fingerprints and windows of the
benchmark are broadcast up to a counted bound and shuffled beyond it; of the texts only
those with a hit are read again.

Defined results: words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z in lower
case. A null or empty text has no words, and an item without words occurs nowhere. Items are
told apart by id: rows of one id are one item, and null ids are one item named `null`.
Repeated document rows each have their row. Extra columns are ignored. Without documents
there are no rows; without items no document has a hit.
"""

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from eventlens.llm.rows import ROW, identified, with_text
from eventlens.llm.tokens import as_long, list_of_longs, slices, sliding_min, window_numbers, word_numbers
from eventlens.session import broadcast_if_small, materialize

WINDOW = 10
GRAM = 5  # words of a fingerprint
SLICE_BYTES = 2_000_000  # text handled at once in a task

# One byte for another: lower case, and a space for every ASCII byte outside words.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def folded(texts: pa.Array) -> pa.Array:
    """The texts with A-Z in lower case and a space for each ASCII character outside words."""
    texts = pc.fill_null(texts, "")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or ends[-1] == ends[0]:
        return texts
    own = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_TO_WORDS)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(own))


def _kept(words: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, places): the fingerprint that each window of one text keeps, and the window's place."""
    gram = min(window, GRAM)
    least = sliding_min(window_numbers(words, gram, window), window - gram + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    places = np.flatnonzero(np.arange(len(least)) + window <= ends)
    return as_long(least)[places], places


def _row_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, side="right") - 1


def _summaries(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Per row: number of words and distinct fingerprints."""

    def summarize(batches):
        for batch in slices(batches, size=SLICE_BYTES):
            words, offsets = word_numbers(folded(batch["text"]))
            kept = [_kept(words, offsets, n) for n in lengths]
            cuts = [np.searchsorted(places, offsets) for _, places in kept]
            prints = [
                np.unique(np.concatenate([k[c[i]:c[i + 1]] for (k, _), c in zip(kept, cuts)] or [np.empty(0, np.int64)]))
                for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["key"], batch["rid"], pa.array(np.diff(offsets)), list_of_longs(prints)],
                names=["doc_id", "key", "rid", "n_words", "prints"])

    return rows.select("doc_id", *ROW, "text").mapInArrow(
        summarize, "doc_id long, key long, rid long, n_words long, prints array<long>")


def _windows(live: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, rid, place, length, a, b): the windows whose fingerprint is one of ``hits``."""

    def extend(batches):
        for batch in slices(batches, size=SLICE_BYTES):
            words, offsets = word_numbers(folded(batch["text"]))
            for length in lengths:
                numbers, places = _kept(words, offsets, length)
                cuts = np.searchsorted(places, offsets)
                alive = np.zeros(len(places), bool)
                for i, hits in enumerate(batch["hits"]):
                    own = slice(cuts[i], cuts[i + 1])
                    alive[own] = np.isin(numbers[own], np.asarray(hits.values))
                yield from _formed(batch, ROW, words, offsets, places[alive], length)

    return live.select(*ROW, "text", "hits").mapInArrow(
        extend, "key long, rid long, place long, length long, a long, b long")


def _formed(batch: pa.RecordBatch, names: list[str], words: np.ndarray, offsets: np.ndarray, at: np.ndarray, length: int):
    """The windows at the places ``at`` in full, with the columns ``names`` of their rows."""
    if not len(at):
        return
    row = _row_of(at, offsets)
    first, second = (as_long(window_numbers(words, length, seed))[at] for seed in (1, 2))
    whole = pa.RecordBatch.from_arrays(
        [pc.take(batch[c], pa.array(row)) for c in names]
        + [pa.array(x) for x in (at - offsets[row], np.full(len(at), length), first, second)],
        names=[*names, "place", "length", "a", "b"])
    for start in range(0, whole.num_rows, SLICE_BYTES // 40):
        yield whole.slice(start, SLICE_BYTES // 40)


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item, place, length, a, b, print): all windows of the items and the fingerprints they keep."""

    def cut(batches):
        for batch in slices(batches, size=SLICE_BYTES):
            words, offsets = word_numbers(folded(batch["text"]))
            sizes = np.minimum(np.diff(offsets), window)
            for length in np.unique(sizes[sizes > 0]).tolist():
                numbers, places = _kept(words, offsets, length)
                own = sizes[_row_of(places, offsets)] == length
                done = 0
                for made in _formed(batch, ["item"], words, offsets, places[own], length):
                    prints = pa.array(numbers[own][done:done + made.num_rows])
                    done += made.num_rows
                    yield made.append_column("print", prints)

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return named.mapInArrow(cut, "item string, place long, length long, a long, b long, print long")


def _item_sets(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(windows with the number of their set of items, (number, item) of each set)."""
    owned = windows.select("length", "a", "b", "item").distinct()
    number = F.struct(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("items"), "item")).alias("y"))
    sets = materialize(owned.groupBy("length", "a", "b").agg(number.alias("items")), "item-sets")
    return sets, materialize(owned.join(sets, ["length", "a", "b"]).select("items", "item").distinct(), "set-items")


def _spans(found: DataFrame) -> DataFrame:
    """(key, rid, n_hit, spans): words covered by the windows of each row, and the runs they form."""

    def merge(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            hit, spans = [], []
            for windows in batch["windows"]:
                first, length = (np.asarray(windows.values.field(c)) for c in ("place", "length"))
                order = np.argsort(first, kind="stable")
                first, end = first[order], np.maximum.accumulate((first + length)[order])
                starts = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
                a, b = first[starts], end[np.append(starts[1:], len(end)) - 1]
                hit.append(int((b - a).sum()))
                spans.append([{"first_word": int(x), "last_word": int(y) - 1} for x, y in zip(a, b)])
            kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["rid"], pa.array(hit, pa.int64()), pa.array(spans, kind)],
                names=["key", "rid", "n_hit", "spans"])

    places = found.groupBy(*ROW).agg(F.collect_list(F.struct("place", "length")).alias("windows"))
    return places.mapInArrow(
        merge, "key long, rid long, n_hit long, spans array<struct<first_word: long, last_word: long>>")


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of (doc_id, text): n_words, n_hit, the ``spans`` of words that windows of
    (item_id, text) cover, and the sorted names of the ``items`` they belong to."""
    known = materialize(_item_windows(items, window), "item-windows")
    lengths = sorted(r.length for r in known.select("length").distinct().collect())  # at most ``window``
    rows = identified(docs.select("doc_id", "text"))
    summary = materialize(_summaries(rows, lengths), "fingerprints")

    prints = materialize(known.select("print").distinct(), "item-prints")
    prints, _ = broadcast_if_small(prints, prints.count())
    hits = summary.select(*ROW, F.explode("prints").alias("print")).join(prints, "print").groupBy(*ROW).agg(
        F.collect_set("print").alias("hits"))
    live = materialize(with_text(materialize(hits, "hits"), rows), "live")

    sets, set_items = _item_sets(known)
    sets, _ = broadcast_if_small(sets, sets.count())
    found = materialize(_windows(live, lengths).join(sets, ["length", "a", "b"]).select(
        *ROW, "place", "length", "items"), "occurrences")
    listed = found.select(*ROW, "items").distinct().join(set_items, "items").groupBy(*ROW).agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return summary.drop("prints").join(_spans(found), ROW, "left").join(listed, ROW, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<first_word: bigint, last_word: bigint>>")).alias("spans"),
        F.coalesce("items", none).alias("items"))
