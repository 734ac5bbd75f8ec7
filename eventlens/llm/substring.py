"""Removal of word windows that an earlier document has, by level-wise doubling.

A window of 50 words can repeat only if its parts of 25 words do. Level one looks at
those alone: of the 25-word parts of each window the one of least number stands for it
(equal windows have equal ones, and neighbouring windows share them, so few are kept).
Windows whose part no other document has are done with; only the others are extended to
twice the length and compared in full, as 128-bit numbers. Documents that repeat an
earlier one word for word are settled before that by one number for the whole text.

All comparisons are aggregations by number, combined before the shuffle, and joins back
that can be split: a passage that a third of all documents share is one row per task.

Defined results: a null or empty text has no words and loses none. A null id counts as
larger than all others. Rows of equal id do not remove each other's words. A text that
keeps all its words keeps its form in `dedup_documents`; one that loses some has the rest
joined by one space; one that loses all is dropped there. Extra columns pass through. A
table without rows gives none.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventlens.llm.rows import LAST, ROW, identified, with_text
from eventlens.llm.tokens import (
    SLICE_BYTES, as_long, list_of_longs, slices, sliding_min, window_numbers, word_numbers)
from eventlens.session import materialize

WINDOW = 50
_NOTHING = hashlib.sha256(b"").hexdigest()


def _valid(offsets: np.ndarray, length: int, total: int) -> np.ndarray:
    """Whether the window of ``length`` words at each place of the joined texts lies in one of them."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return (np.arange(total) + length <= ends)[:max(0, total - length + 1)]


def _marks(words: np.ndarray, window: int) -> np.ndarray:
    """For each window the least number of its parts of half the length."""
    half = (window + 1) // 2
    return sliding_min(window_numbers(words, half), window - half + 1)


def _summaries(docs: DataFrame, window: int) -> DataFrame:
    """Per row: number of words, digest and number of the whole text, the windows' marks."""

    def summarize(batches):
        for batch in slices(batches):
            words, offsets = word_numbers(batch["text"])
            marks, valid = as_long(_marks(words, window)), _valid(offsets, window, len(words))
            whole, digest, parts = [], [], []
            for i, text in enumerate(batch["text"]):
                a, b = offsets[i], offsets[i + 1]
                whole.append(xxhash.xxh3_128_digest(words[a:b].tobytes()))
                digest.append(hashlib.sha256(b" ".join((text.as_py() or "").encode().split())).hexdigest())
                own = marks[a:b][valid[a:b]]
                parts.append(np.unique(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["rid"], pa.array(np.diff(offsets)), pa.array(digest), pa.array(whole, pa.binary()),
                 list_of_longs(parts)],
                names=["key", "rid", "n_words", "digest", "whole", "marks"])

    return docs.select("key", "rid", "text").mapInArrow(
        summarize, "key long, rid long, n_words long, digest string, whole binary, marks array<long>")


def _windows(live: DataFrame, window: int) -> DataFrame:
    """The windows, at twice the length, whose mark is one of ``hits``: (key, rid, place, a, b)."""

    def extend(batches):
        for batch in slices(batches):
            words, offsets = word_numbers(batch["text"])
            marks, valid = as_long(_marks(words, window)), _valid(offsets, window, len(words))
            alive = np.zeros(len(marks), bool)
            for i, hits in enumerate(batch["hits"]):
                a, b = offsets[i], min(offsets[i + 1], len(marks))
                alive[a:b] = np.isin(marks[a:b], np.asarray(hits.values)) & valid[a:b]
            at = np.flatnonzero(alive)
            row = np.searchsorted(offsets, at, side="right") - 1
            first, second = (as_long(window_numbers(words, window, seed))[at] for seed in (1, 2))
            made = [pc.take(batch[c], pa.array(row)) for c in ("key", "rid")]
            made += [pa.array(x) for x in (at - offsets[row], first, second)]
            whole = pa.RecordBatch.from_arrays(made, names=["key", "rid", "place", "a", "b"])
            for start in range(0, whole.num_rows, SLICE_BYTES // 40):
                yield whole.slice(start, SLICE_BYTES // 40)

    return live.select("key", "rid", "text", "hits").mapInArrow(
        extend, "key long, rid long, place long, a long, b long")


def _cut(live: DataFrame, window: int) -> DataFrame:
    """The texts without the words that the windows at ``starts`` cover."""

    def cut(batches):
        for batch in batches:
            texts, removed, digests = [], [], []
            for text, starts in zip(batch["text"], batch["starts"]):
                words = text.as_py().encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                at = np.asarray(starts.values)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                covered = np.cumsum(change[:-1]) > 0
                kept = b" ".join([w for w, gone in zip(words, covered.tolist()) if not gone])
                texts.append(kept.decode())
                removed.append(int(covered.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["rid"], pa.array(removed, pa.int64()), pa.array(digests), pa.array(texts)],
                names=["key", "rid", "n_removed", "kept_sha256", "kept_text"])

    return live.select("key", "rid", "text", "starts").mapInArrow(
        cut, "key long, rid long, n_removed long, kept_sha256 string, kept_text string")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(summary, changed) for (doc_id, text): the summary of each row with ``copy`` set where
    an earlier row has the same words, and the rows of which windows are removed, with
    ``n_removed``, ``kept_sha256`` and ``kept_text``."""
    rows = identified(docs.select("doc_id", "text"))
    summary = materialize(_summaries(rows, window), "summaries")
    firsts = summary.groupBy(F.col("whole").alias("_whole")).agg(F.min("key").alias("first"))
    judged = summary.join(firsts, F.col("whole") == F.col("_whole")).withColumn(
        "copy", (F.col("key") > F.col("first")) & (F.col("n_words") >= window))

    marks = judged.filter(~F.col("copy")).select("key", "rid", F.explode("marks").alias("mark"))
    shared = marks.groupBy("mark").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
    hits = materialize(marks.join(shared.select("mark"), "mark").groupBy("key", "rid").agg(
        F.collect_set("mark").alias("hits")), "hits")

    live = materialize(with_text(hits, rows), "live")

    windows = _windows(live, window)
    earlier = windows.groupBy("a", "b").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high")
    repeats = windows.join(earlier.select("a", "b", "low"), ["a", "b"]).filter("key > low")
    starts = repeats.groupBy("key", "rid").agg(F.collect_list("place").alias("starts"))
    return judged, materialize(_cut(live.join(starts, ROW), window), "changed")


def dedup_summary(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row."""
    judged, changed = repeated_windows(docs, window)
    changed = changed.drop("kept_text")
    doc_id = F.when(F.col("key") != LAST, F.col("key"))
    return judged.join(changed, ROW, "left").select(
        doc_id.alias("doc_id"), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(_NOTHING)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"))


def dedup_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated windows cut out of ``text``; rows left without a word by
    that are gone."""
    judged, changed = repeated_windows(docs, window)
    gone = judged.filter("copy").select("key", "rid").unionByName(
        changed.filter("kept_text = ''").select("key", "rid")).distinct()
    cut = changed.filter("kept_text <> ''").select("key", "rid", "kept_text")
    rows = identified(docs.withColumn("_row", F.struct(*[F.col(c) for c in docs.columns])))
    kept = rows.select("_row", "key", "rid").join(gone, ROW, "left_anti").join(cut, ROW, "left")
    text = F.coalesce("kept_text", "_row.text").alias("text")
    return kept.select(*[text if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
