"""Removal of byte strings that start anywhere else too, decided by suffix arrays.

Whole corpora have no suffix array of their own here; what can match is brought together
first. Every string of 400 bytes is marked by one of its 200-byte parts, the one of least
number (the last of equals), so equal strings have equal marks at equal offsets. Marks that
occur once in all texts end the matter for their strings. Neighbouring strings of a text
with the same mark make one segment; equal segments are counted as one, and are repeated
as a whole if there are two or more. The different segments of one mark meet in one task,
where blocks of such groups are sorted by `grouping.suffix_array`.

A mark with more than `GROUP` different segments (a passage in very many different
surroundings) is divided before that: its strings go to finer groups by where the mark
lies in them and by the 375, 395 and at last 400 bytes that this fixes. In the last step
equal strings are equal segments, so no group stays large.

Texts equal to one another as a whole are removed as a whole and take part once.

Defined results: a null or empty text has no bytes and no runs. Texts of fewer than 400
bytes keep all. Repeated rows are copies of each other. Extra columns are ignored. A table
without rows gives none. What is left of a text is bytes: a cut may fall inside a character.
"""

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventlens.llm.grouping import repeated_starts
from eventlens.llm.rows import ROW, identified, with_text
from eventlens.llm.tokens import as_long, list_of_longs, mixed, sliding_min
from eventlens.session import materialize

LENGTH = 400
GROUP = 1_000  # different segments of one mark that are sorted together
BLOCK_BYTES = 1_000_000
CHUNK = 1 << 20  # starts handled at once; places must fit in the low bits of a mark's rank
STEPS = (25, 5, 1)  # widths of the finer groups, in starts

SEGMENT = "seg binary, mark long, lead long, run long, content binary"


def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the bytes, and powers of an odd base and of its inverse."""
    base = 0x9E3779B97F4A7C15
    size = CHUNK + 2 * LENGTH
    one = np.ones(1, np.uint64)
    powers = np.cumprod(np.concatenate([one, np.full(size, base, np.uint64)]))
    inverse = np.cumprod(np.concatenate([one, np.full(size, pow(base, -1, 1 << 64), np.uint64)]))
    return mixed(np.arange(1, 257, dtype=np.uint64)), powers, inverse


def _marks(data: np.ndarray, length: int, tables) -> tuple[np.ndarray, np.ndarray]:
    """(place, number) of the mark of each string of ``length`` bytes in ``data``."""
    numbers, powers, inverse = tables
    part = length // 2
    places, marks = [], []
    for begin in range(0, max(0, len(data) - length + 1), CHUNK):
        own = data[begin:begin + CHUNK + length - 1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[own] * powers[:len(own)])])
        parts = mixed((sums[part:] - sums[:-part]) * inverse[:len(own) - part + 1])
        # the rank of a part: its number, then the later place first
        low = np.uint64((1 << 21) - 1)
        rank = (parts & ~low) | (low - np.arange(len(parts), dtype=np.uint64))
        at = (low - (sliding_min(rank, length - part + 1) & low)).astype(np.int64)
        places.append(at + begin)
        marks.append(as_long(parts)[at])
    none = np.empty(0, np.int64)
    return (np.concatenate(places), np.concatenate(marks)) if places else (none, none)


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the stretches in which all columns stay the same."""
    changes = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        changes |= c[1:] != c[:-1]
    begins = np.concatenate([[0], np.flatnonzero(changes) + 1]) if len(columns[0]) else np.empty(0, np.int64)
    return begins, np.append(begins[1:], len(columns[0])) if len(begins) else begins


def _summaries(rows: DataFrame, length: int) -> DataFrame:
    """Per row: bytes, digest, number of the text, its marks and how often each occurs."""

    def summarize(batches):
        tables = _hash_tables()
        for batch in batches:
            sizes, digests, wholes, marks, times = [], [], [], [], []
            for text in batch["text"]:
                raw = (text.as_py() or "").encode()
                sizes.append(len(raw))
                digests.append(hashlib.sha256(raw).hexdigest())
                wholes.append(xxhash.xxh3_128_digest(raw))
                place, mark = _marks(np.frombuffer(raw, np.uint8), length, tables)
                begins, _ = _runs(place)
                own, count = np.unique(mark[begins], return_counts=True)
                marks.append(own)
                times.append(count.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["key"], batch["rid"], pa.array(sizes, pa.int64()), pa.array(digests),
                 pa.array(wholes, pa.binary()), list_of_longs(marks), list_of_longs(times)],
                names=["doc_id", "key", "rid", "n_bytes", "digest", "whole", "marks", "times"])

    return rows.select("doc_id", "key", "rid", "text").mapInArrow(
        summarize, "doc_id long, key long, rid long, n_bytes long, digest string, whole binary, marks array<long>, "
                   "times array<long>")


def _seg_id(mark: int, lead: int, content: bytes) -> bytes:
    return xxhash.xxh3_128_digest(content, seed=(mark ^ lead * 0x9E3779B9) & ((1 << 64) - 1))


def _segments(live: DataFrame, length: int) -> DataFrame:
    """The segments of the texts whose marks are among ``hits``: (key, rid, start) and `SEGMENT`.

    ``lead`` is how far the mark lies behind the first start, ``run`` the number of starts.
    A content that the task has just sent is left out, null.
    """

    def cut(batches):
        tables = _hash_tables()
        for batch in batches:
            rows, sent, held = [], set(), 0
            for key, rid, text, hits in zip(batch["key"], batch["rid"], batch["text"], batch["hits"]):
                raw = text.as_py().encode()
                place, mark = _marks(np.frombuffer(raw, np.uint8), length, tables)
                alive = np.isin(mark, np.asarray(hits.values))
                begins, ends = _runs(place, alive)
                for a, b in zip(begins[alive[begins]].tolist(), ends[alive[begins]].tolist()):
                    content, lead, own = raw[a:b - 1 + length], int(place[a]) - a, int(mark[a])
                    seg = _seg_id(own, lead, content)
                    new = seg not in sent
                    sent.add(seg)
                    held += len(content) * new + 100
                    rows.append((key.as_py(), rid.as_py(), a, seg, own, lead, b - a, content if new else None))
                    if held > 8_000_000:
                        yield _batch(rows, "key long, rid long, start long, " + SEGMENT)
                        rows, sent, held = [], set(), 0
            yield _batch(rows, "key long, rid long, start long, " + SEGMENT)

    return live.select("key", "rid", "text", "hits").mapInArrow(cut, "key long, rid long, start long, " + SEGMENT)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


def _divided(segments: DataFrame, width: int, length: int) -> DataFrame:
    """Parts of the segments for finer groups: (whole, offset) and `SEGMENT` of the part."""

    def divide(batches):
        for batch in batches:
            rows = []
            for seg, mark, lead, run, content in zip(*(batch[c].to_pylist() for c in ("seg", "mark", "lead", "run", "content"))):
                # the start at offset o has the mark `lead - o` bytes behind it
                offset = 0
                while offset < run:
                    cell = (lead - offset) // width
                    stop = min(run, lead - cell * width + 1)
                    nearest, farthest = cell * width, cell * width + width - 1
                    # what every string of this cell contains, from before the mark to after it
                    core = content[max(0, lead - nearest):lead - farthest + length]
                    own = content[offset:stop - 1 + length]
                    finer = int.from_bytes(xxhash.xxh3_64_digest(core, seed=(mark ^ cell * 0x632BE5AB) & ((1 << 64) - 1)), "big", signed=True)
                    rows.append((seg, offset, _seg_id(finer, lead - offset, own), finer, lead - offset, stop - offset, own))
                    offset = stop
            yield _batch(rows, "whole binary, offset long, " + SEGMENT)

    return segments.select("seg", "mark", "lead", "run", "content").mapInArrow(divide, "whole binary, offset long, " + SEGMENT)


def _sorted_out(segments: DataFrame, length: int) -> DataFrame:
    """(seg, low, high): runs of starts of the segments that are repeated in their mark's group."""

    def sort(batches):
        held, size, last = [], 0, None

        def flush(rows):
            out = []
            groups = [list(g) for _, g in groupby(rows, key=lambda r: r[0])]
            for group, found in zip(groups, repeated_starts([[r[2] for r in g] for g in groups], length)):
                for (_, seg, _), flags in zip(group, found):
                    begins, ends = _runs(flags)
                    out += [(seg, a, b) for a, b in zip(begins.tolist(), ends.tolist()) if flags[a]]
            return _batch(out, "seg binary, low long, high long")

        for batch in batches:
            for mark, seg, content in zip(*(batch[c].to_pylist() for c in ("mark", "seg", "content"))):
                if mark != last and size > BLOCK_BYTES:
                    yield flush(held)
                    held, size = [], 0
                held.append((mark, seg, content))
                size += len(content)
                last = mark
        if held:
            yield flush(held)

    return segments.select("mark", "seg", "content").repartition("mark").sortWithinPartitions("mark").mapInArrow(
        sort, "seg binary, low long, high long")


def _collapsed(segments: DataFrame) -> DataFrame:
    """One row for each different segment, with the number of its ``copies``."""
    return segments.groupBy("seg", "mark", "lead", "run").agg(
        F.sum("copies").alias("copies"), F.first("content", ignorenulls=True).alias("content"))


def _repeated(occurrences: DataFrame, length: int) -> DataFrame:
    """(key, rid, low, high): runs of starts in the texts whose strings start elsewhere too."""
    places = occurrences.select("key", "rid", "start", "seg")
    segments = materialize(_collapsed(occurrences.withColumn("copies", F.lit(1))), "segments")
    found = []
    for width in (*STEPS, None):
        found.append((places, segments.filter("copies > 1").select(
            "seg", F.lit(0).cast("long").alias("low"), F.col("run").alias("high"))))
        sizes = segments.groupBy("mark").agg(F.count("*").alias("several")).filter("several > 1")
        open_ = segments.join(sizes, "mark")
        small = open_ if width is None else open_.filter(F.col("several") <= GROUP)
        found.append((places, _sorted_out(small, length)))
        if width is None or sizes.filter(F.col("several") > GROUP).isEmpty():
            break
        parts = materialize(_divided(open_.filter(F.col("several") > GROUP), width, length), "parts")
        moved = parts.select(F.col("whole").alias("seg"), "offset", F.col("seg").alias("part")).distinct()
        places = places.join(moved, "seg").select(
            "key", "rid", (F.col("start") + F.col("offset")).alias("start"), F.col("part").alias("seg"))
        weights = segments.select(F.col("seg").alias("whole"), "copies")
        segments = materialize(_collapsed(parts.join(weights, "whole")), "segments")
    runs = [at.join(seen, "seg").select(
        "key", "rid", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
        for at, seen in found]
    result = runs[0]
    for r in runs[1:]:
        result = result.unionByName(r)
    return result


def _cut(live: DataFrame, length: int) -> DataFrame:
    """The texts without the bytes that the strings at the starts in ``runs`` cover."""

    def cut(batches):
        for batch in batches:
            rows = []
            for text, runs in zip(batch["text"].to_pylist(), batch["runs"].to_pylist()):
                raw = np.frombuffer(text.encode(), np.uint8)
                change = np.zeros(len(raw) + 1, np.int64)
                np.add.at(change, np.array([r["low"] for r in runs]), 1)
                np.add.at(change, np.array([r["high"] for r in runs]) - 1 + length, -1)
                covered = np.cumsum(change[:-1]) > 0
                spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                kept = raw[~covered].tobytes()
                rows.append((int(covered.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["rid"], *columns],
                names=["key", "rid", "n_removed", "n_spans", "kept_sha256", "kept"])

    return live.select("key", "rid", "text", "runs").mapInArrow(
        cut, "key long, rid long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(summary, changed) for (doc_id, text): per row its bytes, digest and whether it is a
    ``copy`` of another row; and the rows that lose a part, with ``n_removed``, ``n_spans``,
    ``kept_sha256`` and ``kept``."""
    rows = identified(docs.select("doc_id", "text"))
    summary = materialize(_summaries(rows, length), "summaries")
    texts = summary.groupBy("whole").agg(F.count("*").alias("rows"), F.min(F.struct(*ROW)).alias("first"))
    judged = summary.join(texts, "whole").withColumn("copy", (F.col("rows") > 1) & (F.col("n_bytes") >= length))

    lone = judged.filter((F.col("key") == F.col("first.key")) & (F.col("rid") == F.col("first.rid"))).dropDuplicates(ROW)
    marks = lone.select(*ROW, F.explode(F.arrays_zip("marks", "times")).alias("m")).select(*ROW, "m.marks", "m.times")
    shared = marks.groupBy("marks").agg(F.sum("times").alias("n")).filter("n > 1").select("marks")
    hits = materialize(marks.join(shared, "marks").groupBy(ROW).agg(F.collect_list("marks").alias("hits")), "hits")

    live = materialize(with_text(hits, rows), "live")
    occurrences = materialize(_segments(live, length), "occurrences")
    runs = _repeated(occurrences, length).groupBy(ROW).agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return judged, materialize(_cut(live.drop("hits").join(runs, ROW), length), "changed")


def dedup_summary(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row."""
    judged, changed = repeated_bytes(docs, length)
    copy, nothing = F.col("copy"), hashlib.sha256(b"").hexdigest()
    found = judged.join(changed.drop("kept"), ROW, "left")
    return found.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"))
