"""Words and windows of words as 64-bit numbers, for many texts at a time.

Words are runs of ``[^\\x20\\x09-\\x0D]``. A window's number is built by doubling: that of
``a + b`` words is a mix of those of its first a and its last b words.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 8_000_000  # text handled at once in a task
_MASK = (1 << 64) - 1


def slices(batches, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of about ``size`` bytes of text, whole rows each."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64)
        runs = np.cumsum(sizes) // size
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word (the finish of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all words, offsets): text i has the words offsets[i] to offsets[i + 1]."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten()
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    places = np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]
    words = flat.filter(pa.array(full)).dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in words.dictionary.cast(pa.binary()).to_pylist()),
        np.uint64, len(words.dictionary))
    return (known[np.asarray(words.indices)] if len(known) else known), places


def joined(left: np.ndarray, right: np.ndarray, seed: int = 0) -> np.ndarray:
    """The numbers of windows made of two neighbouring parts."""
    factor = np.uint64((0x9E3779B97F4A7C15 + 2 * seed * 0x632BE59BD9B4E019) & _MASK | 1)
    return mixed(left * factor + (right ^ np.uint64(0xD6E8FEB86659FD93 + seed)))


def window_numbers(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The number of the window of ``length`` words at each place that has one."""
    if len(words) < length:
        return np.empty(0, np.uint64)
    result, size, power, span = None, 0, words, 1
    while True:
        if length & span:
            result = power if result is None else joined(result[:len(words) - size - span + 1], power[size:], seed)
            size += span
        if size == length:
            return result[:len(words) - length + 1]
        power = joined(power[:-span], power[span:], seed)
        span *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.uint64(_MASK))
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def as_long(numbers: np.ndarray) -> np.ndarray:
    return numbers.view(np.int64)


def list_of_longs(parts: list[np.ndarray]) -> pa.Array:
    """A list column; an entry None is null."""
    sizes = [0 if p is None else len(p) for p in parts]
    values = np.concatenate([p for p in parts if p is not None] or [np.empty(0, np.int64)])
    missing = pa.array([p is None for p in parts])
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, pa.int64()),
        mask=missing if any(p is None for p in parts) else None)
