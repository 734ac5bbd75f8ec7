"""The prefix trie of conversations, built as a burst trie.

A conversation becomes one string of fixed-width turn records (digest of role and text, and
the text's bytes), so prefixes of conversations are prefixes of strings and texts are never
shuffled. Conversations of equal strings are one weighted entry from then on.

A container holds the suffixes of the entries under one trie head. Containers of more than
`CONTAINER` entries burst: each suffix gives up its first turn, and the turn names the head of
the container it moves to. Only those are looked at again; the rest are sorted by suffix and
swept once, each in one task, with a stack that is as deep as the longest suffix. The sweep
emits a node when the suffixes leave it. Heads that burst get their totals from the
containers and heads below them.

Copies are counted before anything is shuffled by string: ids are range-partitioned by (string,
id) and written as pieces, so a string that a third of all conversations share is spread
over tasks; what one task reads of it in the end, to hash the ids in order, is its pieces.

Rebuilding: conversation c has the first h turns of conversation c - c mod 5 (all if it has
fewer, none if it does not exist) and then its own turns after its first h, with h = crc32 of
the decimal c, mod 9.

Defined results: turns are ordered by number, null first, and turns of one number by the digest
of role and text; a null role or text is empty. Repeated rows are turns of their own. Rows without a conversation id belong to
no conversation. A conversation that has no turns left is a member of the root alone. Extra columns are ignored. Without
conversations there is no node. A conversation is one row of 24 bytes a turn, so its
turns have to fit in a task.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventlens.session import broadcast_if_small, materialize

TURN = 24  # bytes of a turn record: 16 of a digest, 8 for the text's length
CONTAINER = 256
PIECE_IDS = 4_096
BASE_EVERY, HEAD_MODULUS = 5, 9
_ROWS = 10_000  # nodes a batch

_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_NOTHING = hashlib.sha256(b"").hexdigest()


# --- conversations as strings -----------------------------------------------------

def _turns(seq: Column, first: Column, count: Column | None = None) -> Column:
    """Turns of a string of records from number ``first`` on."""
    start = first * TURN + 1
    return F.substring(seq, start, F.octet_length(seq) if count is None else count * TURN)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq) of turn rows (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    record = F.concat(
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
        F.lpad(F.hex(F.octet_length(text)), 16, "0"))
    said = turns.where("conv_id is not null").select("conv_id", F.struct("turn", record.alias("record")).alias("said"))
    return said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["record"]), "")).alias("seq"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, seq) with the head of each conversation taken from the base of its five."""
    heads = convs.where(F.pmod("conv_id", F.lit(BASE_EVERY)) == 0).select(
        F.col("conv_id").alias("base"), _turns(F.col("seq"), F.lit(0), F.lit(HEAD_MODULUS - 1)).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_MODULUS
    own = convs.withColumns({"base": F.col("conv_id") - F.pmod("conv_id", F.lit(BASE_EVERY)), "h": h.cast("int")})
    none = F.lit("").cast("binary")
    return own.join(heads, "base", "left").select("conv_id", F.concat(
        F.coalesce(_turns(F.col("head"), F.lit(0), F.col("h")), none), _turns(F.col("seq"), F.col("h"))).alias("seq"))


# --- copies ------------------------------------------------------------------------

def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one string, of rows sorted by (string, id)."""
    now, ids, made = None, [], []

    def close():
        if ids:
            made.append((now, ids[0], len(ids), ",".join(map(str, ids))))
            ids.clear()

    def batch_of(rows):
        names = ("digest", "first", "n", "ids")
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for digest, conv in zip(batch["digest"].to_pylist(), batch["conv_id"].to_pylist()):
            if digest != now or len(ids) == PIECE_IDS:
                close()
                now = digest
            ids.append(conv)
        if len(made) >= _ROWS:
            yield batch_of(made)
            made = []
    close()
    if made:
        yield batch_of(made)


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per string: least id, number of ids, digest of all ids; of pieces sorted by (string, first)."""
    now, low, n, ends, made = None, None, 0, None, []

    def batch_of(rows):
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=("low", "n", "ends"))

    for batch in batches:
        for digest, first, count, ids in zip(*[batch[c].to_pylist() for c in ("digest", "first", "n", "ids")]):
            if digest == now:
                ends.update(b"," + ids.encode())
                n += count
                continue
            if now is not None:
                made.append((low, n, ends.hexdigest()))
            now, low, n, ends = digest, first, count, hashlib.sha256(ids.encode())
        if len(made) >= _ROWS:
            yield batch_of(made)
            made = []
    if now is not None:
        made.append((low, n, ends.hexdigest()))
    if made:
        yield batch_of(made)


def entries(convs: DataFrame) -> DataFrame:
    """(low, n, ends, rest): distinct strings with their least conversation, the number of
    conversations and the digest of their ids."""
    named = convs.select(F.unhex(F.md5("seq")).alias("digest"), "conv_id")
    ranged = named.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    pieces = ranged.mapInArrow(_pieces, "digest binary, first long, n long, ids string")
    totals = pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(
        _totals, "low long, n long, ends string")
    return totals.join(convs.select(F.col("conv_id").alias("low"), F.col("seq").alias("rest")), "low")


# --- bursting ----------------------------------------------------------------------

def _burst(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries in small containers, heads): containers burst until all are small.

    Entries have the ``key`` of their container (a digest of the path), its ``depth``, the bytes
    of its last turn, the least conversation of its parent and the keys ``above`` it.
    """
    small, heads = [], []
    while True:
        live = materialize(live, "containers")
        sizes = live.groupBy("key").agg(
            F.count("*").alias("size"), F.sum("n").alias("members"), F.min("low").alias("least"),
            F.first("depth").alias("depth"), F.first("bytes").alias("bytes"), F.first("parent").alias("parent"),
            F.first("above").alias("above"),
            F.max(F.when(F.octet_length("rest") == 0, F.col("ends"))).alias("ends"))
        full = materialize(sizes.where(F.col("size") > CONTAINER), "heads")
        count = full.count()
        if not count:
            return _union([*small, live]), _union(heads) if heads else full
        heads.append(full)
        keys = full.select(F.col("key").alias("_key"), "least")
        keys, _ = broadcast_if_small(keys, count)
        small.append(live.join(keys, F.col("key") == F.col("_key"), "left_anti"))
        turn = F.substring("rest", F.lit(1), F.lit(TURN))
        live = live.join(keys, F.col("key") == F.col("_key")).where(F.octet_length("rest") > 0).select(
            F.unhex(F.md5(F.concat("key", turn))).alias("key"), (F.col("depth") + 1).alias("depth"),
            F.conv(F.hex(F.substring(turn, F.lit(17), F.lit(8))), 16, 10).cast("long").alias("bytes"),
            F.col("least").alias("parent"), F.concat("above", F.array("key")).alias("above"),
            "low", "n", "ends", _turns(F.col("rest"), F.lit(1)).alias("rest"))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole, *more = frames
    for frame in more:
        whole = whole.unionByName(frame)
    return whole


# --- sweeping ----------------------------------------------------------------------

class _Node:
    __slots__ = ("bytes", "n", "low", "children", "leaves", "saved", "ends", "closed")

    def __init__(self, size: int):
        self.bytes, self.n, self.low = size, 0, None
        self.children = self.leaves = self.saved = 0
        self.ends, self.closed = _NOTHING, []

    def take(self, low: int, n: int) -> None:
        self.n += n
        self.low = low if self.low is None or low < self.low else self.low


def _shared_turns(a: bytes, b: bytes) -> int:
    """How many whole turns two strings have in common at their start."""
    most = min(len(a), len(b)) // TURN
    if a[:most * TURN] == b[:most * TURN]:
        return most
    low, high = 0, most - 1  # the answer lies in between
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * TURN:mid * TURN] == b[low * TURN:mid * TURN]:
            low = mid
        else:
            high = mid - 1
    return low


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of the containers, of entries sorted by (container, suffix)."""
    out, stack, here, last = [], [], None, b""

    def close(node: _Node, depth: int) -> tuple:
        """What is known of a node that is complete; its children learn their parent."""
        node.saved += (node.n - 1) * node.bytes
        node.leaves = node.leaves or 1
        out.extend((*child[:2], node.low, *child[3:]) for child in node.closed)
        return (node.low, depth, None, node.n, node.children, node.leaves, node.saved, node.ends, None)

    def pop() -> None:
        row = close(node := stack.pop(), here[1] + len(stack))
        above = stack[-1]
        above.closed.append(row)
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        above.take(node.low, node.n)

    def end_container() -> None:
        while len(stack) > 1:
            pop()
        row = close(stack.pop(), here[1])
        out.append((*row[:2], here[2], *row[3:8], here[3]))

    def batch_of(rows: list) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.binary())]
        names = [c.split()[0] for c in _NODE.split(", ")] + ["above"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    columns = ("key", "depth", "parent", "above", "bytes", "low", "n", "ends", "rest")
    for batch in batches:
        for key, depth, parent, above, size, low, n, ends, rest in zip(*[batch[c].to_pylist() for c in columns]):
            if here is None or key != here[0]:
                if here:
                    end_container()
                here, last = (key, depth, parent, above), b""
                stack.append(_Node(size))
            for _ in range(len(stack) - 1 - _shared_turns(last, rest)):
                pop()
            for at in range((len(stack) - 1) * TURN, len(rest), TURN):
                stack.append(_Node(int.from_bytes(rest[at + 16:at + TURN], "big")))
            stack[-1].take(low, n)
            stack[-1].ends = ends
            last = rest
            while len(out) >= _ROWS:
                yield batch_of(out[:_ROWS])
                del out[:_ROWS]
    if here:
        end_container()
    for start in range(0, len(out), _ROWS):
        yield batch_of(out[start:start + _ROWS])


def _head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of heads that burst: their own figures and those of all heads and containers below."""
    own = (F.col("members") - 1) * F.col("bytes")
    below = heads.select("above", own.alias("saved"), F.lit(0).cast("long").alias("leaves")).unionByName(
        tops.select("above", F.col("saved_tokens").alias("saved"), F.col("n_leaves").alias("leaves")))
    sums = below.select("saved", "leaves", F.size("above").alias("n"), F.posexplode("above").alias("at", "_key")).groupBy(
        "_key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"),
                    F.count_if(F.col("at") == F.col("n") - 1).alias("children"))
    return heads.join(sums, F.col("key") == F.col("_key")).select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (own + F.col("saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(_NOTHING)).alias("ends_sha256"))


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, seq), one row each, named by depth and least member."""
    start = {"key": F.lit("").cast("binary"), "depth": F.lit(0).cast("long"), "bytes": F.lit(0).cast("long"),
             "parent": F.lit(None).cast("long"), "above": F.array().cast("array<binary>")}
    small, heads = _burst(entries(convs).withColumns(start))
    swept = materialize(small.repartition("key").sortWithinPartitions("key", "rest").mapInArrow(
        _sweep, f"{_NODE}, above array<binary>"), "swept")
    tops = swept.where("above is not null")
    return swept.drop("above").unionByName(_head_nodes(heads, tops))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of (conv_id, turn, role, text)."""
    whole = materialize(sequences(turns), "sequences")
    return trie(materialize(rebuilt(whole), "rebuilt"))
