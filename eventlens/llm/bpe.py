"""BPE encoding and decoding in one pass with constant memory.

Encoding is a streaming transducer. Two texts that begin alike get the same tokens up to
some distance before the point where they part. `sufficient_lookahead` computes a bound
of that distance from the merge list, so a token that ends farther than that before the
end of what was read is final: it is emitted and its symbols are forgotten. A word of
any length passes through a buffer of fixed size.

Why the bound holds. In a proper merge list (parts are made before what is made of them)
merging works through the rules in order. Take two words with a common prefix and the
place up to which their tokens agree so far. A rule (u, v) moves that place to the left
only if u ends there and v follows in one word but not in the other, by the length of u.
From then on the token right of the place begins with u in both words. So the next rule
(u', v') that moves it comes later in the list and its v' begins with u. The longest such
chain of rules, by the lengths of their left parts, is the bound.

Decoding is a state machine from ids to text: it either gives the vocabulary's pieces
with a space between them, as a tokenizer without a decoder does, or the bytes they stand
for, assembled to code points as they complete.

Defined results: a null or empty text has no tokens and decodes to an empty text.
Special tokens written in a text are recognised. Repeated rows are encoded each; extra
columns pass through `encode`; a table without rows gives none.
"""

import codecs
import hashlib
import json
import unicodedata
from types import SimpleNamespace

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

END = "</w>"
CACHED_WORDS, CACHED_LENGTH = 150_000, 64  # bounds of a task's memory of encoded words
CHUNK = 256  # symbols read between two emissions
PLAIN_TO = "\u0557"  # below it all Unicode versions in use agree
KNOWN_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable in Latin-1, else the next unused one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def left_spines(merges: list[tuple[str, str]]) -> dict[str, set[str]]:
    """For each product, all tokens it can begin with, itself included."""
    spines: dict[str, set[str]] = {}
    for left, right in merges:
        own = spines.setdefault(left + right, {left + right})
        own |= spines.get(left, {left})
    return spines


def is_proper(merges: list[tuple[str, str]]) -> bool:
    """Whether each rule's parts are made before the rule itself comes."""
    made: dict[str, int] = {}
    for rank, (left, right) in enumerate(merges):
        made.setdefault(left + right, rank)
    return all(made.get(part, -1) < rank for rank, pair in enumerate(merges) for part in pair)


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols to read beyond a token's end until it is final (see the module's text)."""
    if not is_proper(merges):
        raise ValueError("the merge list uses a token before it makes it: no bound is known")
    spines = left_spines(merges)
    longest: dict[str, int] = {}  # by token: longest chain of later rules whose right part begins with it
    bound = 0
    for left, right in reversed(merges):
        chain = len(left) + longest.get(left, 0)
        bound = max(bound, chain)
        for begin in spines.get(right, {right}):
            longest[begin] = max(longest.get(begin, 0), chain)
    return bound


class Tables:
    """What a tokenizer file says; plain dictionaries, so that it travels to the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or steps != KNOWN_NORMALIZERS:
            raise ValueError("not a word BPE file of the known kind")
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word_pattern: str = split["pattern"]["Regex"]
        self.lookahead = sufficient_lookahead(self.merges)
        # the file without its vocabulary: what cuts a text into words
        bare = model | {"vocab": {}, "merges": []}
        self.splitter = json.dumps(spec | {"model": bare, "added_tokens": []})


class Transducer:
    """Symbols of one word in, ids out; holds ``lookahead + CHUNK`` symbols at most."""

    def __init__(self, vocab: dict[str, int], ranks: dict[tuple[str, str], int], lookahead: int, chunk: int = CHUNK):
        self.vocab, self.ranks, self.lookahead, self.chunk = vocab, ranks, lookahead, chunk
        self.pending: list[str] = []
        self.none = len(ranks)  # ranks below every rule

    def _merged(self, symbols: list[str]) -> list[str]:
        """The tokens of a stretch of symbols: always the first of the pairs of least rank."""
        tokens, ranks, none = list(symbols), self.ranks, self.none
        found = [ranks.get(pair, none) for pair in zip(tokens, tokens[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            at = found.index(best)
            tokens[at:at + 2] = [tokens[at] + tokens[at + 1]]
            del found[at]
            if at:
                found[at - 1] = ranks.get((tokens[at - 1], tokens[at]), none)
            if at < len(found):
                found[at] = ranks.get((tokens[at], tokens[at + 1]), none)
        return tokens

    def push(self, symbols: str) -> list[int]:
        """Read on; the ids that have become final."""
        self.pending += symbols
        # the newest symbol may turn out to be the last one, which has a form of its own
        known = len(self.pending) - 1
        if known < self.lookahead + self.chunk:
            return []
        ids, done = [], 0
        for token in self._merged(self.pending[:known]):
            if done + len(token) > known - self.lookahead:
                break
            done += len(token)
            ids.append(self.vocab[token])
        del self.pending[:done]
        return ids

    def end(self) -> list[int]:
        """End of the word: the remaining ids."""
        if not self.pending:
            return []
        self.pending[-1] += END
        ids = [self.vocab[t] for t in self._merged(self.pending)]
        self.pending = []
        return ids


class Encoder:
    """Text to ids, word by word through a `Transducer`; frequent short words are remembered."""

    def __init__(self, tables: Tables):
        self.special = tables.special
        self.by_byte = byte_symbols()
        self.splitter, self.library = tables.splitter, None
        ranks: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(tables.merges):
            ranks.setdefault(pair, rank)
        self.transducer = Transducer(tables.vocab, ranks, tables.lookahead)
        self.words = regex.compile(tables.word_pattern)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, tables.special)) + ")") if tables.special else None

    def segments(self, text: str) -> list[str]:
        return self.marks.split(text) if self.marks else [text]

    def pretokens(self, segment: str) -> list[str]:
        if not segment.isascii() and max(segment) > PLAIN_TO and any(
                unicodedata.category(c) == "Cn" for c in {*segment}):
            return self._newer_pretokens(segment)
        # lower case letter by letter, without the special form of a final sigma
        return self.words.findall(unicodedata.normalize("NFC", segment).replace("Σ", "σ").lower())

    def _newer_pretokens(self, segment: str) -> list[str]:
        """Words of a text with characters that this interpreter's Unicode tables lack:
        which of them are letters, and their lower case, only the library's tables say."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.splitter)
        plain = self.library.normalizer.normalize_str(segment)
        byte_of = {c: b for b, c in enumerate(self.by_byte)}
        cut = self.library.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(map(byte_of.__getitem__, word)).decode() for word, _ in cut]

    def encode_word(self, word: str) -> list[int]:
        symbols = "".join(map(self.by_byte.__getitem__, word.encode("utf-8", "surrogatepass")))
        ids = []
        for at in range(0, len(symbols), CHUNK):
            ids += self.transducer.push(symbols[at:at + CHUNK])
        return ids + self.transducer.end()

    def encode(self, text: str | None) -> list[int]:
        ids = []
        for segment in self.segments(text or ""):
            if segment in self.special:
                ids.append(self.special[segment])
            else:
                for word in self.pretokens(segment):
                    ids += self.encode_word(word)
        return ids


class Decoder:
    """Ids in, text out, one id at a time.

    ``as_bytes=False`` gives the pieces of the vocabulary with a space between them.
    ``as_bytes=True`` gives the text they stand for: bytes are assembled to code points
    (U+FFFD for what is not UTF-8), and a space follows the end of a word if more comes.
    """

    def __init__(self, tables: Tables, as_bytes: bool = False):
        special = {i: piece for piece, i in tables.special.items()}
        self.pieces = {i: piece for piece, i in tables.vocab.items()} | special
        self.special, self.as_bytes = special, as_bytes
        self.bytes_of = {c: bytes([b]) for b, c in enumerate(byte_symbols())}
        self.reset()

    def reset(self) -> None:
        self.gap, self.partial = "", codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, token: int) -> str:
        piece = self.pieces[token]
        if not self.as_bytes:
            text, self.gap = self.gap + piece, " "
            return text
        gap, ends = self.gap, piece.endswith(END) or token in self.special
        body = piece if token in self.special else b"".join(self.bytes_of[c] for c in piece.removesuffix(END))
        text = body if token in self.special else self.partial.decode(body, final=ends)
        self.gap = " " if ends else ""
        return gap + text

    def end(self) -> str:
        """The text of an unfinished code point, if any."""
        rest = self.partial.decode(b"", final=True)
        self.reset()
        return rest


class _Remembered(dict):
    """Word to (ids, decoded) as texts. Long words are not kept; when full, the words are put
    by, and those of them that come again are taken over."""

    def __init__(self, encoder: Encoder, decoder: Decoder):
        super().__init__()
        self.encoder, self.decoder, self.put_by = encoder, decoder, {}

    def __missing__(self, word: str) -> tuple[str, str]:
        value = self.put_by.get(word)
        if value is None:
            ids = self.encoder.encode_word(word)
            self.decoder.reset()
            value = (" ".join(map(str, ids)), "".join(map(self.decoder.push, ids)))
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.put_by = dict(self)
                self.clear()
            self[word] = value
        return value


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (array of int) and ``decoded`` (the pieces of ``ids``)."""
    return _tokenized(docs, tokenizer_path, text_col, keep_text, digests=False)


def encode_digests(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``, the digests of the
    decimal ids and of the decoded text."""
    return _tokenized(docs, tokenizer_path, text_col, keep_text, digests=True)


def _tokenized(docs, tokenizer_path, text_col, keep_text, digests):
    # plain values, of the size of the vocabulary
    spread = docs.sparkSession.sparkContext.broadcast(vars(Tables(tokenizer_path)))
    added = {"n_tokens": (pa.int64(), "long")} | (
        {"ids_sha256": (pa.string(), "string"), "decoded_sha256": (pa.string(), "string")} if digests
        else {"ids": (pa.list_(pa.int32()), "array<int>"), "decoded": (pa.string(), "string")})
    kept = [c for c in docs.columns if (keep_text or c != text_col) and c not in added]

    def run(batches):
        tables = SimpleNamespace(**spread.value)
        encoder, decoder = Encoder(tables), Decoder(tables)
        remembered = _Remembered(encoder, decoder)
        for batch in batches:
            rows = []
            for text in batch[text_col]:
                found = []
                for segment in encoder.segments(text.as_py() or ""):
                    if segment in encoder.special:
                        found.append((str(encoder.special[segment]), segment))
                    else:
                        found += map(remembered.__getitem__, encoder.pretokens(segment))
                ids, decoded = " ".join([f[0] for f in found]), " ".join([f[1] for f in found])
                count = ids.count(" ") + 1 if ids else 0
                if digests:
                    rows.append((count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    rows.append((count, list(map(int, ids.split())), decoded))
            columns = [pa.array([r[i] for r in rows], kind) for i, (kind, _) in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *columns], names=[*kept, *added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)
    return docs.mapInArrow(run, ", ".join([fields, *[f"{name} {kind}" for name, (_, kind) in added.items()]]))
