"""License notices in texts: exact phrases, and notices with a bounded number of edits.

Texts are compared in word form: A-Z in lower case, runs of ASCII characters that are
neither letters nor digits as one space. The fuzzy search splits a notice into
``edits + 1`` pieces. A place with at most that many edits leaves one piece untouched
(pigeonhole), so all places lie around exact finds of the pieces, which are substring
searches; only there the `regex` library matches the notice with its error bound and
reports the span and the edits. Digits of a notice may not be edited: they tell versions
apart. Matching begins and ends at word borders.

Each text is judged alone, so nothing is shuffled and the longest text bounds the memory.

Defined results: a null or empty text has no words, no labels and score 0. Repeated rows
are scanned each; extra columns are ignored; a table without rows gives none.
"""

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# The phrases of the exact search.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@dataclass(frozen=True)
class Notice:
    phrase: str
    label: str
    edits: int


NOTICES = (
    Notice("under the mit license", "mit", 2),
    Notice("apache license version 2", "apache-2", 2),
    Notice("cc by nc", "cc-by-nc", 0),
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("mozilla public license", "mpl", 2),
    Notice("bsd 3 clause license", "bsd-3", 1),
    Notice("bsd 2 clause license", "bsd-2", 1),
    Notice("creative commons attribution", "cc", 2),
    Notice("permission is hereby granted free of charge", "mit", 3),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("all rights reserved", "all-rights-reserved", 1),
)

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label: string, phrase: string, first_word: long, last_word: long, edits: int>>"
)

# One byte for another: lower case, and a space for every ASCII byte outside words.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_form(text: str | None) -> bytes:
    """The words of ``text``, one space before and after each."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def _finds(form: bytes, piece: bytes) -> list[int]:
    found, at = [], form.find(piece)
    while at >= 0:
        found.append(at)
        at = form.find(piece, at + 1)
    return found


def pieces(phrase: str, edits: int) -> list[tuple[int, bytes]]:
    """(offset, piece): the phrase in ``edits + 1`` parts of nearly equal length."""
    cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, phrase[a:b].encode()) for a, b in zip(cuts, cuts[1:])]


def _words_before(form: bytes, places: list[int]) -> dict[int, int]:
    """How many words begin before each place, counted once along the text."""
    at, words, found = 0, 0, {}
    for place in sorted({*places}):
        words += form.count(b" ", at, place)
        at, found[place] = place, words
    return found


class Scanner:
    """Exact and fuzzy search of one text in word form; built once per task."""

    def __init__(self, base=BASE, notices=NOTICES):
        self.base = [(f" {phrase} ".encode(), label) for phrase, label in base]
        self.notices = []
        for n in notices:
            pattern = regex.compile(rb"(?be)(?<![^ ])(?:%b){e<=%d}(?![^ ])" % (regex.escape(n.phrase).encode(), n.edits))
            self.notices.append((n, pieces(n.phrase, n.edits), pattern, [c for c in n.phrase if c.isdigit()]))

    def exact(self, form: bytes) -> list[tuple[int, str]]:
        """(start in bytes, label) of every place of a base phrase."""
        return [(at, label) for phrase, label in self.base for at in _finds(form, phrase)]

    def fuzzy(self, form: bytes) -> list[tuple[int, int, Notice, int]]:
        """(start, end, notice, edits) of the notices' places, at most one per stretch of text."""
        found = []
        for notice, seeds, pattern, digits in self.notices:
            length, slack = len(notice.phrase), notice.edits
            around = sorted(
                (max(0, at - offset - slack), at - offset + length + slack)
                for offset, piece in seeds for at in _finds(form, piece))
            done = 0
            for low, high in around:
                if high - max(low, done) < length - slack:
                    continue
                # One byte more on either side: the pattern sees the word border at the end, and
                # its first edit may be an insertion, which the library takes only behind the start.
                match = pattern.search(form, max(done, low - 1), min(len(form), high + 1))
                if match and [chr(c) for c in match[0] if 48 <= c <= 57] == digits:
                    found.append((match.start(), match.end(), notice, sum(match.fuzzy_counts)))
                    done = match.end()
        return found


def scan_licenses(docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """`SCHEMA` for each row of (doc_id, text): counts and places of the base phrases, the
    labels of both searches, the best agreement (1 - edits / length) and all fuzzy places
    with their spans in words."""

    def scan(batches):
        scanner = Scanner(base, notices)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                form = word_form(text.as_py())
                exact, fuzzy = scanner.exact(form), scanner.fuzzy(form)
                before = _words_before(form, [at for at, _ in exact] + [x for a, b, *_ in fuzzy for x in (a, b)])
                starts = [before[at] for at, _ in exact]
                labels = {label for _, label in exact}
                score = 1.0 if exact else max((1 - e / len(n.phrase) for _, _, n, e in fuzzy), default=0.0)
                matches = [
                    (n.label, n.phrase, before[a] - 1, before[b] - 1, e)
                    for a, b, n, e in sorted(fuzzy, key=lambda m: m[:2])]
                rows.append((
                    max(0, form.count(b" ") - 1), len(exact), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {m[0] for m in matches})), score,
                    [dict(zip(("label", "phrase", "first_word", "last_word", "edits"), m)) for m in matches]))
            match_type = pa.list_(pa.struct([
                ("label", pa.string()), ("phrase", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                ("edits", pa.int32())]))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), match_type]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)
