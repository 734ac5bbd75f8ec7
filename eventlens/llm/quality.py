"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is an expression over the text of the same row, so the whole table is
judged in one scan without a shuffle. Words are runs of ``[^\\x20\\x09-\\x0D]``.

Defined results: a null or empty text has no words and no lines, all counts are 0, it
fails the base rule and is not kept. Extra columns pass through `filter_quality`
untouched; a table without rows gives no rows; repeated rows are judged one by one.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Texts of fewer words may do without stop words.
STOP_FROM = 50

# Frequent function words of the languages in use, as written inside a sentence.
STOP_WORDS = (
    "the of and to in is that for on with as it was by are be this from or an a "
    "le la les de des et en un une est que qui dans pour sur du au "
    "der die das und ist ein eine von zu den mit auf nicht im "
    "el los las y que del por con para su se al una"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a limit of None is open, a null measure passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Ratios are to the number of words, of code points in words or of lines with a word;
# `stop_words` counts the different ones.
RULES = (
    Rule("words", "n_words", low=10),
    Rule("repeated_words", "repeat_ratio", high=0.2),
    Rule("word_length", "mean_word_length", low=2.0, high=20.0),
    Rule("echoed_words", "echo_ratio", high=0.2),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_words", low=2),
    Rule("capitals", "upper_ratio", high=0.6),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
)


def bound(value: Column, then) -> Column:
    """``then(x)`` with x evaluated once, also where lambdas mention it many times."""
    return F.transform(F.array(value), then)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the array.

    Windows are compared by a 64-bit hash, built from the hashes of word pairs. Sorting
    (hash, place) brings equal windows together; the union of the found windows is then
    one pass over their places. Texts without a repeated window stop before the sort.
    """
    pairs = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))
    windows = bound(pairs, lambda p: F.transform(
        p, lambda h, i: F.xxhash64(h, F.get(p, i + 2), F.get(words, i + WINDOW - 1))))
    hashes = F.when(F.size(words) >= WINDOW, F.slice(windows, F.lit(1), F.size(words) - (WINDOW - 1)))

    def covered(hashed: Column) -> Column:
        places = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = bound(places, lambda p: F.transform(
            F.filter(p, lambda x, j: (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"])),
            lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            F.sort_array(found), start,
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
            lambda a: a["n"])

    found = bound(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.coalesce(found, F.lit(0)).cast("long")


def measures(text: Column) -> Column:
    """All measures of a text as one struct; counts are long, ratios double or null."""
    stops = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))])

    def cut(t: Column) -> Column:
        return F.struct(
            F.filter(F.split(t, SPACE), lambda w: w != "").alias("words"),
            F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
            F.regexp_count(t, F.lit(SYMBOLS)).alias("symbols"),
            F.regexp_count(t, F.lit(r"\p{Lu}")).alias("upper"))

    def count(p: Column) -> Column:
        words, lines = p["words"], p["lines"]
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": p["symbols"],
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": bound(words, _repeat_words),
            "n_lines": F.size(lines),
            "n_upper": p["upper"],
            "n_stop": F.size(F.array_intersect(words, stops)),
            "n_echo": F.size(F.filter(words, lambda w, i: F.get(words, i - 1) == w)),
        }
        return F.struct(*[c.cast("long").alias(name) for name, c in counts.items()])

    def ratios(m: Column) -> Column:
        per_word = F.when(m["n_words"] > 0, m["n_words"])
        return F.struct(*[m[c].alias(c) for c in COUNTS], *[c.alias(name) for name, c in {
            "mean_word_length": m["word_chars"] / per_word,
            "symbol_ratio": m["n_symbols"] / per_word,
            "repeat_ratio": m["n_repeat_words"] / per_word,
            "echo_ratio": m["n_echo"] / per_word,
            "stop_words": F.when(m["n_words"] >= STOP_FROM, m["n_stop"]),
            "upper_ratio": m["n_upper"] / F.when(m["word_chars"] > 0, m["word_chars"]),
            "dup_line_ratio": m["n_dup_lines"] / F.when(m["n_lines"] > 0, m["n_lines"]),
        }.items()])

    return bound(bound(bound(F.coalesce(text, F.lit("")), cut), count), ratios)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_stop", "n_echo")


def compiled(m: Column, rules=RULES) -> tuple[Column, Column]:
    """(all rules hold, names of the failed rules) for a struct of measures."""
    held = []
    for r in rules:
        value = m[r.measure]
        limits = [value >= r.low] * (r.low is not None) + [value <= r.high] * (r.high is not None)
        held.append((r.name, F.coalesce(reduce(Column.__and__, limits, F.lit(True)), F.lit(True))))
    failed = F.concat_ws(",", *[F.when(~ok, F.lit(name)) for name, ok in held])
    return reduce(Column.__and__, [ok for _, ok in held], F.lit(True)), failed


def verdict(text: Column, rules=RULES) -> Column:
    """The measures with ``base_failed``, ``failed_rules`` and ``kept``, as one struct.

    One expression, so that a filter on it that the optimizer moves below the projection
    evaluates it once.
    """

    def judged(m: Column) -> Column:
        ok, failed = compiled(m, rules)
        base = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        return F.struct(m.alias("measures"), base.alias("base_failed"), failed.alias("failed_rules"), (~base & ok).alias("kept"))

    return bound(measures(text), judged)


def judge(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), all measures, ``base_failed``, ``failed_rules`` and
    ``kept`` per row."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    return docs.select(row, verdict(docs[text_col], rules).alias("v")).select(
        "row", "v.measures.*", "v.base_failed", "v.failed_rules", "v.kept")


def filter_quality(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows that every rule keeps, with the columns of ``docs``."""
    return docs.filter(verdict(docs[text_col], rules)["kept"])
