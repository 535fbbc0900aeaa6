"""Quality rules: a table of thresholds, compiled into columns of one Spark projection.

A rule bounds one measure, or the ratio of two. The measures of a text are DataFrame
functions of its words and lines, so a document is judged where it is scanned: no user
function, no shuffle, no other row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``measure``, divided by ``per`` if that is named, must lie in ``[low, high]``; None is no bound."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


#: Words are separated by these; 20 and 09 to 0D in hex.
BLANK = " \t\n\x0b\x0c\r"
#: Words of a window whose repetition counts.
WINDOW = 8
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "with", "on", "by", "as", "be", "this", "are",
    "at", "from", "or", "an", "not", "have", "which",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "par", "dans", "qui", "sur", "au",
    "pas", "avec", "il", "ne", "se",
    "der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "für", "ist", "nicht", "im", "dem", "ein",
    "eine", "als", "auch", "es",
    "el", "y", "los", "las", "del", "por", "con", "no", "una", "su", "para", "al", "lo", "como", "más",
)
#: A text fails whatever the table says if it breaks one of these.
BASE = (
    Rule("words", "n_words", low=20),
    Rule("repeated words", "n_repeat_words", "n_words", high=0.3),
)
#: Length, symbol, stop-word and line ratios, in the spirit of published rules for web text.
RULES = (
    Rule("many words", "n_words", high=1_000_000),
    Rule("word length", "word_chars", "n_words", low=2, high=14),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("exclamation marks", "n_marks", "n_words", high=0.2),
    Rule("words without a letter", "n_letterless_words", "n_words", high=0.3),
    Rule("capital letters", "n_capitals", "word_chars", high=0.4),
    Rule("stop words", "n_stop_words", "n_words", low=0.03),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("listed lines", "n_listed_lines", "n_lines", high=0.9),
    Rule("unfinished lines", "n_open_lines", "n_lines", high=0.5),
)


#: What a measure counts; ``\\S`` is what isn't ``BLANK`` in these patterns.
SYMBOLS, MARKS, CAPITALS = "[#*$%&|<>]", "!", "[A-ZÀ-ÖØ-Þ]"
LETTERLESS_WORD = r"(?<!\S)[!-@\[-`{-~]++(?!\S)"
LISTED_LINE = r"(?m)^[ \t]*+[-*•|#]"
OPEN_LINE = r"(?m)(?:\.\.\.|…)$"


def _is_stop_word(word: Column) -> Column:
    """True for a stop word as it stands in a sentence: small or capital, with a comma or a full stop."""
    return word.isin(*[form + end for w in STOP_WORDS for form in (w, w.capitalize()) for end in ("", ",", ".")])


def _count(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _joined(hashes: Column | str, distance: int) -> Column:
    """Hashes of windows of twice the width, each from two neighbours."""
    array = F.col(hashes) if isinstance(hashes, str) else hashes
    both = F.zip_with(array, F.slice(array, F.lit(distance + 1), F.size(array)), lambda a, b: F.xxhash64(a, b))
    return F.slice(both, F.lit(1), F.greatest(F.size(array) - distance, F.lit(0)))


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``_words``: words inside a window that the text holds at least twice."""
    df = df.withColumn("_windows", F.transform("_words", lambda w: F.xxhash64(w)))
    for distance in (1, 2, 4):  # WINDOW is 8
        df = df.withColumn("_windows", _joined("_windows", distance))
    # Few texts repeat a window: only theirs are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    df = df.withColumn("_placed", F.when(repeats, F.sort_array(placed)))
    twin = lambda x, i: (F.get("_placed", i - 1)["hash"] == x["hash"]) | (F.get("_placed", i + 1)["hash"] == x["hash"])
    found = F.filter("_placed", lambda x, i: F.coalesce(twin(x, i), F.lit(False)))
    df = df.withColumn("_starts", F.sort_array(F.transform(found, lambda x: x["at"])))
    # A window adds the words up to the next repeated window, all of its own at most.
    later = F.slice("_starts", F.lit(2), F.size("_starts"))
    added = F.zip_with("_starts", later, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(added, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("_windows", "_placed", "_starts")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the measures of every row's text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias(id_col), text.alias("_text"))
    trimmed = F.btrim("_text", F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split("_text", "\n", -1), lambda s: F.btrim(s, F.lit(BLANK)) != "")
    df = _repeat_words(df.withColumns({"_words": words, "_lines": lines}))
    return df.select(
        id_col,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.translate("_text", BLANK, "")).cast("long").alias("word_chars"),
        _count("_text", SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        _count("_text", MARKS).alias("n_marks"),
        _count("_text", LETTERLESS_WORD).alias("n_letterless_words"),
        _count("_text", CAPITALS).alias("n_capitals"),
        F.size(F.filter("_words", _is_stop_word)).cast("long").alias("n_stop_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _count("_text", LISTED_LINE).alias("n_listed_lines"),
        _count("_text", OPEN_LINE).alias("n_open_lines"),
    )


def broken(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row's measures break, in the table's order.

    Bounds are compared as products with the divisor, so a divisor of zero needs no case:
    a measure of zero then meets every bound.
    """
    failing = []
    for rule in rules:
        value = F.col(rule.measure).cast("double")
        per = F.lit(1.0) if rule.per is None else F.col(rule.per).cast("double")
        out = F.lit(False)
        if rule.low is not None:
            out = out | (value < per * rule.low)
        if rule.high is not None:
            out = out | (value > per * rule.high)
        failing.append(F.when(out, F.lit(rule.name)))
    return F.array_compact(F.array(*failing)) if failing else F.array().cast("array<string>")


def judge(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", base: Sequence[Rule] = BASE,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """``id_col``, the measures, ``base_failed``, ``kept`` and ``broken`` (names of broken rules) for every row.

    Words are runs of characters other than blank and 09 to 0D in hex; lines end at a line
    feed, and only those that have a word count. ``n_dup_lines`` are lines equal to an
    earlier one; ``n_repeat_words`` are words in windows of ``WINDOW`` words that the text
    holds at least twice, the first included. A row fails the base if it breaks a base
    rule; it is kept if it breaks no rule at all.

    A null text is an empty one: no words, so the base fails. Null and repeated ids, ties and
    copies are rows like others, as each row is judged alone. Other columns aren't read. No
    rows give no rows. Windows are told apart by 64-bit hashes: in a text of n words two
    different ones are taken for equal with a probability of n squared over 2^65.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_marks", "n_letterless_words", "n_capitals", "n_stop_words", "n_lines", "n_listed_lines", "n_open_lines"]
    found = measured(docs, id_col, text_col).withColumns({"_base": broken(base), "_rules": broken(rules)})
    return found.select(
        id_col, *names, (F.size("_base") > 0).alias("base_failed"),
        ((F.size("_base") == 0) & (F.size("_rules") == 0)).alias("kept"),
        F.array_join(F.concat("_base", "_rules"), ",").alias("broken"), *more,
    )
