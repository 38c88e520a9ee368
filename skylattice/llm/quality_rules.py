"""Document quality rules: a table of thresholds compiled into one projection.

Every measure is a column expression on the whole text; a rule names a
measure and the range in which it passes. ``apply_rules`` adds all measures,
one flag per rule and the verdict, without any user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, spare, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Frequent words by language (fixed values).
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on", "by", "this", "be", "are", "at", "an"),
    "de": ("der", "die", "das", "und", "in", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "ein", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "qui", "dans", "est", "pour", "par", "sur", "au"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "las", "un", "una", "por", "con", "para", "se", "no", "es", "al"),
}


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` passes; an open side is None. A rule holds
    only for texts of at least ``from_words`` words."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0

    def passes(self) -> Column:
        value, ok = F.col(self.measure), F.lit(True)
        if self.low is not None:
            ok = ok & (value >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (value <= F.lit(self.high))
        return ok | (F.col("n_words") < F.lit(self.from_words))


#: The thresholds in use. Ratios are per word, per line or per character of words.
RULES = (
    Rule("mean_word_length", "word_length", 2.0, 25.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.02, None, from_words=50),
    Rule("repeated_lines", "dup_line_ratio", None, 0.3),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3),
)


def _repeated_words(found: Column) -> Column:
    """Words in windows of ``WINDOW`` words that stand twice or more in the text.

    Windows are first compared by hash; only a text in which two hashes are
    equal has its windows sorted, as text, with their places. Each place of a
    repeated window then adds the words up to the next such place, at most a
    window's width.
    """
    last = F.size(found) - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(WINDOW)]))
    texts = F.array_sort(
        F.transform(places, lambda i: F.struct(F.concat_ws(" ", F.slice(found, i + 1, WINDOW)).alias("w"), i.alias("i")))
    )

    def among(run: Column) -> Column:
        same = lambda k, d: F.coalesce(F.get(run, k)["w"] == F.get(run, k + d)["w"], F.lit(False))
        again = F.filter(run, lambda x, k: same(k, -1) | same(k, 1))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        width = lambda k: F.coalesce(F.least(F.get(at, k + 1) - F.get(at, k), F.lit(WINDOW)), F.lit(WINDOW))
        return F.aggregate(F.transform(at, lambda x, k: width(k)), F.lit(0), lambda a, b: a + b)

    # a transform over one element names an intermediate value, so that it is evaluated once
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    unique = once(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(unique, F.lit(0)).otherwise(once(once(texts, among), covered))


def measures(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the counts and ratios the rules use."""
    content = F.coalesce(F.col(text), F.lit(""))
    blanks = " \t\n\x0b\x0c\r"
    own_words, own_lines = spare(df, "own_words"), spare(df, "own_lines")
    df = df.withColumn(own_words, words(F.col(text)))
    df = df.withColumn(own_lines, F.filter(F.split(content, "\n"), lambda line: line.rlike(WORD)))
    found, lines = F.col(own_words), F.col(own_lines)
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    counts = df.withColumns(
        {
            "n_words": F.size(found).cast("long"),
            "word_chars": F.char_length(F.translate(content, blanks, "")).cast("long"),
            "n_symbols": (F.char_length(content) - F.char_length(F.translate(content, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": _repeated_words(found).cast("long"),
            "n_stop_words": F.size(F.filter(found, lambda w: F.lower(w).isin(stop))).cast("long"),
            "n_bullets": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))).cast("long"),
            "n_ellipses": F.size(F.filter(lines, lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))).cast("long"),
        }
    ).drop(own_words, own_lines)
    per = lambda n, of: F.coalesce(F.try_divide(F.col(n), F.col(of)), F.lit(0.0))
    return counts.withColumns(
        {
            "word_length": per("word_chars", "n_words"),
            "symbol_ratio": per("n_symbols", "n_words"),
            "stop_word_ratio": per("n_stop_words", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"),
            "bullet_line_ratio": per("n_bullets", "n_lines"),
            "ellipsis_line_ratio": per("n_ellipses", "n_lines"),
        }
    )


def apply_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with all measures, ``failed`` (names of the rules a text fails,
    in the order of the table), ``base_failed`` and ``kept``.

    A null text has no words and fails the base rule; so does an empty one.
    Equal texts get equal verdicts, an empty table stays empty. Columns of
    ``df`` with the names of measures are replaced.
    """
    rated = measures(df, text)
    flags = F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules])
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rated = rated.withColumns({"failed": F.filter(flags, lambda f: f.isNotNull()), "base_failed": base})
    return rated.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
