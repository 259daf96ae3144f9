"""Operator 9: quality rules as one Spark projection.

``RULES`` is a table of (name, ratio, comparison, threshold).  ``measured``
computes every count of a text with built-in expressions, and the verdict is
one conjunction compiled from the table.  No user function, no shuffle.

Defined cases: null or empty text has no words and fails ``min_words``;
repeated rows are judged alike; extra input columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.frames import own_columns
from shelfmark.llm.native_text import grams, let, strip_white, words_of

#: The most frequent function words of the four languages.
STOP_WORDS = tuple(
    # English
    "the of and to in a is that it for was on are as with be this from or by at an he not have has had which but"
    # German
    " der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er sie war wird"
    # French
    " de la le les et des en un une du que est pour dans qui par sur au pas il avec plus ce ne se sa son"
    # Spanish
    " el los las y del se por con para una su al lo como más o pero sus le ha me sin sobre".split())

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``value`` (a SQL expression over the measured
    counts) is at least ``low`` and at most ``high``; texts of fewer than
    ``from_words`` words, and those that do not meet ``only_if``, are not held to it."""
    name: str
    value: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    only_if: str | None = None


#: The threshold table.  The first two are the base rules, the rest the method's.
#: The stop words are of four languages in Latin letters: texts in other scripts are not held to
#: them, and a corpus with more languages in Latin letters needs a table of its own (``rules``).
BASE_RULES = (
    Rule("min_words", "n_words", low=20),
    Rule("repeated_words", "100 * n_repeat_words - 30 * n_words", high=0),
)
RULES = (
    Rule("mean_word_length_short", "word_chars / n_words", low=2.0),
    Rule("mean_word_length_long", "word_chars / n_words", high=25.0, from_words=20),
    Rule("symbols_per_word", "n_symbols / n_words", high=0.25),
    Rule("duplicate_lines", "n_dup_lines / n_lines", high=0.5, from_words=50),
    Rule("stop_words", "n_stop_words / n_words", low=0.02, from_words=50, only_if="2 * n_latin_words >= n_words"),
    Rule("shouting", "n_shouts / n_words", high=0.3),
)


def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the struct column ``_q`` of all counts of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: strip_white(x) != F.lit(""))

    def covered(starts: Column) -> Column:
        step = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1), s + WINDOW) - s))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def twice(hashes: Column) -> Column:
        """Words inside windows whose hash occurs again; sorting by (hash, start) puts equal ones side by side."""
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]).eqNullSafe(True)
                                   | F.when(k > 0, F.get(s, k - 1)["h"] == x["h"]).otherwise(False).eqNullSafe(True))
        starts = let(ranked, lambda s: F.array_sort(F.transform(again(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(starts, covered))

    def counts(words: Column) -> Column:
        hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: grams(h, WINDOW, F.xxhash64))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            let(hashes, twice).cast("long").alias("n_repeat_words"),
            _count(words, lambda w: F.lower(w).isin(*STOP_WORDS) & (w != F.upper(w))).alias("n_stop_words"),
            _count(words, lambda w: F.rlike(w, F.lit("[A-Za-z]"))).alias("n_latin_words"),
            _count(words, lambda w: F.endswith(w, F.lit("!!"))).alias("n_shouts"))

    return (docs.withColumn("_w", let(words_of(text), counts))
            .withColumn("_l", let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))))
            .withColumn("_q", F.struct("_w.*", "_l.*",
                                       F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols")))
            .drop("_w", "_l"))


def passes(rules: tuple[Rule, ...], counts: str = "_q") -> Column:
    """The table as one boolean expression; a ratio over nothing counts as met."""
    verdict = F.lit(True)
    for r in rules:
        value = F.expr(_qualified(r.value, counts))
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (value >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (value <= F.lit(r.high))
        if r.only_if:
            ok = ok | ~F.expr(_qualified(r.only_if, counts))
        if r.from_words:
            ok = ok | (F.col(f"{counts}.n_words") < r.from_words)
        verdict = verdict & F.coalesce(ok, F.lit(True))
    return verdict


def _qualified(expression: str, counts: str) -> str:
    import re
    # try_divide keeps a text without words from failing under ANSI rules
    expression = re.sub(r"(\w+) / (\w+)", r"try_divide(\1, \2)", expression)
    return re.sub(r"\b(n_\w+|word_chars)\b", rf"{counts}.\1", expression)


@own_columns
def judged(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus ``_q`` and booleans ``_base_failed``, ``_kept`` (by the base rules and ``rules``)."""
    out = measured(docs, text_col).withColumn("_base_failed", ~passes(BASE_RULES))
    return out.withColumn("_kept", ~F.col("_base_failed") & passes(rules))


@own_columns
def keep_good(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes every rule, columns unchanged."""
    return judged(docs, text_col, rules).where("_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
