"""English text analysis for name search (M1): words, stop words, suffix stemming.

The stemmer is a table of stages; a stage is a list of suffix rules of which
the longest matching one applies, if its condition holds.  ``stage_sql`` turns
a stage into one CASE expression over the columns ``w`` (the word so far), ``r1`` and
``r2`` (code points before the two regions after a vowel and a consonant), so a column of
words is stemmed by nine projections and no Python.  Words are stemmed
once each, however often they occur.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.util import as_col

WORD = r"[\p{L}\p{N}_]+(?:['’][\p{L}\p{N}_]+)*"

# The stop words of the search analyzer.
STOP_WORDS = ("a an and are as at be but by for if in into is it no not of on or such that the their then there these they "
              "this to was will with").split()

# Fixed values of the English suffix rules (public definition): special words, words that stay after the
# plural stage, beginnings with a region of their own, doubled letters and the letters before a droppable "li".
SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
           "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
           "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
STAYS = "inning outing canning herring earring proceed exceed succeed".split()
BEGINNINGS = "gener|commun|arsen"
DOUBLES = "bb|dd|ff|gg|mm|nn|pp|rr|tt"
BEFORE_LI = "[cdeghkmnrt]"

SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
REGION = "^.*?[aeiouy][^aeiouy]"


@dataclass(frozen=True)
class Suffix:
    """``text`` becomes ``to`` if it lies in the region and the part before it matches ``before``."""
    text: str
    to: str = ""
    region: str | None = None
    before: str | None = None


def _all(texts: str, to: str, region: str | None = None, before: str | None = None) -> list[Suffix]:
    return [Suffix(t, to, region, before) for t in texts.split()]


STAGES: dict[str, list[Suffix]] = {
    "possessive": _all("'s' 's '", ""),
    "plural": [Suffix("sses", "ss"), *_all("ied ies", "i", before="..$"), *_all("us ss", "="), Suffix("s", "", before="[aeiouy].")],
    "y": _all("y Y", "i", before=".[^aeiouy]$"),
    "two": [Suffix("tional", "tion", "r1"), Suffix("enci", "ence", "r1"), Suffix("anci", "ance", "r1"), Suffix("abli", "able", "r1"),
            Suffix("entli", "ent", "r1"), *_all("izer ization", "ize", "r1"), *_all("ational ation ator", "ate", "r1"),
            *_all("alism aliti alli", "al", "r1"), Suffix("fulness", "ful", "r1"), *_all("ousli ousness", "ous", "r1"),
            *_all("iveness iviti", "ive", "r1"), *_all("biliti bli", "ble", "r1"), Suffix("ogi", "og", "r1", "l$"),
            Suffix("fulli", "ful", "r1"), Suffix("lessli", "less", "r1"), Suffix("li", "", "r1", f"{BEFORE_LI}$")],
    "three": [Suffix("tional", "tion", "r1"), Suffix("ational", "ate", "r1"), Suffix("alize", "al", "r1"),
              *_all("icate iciti ical", "ic", "r1"), *_all("ful ness", "", "r1"), Suffix("ative", "", "r2")],
    "four": [*_all("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize", "", "r2"), Suffix("ion", "", "r2", "[st]$")],
}

Match = Callable[[str, str], str]


def spark_match(x: str, pattern: str) -> str:
    return f"({x} RLIKE '{pattern}')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _ends(text: str) -> str:
    return f"right(w, {len(text)}) = {_quoted(text)}"


def stage_sql(rules: list[Suffix], match: Match) -> str:
    """The stage as one SQL expression over ``w``, ``r1`` and ``r2``."""
    cases = []
    for r in sorted(rules, key=lambda r: -len(r.text)):
        kept = f"left(w, length(w) - {len(r.text)})"
        done = "w" if r.to == "=" else f"concat({kept}, {_quoted(r.to)})"
        tests = ([f"length(w) - {len(r.text)} >= {r.region}"] if r.region else []) + ([match(kept, r.before)] if r.before else [])
        if r.text in ("ied", "ies"):  # one letter before it: the e stays
            done, tests = f"CASE WHEN {tests[0]} THEN {done} ELSE left(w, length(w) - 1) END", []
        cases.append(f"WHEN {_ends(r.text)} THEN " + (f"CASE WHEN {' AND '.join(tests)} THEN {done} ELSE w END" if tests else done))
    return f"CASE {' '.join(cases)} ELSE w END"


def past_sql(match: Match) -> str:
    """-eed, -ed, -ing: the part before must hold a vowel; what is left is mended."""
    vowel, out = "[aeiouy]", []
    for text in ("ingly", "eedly", "edly", "eed", "ing", "ed"):
        kept = f"left(w, length(w) - {len(text)})"
        if text.startswith("eed"):
            done = f"CASE WHEN length(w) - {len(text)} >= r1 THEN concat({kept}, 'ee') ELSE w END"
        else:
            done = (f"CASE WHEN NOT {match(kept, vowel)} THEN w WHEN {match(kept, '(at|bl|iz)$')} THEN concat({kept}, 'e') "
                    f"WHEN {match(kept, f'({DOUBLES})$')} THEN left(w, length(w) - {len(text) + 1}) "
                    f"WHEN length({kept}) <= r1 AND {match(kept, SHORT)} THEN concat({kept}, 'e') ELSE {kept} END")
        out.append(f"WHEN {_ends(text)} THEN {done}")
    return f"CASE {' '.join(out)} ELSE w END"


def last_sql(match: Match) -> str:
    kept = "left(w, length(w) - 1)"
    return (f"CASE WHEN right(w, 1) = 'e' AND (length(w) - 1 >= r2 OR length(w) - 1 >= r1 AND NOT {match(kept, SHORT)}) THEN {kept} "
            f"WHEN right(w, 2) = 'll' AND length(w) - 1 >= r2 THEN {kept} ELSE w END")


def guarded(expression: str) -> str:
    """Special words and words of two letters pass every stage as they are."""
    return f"CASE WHEN fixed IS NOT NULL THEN w ELSE {expression} END"


def stages_sql(match: Match) -> list[str]:
    """The stages after the regions are known, in order; each gives the next ``w``."""
    stays = ", ".join(_quoted(x) for x in STAYS)
    later = lambda e: f"CASE WHEN w IN ({stays}) THEN w ELSE {e} END"
    return [guarded(stage_sql(STAGES["possessive"], match)), guarded(stage_sql(STAGES["plural"], match)),
            *[guarded(later(e)) for e in (past_sql(match), stage_sql(STAGES["y"], match), stage_sql(STAGES["two"], match),
                                          stage_sql(STAGES["three"], match), stage_sql(STAGES["four"], match), last_sql(match))]]


def special_sql(column: str) -> str:
    cases = " ".join(f"WHEN {column} = '{a}' THEN '{b}'" for a, b in SPECIAL.items())
    return f"CASE {cases} WHEN length({column}) <= 2 THEN {column} END"


def with_stems(words: DataFrame, word_col: str, out: str = "stem") -> DataFrame:
    """``words`` plus the stem of the lower-case word in ``word_col``; NULL stays NULL."""
    held = [c for c in words.columns]
    df = words.select(F.struct(*[F.col(f"`{c}`") for c in held]).alias("row"), F.col(f"`{word_col}`").alias("word"))
    df = df.withColumn("fixed", F.expr(special_sql("word")))
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("word"), "^'", ""), "^y", "Y"), "([aeiouy])y", "$1Y")
    df = df.withColumn("w", F.coalesce("fixed", marked))
    own = F.length(F.regexp_extract("w", f"^({BEGINNINGS})", 1))
    first = F.length(F.regexp_extract("w", REGION, 0))
    df = df.withColumn("r1", F.when(own > 0, own).when(first > 0, first).otherwise(F.length("w")))
    second = F.length(F.regexp_extract(F.substr("w", F.col("r1") + 1), REGION, 0))
    df = df.withColumn("r2", F.when(second > 0, F.col("r1") + second).otherwise(F.length("w")))
    for expression in stages_sql(spark_match):
        df = df.withColumn("w", F.expr(expression))
    return df.select("row.*", F.translate("w", "Y", "y").alias(out))


def words_of(text) -> Column:
    """Lower-case words without stop words, in order, repeats kept; NULL has none."""
    found = F.regexp_extract_all(F.lower(as_col(text)), F.lit(WORD), F.lit(0))
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda w: ~w.isin(*STOP_WORDS))
