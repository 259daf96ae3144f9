"""Text helpers as built-in Column expressions (no Python at run time)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: The white space of the contracts, and the letters they fold.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_az(text: Column) -> Column:
    """A-Z only; ``lower`` is the quick way for pure ASCII, where both agree."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def strip_white(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def words_of(text: Column, separators: str = r"[\x20\x09-\x0D]+") -> Column:
    """Runs between ``separators``; null and separator-only texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def grams(items: Column, k: int, of: Callable[[Column], Column]) -> Column:
    """``of`` each run of k neighbours of the array ``items`` (none if it is shorter)."""
    empty = F.transform(F.slice(items, 1, 0), lambda _: of(F.slice(items, 1, 0)))
    return F.when(F.size(items) >= k,
                  F.transform(F.sequence(F.lit(1), F.size(items) - (k - 1)), lambda i: of(F.slice(items, i, k)))
                  ).otherwise(empty)
