"""Text cleaners as native Column expressions (no Python UDF in any plan).

Each function mirrors one cleaning rule of the library ETL exactly, including
its quirks (see the golden vectors in tests/test_text.py).  Java regex flags:
``(?U)`` gives Unicode whitespace for ``\\s`` and ``(?d)`` makes ``.``, ``^``
and ``$`` treat only ``\\n`` as a line end, which is how Python's ``re``
behaves on ``str``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.util import as_col

# Fixed values that must equal the original rules.
# Whitespace as Python's str.isspace() sees it: Unicode White_Space plus the
# four information separators U+001C..U+001F.
_WS = r"[\s\x{1C}-\x{1F}]"
# Punctuation replaced by a blank in normalize_text (digits are kept).
NORMALIZE_PUNCTUATION = r"""[\[\]<>{}|\\!"#&()*+,./:;?@_-]"""
# Year suffix stripped from catalogue author names, e.g. ", 1952-" or ", 1858-1940".
AUTHOR_YEAR_SUFFIX = r", \d{4}-(\d{4})?$"
# Longest name part that is still swapped when no year suffix is present (exclusive).
AUTHOR_MAX_NAME_LEN = 36


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(as_col(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def _blank_to_null(c: Column) -> Column:
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).otherwise(c)


def clean_title(raw, external=None) -> Column:
    """F1. Prefer a non-empty external title; else cut the last ``" / "`` and
    strip.  A title without the separator is returned unchanged (not
    stripped); NULL or empty gives NULL."""
    raw = as_col(raw)
    cut = py_strip(F.regexp_extract(raw, r"(?s)^(.*) / ", 1))
    local = (F.when(raw.isNull() | (raw == ""), F.lit(None).cast("string"))
             .when(raw.contains(" / "), cut)
             .otherwise(raw))
    if external is None:
        return local
    ext = as_col(external)
    return F.when(ext.isNotNull() & (ext != ""), ext).otherwise(local)


def extract_min_year(raw) -> Column:
    """Smallest run of four digits, scanned left to right without overlap."""
    found = F.regexp_extract_all(as_col(raw), F.lit(r"(\d{4})"), 1)
    return F.array_min(F.transform(found, lambda y: y.cast("int")))


def clean_publication_year(raw, external_ts=None) -> Column:
    """F2. Year of the external date if present, else the smallest 4-digit
    run in the raw text (``"1991, c1988."`` -> 1988); NULL if none."""
    local = extract_min_year(raw)
    if external_ts is None:
        return local
    ext = as_col(external_ts)
    return F.when(ext.isNotNull(), F.year(ext)).otherwise(local)


def clean_publisher(c) -> Column:
    """F3. NULL/empty -> NULL; strip whitespace, then commas at both ends."""
    c = as_col(c)
    stripped = F.regexp_replace(py_strip(c), r"^,+|,+$", "")
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).otherwise(stripped)


def format_person_name(c) -> Column:
    """F4. ``"Last, First, 1952-"`` -> ``"First Last"``.

    With a year suffix the two remaining parts are swapped; without one the
    swap needs exactly two parts, each shorter than 36 characters.
    Everything else is returned as is (minus a found year suffix)."""
    c = as_col(c)
    no_years = F.regexp_replace(c, AUTHOR_YEAR_SUFFIX, "")
    parts_ny = F.split(no_years, ", ")
    parts = F.split(c, ", ")
    swapped_ny = F.concat(F.get(parts_ny, 1), F.lit(" "), F.get(parts_ny, 0))
    swapped = F.concat(F.get(parts, 1), F.lit(" "), F.get(parts, 0))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.length(no_years) != F.length(c),
                  F.when(F.size(parts_ny) == 2, swapped_ny).otherwise(no_years))
            .when((F.size(parts) == 2)
                  & (F.length(F.get(parts, 0)) < AUTHOR_MAX_NAME_LEN)
                  & (F.length(F.get(parts, 1)) < AUTHOR_MAX_NAME_LEN), swapped)
            .otherwise(c))


def format_person_name_v0(c) -> Column:
    """F5. Earlier rule: swap the first two ``", "`` parts when there are two
    or three parts, else unchanged."""
    c = as_col(c)
    parts = F.split(c, ", ")
    swapped = F.concat(F.get(parts, 1), F.lit(" "), F.get(parts, 0))
    return F.when(F.size(parts).isin(2, 3), swapped).otherwise(c)


def normalize_text(c) -> Column:
    """F6. Join key for names: lower-case, drop a trailing parenthesised part
    (greedy from the first ``(``), punctuation -> blank, drop apostrophes,
    squeeze whitespace runs of two or more, strip.  Digits are kept."""
    x = F.lower(as_col(c))
    x = F.regexp_replace(x, rf"(?U)(?d)({_WS}*\(.+\){_WS}*)$", "")
    x = F.regexp_replace(x, NORMALIZE_PUNCTUATION, " ")
    x = F.regexp_replace(x, "'", "")
    x = F.regexp_replace(x, rf"(?U){_WS}{{2,}}", " ")
    return py_strip(x)


def split_list(c, delimiter: str = ", ") -> Column:
    """F7 helper: a delimited multi-value field as an array (regex-quoted)."""
    import re

    return F.split(as_col(c), re.escape(delimiter))


def first_list_item_links(html, exclude_prefix: str | None = "List of ", tag: str | None = None,
                          css_class: str | None = None) -> Column:
    """Text of the first link of every list item, as an array.

    Items are cut out whole first (``<li ...>`` to ``</li>``, never ``<link>``),
    so text before the link does not matter and an item without a link gives
    nothing.  With ``tag`` (and ``css_class``) only items inside such an
    element count.  Tags inside the link are dropped and the five XML
    entities decoded as an HTML parser would."""
    import re

    scope = as_col(html)
    if tag:
        named = rf'[^>]*class="[^"]*\b{re.escape(css_class)}\b[^"]*"' if css_class else ""
        scope = F.array_join(F.regexp_extract_all(scope, F.lit(rf"(?s)<{tag}\b{named}[^>]*>(.*?)</{tag}>"), 1), " ")
    items = F.regexp_extract_all(scope, F.lit(r"(?s)<li\b[^>]*>(.*?)</li>"), 1)
    linked = F.filter(items, lambda x: F.regexp_like(x, F.lit(r"(?s)<a\b[^>]*>.*?</a>")))
    found = F.transform(linked, lambda x: F.regexp_replace(F.regexp_extract(x, r"(?s)<a\b[^>]*>(.*?)</a>", 1), "<[^>]*>", ""))
    decoded = F.transform(found, lambda t: decode_entities(t))
    if exclude_prefix is None:
        return decoded
    return F.filter(decoded, lambda t: ~t.startswith(exclude_prefix))


def decode_entities(c) -> Column:
    x = as_col(c)
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x
