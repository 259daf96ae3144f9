"""Links of list items in HTML pages (S6), as an HTML parser sees them.

A page is split into tags, comments and text; every element's end is the
close tag at its own depth, so items in items, containers in containers and items in comments
come out right.  All of it is window functions over the tokens of one page; no Python.

Defined cases: an element that is never closed ends with the page; a close tag
without an open one ends nothing; names of tags are case-insensitive; a NULL page has no
links; rows of equal ids are different pages.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from shelfmark.functions.text import decode_entities
from shelfmark.session import stored

TOKEN = r"(?s)<!--.*?-->|</?[a-zA-Z][^>]*>|[^<]+|<"
TAG = "^</?([a-zA-Z][a-zA-Z0-9]*)"


def class_pattern(css_class: str) -> str:
    return rf'\bclass="([^"]*\s)?{re.escape(css_class)}(\s[^"]*)?"'


def tokens_of(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Written: (page, id, pos, token, name, opens, closes) of every tag and text; comments are left out."""
    rows = pages.select(F.monotonically_increasing_id().alias("page"), F.col(id_col).alias("id"),
                        F.regexp_extract_all(F.col(html_col), F.lit(TOKEN), F.lit(0)).alias("_t"))
    tokens = rows.select("page", "id", F.posexplode("_t").alias("pos", "token")).where(~F.col("token").startswith("<!--"))
    name = F.lower(F.regexp_extract("token", TAG, 1))
    return stored(tokens.withColumns({"name": name, "closes": F.col("token").startswith("</"),
                                      "opens": (name != "") & ~F.col("token").startswith("</")}), "html-tokens")


def spans(tokens: DataFrame, names: list[str]) -> DataFrame:
    """(page, id, name, start, stop, token): the elements of the given names; ``stop`` is where their close tag stands."""
    events = tokens.where(F.col("name").isin(*names))
    running = W.partitionBy("page", "name").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    depth = F.sum(F.when(F.col("opens"), 1).otherwise(-1)).over(running)
    level = events.withColumn("level", depth + F.col("closes").cast("int"))
    same = W.partitionBy("page", "name", "level").orderBy("pos")
    ended = level.withColumns({"next": F.lead("pos").over(same), "ends": F.lead("closes").over(same)})
    stop = F.when(F.col("ends"), F.col("next")).otherwise(F.lit(2**31 - 1))
    return ended.where("opens").select("page", "id", "name", F.col("pos").alias("start"), stop.alias("stop"), "token")


def nested_list_links(pages: DataFrame, id_col: str, html_col: str, exclude_prefix: str = "List of ", tag: str | None = None,
                      css_class: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Text of the first link of every list item, minus texts starting with ``exclude_prefix``; with ``tag`` (and
    ``css_class``) only of items inside such an element.  Returns (links, dropped count per page id)."""
    tokens = tokens_of(pages, id_col, html_col)
    found = stored(spans(tokens, sorted({"li", "a", *([tag.lower()] if tag else [])})), "html-spans")
    ahead = W.partitionBy("page").orderBy("start").rowsBetween(1, W.unboundedFollowing)
    before = W.partitionBy("page").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    holds = F.lit(False)
    if tag:
        holds = (F.col("name") == tag.lower()) & (F.col("token").rlike(class_pattern(css_class)) if css_class else F.lit(True))
    marked = found.withColumns({"link": F.min(F.when(F.col("name") == "a", F.col("start"))).over(ahead),
                                "held": F.max(F.when(holds, F.col("stop"))).over(before)})
    items = marked.where((F.col("name") == "li") & (F.col("link") < F.col("stop")))
    if tag:
        items = items.where(F.col("held") > F.col("start"))
    # text belongs to the last link opened before it, if that is still open
    links = found.where(F.col("name") == "a").select("page", F.col("start").alias("pos"), F.col("stop").alias("until"))
    parts = tokens.where(F.col("name") == "").join(links, ["page", "pos"], "full_outer").select("page", "pos", "token", "until")
    so_far = W.partitionBy("page").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = parts.withColumns({"link": F.last(F.when(F.col("until").isNotNull(), F.col("pos")), ignorenulls=True).over(so_far),
                                "end": F.last("until", ignorenulls=True).over(so_far)})
    texts = (inside.where(F.col("token").isNotNull() & (F.col("pos") < F.col("end"))).groupBy("page", "link")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("t"))
             .select("page", "link", decode_entities(F.array_join(F.transform("t", lambda x: x["token"]), "")).alias("link_text")))
    out = (items.join(texts, ["page", "link"], "left")
           .select(F.col("id").alias(id_col), F.coalesce("link_text", F.lit("")).alias("link_text")))
    out = stored(out, "html-links")
    starts = F.col("link_text").startswith(exclude_prefix)
    dropped = out.groupBy(id_col).agg(F.count_if(starts).alias("n_dropped"))
    return out.where(~starts), dropped
