"""Fixed-size samples (P11), stored sketches (A1) and nested list pages (S6) over the driver tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.phonetic import double_metaphone, sounds_alike
from shelfmark.functions.text import format_person_name
from shelfmark.operators import markup, match, profile, sampling, sketches
from shelfmark.plans import catalog as C
from shelfmark.plans import oracle as O
from shelfmark.plans.registry import _DECODE, _gazetteer, _raw_names, register
from shelfmark.session import remove_path, scratch_path, stored
from shelfmark.sources.tables import table

SAMPLE, SEED = 20, 7


def _sample_sql(columns: list[str], source: str, n: int, seed: int) -> str:
    texts = ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT {', '.join(columns)} FROM ({source}) ORDER BY md5(concat_ws('|', '{seed}', {texts})), {', '.join(columns)} LIMIT {n}"


@register("row_sample", _sample_sql(["raw_author", "name"], f"SELECT DISTINCT raw_author, {O.format_author('raw_author')} AS name FROM ({C.SQL_INVENTORY})",
                                    SAMPLE, SEED))
def q_row_sample(spark, d):
    """Twenty authors before and after formatting, to look at: the limit is the feature."""
    authors = C.inventory(spark, d).select("raw_author", format_person_name("raw_author").alias("name")).distinct()
    return sampling.sample_rows(authors, SAMPLE, SEED)


_PROFILED = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"]


@register("profile_sketches", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values, count(*) - count({c}) AS n_null, "
    f"count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '') AS n_empty, true AS close FROM lineitem" for c in _PROFILED))
def q_profile_sketches(spark, d):
    """Sketches of every year of the fact, one year stored after the others, and whether the merged estimates are close to exact counts."""
    rows = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    path = scratch_path(spark, "sketches")
    last = F.col("year") == 1998
    try:
        sketches.add_sketches(rows.where(~last | F.col("year").isNull()), _PROFILED, "year", path)
        sketches.add_sketches(rows.where(last), _PROFILED, "year", path)
        found = stored(sketches.profile_of(spark, path), "sketched-profile")
    finally:
        remove_path(spark, path)
    exact = profile.profile(rows, _PROFILED).select("column_name", F.col("n_distinct").alias("exact"))
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.ceil(F.col("exact") * F.lit(sketches.ERROR))
    return found.join(exact, "column_name").select("column_name", "n_rows", "n_values", "n_null", "n_empty", close.alias("close"))


# a page for up to fifty suppliers of a nation: items in items, a container in a container, an item in a comment
_ITEM = "concat('<LI><i>no.</i> <a href=\"/s\">', s_name, ' &amp; <b>Co</b></a> <a>second</a></LI><!-- <li><a>hidden</a></li> -->')"
_HEAD = "concat('<ul><li><a>before</a></li></ul><div class=\"x box\"><div class=\"in\"><ul><li>of <a href=\"/n\">', n_name, '</a><ul>')"
_TAIL = ("concat('</ul> end</li><li>no link</li></ul></div><p>a < b</p><ul><li><a>List of ', n_name, '</a></li><li><a></a></li></ul></div>"
         "<div class=\"boxes\"><ul><li><a>after</a></li></ul></div>')")
_PAGES = "n_nationkey * 1000000 + s_suppkey {div} 50 AS page_id"


def _nested_sql() -> str:
    last = f"\\bclass=\"([^\"]*\\s)?box(\\s[^\"]*)?\""
    return f"""
WITH it AS (SELECT {_PAGES.format(div='//')}, n_name, s_suppkey, {_ITEM} AS item FROM supplier JOIN nation ON s_nationkey = n_nationkey),
pg AS (SELECT page_id, any_value({_HEAD}) || string_agg(item, '' ORDER BY s_suppkey) || any_value({_TAIL}) AS html FROM it GROUP BY page_id),
tl AS (SELECT page_id, regexp_extract_all(html, '{markup.TOKEN}') AS t FROM pg),
tk AS (SELECT * FROM (SELECT page_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM tl) WHERE NOT starts_with(token, '<!--')),
nm AS (SELECT *, lower(regexp_extract(token, '{markup.TAG}', 1)) AS name, starts_with(token, '</') AS closes FROM tk),
ev AS (SELECT *, sum(CASE WHEN closes THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY pos) + CAST(closes AS INTEGER) AS level
       FROM nm WHERE name IN ('li', 'a', 'div')),
en AS (SELECT *, CASE WHEN lead(closes) OVER w THEN lead(pos) OVER w ELSE 2147483647 END AS stop FROM ev
       WINDOW w AS (PARTITION BY page_id, name, level ORDER BY pos)),
sp AS (SELECT page_id, name, pos, stop, token FROM en WHERE NOT closes),
li AS (SELECT i.page_id, i.pos, min(a.pos) AS link FROM sp i JOIN sp a ON a.page_id = i.page_id AND a.name = 'a' AND a.pos > i.pos AND a.pos < i.stop
       WHERE i.name = 'li' AND EXISTS (SELECT 1 FROM sp c WHERE c.page_id = i.page_id AND c.name = 'div' AND c.pos < i.pos AND c.stop > i.pos
                                       AND regexp_matches(c.token, '{last}')) GROUP BY ALL),
tx AS (SELECT li.page_id, li.pos, coalesce(string_agg(n.token, '' ORDER BY n.pos), '') AS t FROM li
       JOIN sp a ON a.page_id = li.page_id AND a.pos = li.link
       LEFT JOIN nm n ON n.page_id = li.page_id AND n.name = '' AND n.pos > a.pos AND n.pos < a.stop GROUP BY ALL)
SELECT page_id, link_text FROM (SELECT page_id, {_DECODE} AS link_text FROM tx) WHERE NOT starts_with(link_text, 'List of ')"""


@register("html_nested_links", _nested_sql())
def q_html_nested_links(spark, d):
    items = (table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
             .select(F.expr(_PAGES.format(div="div")), "s_suppkey", F.expr(_ITEM).alias("item"), F.expr(_HEAD).alias("head"), F.expr(_TAIL).alias("tail")))
    ordered = F.array_sort(F.collect_list(F.struct("s_suppkey", "item")))
    pages = items.groupBy("page_id").agg(F.concat(F.any_value("head"), F.array_join(F.transform(ordered, lambda x: x["item"]), ""), F.any_value("tail")).alias("html"))
    links, _ = markup.nested_list_links(pages, "page_id", "html", tag="div", css_class="box")
    return links


@register("metaphone_pairs")
def q_metaphone_pairs(spark, d):
    """The search's candidate pairs with their sound codes; SQL has none, tests hold the codes against worked names."""
    names = _raw_names(spark, d).select(F.col("raw_name").alias("name")).distinct()
    pairs = match.match_candidates(names, _gazetteer(spark, d), "name", "official").select("name", "official")
    coded = pairs.select("name", "official", double_metaphone("name").alias("a"), double_metaphone("official").alias("b"))
    return coded.select("name", "official", "a.primary", "a.secondary", sounds_alike(F.col("a"), F.col("b")).alias("alike"))
