"""Name search and name dedupe over the driver tables (M1, M2, M4), with their SQL.

Names to search: the dirty names of ``registry``.  Names to dedupe: a part's
name, type and brand as a publisher's name in one of four spellings, dealt by part number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import english as E
from shelfmark.functions.text import normalize_text
from shelfmark.operators import linkage as L, match, search
from shelfmark.plans import oracle as O
from shelfmark.plans.registry import _SQL_BEST, _SQL_RAW, _gazetteer, _raw_names, _sql_ratio, register
from shelfmark.sources.tables import table


# ---- English stems and BM25 --------------------------------------------------

def _match(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def stems_sql(words: str) -> str:
    """CTEs from ``words`` (word) to ``stems`` (word, stem)."""
    region = lambda x: f"length(regexp_extract({x}, '{E.REGION}'))"
    marked = "regexp_replace(regexp_replace(regexp_replace(word, '^''', ''), '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g')"
    ctes = [f"st0 AS (SELECT word, {E.special_sql('word')} AS fixed FROM {words})",
            f"st1 AS (SELECT *, coalesce(fixed, {marked}) AS w FROM st0)",
            f"st2 AS (SELECT *, length(regexp_extract(w, '^({E.BEGINNINGS})')) AS own, {region('w')} AS f1 FROM st1)",
            "st3 AS (SELECT *, CASE WHEN own > 0 THEN own WHEN f1 > 0 THEN f1 ELSE length(w) END AS r1 FROM st2)",
            f"st4 AS (SELECT *, {region('substr(w, r1 + 1)')} AS f2 FROM st3)",
            "sw0 AS (SELECT word, fixed, w, r1, CASE WHEN f2 > 0 THEN r1 + f2 ELSE length(w) END AS r2 FROM st4)"]
    stages = E.stages_sql(_match)
    for k, expression in enumerate(stages):
        ctes.append(f"sw{k + 1} AS (SELECT word, fixed, {expression} AS w, r1, r2 FROM sw{k})")
    ctes.append(f"stems AS (SELECT word, translate(w, 'Y', 'y') AS stem FROM sw{len(stages)})")
    return ",\n".join(ctes)


def _words_sql(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in E.STOP_WORDS)
    return f"list_filter(regexp_extract_all(lower({x}), '{E.WORD.replace(chr(39), chr(39) * 2)}'), lambda w: w NOT IN ({stop}))"


_SQL_SEARCH = f"""
raw_names AS (SELECT DISTINCT raw_name AS name FROM ({_SQL_RAW}) WHERE raw_name IS NOT NULL),
gaz AS (SELECT DISTINCT p_name AS official FROM part WHERE p_name IS NOT NULL),
gw AS (SELECT official, len(ws) AS dl, unnest(ws) AS word FROM (SELECT official, {_words_sql('official')} AS ws FROM gaz)),
nw AS (SELECT name, unnest({_words_sql('name')}) AS word FROM raw_names),
aw AS (SELECT word FROM gw UNION SELECT word FROM nw),
{stems_sql('aw')},
gt AS (SELECT official, dl, stem, count(*) AS tf FROM gw JOIN stems USING (word) GROUP BY ALL),
nt AS (SELECT name, stem, count(*) AS times FROM nw JOIN stems USING (word) GROUP BY ALL),
gn AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS mean FROM (SELECT DISTINCT official, dl FROM gt)),
gd AS (SELECT stem, count(*) AS df FROM gt GROUP BY stem),
gs AS (SELECT official, stem, CAST(round(ln(1.0::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * {search.K1 + 1}::DOUBLE
              / (tf + {search.K1}::DOUBLE * (1 - {search.B}::DOUBLE + {search.B}::DOUBLE * dl / mean)) * {search.SCALE}) AS BIGINT) AS score
       FROM gt JOIN gd USING (stem), gn),
cand AS (SELECT name, official, CAST(sum(times * score) AS BIGINT) AS relevance,
                row_number() OVER (PARTITION BY name ORDER BY sum(times * score) DESC, official) AS rank
         FROM nt JOIN gs USING (stem) GROUP BY name, official QUALIFY rank <= {match.CANDIDATES})"""


@register("stem_words", f"""
WITH aw AS (SELECT DISTINCT unnest({_words_sql("p_name || ' ' || p_type || ' ' || p_brand")}) AS word FROM part
            UNION SELECT DISTINCT unnest({_words_sql('text')}) FROM documents),
{stems_sql('aw')}
SELECT word, stem FROM stems""")
def q_stem_words(spark, d):
    parts = table(spark, d, "part").select(E.words_of(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("_w"))
    texts = table(spark, d, "documents").select(E.words_of("text").alias("_w"))
    return E.with_stems(parts.unionByName(texts).select(F.explode("_w").alias("word")).distinct(), "word")


@register("search_candidates", f"WITH {_SQL_SEARCH.strip()}\nSELECT * FROM cand")
def q_search_candidates(spark, d):
    return search.search_candidates(_raw_names(spark, d), _gazetteer(spark, d), "raw_name", "official")


@register("search_best_match", f"""WITH {_SQL_SEARCH.strip()},{_SQL_BEST}
SELECT name, official, score FROM best""")
def q_search_best_match(spark, d):
    return match.best_match(search.search_candidates(_raw_names(spark, d), _gazetteer(spark, d), "raw_name", "official"))


# ---- learned links -----------------------------------------------------------

_SPELT = "concat(p_name, ' ', lower(p_type), ' ', replace(lower(p_brand), '#', ' '), ' press')"
_SPELLING = f"""CASE p_partkey % 4 WHEN 0 THEN {_SPELT} WHEN 1 THEN concat(upper({_SPELT}), ',')
                WHEN 2 THEN concat(left({_SPELT}, 5), substr({_SPELT}, 7)) ELSE concat({_SPELT}, ' (reprint)') END"""


def _linked_sql() -> str:
    tok = lambda x: f"list_filter(string_split_regex({x}, ' +'), lambda t: t <> '')"
    rest = lambda x, y: f"array_to_string(list_sort(list_filter(list_distinct({tok(x)}), lambda t: NOT list_contains({tok(y)}, t))), ' ')"
    graded = lambda x, bounds: " + ".join(f"CAST({x} >= {b} AS INTEGER)" for b in bounds)
    levels = [c.levels for c in L.COMPARISONS]
    ctes = [f"nm AS (SELECT name, key, count(*) AS name_rows FROM (SELECT name, {O.normalize('name')} AS key "
            f"FROM (SELECT {_SPELLING} AS name FROM part)) WHERE key IS NOT NULL GROUP BY ALL)",
            "ks AS (SELECT DISTINCT key FROM nm)"]
    orders = ["key", "reverse(key)", f"array_to_string(list_sort({tok('key')}), ' ')"]
    for k, order in enumerate(orders):
        ctes.append(f"od{k} AS (SELECT key, row_number() OVER (ORDER BY {order}, key) AS p FROM ks)")
    ctes.append("pairs AS (" + " UNION ".join(
        f"SELECT least(x.key, y.key) AS a, greatest(x.key, y.key) AS b FROM od{k} x JOIN od{k} y ON y.p BETWEEN x.p + 1 AND x.p + {L.WINDOW}"
        for k in range(len(orders))) + ")")
    ctes.append(f"rs AS (SELECT a, b, {_sql_ratio('a', 'b')} AS ratio, {rest('a', 'b')} AS ra, {rest('b', 'a')} AS rb, "
                f"{tok('a')}[1] AS fa, {tok('b')}[1] AS fb FROM pairs)")
    ctes.append(f"lv AS MATERIALIZED (SELECT a, b, {graded('ratio', L.RATIO_BOUNDS)} AS l0, CASE WHEN ra = '' AND rb = '' THEN {len(L.REST_BOUNDS) + 1} "
                f"ELSE {graded(_sql_ratio('ra', 'rb'), L.REST_BOUNDS)} END AS l1, coalesce(CAST(fa = fb AS INTEGER), 0) AS l2 FROM rs)")
    ctes.append("pat AS MATERIALIZED (SELECT l0, l1, l2, count(*)::DOUBLE AS n FROM lv GROUP BY ALL)")
    rows = ", ".join(f"({k}, {x}, {n}, {L.START**x * (L.START - 1) / (L.START**n - 1)!r}::DOUBLE)" for k, n in enumerate(levels) for x in range(n))
    ctes.append(f"lvl(k, x, nl, m) AS (VALUES {rows})")
    mine = "CASE k WHEN 0 THEN l0 WHEN 1 THEN l1 ELSE l2 END = x"
    share = lambda v: f"(coalesce(sum({v}) FILTER (WHERE {mine}), 0) + {L.HALF}::DOUBLE) / (sum({v}) + {L.HALF}::DOUBLE * nl)"
    ctes.append(f"par0 AS MATERIALIZED (SELECT k, x, nl, any_value(m) AS m, {share('n')} AS u FROM lvl, pat GROUP BY k, x, nl)")
    ctes.append(f"pr0 AS (SELECT {L.PRIOR}::DOUBLE AS prior)")

    def weight(k: int) -> str:
        return (f"SELECT pat.*, log2(prior / (1 - prior)) + log2(p0.m / p0.u) + log2(p1.m / p1.u) + log2(p2.m / p2.u) AS w FROM pat, pr{k} "
                + " ".join(f"JOIN par{k} p{c} ON p{c}.k = {c} AND p{c}.x = l{c}" for c in range(3)))
    for k in range(L.ROUNDS):
        ctes += [f"ex{k} AS MATERIALIZED (SELECT l0, l1, l2, n, n * pow(2.0::DOUBLE, w) / (1 + pow(2.0::DOUBLE, w)) AS e FROM ({weight(k)}))",
                 f"pr{k + 1} AS MATERIALIZED (SELECT (sum(e) + {L.HALF}::DOUBLE) / (sum(n) + {2 * L.HALF}::DOUBLE) AS prior FROM ex{k})",
                 f"par{k + 1} AS MATERIALIZED (SELECT k, x, nl, {share('e')} AS m, {share('(n - e)')} AS u FROM lvl, ex{k} GROUP BY k, x, nl)"]
    top = levels[1] - 1
    ctes += [f"pw AS MATERIALIZED ({weight(L.ROUNDS)})",
             f"kw AS (SELECT key, unnest(list_distinct({tok('key')})) AS word FROM ks)",
             "sh AS (SELECT word, count(*) / (SELECT count(*) FROM ks)::DOUBLE AS share FROM kw GROUP BY word)",
             "rar AS (SELECT key, min(share) AS rarest FROM kw JOIN sh USING (word) GROUP BY key)",
             f"lk AS MATERIALIZED (SELECT a, b, weight FROM (SELECT a, b, w + CASE WHEN l1 = {top} AND rarest IS NOT NULL THEN "
             f"log2((SELECT u FROM par{L.ROUNDS} WHERE k = 1 AND x = {top}) / rarest) ELSE 0 END AS weight "
             f"FROM lv JOIN pw USING (l0, l1, l2) LEFT JOIN rar ON rar.key = a) WHERE weight >= log2({L.PROBABILITY}::DOUBLE / (1 - {L.PROBABILITY}::DOUBLE)))",
             "un AS (SELECT a, b FROM lk UNION SELECT b, a FROM lk)",
             "re AS (SELECT a AS node, a AS lo FROM un UNION SELECT un.b, re.lo FROM re JOIN un ON re.node = un.a)",
             "ro AS (SELECT node, min(lo) AS root FROM re GROUP BY node)",
             "be AS (SELECT key, round(max(weight), 6) AS match_weight FROM (SELECT a AS key, weight FROM lk UNION ALL SELECT b, weight FROM lk) GROUP BY key)",
             "pl AS (SELECT nm.*, coalesce(root, nm.key) AS cluster, match_weight FROM nm LEFT JOIN ro ON ro.node = nm.key LEFT JOIN be ON be.key = nm.key)",
             "si AS (SELECT cluster, sum(name_rows)::BIGINT AS cluster_rows, count(*) AS cluster_names, count(DISTINCT key) AS cluster_keys FROM pl GROUP BY cluster)",
             "rp AS (SELECT cluster, name AS representative FROM pl QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY name_rows DESC, name) = 1)"]
    return (f"WITH RECURSIVE {', '.join(ctes)}\nSELECT name, key, cluster, name_rows, cluster_rows, cluster_names, cluster_keys, representative, "
            f"{_sql_ratio('name', 'representative')} AS similarity, match_weight FROM pl JOIN si USING (cluster) JOIN rp USING (cluster)")


@register("dedupe_names", _linked_sql())
def q_dedupe_names(spark, d):
    names = table(spark, d, "part").select(F.expr(_SPELLING).alias("name"))
    return L.linked_clusters(names, "name", normalize_text("name"))
