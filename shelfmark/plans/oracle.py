"""SQL twins of the native cleaners and of the star build, for the DuckDB
oracle (RE2 regex; ASCII whitespace, which is all the driver text holds)."""

from __future__ import annotations

from shelfmark.plans.catalog import SQL_CHECKOUTS, SQL_EXTERNAL, SQL_INVENTORY, SQL_WEATHER


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def normalize(x: str) -> str:
    s = rf"regexp_replace(lower({x}), '(\s*\(.+\)\s*)$', '')"
    s = rf"""regexp_replace({s}, '[\[\]<>{{}}|\\!"#&()*+,./:;?@_-]', ' ', 'g')"""
    s = f"replace({s}, '''', '')"
    s = rf"regexp_replace({s}, '\s{{2,}}', ' ', 'g')"
    return strip(s)


def clean_title(raw: str, ext: str | None = None) -> str:
    local = (f"CASE WHEN {raw} IS NULL OR {raw} = '' THEN NULL "
             f"WHEN contains({raw}, ' / ') THEN {strip(f'regexp_extract({raw}, {chr(39)}(?s)^(.*) / {chr(39)}, 1)')} "
             f"ELSE {raw} END")
    if ext is None:
        return local
    return f"CASE WHEN {ext} IS NOT NULL AND {ext} <> '' THEN {ext} ELSE {local} END"


def min_year(raw: str) -> str:
    return rf"list_min(list_transform(regexp_extract_all({raw}, '(\d{{4}})', 1), lambda y: CAST(y AS INTEGER)))"


def clean_year(raw: str, ext_ts: str) -> str:
    return f"CASE WHEN {ext_ts} IS NOT NULL THEN year({ext_ts}) ELSE {min_year(raw)} END"


def clean_publisher(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE regexp_replace({strip(x)}, '^,+|,+$', '', 'g') END"


def format_author(s: str) -> str:
    ny = rf"regexp_replace({s}, ', \d{{4}}-(\d{{4}})?$', '')"
    p = f"string_split({s}, ', ')"
    q = f"string_split({ny}, ', ')"
    return (f"CASE WHEN {s} IS NULL THEN NULL "
            f"WHEN length({ny}) <> length({s}) THEN "
            f"CASE WHEN len({q}) = 2 THEN {q}[2] || ' ' || {q}[1] ELSE {ny} END "
            f"WHEN len({p}) = 2 AND length({p}[1]) < 36 AND length({p}[2]) < 36 THEN {p}[2] || ' ' || {p}[1] "
            f"ELSE {s} END")


# The star over the driver tables as one CTE chain (names match the Spark tables).
_STAR = f"""
inv AS (@inventory),
ext AS (@external),
inv_keys AS (SELECT bib_num, unnest(string_split(isbns, ', ')) AS k FROM inv),
ext_keys AS (SELECT * FROM (SELECT e.*, unnest(list_distinct([e.isbn, e.isbn13])) AS k FROM ext e)
             WHERE k IS NOT NULL),
matched AS (SELECT ik.bib_num, ek.* EXCLUDE (k),
                   row_number() OVER (PARTITION BY ik.bib_num ORDER BY ek.bookID, ek.title, ek.authors) AS rn
            FROM inv_keys ik JOIN ext_keys ek ON ik.k = ek.k),
books AS (SELECT i.*, m.title AS gr_title, m.authors AS gr_authors, m.publication_date AS gr_publication_date,
                 m.average_rating AS gr_average_rating, m.ratings_count AS gr_ratings_count,
                 m.text_reviews_count AS gr_text_reviews_count
          FROM inv i LEFT JOIN (SELECT * FROM matched WHERE rn = 1) m ON i.bib_num = m.bib_num),
co AS (@checkouts),
weather AS (@weather),
subj AS (SELECT DISTINCT unnest(string_split(raw_subjects, ', ')) AS name FROM books),
dim_subject AS (SELECT row_number() OVER (ORDER BY name) - 1 AS id, name FROM subj),
br_book_subject AS (SELECT b.bib_num, s.id AS subject_id
                    FROM (SELECT bib_num, unnest(string_split(raw_subjects, ', ')) AS name FROM books) b
                    JOIN dim_subject s ON b.name = s.name),
author_names AS (SELECT * FROM (SELECT bib_num, {format_author('raw_author')} AS name FROM books
                                UNION ALL
                                SELECT bib_num, unnest(string_split(gr_authors, '/')) AS name FROM books)
                 WHERE name IS NOT NULL),
author_keys AS (SELECT bib_num, name, {normalize('name')} AS key FROM author_names),
dim_author_k AS (SELECT row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS id, name, key
                 FROM (SELECT key, min(name) AS name FROM author_keys GROUP BY key)),
dim_author AS (SELECT id, name FROM dim_author_k),
br_book_author AS (SELECT a.bib_num, d.id AS author_id FROM author_keys a JOIN dim_author_k d ON a.key = d.key),
pub_lookup AS (SELECT bib_num, raw_publisher AS publisher, {normalize('raw_publisher')} AS key FROM books),
dim_publisher_k AS (SELECT row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS id,
                           {clean_publisher('publisher')} AS name, key
                    FROM (SELECT key, min(publisher) AS publisher FROM pub_lookup GROUP BY key)),
dim_publisher AS (SELECT id, name FROM dim_publisher_k),
dim_checkout_time AS (SELECT checkout_datetime, hour(checkout_datetime) AS hour, day(checkout_datetime) AS day,
                             weekofyear(checkout_datetime) AS week, dayofweek(checkout_datetime) + 1 AS weekday,
                             month(checkout_datetime) AS month, year(checkout_datetime) AS year
                      FROM (SELECT DISTINCT checkout_datetime FROM co)),
dim_book AS (SELECT bib_num, {clean_title('raw_title', 'gr_title')} AS title, isbns,
                    {clean_year('raw_publication_year', 'gr_publication_date')} AS publication_year,
                    CAST(gr_average_rating AS DOUBLE) AS avg_rating, CAST(gr_ratings_count AS INTEGER) AS ratings_count,
                    CAST(gr_text_reviews_count AS INTEGER) AS text_reviews_count,
                    raw_title, raw_author, raw_publisher, raw_publication_year FROM books),
fact_spl_book_checkout AS (
  SELECT c.bib_num, c.item_barcode, c.checkout_datetime, CAST(w.temperature AS DOUBLE) AS temperature,
         p.id AS publisher_id,
         md5(concat_ws('=', c.bib_num, c.item_barcode, CAST(c.checkout_datetime AS VARCHAR))) AS id
  FROM co c
  LEFT JOIN weather w ON w.year = year(c.checkout_datetime) AND w.month = month(c.checkout_datetime)
                     AND w.day = day(c.checkout_datetime)
  LEFT JOIN pub_lookup l ON l.bib_num = c.bib_num
  LEFT JOIN dim_publisher_k p ON p.key = l.key)
"""


def with_star(select_sql: str, inventory: str = SQL_INVENTORY, external: str = SQL_EXTERNAL,
              checkouts: str = SQL_CHECKOUTS, weather: str = SQL_WEATHER) -> str:
    cte = _STAR.strip()
    for name, sql in (("@inventory", inventory), ("@external", external), ("@checkouts", checkouts), ("@weather", weather)):
        cte = cte.replace(name, sql)
    return f"WITH {cte}\n{select_sql}"
