"""Feed readers (S1-S8) and writers (S9-S13) on small temporary files."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from shelfmark.sources import feeds, sinks


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_header_csv_all_strings_and_glob(spark, tmp):
    _write(os.path.join(tmp, "checkouts_2016.csv"),
           "BibNumber,ItemBarcode,ItemType,Collection,CallNumber,CheckoutDateTime\n"
           "1,0010000000001,acbk,nanf,X,01/05/2016 01:02:03 PM\n")
    _write(os.path.join(tmp, "checkouts_2017.csv"),
           "BibNumber,ItemBarcode,ItemType,Collection,CallNumber,CheckoutDateTime\n"
           "2,0010000000002,acdvd,nanf,Y,12/31/2017 11:59:00 AM\n")
    df = feeds.load_checkouts(spark, os.path.join(tmp, "checkouts_*.csv"))
    assert set(t for _, t in df.dtypes) == {"string"}
    assert df.count() == 2


def test_external_books_padded_header_and_bad_date(spark, tmp):
    p = _write(os.path.join(tmp, "books.csv"),
               "bookID,title,authors,average_rating,isbn,isbn13,language_code,  num_pages,ratings_count,"
               "text_reviews_count,publication_date,publisher\n"
               "1,T,A/B,3.5,0439785960,9780439785969,eng,652,10,2,9/16/2006,Scholastic\n"
               "2,U,C,x,3.63,123456789,eng,12,1,0,13/45/2006,P\n")
    rows = feeds.load_external_books(spark, p).orderBy("bookID").collect()
    assert "num_pages" in rows[0].asDict()
    assert rows[0].publication_date == dt.datetime(2006, 9, 16)
    assert rows[0].num_pages == 652
    assert rows[1].publication_date is None and rows[1].average_rating is None


def test_headerless_map_and_gazetteer(spark, tmp):
    m = feeds.load_name_map(spark, _write(os.path.join(tmp, "map.csv"), "Bloomsbury,,Bloomsbury Publishing\n"
                                                                        "Knopf,Alfred A. Knopf\n"))
    assert m.columns == ["publisher", "official_publisher"]
    g = feeds.read_gazetteer(spark, _write(os.path.join(tmp, "gaz.csv"), "publisher\nA\n\nB\n  \n"))
    assert sorted(r.publisher for r in g.collect()) == ["A", "B"]


def test_weather_runs_of_blanks(spark, tmp):
    p = _write(os.path.join(tmp, "w.txt"), " 1   2  2017    45.5\n\n12  31 2016  -99\n 1 2 2017 bad\n")
    rows = feeds.load_weather(spark, p).orderBy("year", "month", "day").collect()
    assert [(r.month, r.day, r.year) for r in rows] == [(12, 31, 2016), (1, 2, 2017), (1, 2, 2017)]
    assert rows[0].temperature == -99.0
    assert sorted(str(r.temperature) for r in rows[1:]) == ["45.5", "None"]  # the bad value is NULL, its row stays


def test_json_map_files(spark, tmp):
    _write(os.path.join(tmp, "000724519X_com.json"), json.dumps({"1360000000": 12, "1360086400": 15}))
    _write(os.path.join(tmp, "B00000000X_com.json"), json.dumps({"1360000000": 7}))
    df = feeds.read_json_map_files(spark, os.path.join(tmp, "*.json"))
    got = sorted((r.file_key, r.map_key, r.map_value) for r in df.collect())
    assert got == [("000724519X", "1360000000", "12"), ("000724519X", "1360086400", "15"),
                   ("B00000000X", "1360000000", "7")]


def test_html_list_links(spark):
    html = ('<div class="div-col"><ul><li><a href="/a">Microsoft Press</a> – arm of <a href="/m">Microsoft</a></li>'
            '<li><a href="/b">Tom &amp; Jerry Books</a></li>'
            + "".join(f'<li><a href="/l{i}">List of things {i}</a></li>' for i in range(8)) + "</ul></div>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    links, dropped = feeds.extract_list_links(pages, "page_id", "html")
    assert sorted(r.link_text for r in links.collect()) == ["Microsoft Press", "Tom & Jerry Books"]
    assert dropped.first().n_dropped == 8


def test_limit_rows_ordered(spark):
    df = spark.range(100).withColumn("k", (F.col("id") * 37) % 100)
    assert [r.k for r in feeds.limit_rows(df, 3, ["k"]).collect()] == [0, 1, 2]
    assert feeds.limit_rows(df, 0).count() == 100


def test_partitioned_write_and_conform(spark, tmp):
    df = spark.createDataFrame([("1", "2017-01-01 10:00:00"), ("2", "2017-02-01 10:00:00")], "b string, t string") \
        .select("b", F.col("t").cast("timestamp_ntz").alias("ts"))
    path = os.path.join(tmp, "out")
    sinks.write_parquet(df.withColumn("month", F.month("ts")), path, partition_by=["month"])
    assert {"month=1", "month=2"} <= set(os.listdir(path))
    back = spark.read.parquet(path).filter("month = 2")
    assert back.count() == 1
    # load by position into declared names and types
    shaped = sinks.conform_schema(spark.createDataFrame([(1, "x")], "a long, b string"), "dim_author")
    assert shaped.dtypes == [("id", "bigint"), ("name", "string")]


def test_bulk_load_fails_on_extra_columns_and_bad_values(spark):
    import pytest

    with pytest.raises(ValueError):
        sinks.conform_schema(spark.createDataFrame([(1, "n", "lost")], "a long, b string, c string"), "dim_author")
    with pytest.raises(ValueError):
        sinks.conform_schema(spark.createDataFrame([(1,)], "id long"), "dim_author", by_position=False)
    bad = sinks.conform_schema(spark.createDataFrame([("abc", "n"), (None, "m")], "a string, b string"), "dim_author")
    with pytest.raises(Exception, match="not a bigint: abc"):
        bad.collect()


def test_file_count(spark, tmp):
    path = os.path.join(tmp, "few")
    sinks.write_parquet(spark.range(1000).repartition(8), path, files=2)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 2
    assert spark.read.parquet(path).count() == 1000
