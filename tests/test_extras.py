"""Nested list pages against an HTML parser, fixed-size samples, stored sketches, quoted CSV fields."""

import os
import random
from collections import Counter
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import markup, sampling, sketches
from shelfmark.sources import feeds
from shelfmark.sources.sinks import write_csv


# ---- nested lists ------------------------------------------------------------

class Tree(HTMLParser):
    """The first link of every item, items and containers nested as they are closed."""

    def __init__(self, tag, css_class):
        super().__init__()
        self.tag, self.css_class, self.open, self.items, self.links = tag, css_class, [], [], []

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "classes": (dict(attrs).get("class") or "").split(), "text": "", "link": None}
        inside = any(o["tag"] == self.tag and (not self.css_class or self.css_class in o["classes"]) for o in self.open)
        if tag == "a":
            for o in self.open:
                if o["tag"] == "li" and o["link"] is None:
                    o["link"] = node
        if tag == "li" and (inside or not self.tag):
            self.items.append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k]["tag"] == tag:
                del self.open[k]
                return

    def handle_data(self, data):
        for o in self.open:
            if o["tag"] == "a":
                o["text"] += data


def parsed(html, tag=None, css_class=None):
    t = Tree(tag, css_class)
    t.feed(html)
    return sorted(i["link"]["text"] for i in t.items if i["link"])


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.randint(0, 6)
        inner = random_page(rng, depth + 1) if depth < 4 else f"t{rng.randint(0, 99)}"
        out.append({0: f"text {rng.randint(0, 99)} &amp; a < b ", 1: f"<ul><li>{inner}</li></ul>", 2: f"<UL CLASS=\"q\"><LI>{inner}</LI><li>x</li></UL>",
                    3: f"<a href=\"/x\">link{rng.randint(0, 999)} <b>bold</b></a>", 4: f"<!-- <li><a>hidden{rng.randint(0, 9)}</a></li> -->",
                    5: f"<div class=\"{rng.choice(['box', 'a box b', 'boxes', ''])}\">{inner}</div>", 6: f"<div>{inner}</div>"}[kind])
    return "".join(out)


@pytest.mark.parametrize("tag,css_class", [(None, None), ("div", None), ("div", "box")])
def test_nested_lists_as_a_parser_sees_them(spark, tag, css_class):
    rng = random.Random(11)
    pages = [(k % 20, random_page(rng)) for k in range(40)] + [(90, None), (91, ""), (92, "no tags"), (93, "</li><li><a>open"), (94, "<ul><li><a>a</a><ul><li><a>b</a></li></ul></li></ul>")]
    links, dropped = markup.nested_list_links(spark.createDataFrame(pages, "page int, h string"), "page", "h", "link1", tag, css_class)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    want = [(k, t) for k, h in pages for t in parsed(h or "", tag, css_class)]
    assert sorted(map(tuple, links.collect())) == sorted((k, t) for k, t in want if not t.startswith("link1"))
    gone = Counter(k for k, t in want if t.startswith("link1"))
    assert {r["page"]: r["n_dropped"] for r in dropped.collect() if r["n_dropped"]} == gone


# ---- samples -----------------------------------------------------------------

def test_a_sample_has_n_rows_whatever_the_partitions(spark):
    df = spark.range(500).select("id", F.concat(F.lit("n"), F.col("id") % 50).alias("name"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise("x").alias("v"))
    got = [sorted(map(str, sampling.sample_rows(df.repartition(p), 20, seed=4).collect())) for p in (1, 3, 11)]
    assert len(got[0]) == 20 and got[0] == got[1] == got[2]
    assert sampling.sample_rows(df, 20, 4).columns == df.columns
    assert sampling.sample_rows(df.limit(7), 20).count() == 7 and sampling.sample_rows(df.where("false"), 20).count() == 0
    small, large = ({r["id"] for r in sampling.sample_rows(df, n, 4).collect()} for n in (20, 60))
    assert small < large
    # the sample of a whole from samples of its parts
    halves = sampling.sample_rows(df.where("id < 100"), 20, 4).unionByName(sampling.sample_rows(df.where("id >= 100"), 20, 4))
    assert {r["id"] for r in sampling.sample_rows(halves, 20, 4).collect()} == small
    assert "TakeOrderedAndProject" in sampling.sample_rows(df, 20)._jdf.queryExecution().executedPlan().toString()


def test_samples_are_uniform(spark):
    df = spark.range(40).select(F.col("id"))
    seeds = spark.range(3000).select(F.col("id").alias("seed"))
    h = F.md5(F.concat_ws("|", F.col("seed").cast("string"), F.concat(F.lit("="), F.col("id").cast("string"))))
    assert (sampling.sample_rows(df, 5, seed=17).collect()
            == df.orderBy(F.md5(F.concat_ws("|", F.lit("17"), F.concat(F.lit("="), F.col("id").cast("string"))))).limit(5).collect())
    drawn = (seeds.join(df).groupBy("seed").agg(F.slice(F.array_sort(F.collect_list(F.struct(h.alias("h"), "id"))), 1, 5).alias("s"))
             .select(F.explode("s.id").alias("id")).groupBy("id").count().collect())
    expected = 3000 * 5 / 40
    chi = sum((r["count"] - expected) ** 2 / expected for r in drawn)
    assert len(drawn) == 40 and chi < 75  # 39 degrees of freedom: 75 is beyond 0.9995


# ---- sketches ----------------------------------------------------------------

def test_sketches_of_months_merge_and_are_replaced(spark, tmp):
    df = spark.range(20_000).select((F.col("id") % 4).alias("month"), (F.col("id") * 7919 % 6000).alias("a"),
                                    F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), F.col("id") % 37)).alias("b"), F.lit(" ").alias("c"))
    columns = ["a", "b", "c"]
    plan = sketches.column_sketches(df, columns, "month")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
    sketches.add_sketches(df.where("month < 3"), columns, "month", tmp + "/s")
    sketches.add_sketches(df.where("month = 3").limit(10), columns, "month", tmp + "/s")
    sketches.add_sketches(df.where("month = 3"), columns, "month", tmp + "/s")  # replaces the ten rows
    got = {r["column_name"]: r for r in sketches.profile_of(spark, tmp + "/s").collect()}
    exact = {"a": 6000, "b": 37, "c": 1}
    for c, n in exact.items():
        assert got[c]["n_rows"] == 20_000 and abs(got[c]["n_distinct"] - n) <= sketches.ERROR * n + 0.5
    assert (got["b"]["n_null"], got["b"]["n_values"], got["c"]["n_empty"]) == (4000, 16_000, 20_000)


# ---- quoted fields -----------------------------------------------------------

def test_quotes_and_line_breaks_in_fields(spark, tmp):
    path = os.path.join(tmp, "in.csv")
    with open(path, "w") as f:
        f.write('BibNum,Title,Author\n1,"The ""only"" child, a novel / Pyper.","Pyper, Andrew"\n2,"two\nlines",x\n3,back\\slash,y\n')
    rows = feeds.read_header_csv(spark, path, ["BibNum", "Title", "Author"], multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", 'The "only" child, a novel / Pyper.', "Pyper, Andrew"), ("2", "two\nlines", "x"), ("3", "back\\slash", "y")]
    values = [('a "b", c', "x"), ('"', ","), ("\\", '\\"')]
    out = os.path.join(tmp, "out")
    write_csv(spark.createDataFrame(values, "publisher string, official_publisher string"), out)
    assert sorted(map(tuple, feeds.load_name_map(spark, out).collect())) == sorted(values)


def test_json_maps_take_their_key_from_the_file_name(spark, tmp):
    for name, text in (("000724519X_1.json", '{"1": 5, "2": 6}'), ("b_2_x.json", '{"1": 7}'), ("c.json", "{}")):
        with open(os.path.join(tmp, name), "w") as f:
            f.write(text)
    got = sorted(map(tuple, feeds.read_json_map_files(spark, tmp).collect()))
    assert got == [("000724519X", "1", "5"), ("000724519X", "2", "6"), ("b", "1", "7")]
