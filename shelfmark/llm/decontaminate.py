"""Operator 7: benchmark decontamination by winnowing.

A window is ``WINDOW`` (10) consecutive words of a benchmark item; an item of
fewer words is one window.  Both texts are hashed in ``K``-word grams and each
run of WINDOW - K + 1 neighbouring grams keeps its smallest hash, so two equal
windows always keep the same hash: no shared span of ten words can be missed.
Runs of equal minima are stored once, with the window starts that they stand
for.  The document fingerprints are joined with the benchmark's, and only
windows behind a hit are extended, that is compared word for word.  Items
shorter than WINDOW are fingerprinted by their whole length, one gram size per
length that occurs (at most WINDOW - 1).

The benchmark's fingerprints and windows, and the marks of rows that hold a fingerprint, are each broadcast only when their counted bytes are
at most ``BROADCAST_BYTES``; beyond that both sides are shuffled
and adaptive execution splits hot fingerprints.

Defined cases: null or empty texts have no words and no hits; items without
words give no window; repeated document rows are judged alike, repeated items count
once; null item ids are left out of the item list; null doc ids stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.frames import identified, own_columns, with_identity, written
from shelfmark.llm.native_text import grams, let, lower_az, words_of

WINDOW = 10
K = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 16 << 20
KEY = ["_id", "_th"]


def plain_words(text: Column) -> Column:
    return words_of(lower_az(F.coalesce(text, F.lit(""))), SEPARATORS)


def _minima(words: Column) -> Column:
    """The kept hash of every WINDOW-word window, in order."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    kgrams = lambda h: grams(h, K, F.xxhash64)
    return let(let(hashes, kgrams), lambda g: grams(g, WINDOW - K + 1, F.array_min))


def _whole(words: Column, length: int) -> Column:
    """Hashes of all ``length``-word windows."""
    return let(F.transform(words, lambda w: F.xxhash64(w)),
               lambda h: grams(h, length, lambda g: F.xxhash64(F.lit(length), g)))


def _runs(hashes: Column, length: int) -> Column:
    """Neighbouring equal hashes as one struct (fp, len, start, stop)."""
    def of(h: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(h) - 1),
                         lambda i: (i == 0) | (F.get(h, i) != F.coalesce(F.get(h, i - 1), F.get(h, i))))
        return let(heads, lambda s: F.transform(s, lambda i, j: F.struct(
            F.get(h, i).alias("fp"), F.lit(length).alias("len"), i.alias("start"),
            F.coalesce(F.get(s, j + 1), F.size(h)).alias("stop"))))
    none = F.array().cast("array<struct<fp:bigint,len:int,start:int,stop:int>>")
    return let(hashes, lambda h: F.when(F.size(h) > 0, of(h)).otherwise(none))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(_fp, _len, _window, _item): every window of every item, once."""
    items = benchmark.select(F.col(item_col).alias("_item"), plain_words(F.col(text_col).cast("string")).alias("_w"))
    size = F.size("_w")
    windows = F.when(size >= WINDOW, grams(F.col("_w"), WINDOW, lambda g: g)).otherwise(F.array(F.col("_w")))
    rows = items.where(size > 0).select("_item", F.explode(windows).alias("_g")).select(
        "_item", F.size("_g").alias("_len"), F.array_join("_g", " ").alias("_window"), "_g")
    short = F.lit(None).cast("long")
    for n in range(1, WINDOW):
        short = F.when(F.col("_len") == n, F.get(_whole(F.col("_g"), n), F.lit(0))).otherwise(short)
    fp = F.when(F.col("_len") == WINDOW, F.get(_minima(F.col("_g")), F.lit(0))).otherwise(short)
    return rows.select(fp.alias("_fp"), "_len", "_window", "_item").distinct()


def _maybe_broadcast(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(per row: _id, _th, _n_words; per matched window: _id, _th, _start, _len, _item)."""
    windows = written(benchmark_windows(benchmark, item_col, item_text_col), "benchmark-windows")
    text_bytes = F.sum(F.octet_length("_window") + F.octet_length(F.col("_item").cast("string")))
    known = windows.agg(F.count("*").alias("n"), F.collect_set("_len").alias("l"), F.coalesce(text_bytes, F.lit(0)).alias("bytes")).first()
    rows = identified(docs, id_col, text_col)
    runs = _runs(_minima(F.col("_w")), WINDOW)
    for n in sorted(x for x in known["l"] if x < WINDOW):
        runs = F.concat(runs, _runs(_whole(F.col("_w"), n), n))
    prints = windows.select("_fp", "_len").distinct()
    marks = (rows.select(*KEY, plain_words(F.col("_text")).alias("_w"))
             .select(*KEY, F.explode(runs).alias("_r")).select(*KEY, "_r", F.col("_r.fp").alias("_fp"), F.col("_r.len").alias("_len"))
             .join(_maybe_broadcast(prints, 12 * known["n"]), ["_fp", "_len"], "left_semi")
             .groupBy(*KEY).agg(F.collect_set(F.struct("_r.len", "_r.start", "_r.stop")).alias("_runs")))
    marks = written(marks, "benchmark-marks")
    size = marks.agg(F.coalesce(F.sum(24 + 12 * F.size("_runs")), F.lit(0))).first()[0]

    def starts(w: Column) -> Column:
        spread = F.flatten(F.transform(F.col("_runs"), lambda r: F.transform(
            F.sequence(r["start"], r["stop"] - 1), lambda i: F.struct(r["len"].alias("len"), i.alias("start")))))
        return F.transform(spread, lambda x: F.struct(
            x["len"].alias("len"), x["start"].alias("start"),
            F.array_join(F.slice(w, x["start"] + 1, x["len"]), " ").alias("window")))

    # only rows with a mark meet their words again; marks go to the texts, not texts to the marks, while they are small
    marked = rows.join(_maybe_broadcast(marks, size), KEY).select(*KEY, "_runs", plain_words(F.col("_text")).alias("_w"))
    spans = written(marked.select(*KEY, let(F.col("_w"), starts).alias("_at")), "benchmark-hits")
    per_row = rows.select(*KEY, F.size(plain_words(F.col("_text"))).cast("long").alias("_n_words")).distinct()
    matched = (spans.select(*KEY, F.explode("_at").alias("_a"))
               .select(*KEY, F.col("_a.start").alias("_start"), F.col("_a.len").alias("_len"), F.col("_a.window").alias("_window"))
               .distinct()
               .join(_maybe_broadcast(windows.select("_len", "_window", "_item"), known["bytes"] + 32 * known["n"]), ["_len", "_window"])
               .select(*KEY, "_start", "_len", "_item"))
    return per_row, matched


def _covered(spans: Column) -> Column:
    """Words under the union of (start, len) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    def add(a: Column, x: Column) -> Column:
        end = x["_start"] + x["_len"]
        return F.struct((a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], x["_start"]))).alias("n"),
                        F.greatest(a["end"], end).alias("end"))
    return F.aggregate(F.array_sort(spans), zero, add, lambda a: a["n"])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per distinct row: _id, _th, _n_words, _n_hit, _items (sorted texts)."""
    per_row, matched = hits(docs, benchmark, id_col, text_col, item_col, item_text_col)
    found = matched.groupBy(*KEY).agg(
        _covered(F.collect_set(F.struct("_start", "_len"))).cast("long").alias("_n_hit"),
        F.array_sort(F.collect_set(F.col("_item").cast("string"))).alias("_items"))
    return (per_row.join(found, KEY, "left")
            .withColumn("_n_hit", F.coalesce("_n_hit", F.lit(0).cast("long")))
            .withColumn("_items", F.coalesce("_items", F.array().cast("array<string>"))))


@own_columns
def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, columns unchanged."""
    dirty = contaminated(docs, benchmark, id_col, text_col).where("_n_hit > 0").select(*KEY)
    # equal null-safe: the hash of a null text is a value, the id is never null
    return (with_identity(docs, id_col, text_col).join(dirty, KEY, "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
