"""Operator 13: ranked lexical search by NRA (no random access).

``index`` writes one row per document: its term count and its distinct terms with
their counts.  ``search`` keeps the postings of the queries' terms, turns each into an
integer impact (term weight times saturated count), and stores them sorted from
the highest impact level down.  A (term, level) block of that order is what is read at once; a
directory of the blocks (rows, largest impact) is all that is known ahead.

Every query reads its lists downwards: the lists that hold most score per row
first, each from its highest level on.  A document's lower bound is the sum of what was read;
its upper bound adds, for each list where it was not met, the largest impact still unread there.  The first
round reads BUDGET rows a query, which gives a k-th lower bound; the directory tells how far to read until all that
an unseen document can reach is SHARE of it, and the next round reads that far (but at most GROWTH times as many rows as
the last one, so that a poor first bound costs little).  Then the query closes: the documents whose upper bound
reaches the k-th lower bound are its candidates, every tie among them.  The rest of the lists is read
for the candidates alone, which makes membership, ties and scores exact.

Terms are named by 64-bit hashes of their bytes.  Blocks are rows dealt over tasks, never groups in one
task, so a word that every document holds is no hot spot; per query only the
directory of its blocks is windowed.

Defined cases: null texts and texts without terms match nothing and do not count in N;
repeated rows are documents of their own; equal scores rank by ascending id (null
last), then by row; queries without terms or matches give no rows; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from shelfmark.llm import byte_words as bw
from shelfmark.llm.frames import scratch_scope, shuffle_partitions, written

K = 10
BUDGET = 4096
GROWTH = 64
STEPS = 8  # impact levels an octave
SHARE = 0.3  # of the k-th lower bound: reading on to here leaves few candidates
LEVELS = 1024  # more than there are levels


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in bw.pieces(batch.column("_text")):
            w = bw.words(piece, bw.LETTERS)
            text = w.text_of_word()
            order = np.lexsort((w.hashes, text))
            hashes, text = w.hashes[order], text[order]
            new = np.ones(len(order), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
            at = np.flatnonzero(new)
            first = pa.array(np.searchsorted(text[at], np.arange(len(w.first))).astype(np.int32))
            counts = np.diff(np.append(at, len(order)))
            lists = [pa.ListArray.from_arrays(first, pa.array(v)) for v in (hashes[at].view(np.int64), counts)]
            rest = [batch.column(c)[piece.rows] for c in ("_row", "_name")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(w.counts().astype(np.int64)), *lists],
                                             names=["_row", "_name", "_n", "_terms", "_tfs"])


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written: (_row, _name: the id, _n: terms with repeats, _terms, _tfs) of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_name"),
                       F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("_n", T.LongType()),
                           T.StructField("_terms", T.ArrayType(T.LongType())), T.StructField("_tfs", T.ArrayType(T.LongType()))])
    return written(rows.mapInArrow(_counted, schema), "lexical-index")


def _postings(rows: DataFrame) -> DataFrame:
    return rows.select("_row", "_n", F.inline(F.arrays_zip("_terms", "_tfs"))).select(
        "_row", "_n", F.col("_terms").alias("_term"), F.col("_tfs").alias("_tf"))


def _impacts(indexed: DataFrame, terms: DataFrame) -> DataFrame:
    """Written, highest level first: (_level, _term, _row, _impact), the impacts above 0 of ``terms``."""
    n_docs, n_terms = indexed.where("_n > 0").agg(F.count("*"), F.sum("_n")).first()
    found = written(_postings(indexed).join(terms, "_term"), "query-postings")
    df = found.groupBy("_term").agg(F.count("*").alias("_df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2) * F.col("_df") + 1)))
    weights = written(df.select("_term", weight.cast("long").alias("_w")), "term-weights", narrow=True)
    norm = F.expr(f"25 + (75 * _n * {n_docs}L) div {n_terms or 1}L")
    scored = (found.join(weights, "_term").withColumn("_m", norm)
              .withColumn("_impact", F.expr("_w * ((1000000000L * _tf) div (1000 * _tf + 8 * _m))")).where("_impact > 0")
              .select(F.floor(STEPS * F.log2("_impact")).cast("int").alias("_level"), "_term", "_row", "_impact"))
    order = [F.desc("_level"), "_term", "_row"]
    return written(scored.repartitionByRange(shuffle_partitions(indexed.sparkSession), *order).sortWithinPartitions(*order), "impacts")


def _blocks(wanted: DataFrame, postings: DataFrame) -> DataFrame:
    """Written: the blocks of every query's lists, with the largest addition to a score (_most), what reading them takes
    from the bound of an unseen document (_gain), and their place in the reading order (_step, highest first)."""
    directory = postings.groupBy("_term", "_level").agg(F.count("*").alias("_rows"), F.max("_impact").alias("_most"))
    lists = Window.partitionBy("_item", "_term")
    down = lists.orderBy(F.desc("_level"))
    telling = F.floor(STEPS * F.log2(F.max("_most").over(lists) / F.sum("_rows").over(lists)))
    blocks = wanted.join(directory, "_term").withColumn("_most", F.col("_times") * F.col("_most"))
    return written(blocks.withColumns({"_gain": F.col("_most") - F.lead("_most", 1, 0).over(down),
                                       "_step": (telling * LEVELS + F.col("_level")).cast("long")}), "blocks", narrow=True)


def _cuts(blocks: DataFrame, state: DataFrame, budget: int) -> DataFrame:
    """(_item, _kth, _cut: the step down to which to read, _unseen: what an unseen document can reach then)."""
    steps = blocks.groupBy("_item", "_step").agg(F.sum("_rows").alias("_rows"), F.sum("_gain").alias("_gain"))
    down = Window.partitionBy("_item").orderBy(F.desc("_step"))
    depth = steps.join(state, "_item").withColumns({
        "_so_far": F.sum("_rows").over(down), "_nth": F.row_number().over(down),
        "_unseen": F.sum("_gain").over(Window.partitionBy("_item")) - F.sum("_gain").over(down)})
    needed = F.col("_unseen") + F.col("_gain") >= F.col("_kth") * SHARE  # before this step the bound was not yet below
    affordable = (F.col("_so_far") <= budget) | (F.col("_nth") == 1)
    return depth.where(needed & affordable).groupBy("_item", "_kth").agg(F.min("_step").alias("_cut"), F.min("_unseen").alias("_unseen"))


def _read(lists: DataFrame, postings: DataFrame) -> DataFrame:
    """(_item, _row, _lower, _covered): what the read blocks of ``lists`` say of the documents they name."""
    floor = lists.agg(F.min("_level")).first()[0]
    met = lists.join(postings.where(F.col("_level") >= F.lit(floor)), ["_term", "_level"])
    return met.groupBy("_item", "_row").agg(F.sum(F.col("_times") * F.col("_impact")).alias("_lower"),
                                            F.sum("_ahead").alias("_covered"))


def _round(blocks: DataFrame, state: DataFrame, postings: DataFrame, budget: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Read on for the queries of ``state`` (_item, _kth).  Returns (_item, _kth, _closed, _cut) and the
    intervals (_item, _row, _lower, _upper) of the documents that can still be among the k best."""
    cut = written(_cuts(blocks, state, budget), "cuts", narrow=True)
    marked = written(blocks.join(cut, "_item").withColumn("_open", F.col("_step") < F.col("_cut")), "marked", narrow=True)
    ahead = marked.where("_open").groupBy("_item", "_term").agg(F.max("_most").alias("_ahead"))
    lists = (marked.where("NOT _open").select("_item", "_term", "_level", "_times")
             .join(ahead, ["_item", "_term"], "left").withColumn("_ahead", F.coalesce("_ahead", F.lit(0).cast("long"))))
    bounds = _read(written(lists, "lists", narrow=True), postings).join(cut, "_item")
    upper = (F.col("_lower") + F.col("_unseen") - F.col("_covered")).alias("_upper")
    seen = written(bounds.where(upper >= F.col("_kth")).select("_item", "_row", "_lower", upper), "intervals")
    top = Window.partitionBy("_item").orderBy(F.desc("_lower"))
    best = (seen.withColumn("_nth", F.row_number().over(top)).where(F.col("_nth") <= k)
            .groupBy("_item").agg(F.min("_lower").alias("_low"), F.max("_nth").alias("_have")))
    kth = F.when(F.col("_have") == k, F.greatest("_low", "_kth")).otherwise(F.col("_kth"))
    after = cut.join(best, "_item", "left").select("_item", kth.alias("_kth"), "_cut", "_unseen")
    closed = (F.col("_unseen") == 0) | (F.col("_unseen") < F.col("_kth") * SHARE)
    return written(after.select("_item", "_kth", "_cut", closed.alias("_closed")), "state", narrow=True), seen


def _settled(state: DataFrame, seen: DataFrame, blocks: DataFrame, postings: DataFrame) -> DataFrame:
    """Written: (_item, _row, score), the exact scores of the candidates of the queries that closed."""
    closed = state.where("_closed")
    named = written(seen.join(closed, "_item").where("_upper >= _kth").select("_item", "_row", "_lower"), "candidates")
    unread = blocks.join(closed, "_item").where("_step < _cut").select("_item", "_term", "_level", "_times")
    more = (postings.join(named.select("_row", "_item"), "_row").join(unread, ["_item", "_term", "_level"])
            .select("_item", "_row", (F.col("_times") * F.col("_impact")).alias("_lower")))
    return written(named.unionByName(more).groupBy("_item", "_row").agg(F.sum("_lower").alias("score")), "scores")


def search(indexed: DataFrame, queries: DataFrame, k: int = K, budget: int = BUDGET, item_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """(<item_col>, rank, doc: the document's id, score): the k best documents of ``index`` for every row of ``queries``."""
    spark = indexed.sparkSession
    asked = index(queries, item_col, text_col)
    wanted = written(_postings(asked).select(F.col("_row").alias("_item"), "_term", F.col("_tf").alias("_times")), "queries", narrow=True)
    with scratch_scope(spark):
        postings = _impacts(indexed, written(wanted.select("_term").distinct(), "query-terms", narrow=True))
    blocks = _blocks(wanted, postings)
    found = wanted.select("_item", F.col("_item").alias("_row"), F.lit(0).cast("long").alias("score")).where("false")
    state = blocks.select("_item", F.lit(0).cast("long").alias("_kth")).distinct()
    while not state.isEmpty():
        with scratch_scope(spark, keep=2):
            after, seen = _round(blocks, state, postings, budget, k)
            found = found.unionByName(_settled(after, seen, blocks, postings))
            state = written(after.where("NOT _closed").select("_item", "_kth"), "open", narrow=True)
        budget *= GROWTH
    best = found.join(indexed.select("_row", F.col("_name").alias("doc")), "_row")
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "_row")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    items = asked.select(F.col("_row").alias("_item"), F.col("_name").alias("_asked"))
    return ranked.join(items, "_item").select(F.col("_asked").alias(item_col), "rank", "doc", "score")
