"""Operator 5: near-duplicate groups by HyperMinHash.

A text's set holds its distinct 5-word shingles (64-bit hashes).  Equal sets
(size and two sums of hashes agree) form one class, and only one sketch per class goes on.  A sketch has REGISTERS
buckets; each keeps the smallest hash that fell into it as a leading-zero
count (6 bits) and the next 10 bits.  Sets of at least WIDE shingles are dealt over
the buckets by one hash; smaller sets cannot fill them, so there each bucket
has a hash of its own over the whole set.  Sets near the border carry both forms, as
a partner of 1/0.85 times the size may lie beyond it.

Compressed registers are banded (ROWS by BANDS: a pair at 0.85 is missed with
probability 3e-7).  A band group is never expanded into all its pairs: in each of
PIVOT_ROUNDS rounds every group compares its members with one pivot, all pairs
are verified together, and groups whose members are in one component are
settled.  In what is left, groups of at most SMALL_GROUP members compare the
pairs of different components.  Larger groups (texts from one template share bands without being near) are
grouped anew by their sets' rarest shingles: two sets at the threshold share one of the first
size - ceil(0.85 size) + 1 in any common order, so groups by these lose no pair, and a shingle of the
template is not among them.  Those groups are compared like the others; the few that are still large hold the members outside
their largest component against all members, in blocks.  So no pair that shares
a band goes unseen unless it is already connected.  Pairs whose collision-corrected
estimate is five standard errors below the threshold are left out; the others
are confirmed on the full sets.  Components: alternating star contraction.

Defined cases: null, empty or white-space texts have an empty set and no
links; a null id counts as the largest id and is given back as null; repeated rows are in one group;
two rows without id and with different texts are different documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm import byte_words as bw
from shelfmark.llm.components import components
from shelfmark.llm.frames import identified, own_columns, with_identity, written

SHINGLE = 5
THRESHOLD = 85  # in hundredths
ROWS, BANDS = 5, 26
REGISTERS = ROWS * BANDS
WIDE = 512
MANTISSA = 10
EMPTY = 0xFFFF
PIVOT_ROUNDS = 1
SMALL_GROUP = 32
BLOCK = 128
BLOCK_SHINGLES = 1 << 16
STRIP = 4096
KEY = ["_id", "_th"]

_HASHES = bw.seeds(REGISTERS, 4242)
_BAND = bw.seeds(BANDS, 77)
_ROW = bw.seeds(ROWS, 55)


def _compressed(rest: np.ndarray) -> np.ndarray:
    """32-bit minima as leading zeros and the bits after the first one."""
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    zeros = 32 - length
    shifted = (rest.astype(np.uint64) << (zeros + 1).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | (shifted >> np.uint64(32 - MANTISSA))).astype(np.uint16)


def _wide(x: np.ndarray) -> np.ndarray:
    """Registers of one sorted set: buckets are ranges of the hash, so the first of a range is its minimum."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    scaled = (x >> np.uint64(32)) * np.uint64(REGISTERS)
    bucket = (scaled >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    out[bucket[first]] = _compressed(scaled[first] & np.uint64(0xFFFFFFFF))
    return out


def _narrow(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of some sets that lie one after another."""
    return np.stack([_compressed(np.minimum.reduceat(x * a, first) >> np.uint64(32)) for a in _HASHES], axis=1)


def _bands(registers: np.ndarray, narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    """(keys, usable): a key per band; a band without any filled bucket is not usable."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    mixed = bw.mix((parts.astype(np.uint64) + np.uint64(1)) * _ROW).sum(axis=2, dtype=np.uint64)
    return bw.mix(mixed * _BAND + np.uint64(narrow)), (parts != EMPTY).any(axis=2)


def _distinct_sets(texts: pa.Array, k: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    for piece in bw.pieces(texts):
        hashes, first = bw.shingles(bw.words(piece), k)
        sets = []
        for a, b in zip(first[:-1], first[1:]):
            x = np.sort(hashes[a:b])
            sets.append(x[np.diff(x, prepend=~x[:1]).astype(bool)] if len(x) else x)
        yield piece.rows, sets


SKETCH = ("_id bigint, _th bigint, _n bigint, _node bigint, _check bigint, _bands array<bigint>, "
          "_narrow binary, _wide binary")
SETS = "_node bigint, _set array<bigint>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, sets in _distinct_sets(batch.column("_text"), SHINGLE):
            size = np.array([len(s) for s in sets], np.int64)
            joined = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
            first = np.concatenate([[0], np.cumsum(size)])
            node = bw.mix(bw.segment_sums(bw.mix(joined ^ np.uint64(0x5DEECE66D)), first) + size.astype(np.uint64))
            check = bw.mix(bw.segment_sums(bw.mix(joined ^ np.uint64(0xB5297A4D3F84D5B5)), first))
            limit = WIDE * 100 / THRESHOLD
            low = np.flatnonzero((size > 0) & (size < limit))
            high = np.flatnonzero(size >= WIDE * THRESHOLD / 100)
            bands: list[list] = [[] for _ in sets]
            regs: list[list] = [[None] * len(sets), [None] * len(sets)]
            if len(low):
                part = np.concatenate([sets[t] for t in low])
                at = np.concatenate([[0], np.cumsum(size[low])[:-1]])
                _fill(low, _narrow(part, at), True, bands, regs[0])
            if len(high):
                _fill(high, np.stack([_wide(sets[t]) for t in high]), False, bands, regs[1])
            yield pa.RecordBatch.from_arrays([
                batch.column("_id")[rows], batch.column("_th")[rows], pa.array(size),
                pa.array(node.view(np.int64)), pa.array(check.view(np.int64)), pa.array(bands, pa.list_(pa.int64())),
                pa.array(regs[0], pa.binary()), pa.array(regs[1], pa.binary())],
                names=["_id", "_th", "_n", "_node", "_check", "_bands", "_narrow", "_wide"])


def _fill(texts, registers, narrow, bands, regs) -> None:
    keys, usable = _bands(registers, narrow)
    for row, t in enumerate(texts):
        bands[t].extend(keys[row][usable[row]].view(np.int64).tolist())
        regs[t] = registers[row].tobytes()


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, sets in _distinct_sets(batch.column("_text"), SHINGLE):
            yield pa.RecordBatch.from_arrays([
                batch.column("_node")[rows],
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["_node", "_set"])


def estimated(a: bytes, b: bytes) -> float:
    """Jaccard estimate of two register strings, corrected for registers
    that agree by chance (0.17 in 2^MANTISSA)."""
    x, y = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
    filled = (x != EMPTY) | (y != EMPTY)
    chance = 0.17 / 2**MANTISSA
    return max(0.0, (float((x[filled] == y[filled]).mean()) - chance) / (1 - chance)) if filled.any() else 0.0


FLOOR = THRESHOLD / 100 - 5 * (0.85 * 0.15 / REGISTERS) ** 0.5


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("_narrow_a", "_narrow_b", "_wide_a", "_wide_b")
        columns = {c: batch.column(c).to_pylist() for c in names}
        keep = []
        for na, nb, wa, wb in zip(*(columns[c] for c in names)):
            keep.append(any(x is not None and y is not None and estimated(x, y) >= FLOOR for x, y in ((na, nb), (wa, wb))))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _linked(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that the full sets confirm."""
    side = lambda df, x: df.select(*[F.col(c).alias(x if c == "_node" else f"{c}_{x}") for c in df.columns])
    regs = sketches.select("_node", "_n", "_narrow", "_wide")
    near = (pairs.distinct().join(side(regs, "a"), "a").join(side(regs, "b"), "b")
            .where((F.col("_n_a") * 100 >= F.col("_n_b") * THRESHOLD) & (F.col("_n_b") * 100 >= F.col("_n_a") * THRESHOLD))
            .mapInArrow(_plausible, "a bigint, b bigint"))
    both = near.join(side(sets, "a"), "a").join(side(sets, "b"), "b")
    shared = F.size(F.array_intersect("_set_a", "_set_b"))
    return both.where(shared * 100 >= (F.size("_set_a") + F.size("_set_b") - shared) * THRESHOLD).select("a", "b")


def _labelled(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("_root", F.col("_node"))
    return (members.join(roots.withColumnRenamed("node", "_node"), "_node", "left")
            .withColumn("_root", F.coalesce("root", "_node")).drop("root"))


def _unsettled(members: DataFrame) -> DataFrame:
    """Members (_band, _node, _root, _g: the group's size) of the groups that
    still hold two components, written.  Facts about groups are written before
    they are joined to members: two shuffled sides without an aggregate between
    can be split where a group is large."""
    groups = written(members.groupBy("_band").agg(F.min("_root").alias("lo"), F.max("_root").alias("hi"), F.count("*").alias("_g"))
                     .where("lo <> hi").select("_band", "_g"), "open-groups", narrow=True)
    return written(members.select("_band", "_node", "_root").join(groups, "_band"), "members", narrow=True)


def _hub_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of every group's pivot with its other members, members without
    pivots).  The pivot is the member that meets most others over all its
    groups: the text that copies were made from, where it is there."""
    score = members.groupBy("_node").agg(F.sum("_g").alias("_score"))
    pivots = written(members.join(score, "_node").groupBy("_band").agg(F.max(F.struct("_score", "_node", "_root")).alias("_p")),
                     "pivots", narrow=True)
    marked = members.join(pivots, "_band").where(F.col("_node") != F.col("_p._node"))
    pairs = marked.where(F.col("_root") != F.col("_p._root")).select(
        F.least("_p._node", "_node").alias("a"), F.greatest("_p._node", "_node").alias("b"))
    return pairs, marked.select("_band", "_node")


def _small_pairs(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of different components in groups of at most SMALL_GROUP members."""
    small = members.join(sizes.where(F.col("g") <= SMALL_GROUP).select("_band"), "_band", "left_semi")
    x, y = small.alias("x"), small.alias("y")
    return x.join(y, (F.col("x._band") == F.col("y._band")) & (F.col("x._node") < F.col("y._node"))
                  & (F.col("x._root") != F.col("y._root"))).select(F.col("x._node").alias("a"), F.col("y._node").alias("b"))


def _sized(members: DataFrame) -> DataFrame:
    """Written: (_band, g: members, _main: the largest component) of every group."""
    per_root = members.groupBy("_band", "_root").agg(F.count("*").alias("n"))
    return written(per_root.groupBy("_band").agg(F.sum("n").alias("g"), F.max(F.struct("n", "_root"))["_root"].alias("_main")),
                   "group-sizes", narrow=True)


def _by_rare_shingles(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Written: (_band: a shingle, _node): every set's rarest shingles that another of the sets holds, as many as
    two sets at the threshold must share one of."""
    rows = sets.join(nodes, "_node").select("_node", F.explode("_set").alias("_shingle"))
    often = written(rows.groupBy("_shingle").agg(F.count("*").alias("_df")), "shingle-counts")
    n = F.size("_s").cast("long")
    first = n - F.ceil(n * THRESHOLD / 100) + 1
    ranked = (rows.join(often, "_shingle").groupBy("_node").agg(F.array_sort(F.collect_list(F.struct("_df", "_shingle"))).alias("_s"))
              .select("_node", F.explode(F.slice("_s", F.lit(1), first.cast("int"))).alias("_x")))
    return written(ranked.where("_x._df > 1").select(F.col("_x._shingle").alias("_band"), "_node"), "rare-shingles")


def _block_links(members: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links inside larger groups: the members outside a group's largest
    component are held against all its members, block by block.  A block holds
    about BLOCK sets (or BLOCK_SHINGLES shingles); a pair of blocks gives at most one link
    for each queried member and component."""
    large = sizes.where(F.col("g") > SMALL_GROUP)
    rows = (members.join(large.select("_band", "_main"), "_band").join(sets, "_node")
            .withColumn("_n", F.size("_set").cast("long")))
    blocks = written(rows.groupBy("_band").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("_n") / BLOCK_SHINGLES)).cast("int").alias("_of")), "blocks", narrow=True)
    placed = rows.join(blocks, "_band").withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_of")).cast("int"))
    content = F.collect_list(F.struct("_node", "_root", "_set"))
    # dealt by block, not by group: a large group must not be gathered in one task
    placed = placed.repartition("_band", "_block")
    whole = placed.groupBy("_band", "_block").agg(content.alias("_members"))
    asked = (placed.where(F.col("_root") != F.col("_main")).groupBy("_band", "_block").agg(content.alias("_queries"), F.first("_of").alias("_of"))
             .drop("_block")
             .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_of") - 1))))
    return (asked.join(whole, ["_band", "_block"]).select("_queries", "_members")
            .mapInArrow(_compare_blocks, "a bigint, b bigint"))


def _unpacked(cell: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, roots, all set entries, which member each entry is of)."""
    rows = cell.values
    sets = rows.field("_set")
    size = np.diff(sets.offsets.to_numpy())
    return (rows.field("_node").to_numpy(), rows.field("_root").to_numpy(), sets.flatten().to_numpy(),
            np.repeat(np.arange(len(size)), size))


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found_a, found_b = [], []
        for asked, all_of in zip(batch.column("_queries"), batch.column("_members")):
            (qn, qr, qs, qi), (mn, mr, ms, mi) = _unpacked(asked), _unpacked(all_of)
            common, place = np.unique(np.concatenate([qs, ms]), return_inverse=True)
            both = np.zeros((len(qn), len(mn)), np.float32)
            qp, mp = place[:len(qs)], place[len(qs):]
            for lo in range(0, len(common), STRIP):  # strips keep the 0/1 tables small
                q, m = np.zeros((len(qn), STRIP), np.float32), np.zeros((len(mn), STRIP), np.float32)
                for table, p, i in ((q, qp, qi), (m, mp, mi)):
                    here = (p >= lo) & (p < lo + STRIP)
                    table[i[here], p[here] - lo] = 1
                both += q @ m.T
            nq, nm = np.bincount(qi, minlength=len(qn)), np.bincount(mi, minlength=len(mn))
            union = nq[:, None] + nm[None, :] - both
            ok = (both * 100 >= union * THRESHOLD) & (qr[:, None] != mr[None, :])
            for k in np.flatnonzero(ok.any(axis=1)):
                hit = np.flatnonzero(ok[k])
                hit = hit[np.unique(mr[hit], return_index=True)[1]]
                found_a.append(np.full(len(hit), qn[k]))
                found_b.append(mn[hit])
        none = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *found_a])), pa.array(np.concatenate([none, *found_b]))],
                                         names=["a", "b"])


def links(sketches: DataFrame, sets_of) -> DataFrame | None:
    """Links between classes that connect every two classes that any
    verified pair connects, and no others.  ``sets_of(nodes)`` gives full sets."""
    members = _unsettled(_labelled(sketches.select(F.explode("_bands").alias("_band"), "_node").distinct(), None))
    if members.isEmpty():
        return None
    sets = sets_of(members.select("_node").distinct())
    found = None
    for _ in range(PIVOT_ROUNDS):
        pairs, rest = _hub_pairs(members)
        more = written(_linked(pairs, sketches, sets), "links", narrow=True)
        roots = components(more if found is None else found.unionByName(more))
        found = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        members = _unsettled(_labelled(rest, roots))
        if members.isEmpty():
            return found
    sizes = _sized(members)
    found = found.unionByName(_linked(_small_pairs(members, sizes), sketches, sets))
    large = members.join(sizes.where(F.col("g") > SMALL_GROUP).select("_band"), "_band", "left_semi")
    members = _unsettled(_labelled(_by_rare_shingles(large.select("_node").distinct(), sets), roots))
    if members.isEmpty():
        return found
    sizes = _sized(members)
    return (found.unionByName(_linked(_small_pairs(members, sizes), sketches, sets))
            .unionByName(_block_links(members, sizes, sets)))


def _parted(sketched: DataFrame) -> DataFrame:
    """``sketched`` with a node of its own for every set.  Sets are one class if size and two 64-bit sums over
    their shingles agree; where only the first agrees, the others get new nodes."""
    same = sketched.where("_n > 0").select("_node", "_n", "_check").distinct()
    mixed = same.groupBy("_node").agg(F.count("*").alias("_of"), F.min(F.struct("_n", "_check")).alias("_stays")).where("_of > 1")
    moved = written(same.join(mixed, "_node").where(F.struct("_n", "_check") != F.col("_stays"))
                    .select("_node", "_n", "_check", F.xxhash64("_node", "_n", "_check").alias("_new")), "moved-nodes", narrow=True)
    if moved.isEmpty():
        return sketched
    return sketched.join(moved, ["_node", "_n", "_check"], "left").withColumn("_node", F.coalesce("_new", "_node")).drop("_new")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per distinct row: _id, _th, _n (set size), _root (the group; null for
    an empty set) and _component (the group's smallest _id)."""
    rows = identified(docs, id_col, text_col)
    sketched = _parted(written(rows.select("_id", "_th", "_text").mapInArrow(_sketches, SKETCH), "sketches"))
    first = (sketched.where("_n > 0").groupBy("_node").agg(F.min(F.struct("_id", "_th")).alias("_rep")))
    classes = written(first.select("_node", "_rep._id", "_rep._th"), "classes")
    sketches = written(sketched.join(classes, ["_node", *KEY], "left_semi").dropDuplicates(["_node"]), "class-sketches")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "_node", "left_semi")
        texts = rows.join(wanted, KEY).select("_node", "_text")
        return written(texts.mapInArrow(_set_rows, SETS).dropDuplicates(["_node"]), "shingle-sets")

    found = links(sketches.select("_node", "_n", "_bands", "_narrow", "_wide"), sets_of)
    if found is None:
        return _assigned(sketched, classes.select("_node", F.col("_node").alias("_root"), F.col("_id").alias("_component")))
    roots = components(found)
    labelled = _labelled(classes.select("_node", "_id"), roots)
    smallest = labelled.groupBy("_root").agg(F.min("_id").alias("_component"))
    return _assigned(sketched, labelled.join(smallest, "_root").select("_node", "_root", "_component"))


def _assigned(sketched: DataFrame, component: DataFrame) -> DataFrame:
    rows = sketched.select(*KEY, "_n", "_node").distinct()
    empty = rows.where("_n = 0").select(*KEY, "_n", F.lit(None).cast("long").alias("_root"), F.col("_id").alias("_component"))
    return rows.where("_n > 0").join(component, "_node").select(*KEY, "_n", "_root", "_component").unionByName(empty)


@own_columns
def with_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus _id, _th, _n, _root and _component."""
    return with_identity(docs, id_col, text_col).join(near_duplicates(docs, id_col, text_col), KEY)


@own_columns
def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group, the one of the smallest id; among rows of one id
    or without id, the one of the smallest text hash.  Texts without words are groups of their own."""
    groups = near_duplicates(docs, id_col, text_col)
    best = (groups.where("_n > 0").groupBy("_root").agg(F.min(F.struct("_id", "_th")).alias("_b"))
            .select("_b._id", "_b._th").unionByName(groups.where("_n = 0").select(*KEY)))
    return (with_identity(docs, id_col, text_col).join(best, KEY, "left_semi").dropDuplicates(KEY)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
