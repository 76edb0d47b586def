"""Hard negatives by threshold joins over an inverted index, L2AP style.

Rows become integer vectors, floor(256 x). Dimensions are put in order of
their energy (sum of squares over all rows), so that the norm of what follows
a dimension falls fast. Rows lie in blocks; anchors travel to the blocks in
groups, by an equi-join on the part number. A join with thresholds finds, in
one block, all rows that an anchor scores at its threshold or above:

1. the inverted index leaves out, of every row, the trailing dimensions whose
   norm times the anchors' norm stays below the least threshold. A row with no
   indexed dimension can't be found;
2. lists are read in chunks of dimensions, partial scores add up; after each
   chunk a row stays only if partial score plus the product of the remaining
   norms reaches the threshold of some anchor;
3. what is left is scored in whole, in exact integers.

Lists are dense: rows are in order of their indexed dimensions, so a
dimension's list is the first rows of its column.

Thresholds start high and are lowered for the anchors whose windows aren't
full: first for positives (the first ``POSITIVES`` rows of the same label),
then for the window of scores that every positive opens for negatives. A
round finds *all* rows at or above its threshold, so a full window is final;
the last round reaches the window's lower end (for positives: everything).

Defined results: rows with a NULL vec_id, label or vector, or a NULL or
non-finite component, take no part; neither do rows whose squared norm is
beyond 2^62, so scores fit a long. Shorter vectors end in zeros. Rows that
share a vec_id are rows of their own (also as anchors). An anchor without
positives, and a positive without negatives, give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.blocks import pack, unpack
from tripmart.llm.shipping import ship_package
from tripmart.session import cut_lineage

POSITIVES, NEGATIVES = 5, 3
#: A negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
#: Thresholds of the rounds: for positives, shares of the largest possible
#: score; for negatives, percent of the positive's score.
POSITIVE_ROUNDS = (0.7, 0.45, 0.3, None)
NEGATIVE_ROUNDS = (90, 75, LOW)
BLOCK_ROWS, GROUP_ROWS, CHUNK = 2048, 512, 16
_EXACT = float(1 << 53)
_INDEX = "block long, payload binary"
FOUND = "anchor long, slot int, score long, vec_id long, row long"


def clean_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label") -> DataFrame:
    """(row, vec_id, label, v, squares) of the rows that take part; ``row``
    tells rows apart and is stable once the result is written."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 30)))
    out = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                      & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    out = out.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.col(label_col).cast("long").alias("label"),
                     F.transform(x, lambda c: F.floor(c * 256.0)).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return (out.withColumn("squares", squares).filter(F.col("squares") < float(1 << 62))
            .withColumn("row", F.monotonically_increasing_id()))


def _energy_order(rows: DataFrame) -> list[int]:
    """Dimensions by falling sum of squares (one row per dimension comes back)."""
    sums = rows.select(F.posexplode("v").alias("dim", "x")).groupBy("dim").agg(
        F.sum(F.col("x").cast("double") * F.col("x")).alias("energy")).collect()
    return [r.dim for r in sorted(sums, key=lambda r: (-r.energy, r.dim))]


class _Vectors:
    """A packed set of vectors, dimensions in the index order."""

    def __init__(self, payload):
        t = unpack(payload)
        for name in ("row", "vec_id", "label"):
            setattr(self, name, t.column(name).to_numpy())
        flat = t.column("v").combine_chunks().flatten().to_numpy()
        self.v = flat.reshape(t.num_rows, -1).astype(np.float64)
        rest = np.cumsum((self.v ** 2)[:, ::-1], axis=1)[:, ::-1]
        # norm of dimension d and all that follow, a little rounded up
        self.rest = np.sqrt(np.concatenate([rest, np.zeros((len(self.v), 1))], axis=1)) \
            * (1 + 1e-12)
        self.table = t


def _dense(vectors: pa.ListArray, order: list[int]) -> np.ndarray:
    """A matrix with its columns in the index order (one of zeros, if none)."""
    counts = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), max(1, len(order))), np.int64)
    row = np.repeat(np.arange(len(vectors)), counts)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)] = \
        vectors.flatten().to_numpy()
    return out[:, order] if order else out


def _packed(rows: DataFrame, order: list[int], size: int, *more: str) -> DataFrame:
    """Rows in packed sets of ``size``: (block, payload)."""

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            while rest.num_rows >= size:
                yield one(number, rest.slice(0, size))
                number, rest = number + 1, rest.slice(size)
        if rest is not None and rest.num_rows:
            yield one(number, rest)

    def one(number, t):
        columns = {c: t.column(c).combine_chunks() for c in t.column_names}
        dense = _dense(columns["v"], order)
        columns["v"] = pa.FixedSizeListArray.from_arrays(pa.array(dense.ravel()), dense.shape[1])
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([pack(**columns)])],
                                          ["block", "payload"])

    return rows.select("row", "vec_id", "label", "v", *more).mapInArrow(run, _INDEX)


def threshold_join(anchors: _Vectors, rows: _Vectors, floor: np.ndarray, mask: np.ndarray):
    """(anchor, row, score) with ``mask[anchor, row]`` and score at or above
    ``floor[anchor]`` (-inf: all)."""
    scale = np.maximum(anchors.rest[:, 0], 1e-300)
    least = float((floor / scale).min())  # a row must reach this norm to be found
    width = rows.v.shape[1]
    if least > 0:  # norms fall along a row: the indexed dimensions come first
        indexed = (rows.rest[:, :width] >= least).sum(axis=1)
    else:
        indexed = np.full(len(rows.v), width)
    order = np.argsort(-indexed, kind="stable")
    order = order[indexed[order] > 0] if least > 0 else order
    indexed, v, rest = indexed[order], rows.v[order], rows.rest[order]
    partial = np.zeros((len(anchors.v), len(order)))
    stay = mask[:, order].copy()
    small = rows.rest[:, 0].max(initial=0) * anchors.rest[:, 0].max(initial=0) < _EXACT
    for at in range(0, width, CHUNK):
        n = int(np.searchsorted(-indexed, -at))  # rows with a list that reaches this far
        n = int(np.flatnonzero(stay[:, :n].any(axis=0)).max(initial=-1)) + 1
        if not n:
            break
        to = min(at + CHUNK, width)
        partial[:, :n] += anchors.v[:, at:to] @ v[:n, at:to].T
        bound = partial[:, :n] + anchors.rest[:, to:to + 1] * rest[:n, to][None, :]
        slack = 1 + 1e-9 * np.abs(floor)[:, None] if small else \
            1 + 1e-9 * anchors.rest[:, :1] * rest[:n, 0][None, :]
        stay[:, :n] &= bound + slack >= floor[:, None]
    # rows whose lists end early: what isn't indexed adds less than the bound says
    a, r = np.nonzero(stay)
    r = order[r]
    score = _scores(anchors, rows, a, r, small)
    ok = score >= floor[a]
    return a[ok], r[ok], score[ok]


def _scores(anchors, rows, a, r, small) -> np.ndarray:
    """Exact inner products of pairs, a bounded number of them at a time."""
    out = np.empty(len(a), np.int64)
    kind = np.float64 if small else np.int64
    av, rv = anchors.v.astype(kind, copy=False), rows.v.astype(kind, copy=False)
    for k in range(0, len(a), 1 << 15):
        part = slice(k, k + (1 << 15))
        out[part] = np.einsum("ij,ij->i", av[a[part]], rv[r[part]])
    return out


def _first(n: int, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> np.ndarray:
    """Indices of the first n of each group, by falling score and rising vec_id."""
    order = np.lexsort((vec_id, -score, group))
    g = group[order]
    begin = np.flatnonzero(np.diff(g, prepend=-1)) if len(g) else np.zeros(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    return order[rank < n]


def _cells(index: DataFrame, groups: DataFrame, parts: int, work) -> DataFrame:
    """Run ``work(anchors, rows)`` on every pair of a group and a block. Blocks
    are dealt to parts; every part gets each group once."""
    blocks = index.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    sent = groups.select(F.col("payload").alias("anchors"),
                         F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def run(batches):
        seen = (None, None)
        for b in batches:
            for k in range(b.num_rows):
                block = b.column(0)[k].as_py()
                if seen[0] != block:
                    seen = (block, _Vectors(b.column(1)[k].as_buffer()))
                rows = seen[1]
                anchors = _Vectors(b.column(2)[k].as_buffer())
                a, slot, r, score = work(anchors, rows)
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors.row[a]), pa.array(slot.astype(np.int32)),
                         pa.array(score), pa.array(rows.vec_id[r]), pa.array(rows.row[r])],
                        [f.split()[0] for f in FOUND.split(", ")])

    return (blocks.join(sent.hint("merge"), "part").select("block", "payload", "anchors")
            .mapInArrow(run, FOUND))


def _positives(threshold: float | None, largest: float):
    def work(anchors, rows):
        same = anchors.label[:, None] == rows.label[None, :]
        same &= anchors.row[:, None] != rows.row[None, :]
        if not same.any():
            return (np.zeros(0, np.int64),) * 4
        floor = np.full(len(anchors.v), -np.inf)
        if threshold is not None:
            floor = threshold * largest * anchors.rest[:, 0]
        a, r, score = threshold_join(anchors, rows, floor, same)
        best = _first(POSITIVES, a, score, rows.vec_id[r])
        return a[best], np.zeros(len(best), np.int64), r[best], score[best]

    return work


def _negatives(percent: int):
    def work(anchors, rows):
        other = anchors.label[:, None] != rows.label[None, :]
        bars = anchors.table.column("scores").combine_chunks()
        counts = np.diff(bars.offsets.to_numpy())
        owner = np.repeat(np.arange(len(anchors.v)), counts)
        flat = bars.flatten()
        slot = flat.field("slot").to_numpy()
        bar = flat.field("score").to_numpy().astype(np.float64)
        floor = np.full(len(anchors.v), np.inf)
        np.minimum.at(floor, owner, np.ceil(bar * percent / 100) - 1)
        if not other.any() or not len(owner):
            return (np.zeros(0, np.int64),) * 4
        a, r, score = threshold_join(anchors, rows, floor, other)
        out = []
        exact = flat.field("score").to_numpy()
        begin = np.concatenate([[0], np.cumsum(counts)])
        for k in range(int(counts.max(initial=0))):  # the windows of one rank together
            has = counts[a] > k
            w = begin[a[has]] + k
            s = score[has]
            low, high = _ends(exact[w], percent)
            fits = (s >= low) & (s <= high)
            i = np.flatnonzero(has)[fits]
            best = i[_first(NEGATIVES, w[fits], score[i], rows.vec_id[r[i]])]
            out.append((a[best], slot[begin[a[best]] + k], r[best], score[best]))
        return tuple(np.concatenate(c) for c in zip(*out))

    return work


def _ends(bar: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest score of a window: whole numbers s with
    percent * bar <= 100 * s <= HIGH * bar."""
    hundreds, ones = bar // 100, bar % 100  # keeps products within 64 bits
    return (percent * hundreds + (percent * ones + 99) // 100,
            HIGH * hundreds + HIGH * ones // 100)


def _ranked(found: DataFrame, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order))


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of the rows for which ``is_anchor`` (over vec_id) holds."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = cut_lineage(clean_vectors(rows, id_col, vector_col, label_col), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.max("squares").alias("most")).first()
    order = _energy_order(rows)
    largest = float(np.sqrt(facts.most or 0.0)) * (1 + 1e-12)
    parts = max(1, -(-facts.n // (2 * BLOCK_ROWS)))
    index = cut_lineage(_packed(rows, order, BLOCK_ROWS), "vector_index")
    anchors = cut_lineage(rows.filter(is_anchor), "anchors")
    of_label = rows.groupBy("label").agg(F.count("*").alias("of_label"))
    open_ = cut_lineage(anchors.join(of_label, "label").select(
        "row", "vec_id", "label", "v",
        F.least(F.lit(POSITIVES), F.col("of_label") - 1).alias("needs"))
        .filter("needs > 0"), "open_anchors")
    done = []
    for threshold in POSITIVE_ROUNDS:  # lowered until the windows of all anchors are full
        if open_.isEmpty():
            break
        found = _cells(index, _packed(open_, order, GROUP_ROWS), parts,
                       _positives(threshold, largest))
        best = _ranked(found, "anchor").filter(F.col("rank") <= POSITIVES)
        best = best.join(open_.select(F.col("row").alias("anchor"), "needs"), "anchor")
        best = cut_lineage(best.withColumn("got", F.count("*").over(
            Window.partitionBy("anchor"))).filter("got >= needs").select(
            "anchor", F.col("rank").alias("slot"), "score", "vec_id"), "positives")
        done.append(best)
        open_ = cut_lineage(open_.join(best.select("anchor").distinct(),
                                       F.col("row") == F.col("anchor"), "left_anti"),
                            "open_anchors")
    if not done:
        done = [spark.createDataFrame([], "anchor long, slot int, score long, vec_id long")]
    positives = done[0]
    for more in done[1:]:
        positives = positives.union(more)
    # a window without a whole number in it stays empty: 0 or below, or too narrow
    windows = cut_lineage(positives.filter("score >= 0"), "windows")
    results = []
    for percent in NEGATIVE_ROUNDS:
        if windows.isEmpty():
            break
        waiting = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(
            F.struct("slot", "score"))).alias("scores"))  # at most POSITIVES
        group = anchors.join(waiting, F.col("row") == F.col("anchor"))
        found = _cells(index, _packed(group, order, GROUP_ROWS, "scores"), parts,
                       _negatives(percent))
        best = _ranked(found, "anchor", "slot").filter(F.col("rank") <= NEGATIVES)
        best = best.withColumn("got", F.count("*").over(Window.partitionBy("anchor", "slot")))
        if percent > LOW:
            best = best.filter(F.col("got") >= NEGATIVES)
        best = cut_lineage(best.select("anchor", "slot", "rank", "score", "vec_id"), "negatives")
        results.append(best)
        windows = cut_lineage(windows.join(best.select("anchor", "slot").distinct(),
                                           ["anchor", "slot"], "left_anti"), "windows")
    if not results:
        results = [spark.createDataFrame(
            [], "anchor long, slot int, rank int, score long, vec_id long")]
    negatives = results[0]
    for more in results[1:]:
        negatives = negatives.union(more)
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (negatives.select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"),
                             F.col("score").alias("negative_score"))
            .join(positives.select("anchor", "slot", F.col("vec_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["anchor", "slot"])
            .join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))


def noisy_label(vec_id: Column, label: Column) -> Column:
    """The label, moved on by one (of ten) where the id is divisible by 7."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
