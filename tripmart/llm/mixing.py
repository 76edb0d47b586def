"""Mixing sources to target weights along a time-varying curriculum.

Each source has a mean weight and a schedule (piecewise linear over training
time 0..1). Means fix the targets (water-filling: no target above
``max_passes`` times its source); schedules fix when a source is read. A
source's documents, in a pseudo-random order by MD5 of doc_id, lie end to end
on its demand axis, pass after pass, until the target is met; the integral of
the schedule, inverted, turns an offset on that axis into a training
position, and the stream is range-sorted by position.

Prefix sums are two-level: the documents are cut into ranges along (source,
order), and an offset is what the source has in earlier ranges plus what comes
before in the same one. So neither a source nor a doc_id with a third of all rows
is one window; rows equal in id, source and text are one row there, with their
number. Everything is plain Spark SQL.

Defined results: a NULL text has size 0; sizes of 0 take nothing and have a
NULL position; sources are ordered by code point with NULL last and NULL is a
source; rows that share a doc_id are separate rows.
"""

from __future__ import annotations

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.shipping import ship_package
from tripmart.session import cut_lineage, cut_observed

WORD = r"[^\x20\x09-\x0D]+"
#: Mean weights, dealt to the sources in order, again and again.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_PASSES = 2
#: Weight over training time, one per entry of WEIGHTS: (time, relative weight).
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
)
#: Documents of an ordered range of the axes.
ROWS_PER_RANGE = 250_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(cells: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """Per source: rank, weight, source_size and target, by water-filling.

    Works on one row per source. Sources sorted by size over weight fill up
    first; the level is the budget that full sources leave over the weights
    of the others. The ordered windows see one row per source.
    """
    per = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    slot = (F.row_number().over(in_order) - 1) % len(weights)
    per = per.withColumn("slot", slot.cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("slot") + 1)
    per = per.withColumns({"weight": weight,
                           "cap": F.col("source_size") * F.lit(float(max_passes))})
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    per = per.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    per = per.withColumns({
        "caps_before": F.coalesce(F.sum("cap").over(
            by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "weights_from": F.sum("weight").over(
            by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    per = per.withColumn("full", F.col("cap") * F.col("weights_from")
                         <= (F.col("budget") - F.col("caps_before")) * F.col("weight"))
    left = (F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap")))
                                         .over(everything), F.lit(0.0)))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return per.withColumn("level", F.try_divide(left, open_weight)).select(
        "source", "slot", "weight", "source_size",
        F.when(F.col("full"), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
         .alias("target"))


def _invert(slot: Column, share: Column, schedules) -> Column:
    """Training time by which a source has met ``share`` (0..1) of its demand:
    the inverse of the integral of its schedule, segment by segment."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
        y, done, inverse = share * F.lit(total), 0.0, F.lit(float(knots[-1][0]))
        pieces = []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            rest = F.greatest(y - F.lit(done), F.lit(0.0))
            slope = (w1 - w0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            step = F.coalesce(F.try_divide(rest * 2, F.lit(w0) + root), F.lit(0.0))
            done += (t1 - t0) * (w0 + w1) / 2
            pieces.append((done, F.lit(t0) + step))
        for end, at in reversed(pieces):
            inverse = F.when(y <= F.lit(end), at).otherwise(inverse)
        out = F.when(slot == k, inverse).otherwise(out)
    return out


def mixing_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE,
                max_passes: int = MAX_PASSES, schedules=SCHEDULES) -> DataFrame:
    """One row per document: size, source_size, target, offset on the source's
    axis, words taken in each pass (``takes``), their positions, and taken."""
    spark = docs.sparkSession
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), key.alias("order_key"),
        _row_key()[0].alias("mix_key"))
    order = ["source", "order_key", "doc_id", "size", "mix_key"]
    rows, seen = cut_observed(rows.groupBy(*order).agg(F.count(F.lit(1)).alias("times")),
                              "mix_sizes", [F.count(F.lit(1)).alias("n")])
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-seen["n"] // ROWS_PER_RANGE))
    rows = cut_lineage(rows.repartitionByRange(ranges, *order)
                       .withColumn("range", F.spark_partition_id()), "mix_ranges")
    cells = rows.groupBy("source", "range").agg(
        F.sum(F.col("size") * F.col("times")).alias("cell_size"))
    targets = source_targets(cells, weights, share, max_passes)
    # a row per source and range that it has rows in
    earlier = (Window.unboundedPreceding, -1)
    along = Window.partitionBy("source").orderBy("range").rowsBetween(*earlier)
    starts = cells.withColumn("cell_start", F.coalesce(F.sum("cell_size").over(along), F.lit(0)))
    starts = (starts.alias("a").join(targets.alias("b"),
                                     F.col("a.source").eqNullSafe(F.col("b.source")))
              .select(F.coalesce("a.source", F.lit("")).alias("source_key"),
                      F.col("a.source").isNull().alias("no_source"), "a.range", "a.cell_start",
                      "b.slot", "b.source_size", "b.target"))
    starts = cut_lineage(starts, "mix_cells")
    rows = rows.withColumns({"source_key": F.coalesce("source", F.lit("")),
                             "no_source": F.col("source").isNull()})
    rows = rows.join(starts, ["source_key", "no_source", "range"])
    within = (Window.partitionBy("source_key", "no_source", "range")
              .orderBy(*order[1:]).rowsBetween(*earlier))
    before = F.coalesce(F.sum(F.col("size") * F.col("times")).over(within), F.lit(0))
    rows = rows.withColumn("before", F.col("cell_start") + before)
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))  # equal rows in a row
    rows = rows.withColumn("nth", nth).withColumn(
        "offset", F.col("before") + F.col("size") * F.col("nth"))
    whole = F.floor("target").cast("long")
    zero = F.lit(0).cast("long")
    starts_at = [F.col("offset") + F.col("source_size") * p for p in range(max_passes)]
    takes = [F.greatest(zero, F.least(F.col("size"), whole - at)) for at in starts_at]
    places = [F.when(take > 0, _invert(F.col("slot"), at / F.col("target"), schedules))
              for at, take in zip(starts_at, takes)]
    return rows.select("doc_id", "source", "size", "source_size", "target", "offset",
                       F.array(*takes).alias("takes"), F.array(*places).alias("positions"),
                       sum(takes[1:], takes[0]).alias("taken"), "mix_key")


def training_order(plan: DataFrame) -> DataFrame:
    """The plan range-sorted by the position at which a document is first read;
    documents that are not taken come last."""
    first = F.coalesce(F.element_at("positions", 1), F.lit(2.0))
    return (plan.withColumn("position", F.element_at("positions", 1))
            .repartitionByRange(first, F.col("doc_id")).sortWithinPartitions(first, "doc_id"))


def _row_key(prefix: str = "") -> tuple[Column, Column]:
    """(hash of id, source and text; number among rows equal in all three):
    tells rows apart where a doc_id is repeated or NULL."""
    key = F.xxhash64(f"{prefix}doc_id", f"{prefix}source", f"{prefix}text")
    return key, F.row_number().over(Window.partitionBy("mix_key").orderBy("mix_key"))


def _squeeze(texts: pd.Series) -> pd.Series:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return texts.map(lambda t: None if t is None else squeeze(t.encode("utf-8", "surrogatepass")))


def _expand(packed: pd.Series) -> pd.Series:
    expand = zstandard.ZstdDecompressor().decompress
    return packed.map(lambda p: None if p is None else expand(p).decode("utf-8", "surrogatepass"))


def mixed_stream(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents as the mix reads them: a row per pass, in training order,
    with the columns of ``docs``. A pass that the target cuts off holds the
    words it takes, joined by one space. ``plan`` must come from ``docs``. Texts
    are moved twice, to their passes and to their position, in compressed form."""
    ship_package(docs.sparkSession)
    passes = (plan.filter(F.col("taken") > 0)
              .withColumn("mix_row", _row_key()[1])
              .select("mix_key", "mix_row", "size",
                      F.explode(F.arrays_zip("takes", "positions")).alias("pass"))
              .filter(F.col("pass")["takes"] > 0))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = rows.withColumn("mix_key", _row_key("doc.")[0])
    rows = rows.select("mix_key", F.pandas_udf(_squeeze, "binary")(F.col("doc.text")).alias("packed"),
                       F.col("doc").withField("text", F.lit(None).cast("string")).alias("doc"))
    rows = rows.withColumn("mix_row", _row_key()[1])
    out = rows.join(passes, ["mix_key", "mix_row"])
    at = F.col("pass")["positions"]
    out = out.repartitionByRange(at, F.col("mix_key")).sortWithinPartitions(at, "mix_key")
    out = out.withColumn("text", F.pandas_udf(_expand, "string")(F.col("packed")))
    part = F.col("pass")["takes"] < F.col("size")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)),
                               F.lit(1), F.col("pass")["takes"].cast("int")), " ")
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.when(part, cut).otherwise(F.col("text")).alias(c))
        elif c == "n_chars":
            cols.append(F.when(part, F.char_length(cut)).otherwise(F.col("doc.n_chars")).alias(c))
        else:
            cols.append(F.col(f"doc.`{c}`").alias(c))
    return out.select(*cols)
