"""Skew-safe ordered scans within a key (lag, lead, running totals).

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so a
key that holds a third of the rows becomes a third of the job in one task.
Here the order column is cut into contiguous ranges ("chunks") at approximate
quantiles of the whole input, one per ``rows_per_chunk`` rows however many
that makes. Boundaries depend only on the value, so within a key chunk ``c``
holds rows strictly before chunk ``c + 1``. A scan then runs in two levels:

1. a window over ``(key, chunk)``: bounded by the rows of one quantile range;
2. a window over one summary row per ``(key, chunk)``, joined back to the rows
   on ``(key, chunk)``.

At most FIRST_LEVEL - 1 boundaries come back to the driver; beyond that many
ranges, each first-level range is cut again by quantiles of its own, which
stay in a table of one array per range. A row finds its range by binary
lifting over the array (``Chunks.assign``), in generated code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import cut_lineage

CHUNK = "_chunk"
DEFAULT_ROWS_PER_CHUNK = 1 << 16
#: Ranges whose boundaries fit one literal; more are made by a second level.
FIRST_LEVEL = 1024
#: Quantile accuracy, as a multiple of the number of ranges.
ACCURACY = 10


def numeric_order(df: DataFrame, col: str) -> Column:
    """A numeric image of ``col`` that preserves its order (timestamps as
    microseconds since 1970, zone-free)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(col))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(col))
    return F.col(col)


def _lift(df: DataFrame, value: Column, bounds: Column, most: int, out: str) -> DataFrame:
    """Add ``out`` = number of entries of the ascending array ``bounds`` (at most
    ``most``) that are <= ``value``: one comparison per power of two."""
    d = df.withColumn(out, F.lit(0))
    step = 1 << (most.bit_length() - 1) if most else 0
    while step >= 1:
        cand = F.col(out) + F.lit(step)
        reach = F.coalesce(value >= F.get(bounds, cand - 1), F.lit(False))
        d = d.withColumn(out, F.when(reach, cand).otherwise(F.col(out)))
        step //= 2
    return d


@dataclass
class Chunks:
    """Result of profiling an order column: row count, number of ranges, the
    first-level boundaries (ascending), the table of second-level boundaries
    if there are more, and, if asked for, the number of keys."""
    rows: int
    count: int
    col: str
    bounds: list[float] = field(default_factory=list)
    keys: int | None = None
    finer: DataFrame | None = None
    finer_count: int = 1

    def summary_rows(self) -> int:
        """Upper bound of the rows of a one-row-per-(key, range) summary."""
        if self.keys is None:
            return self.rows
        return min(self.rows, self.keys * self.count)

    def assign(self, df: DataFrame, out: str, col: str | None = None) -> DataFrame:
        """Add column ``out`` = the range of the row's order value (0 for NULL):
        a non-decreasing function of the order column, or of another column
        ``col`` of its type."""
        if self.count == 1 or not self.bounds:
            return df.withColumn(out, F.lit(0))
        # a column of its own, made once: every step of both searches compares it
        value = F.col("_order_value")
        d = df.withColumn("_order_value", numeric_order(df, col or self.col).cast("double"))
        bounds = F.expr("array(" + ",".join(repr(float(b)) for b in self.bounds) + ")")
        d = _lift(d, value, bounds, len(self.bounds), out)
        if self.finer is not None:
            # at most FIRST_LEVEL rows, one number per range
            d = d.withColumnRenamed(out, "_l1").join(F.broadcast(self.finer), "_l1", "left")
            d = _lift(d, value, F.col("_l2_bounds"), self.finer_count - 1, "_l2")
            d = d.withColumn(out, F.col("_l1") * F.lit(self.finer_count) + F.col("_l2")).drop(
                "_l1", "_l2", "_l2_bounds")
        return d.withColumn(out, F.when(value.isNull(), F.lit(0)).otherwise(F.col(out))).drop(
            "_order_value")


def _fractions(n: int) -> Column:
    # One array literal: building it element by element costs a round trip each.
    return F.expr("array(" + ",".join(repr(i / n) for i in range(1, n)) + ")")


def profile_order(df: DataFrame, col: str, rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                  key: str | None = None, keys_if_over: int = 0) -> Chunks:
    """Row count and range boundaries (approximate quantiles of ``col``) from
    one aggregate job over ``df``, and a second one beyond FIRST_LEVEL ranges.
    With ``key``, also the exact number of distinct keys, counted by a job of
    its own only when there are more than ``keys_if_over`` rows (below that
    the row count is the tighter bound)."""
    value = numeric_order(df, col).cast("double")
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.percentile_approx(value, _fractions(FIRST_LEVEL), ACCURACY * FIRST_LEVEL)
                 .alias("q")).first()
    n = row["n"] or 0
    keys = None
    if key is not None:
        if n > keys_if_over:
            keys = (df.agg(F.count_distinct(F.col(key))).first()[0] or 0) + 1  # + 1: NULL key
        else:
            keys = n
    chunks = max(1, math.ceil(n / max(1, rows_per_chunk)))
    if chunks == 1 or not row["q"]:
        return Chunks(n, 1, col, [], keys)
    first = min(chunks, FIRST_LEVEL)
    picked = [row["q"][int(round(FIRST_LEVEL / first * i)) - 1] for i in range(1, first)]
    found = Chunks(n, 1, col, sorted({b for b in picked if b is not None}), keys)
    found.count = len(found.bounds) + 1
    if chunks <= FIRST_LEVEL:
        return found
    finer = math.ceil(chunks / FIRST_LEVEL)
    if finer > 1:
        inside = found.assign(df, "_l1").groupBy("_l1").agg(F.array_sort(F.array_distinct(
            F.percentile_approx(value, _fractions(finer), ACCURACY * finer * 10)))
            .alias("_l2_bounds"))
        found.finer = cut_lineage(inside, "range_bounds")
        found.finer_count = finer
        found.count *= finer
    return found


def next_in_key(df: DataFrame, key: str, order: list[str], value: str, out: str,
                rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """``lead(value) OVER (PARTITION BY key ORDER BY order...)`` without
    sending a whole key to one task. ``order`` must be unique within a key;
    NULL is a key like any other."""
    # A NULL key becomes a flag and a stand-in, so that windows and join share
    # one partitioning by plain equality.
    stand_in = F.coalesce(F.col(key), F.lit("0").cast(df.schema[key].dataType))
    d = df.withColumns({"_k": stand_in, "_no_k": F.col(key).isNull()})
    d = profile_order(df, order[0], rows_per_chunk).assign(d, CHUNK)
    by = ["_k", "_no_k", CHUNK]
    w = Window.partitionBy(*by).orderBy(*order)
    firsts = (d.groupBy(*by)
               .agg(F.min(F.struct(*[F.col(c) for c in order], F.col(value).alias("_v")))
                    .getField("_v").alias("_first")))
    wc = Window.partitionBy("_k", "_no_k").orderBy(CHUNK)
    following = firsts.select(*by, F.lead("_first").over(wc).alias("_next_chunk_first"))
    d = (d.withColumn(out, F.lead(value).over(w))
          .withColumn("_is_last", F.lead(F.lit(True)).over(w).isNull()))
    return (d.join(following, by, "left")
            .withColumn(out, F.when(F.col("_is_last"), F.col("_next_chunk_first"))
                        .otherwise(F.col(out)))
            .drop(*by, "_is_last", "_next_chunk_first"))


def total_before(df: DataFrame, order_col: str, value: str, out: str,
                 rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the rows with a smaller ``order_col``
    (unique), without a global sort: sums within ranges, then over ranges."""
    d = profile_order(df, order_col, rows_per_chunk).assign(df, "_tbc")
    inside = (Window.partitionBy("_tbc").orderBy(order_col)
              .rowsBetween(Window.unboundedPreceding, -1))
    per_range = d.groupBy("_tbc").agg(F.sum(value).alias("_tbn"))
    before = Window.orderBy("_tbc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select("_tbc", F.coalesce(F.sum("_tbn").over(before), F.lit(0))
                               .alias("_tbo"))
    return (d.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
             .join(offsets, "_tbc")
             .withColumn(out, F.col(out) + F.col("_tbo")).drop("_tbc", "_tbo"))


def assign_surrogate_keys(df: DataFrame, order_col: str, start, out: str,
                          chunk: Chunks | None = None,
                          rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """``out = start + rank of order_col`` (1, 2, ... in ``order_col`` order,
    values unique) without a global sort.

    Rows are ranked inside their chunk; each chunk's offset is the number of
    rows in earlier chunks, one row per chunk. With a single chunk (at most
    ``rows_per_chunk`` rows) the rank is the key and there is no offset table.
    ``start`` may be a number or a column.
    """
    if chunk is None:
        chunk = profile_order(df, order_col, rows_per_chunk)
    start_col = start if isinstance(start, Column) else F.lit(start)
    if chunk.count == 1:
        rank = F.row_number().over(Window.orderBy(order_col))
        return df.withColumn(out, (start_col + rank).cast("long"))
    d = chunk.assign(df, "_skc")
    d = d.withColumn("_skrn", F.row_number().over(Window.partitionBy("_skc").orderBy(order_col)))
    counts = d.groupBy("_skc").agg(F.count(F.lit(1)).alias("_skn"))
    before = Window.orderBy("_skc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_skc", F.coalesce(F.sum("_skn").over(before), F.lit(0))
                            .alias("_skoff"))
    return (d.join(offsets, "_skc")
             .withColumn(out, (start_col + F.col("_skoff") + F.col("_skrn")).cast("long"))
             .drop("_skc", "_skrn", "_skoff"))
