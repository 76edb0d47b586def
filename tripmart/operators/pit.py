"""Point-in-time join of facts to the versioned zone dimension.

A fact row matches every version of its location whose half-open window
[effective_from, effective_to) contains the fact time; an open end is NULL. A
fact without a match (before the first version, in a gap, or without location
or time) stays once, with NULLs. Windows of a location that overlap (rule C7
of ``dim_checks``) give a fact as many rows as versions were in effect.

Both plans compute exactly that. Within the checked bound the dimension is
broadcast and the join is an equi-join on the location with the window as a
residual condition. Beyond it, time is cut into ranges: a version goes to each
range that its window meets and in which its location has facts, and the join
is on (location, range), so neither a hot location nor a long history meets in
one task.

A cell is a range in which a location has facts. The cells of a location are
numbered in time order, and a version finds the numbers that its window spans by
two equi-joins, so a version and a cell that have nothing to do with each other
never meet: a version takes as many rows as it has cells to go to, and all but
the first and the last of these match every fact there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.enrich import DEFAULT_BROADCAST_MAX_ROWS, fits_broadcast
from tripmart.operators.sequence import CHUNK, DEFAULT_ROWS_PER_CHUNK, profile_order
from tripmart.session import cut_lineage

#: Ranges that one task numbers, and cells that one row lists, at a time.
BLOCK = 1 << 12

VERSION_COLUMNS = ["zone_dim_sk", "version_number", "borough", "zone", "service_zone"]


def zone_as_of(facts: DataFrame, dim: DataFrame, key: str, at: str, prefix: str = "",
               max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               strategy: str = "auto",
               rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Add the dimension versions in effect at ``facts[at]`` for ``facts[key]``.

    Output columns are the fact columns plus ``prefix`` + zone_dim_sk,
    version_number, borough, zone, service_zone.

    ``strategy``: "broadcast" (hash join, dimension on every executor),
    "ranges" (join by location and time range), or "auto": broadcast when the
    dimension is within ``max_broadcast_rows``, else ranges. The answer is the
    same.
    """
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(dim, max_broadcast_rows) else "ranges"
    versions = dim.select(F.col("location_id").alias("_pit_key"),
                          F.col("effective_from").alias("_pit_from"),
                          F.col("effective_to").alias("_pit_to"),
                          *[F.col(c).alias(prefix + c) for c in VERSION_COLUMNS])
    t = F.col(at)
    in_effect = ((F.col("_pit_from") <= t)
                 & (F.col("_pit_to").isNull() | (t < F.col("_pit_to"))))
    extra = ["_pit_key", "_pit_from", "_pit_to"]
    if strategy == "broadcast":
        cond = (F.col(key) == F.col("_pit_key")) & in_effect
        return facts.join(F.broadcast(versions), cond, "left").drop(*extra)

    chunks = profile_order(facts, at, rows_per_chunk)
    dated = F.col(key).isNotNull() & t.isNotNull()
    ranged = chunks.assign(facts.filter(dated), CHUNK)
    # one row per location and range that has facts, with their first and last time
    cells = cut_lineage(ranged.groupBy(F.col(key).alias("_pit_key"), F.col(CHUNK).alias("_at"))
                        .agg(F.min(at).alias("_first"), F.max(at).alias("_last")), "pit_cells")
    spans = versions.filter(F.col("_pit_from").isNotNull()
                            & (F.col("_pit_to").isNull() | (F.col("_pit_from") < F.col("_pit_to"))))
    # written after each search: the ranges are read three times below, and two
    # searches in one stage take many times as long as two stages
    spans = cut_lineage(chunks.assign(spans, "_pit_low", "_pit_from"), "pit_lows")
    spans = chunks.assign(spans, "_pit_high", "_pit_to").withColumn(
        "_pit_high", F.when(F.col("_pit_to").isNotNull(), F.col("_pit_high"))
        .otherwise(F.lit(chunks.count - 1)))
    spans = cut_lineage(spans, "pit_spans")
    clipped = _cells_in_reach(spans, cells).withColumnRenamed("_at", "_pit_chunk")
    cond = ((F.col(key) == F.col("_pit_key")) & (F.col(CHUNK) == F.col("_pit_chunk")) & in_effect)
    matched = ranged.join(clipped, cond, "left").drop(*extra, "_pit_chunk", CHUNK)
    # without a location or a time there is nothing to look for
    rest = facts.filter(~dated)
    return matched.unionByName(rest, allowMissingColumns=True)


def _cells_in_reach(spans: DataFrame, cells: DataFrame) -> DataFrame:
    """``spans`` (_pit_key, _pit_low, _pit_high: ranges; _pit_from, _pit_to: times),
    a row per cell that the span meets, with the cell's range ``_at``."""
    ends = spans.select("_pit_key", F.explode(F.array("_pit_low", "_pit_high")).alias("_at"))
    places = (cells.select("_pit_key", "_at", F.lit(1).alias("_cell"))
              .unionByName(ends.select("_pit_key", "_at", F.lit(0).alias("_cell")))
              .groupBy("_pit_key", "_at").agg(F.max("_cell").alias("_cell"))
              .withColumn("_block", F.floor(F.col("_at") / F.lit(BLOCK)).cast("int")))
    # cells of the location up to a place: within a block of ranges, then over
    # one row per block
    inside = Window.partitionBy("_pit_key", "_block").orderBy("_at")
    over = Window.partitionBy("_pit_key").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    per_block = places.groupBy("_pit_key", "_block").agg(F.sum("_cell").alias("_n")).select(
        "_pit_key", "_block", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_before"))
    places = (places.withColumn("_upto", F.sum("_cell").over(inside))
              .join(per_block, ["_pit_key", "_block"])
              .withColumn("_upto", F.col("_upto") + F.col("_before")))
    places = cut_lineage(places.select("_pit_key", "_at", "_cell", "_upto"), "pit_places")

    # the numbers 1, 2, ... of the cells from a span's first range to its last
    low = places.select("_pit_key", F.col("_at").alias("_pit_low"),
                        (F.col("_upto") - F.col("_cell") + 1).alias("_from_n"))
    high = places.select("_pit_key", F.col("_at").alias("_pit_high"), F.col("_upto").alias("_to_n"))
    found = (spans.join(low, ["_pit_key", "_pit_low"]).join(high, ["_pit_key", "_pit_high"])
             .filter(F.col("_from_n") <= F.col("_to_n")).drop("_pit_low", "_pit_high"))
    # by blocks first, so that no row holds a long list
    found = found.withColumn("_part", F.explode(F.sequence(
        F.floor(F.col("_from_n") / F.lit(BLOCK)), F.floor(F.col("_to_n") / F.lit(BLOCK)))))
    found = found.withColumn("_number", F.explode(F.sequence(
        F.greatest("_from_n", F.col("_part") * BLOCK),
        F.least("_to_n", F.col("_part") * BLOCK + F.lit(BLOCK - 1)))))
    numbered = (places.filter(F.col("_cell") == 1).join(cells, ["_pit_key", "_at"])
                .select("_pit_key", "_at", "_first", "_last", F.col("_upto").alias("_number")))
    # a span that starts after the cell's last fact, or ends before its first, has none there
    return (found.join(numbered, ["_pit_key", "_number"])
            .filter((F.col("_pit_from") <= F.col("_last"))
                    & (F.col("_pit_to").isNull() | (F.col("_pit_to") > F.col("_first"))))
            .drop("_from_n", "_to_n", "_part", "_number", "_first", "_last"))
