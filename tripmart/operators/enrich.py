"""Enrich trips from the deduplicated masters (left joins).

A master side is broadcast only after its rows and bytes, observed while it is
written, are checked against bounds. Above the bound the join is a hybrid: keys
with more than ``HOT_SHARE`` of the trips get their (at most 1 / HOT_SHARE)
master rows by broadcast, the other trips meet the master in a shuffle join;
trips that need no master row there (hot keys, NULL keys) are spread over its
partitions by a key of their own. Each master has one row per key, so no join
fans out: trips in = trips out.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import cut_observed

# Largest side that is broadcast: rows, and bytes of its text columns.
DEFAULT_BROADCAST_MAX_ROWS = 250_000
DEFAULT_BROADCAST_MAX_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and ``max_bytes`` of text.
    Reads at most ``max_rows + 1`` rows, so the check stays cheap on a big
    input."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = F.lit(0)
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(size.cast("long")).alias("size")).first()
    return row["n"] <= max_rows and (row["size"] or 0) <= max_bytes


#: Share of the trips from which on a key is hot, and the values that trips
#: without a match in the shuffle join are spread over.
HOT_SHARE = 0.005
SPREAD = 1 << 14


def size_columns(df: DataFrame) -> list[Column]:
    """Rows and bytes of text, to be observed while ``df`` is written."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")]


def written_once(df: DataFrame, name: str, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                 max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> tuple[DataFrame, bool]:
    """A written copy of ``df`` and whether it is small enough to broadcast."""
    copy, seen = cut_observed(df, name, size_columns(df))
    return copy, seen["rows"] <= max_rows and (seen["bytes"] or 0) <= max_bytes


def hot_keys(trips: DataFrame, columns: list[str], share: float = HOT_SHARE) -> dict[str, list]:
    """Per key column, the values that more than ``share`` of the trips have: one
    pass over these columns, and at most 1 / share values of each come back."""
    if not columns:
        return {}
    keys = trips.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("long").alias("key")) for c in columns])))
    counts = keys.groupBy("col", "key").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("col"))  # one row per key value
    hot = counts.withColumn("total", total).filter(
        F.col("key").isNotNull() & (F.col("n") > F.col("total") * share)).collect()
    return {c: sorted(r.key for r in hot if r.col == c) for c in columns}


def hybrid_join(trips: DataFrame, key: str, master: DataFrame, master_key: str,
                names: dict[str, str], hot: list) -> DataFrame:
    """Left join of trips to a large master by a 32-bit id; ``names``: master
    column -> new column. ``hot``: keys whose master rows are broadcast."""
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    some = master.filter(F.col(master_key).isin(hot) if hot else F.lit(False)).select(
        F.col(master_key).alias("_hot_key"), F.lit(True).alias("_hot_hit"),
        *[F.col(m).alias(f"_hot_{m}") for m in names])
    rest = master.select(F.col(master_key).cast("long").alias("_cold_key"),
                         *[F.col(m).alias(f"_cold_{m}") for m in names])
    out = trips.join(F.broadcast(some), F.col(key) == F.col("_hot_key"), "left")  # <= 1 / HOT_SHARE
    away = is_hot | F.col(key).isNull()
    # numbers below any 32-bit id, so that they match no master row
    nowhere = F.lit(-(1 << 40)) - F.pmod(F.xxhash64(*trips.columns), F.lit(SPREAD))
    out = out.withColumn("_key", F.when(away, nowhere).otherwise(F.col(key).cast("long")))
    out = out.join(rest.hint("merge"), F.col("_key") == F.col("_cold_key"), "left")
    return out.select(*[F.col(c) for c in trips.columns], *[
        F.when(F.col("_hot_hit"), F.col(f"_hot_{m}")).otherwise(F.col(f"_cold_{m}")).alias(new)
        for m, new in names.items()])


def enrich_trips(clean: DataFrame, rates: DataFrame, zones: DataFrame,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Add ratecode_name and pickup/dropoff borough, zone, service zone.

    ``rates``: (ratecode_id, ratecode_name), one row per code.
    ``zones``: (location_id, borough, zone, service_zone), one row per location.
    The zone side is used twice; Spark reuses its broadcast.
    """
    # The deduplicated masters are made once: measured while they are written,
    # and joined from the written copy.
    with ThreadPoolExecutor(2) as pool:  # side by side: each is a few short jobs
        made = [pool.submit(copy_context().run, written_once, df, name, max_broadcast_rows)
                for df, name in ((rates, "rates"), (zones, "zones"))]
    (rates, small_rates), (zones, small_zones) = (m.result() for m in made)
    sides = [("ratecode_id", rates, small_rates, "ratecode_id",
              {"ratecode_name": "ratecode_name"})]
    sides += [(f"{end}_location_id", zones, small_zones, "location_id",
               {c: f"{end}_{c}" for c in ("borough", "zone", "service_zone")})
              for end in ("pu", "do")]
    hot = hot_keys(clean, [key for key, _, small, _, _ in sides if not small])
    out = clean
    for key, master, small, master_key, names in sides:
        if small:
            # the same plan for both ends of a trip, renamed after the join, so
            # that both joins share one broadcast (ReusedExchange)
            side = F.broadcast(master).alias("m")
            out = out.alias("t").join(side, F.col(f"t.{key}") == F.col(f"m.{master_key}"),
                                      "left").select(
                "t.*", *[F.col(f"m.{m}").alias(new) for m, new in names.items()])
        else:
            out = hybrid_join(out, key, master, master_key, names, hot[key])
    return out
