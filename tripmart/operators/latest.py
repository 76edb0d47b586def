"""Best row per key (top-1) for the versioned master tables.

``row_number() ... = 1`` is planned by Spark as a WindowGroupLimit: a partial
top-1 per key runs in every map task before the shuffle, so at most one row
per key and map task crosses the network, however hot a key is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import ntz, status_rank


def top1_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key under ``order`` (filter ``rn = 1``)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def latest_rate(rate_master: DataFrame) -> DataFrame:
    """Latest name per rate code. ``version DESC`` puts NULL first, as the
    reference's database does; name breaks remaining ties."""
    best = top1_per_key(rate_master.select("ratecode_id", "ratecode_name", "version"),
                        "ratecode_id",
                        [F.col("version").desc_nulls_first(),
                         F.col("ratecode_name").asc_nulls_last()])
    return best.select("ratecode_id", "ratecode_name")


def in_effect(df: DataFrame, as_of) -> DataFrame:
    """rows valid at ``as_of`` in the half-open window [from, to);
    an open end is NULL, a NULL start never qualifies."""
    t = ntz(as_of)
    return df.filter((F.col("effective_from") <= t)
                     & (F.col("effective_to").isNull() | (t < F.col("effective_to"))))


def current_zones(zone_master: DataFrame, as_of) -> DataFrame:
    """The zone record of each location in effect at ``as_of``. An ACTIVE
    row (any case) wins; then the highest version, NULL first. The effective
    filter runs before ranking: ranking first would change the winner."""
    cols = ["location_id", "borough", "zone", "service_zone", "record_status", "version",
            "effective_from", "effective_to"]
    eff = in_effect(zone_master.select(*cols), as_of)
    best = top1_per_key(eff, "location_id",
                        [status_rank("record_status").asc(),
                         F.col("version").desc_nulls_first(),
                         F.col("borough").asc_nulls_last(),
                         F.col("zone").asc_nulls_last(),
                         F.col("service_zone").asc_nulls_last()])
    return best.select("location_id", "borough", "zone", "service_zone")


def seed_candidates(zone_master: DataFrame) -> DataFrame:
    """Best master row per location for the dimension seed (no effective
    filter). ACTIVE first, then version, updated_at, created_at, each DESC
    with NULLs last."""
    best = top1_per_key(zone_master, "location_id",
                        [status_rank("record_status").asc(),
                         F.col("version").desc_nulls_last(),
                         F.col("updated_at").desc_nulls_last(),
                         F.col("created_at").desc_nulls_last(),
                         F.col("borough").asc_nulls_last(),
                         F.col("zone").asc_nulls_last(),
                         F.col("service_zone").asc_nulls_last()])
    return best.select("location_id", "borough", "zone", "service_zone")
