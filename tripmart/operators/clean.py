"""Standard names, integer casts, trip duration, negative distances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import duration_seconds, null_if_negative, to_int

# --- fixed values: staging columns the fact reads (20 of 27); the six pu_/do_ names of staging
# are deliberately not read: enrichment comes from the masters only.
SOURCE_COLUMNS = [
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    "total_amount",
]


def clean_trips(staging: DataFrame, null_negative_distance: bool = True) -> DataFrame:
    """Standardised trips, one row per staging row, no filtering.

    ``null_negative_distance=False`` keeps raw distances; only used to show
    that the data tests can fail on unfiltered input.
    """
    s = staging.select(*SOURCE_COLUMNS)
    distance = null_if_negative("trip_distance") if null_negative_distance else F.col("trip_distance")
    return s.select(
        to_int("vendorid").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").alias("dropoff_ts"),
        duration_seconds("tpep_pickup_datetime", "tpep_dropoff_datetime")
        .alias("trip_duration_seconds"),
        F.col("passenger_count"),
        distance.alias("trip_distance"),
        to_int("ratecodeid").alias("ratecode_id"),
        "store_and_fwd_flag",
        to_int("pulocationid").alias("pu_location_id"),
        to_int("dolocationid").alias("do_location_id"),
        "payment_type",
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee",
        "cbd_congestion_fee", "total_amount",
    )


def valid_trips(df: DataFrame) -> DataFrame:
    """both times present, dropoff not before pickup, total present,
    distance NULL or non-negative. Zero and negative totals stay."""
    return df.filter(F.col("pickup_ts").isNotNull()
                     & F.col("dropoff_ts").isNotNull()
                     & (F.col("dropoff_ts") >= F.col("pickup_ts"))
                     & F.col("total_amount").isNotNull()
                     & (F.col("trip_distance").isNull() | (F.col("trip_distance") >= 0)))
