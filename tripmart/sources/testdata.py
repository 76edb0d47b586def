"""Inputs of the reference's shapes, derived by Spark from the driver tables.

The driver's tables hold no taxi trips, so each input of the reference is a
view over them (documented in FIXTURES.md section 3). Every view is a lazy
DataFrame over the whole parquet tables: its work grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import ntz

# --- fixed values: fixture clock ----------------------------------------------
AS_OF = dt.datetime(2024, 6, 1, 0, 0, 0)
CHANGES_START = dt.datetime(2024, 7, 1, 0, 0, 0)
FAR_FUTURE_FROM = dt.datetime(2099, 1, 1)
DEFAULT_FROM = dt.datetime(2020, 1, 1)
EXPIRED_TO = dt.datetime(2023, 1, 1)
MASTER_CREATED_AT = dt.datetime(2019, 1, 1)
MASTER_UPDATED_BASE = dt.datetime(2021, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(value: dt.datetime) -> Column:
    return ntz(value)


def _null_if(cond: Column, value: Column) -> Column:
    """``CASE WHEN cond THEN NULL ELSE value END`` (a NULL condition keeps the value)."""
    return F.when(cond, F.lit(None)).otherwise(value)


def _add_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def curated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated trips in canonical names: lineitem joined to its order."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    null_d = F.lit(None).cast("double")
    stale = F.lit("STALE")
    return j.select(
        F.col("l_suppkey").cast("int").alias("vendorid"),
        _null_if((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("l_linenumber") == 7),
                 F.col("o_orderdate")).alias("tpep_pickup_datetime"),
        _null_if((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 6),
                 F.col("l_shipdate")).alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("long").alias("passenger_count"),
        _null_if(F.col("l_quantity") == 50, F.col("l_quantity") - 3).alias("trip_distance"),
        (F.col("l_quantity").cast("long") + 3).alias("ratecodeid"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        (F.col("l_suppkey") % 27).cast("int").alias("pulocationid"),
        (F.col("l_partkey") % 26).cast("int").alias("dolocationid"),
        (F.col("l_partkey") % 6).cast("long").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        null_d.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        _null_if(F.col("l_quantity") == 25, F.col("o_totalprice")).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        null_d.alias("airport_fee"),
        F.lit(0.0).alias("cbd_congestion_fee"),
        stale.alias("pu_borough"), stale.alias("pu_zone"), stale.alias("pu_servicezone"),
        stale.alias("do_borough"), stale.alias("do_zone"), stale.alias("do_servicezone"),
    )


def raw_curated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips under the raw source names, plus one extra column,
    as a crawler would deliver them (input of the column normaliser)."""
    from tripmart.schemas import RAW_TO_CANONICAL

    back = {v: k for k, v in RAW_TO_CANONICAL.items()}
    trips = curated_trips(spark, sf_dir)
    cols = [F.col(c).alias(back.get(c, c)) for c in trips.columns]
    return trips.select(*cols, F.lit("x").alias("source_file_tag"))


def rate_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_size").cast("int").alias("ratecode_id"),
        F.concat("p_name", F.lit("/"), "p_brand", F.lit("/"), "p_type").alias("ratecode_name"),
        _null_if(F.col("p_partkey") == 1, F.col("p_partkey").cast("int")).alias("version"),
    )


def zone_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("s_suppkey")
    status = (F.when(k % 3 == 0, F.lit("RETIRED"))
              .when(k % 3 == 1, F.lit("active"))
              .otherwise(F.lit("ACTIVE")))
    return j.select(
        F.col("s_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("s_name").alias("zone"),
        F.col("n_name").alias("service_zone"),
        status.alias("record_status"),
        k.cast("int").alias("version"),
        F.when(k % 10 == 9, _ts(FAR_FUTURE_FROM)).otherwise(_ts(DEFAULT_FROM)).alias("effective_from"),
        F.when(k % 4 == 0, _ts(EXPIRED_TO)).alias("effective_to"),
        _null_if(k % 5 == 0, _ts(MASTER_UPDATED_BASE)
                 + F.make_dt_interval((k % 7).cast("int"))).alias("updated_at"),
        _ts(MASTER_CREATED_AT).alias("created_at"),
    )


def zone_changes(spark: SparkSession, sf_dir: str, key_modulus: int = 40) -> DataFrame:
    """Upsert requests from ``customer``. 40 keys are skewed on purpose; a
    wide modulus (e.g. 5000) spreads them for benchmarking. ``seq`` starts
    anew in each location; some requests share a seq, come late, or lack seq,
    location or time."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    turn = F.floor(k / key_modulus).cast("long")
    return c.select(
        F.when(k % 223 == 0, F.lit(None)).when(k % 97 == 0, turn + 1).otherwise(turn).alias("seq"),
        F.when(k % 211 != 0, k % key_modulus).cast("int").alias("location_id"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.lit("")).otherwise(F.lit("B"))
        .alias("borough"),
        F.when(seg == "BUILDING", F.lit(None)).when(seg == "MACHINERY", F.lit(""))
        .otherwise(seg).alias("zone"),
        F.when(k % 23 == 0, F.lit("S")).when(k % 5 == 0, F.lit("")).alias("service_zone"),
        _null_if(k % 3 == 0, F.lit("analyst")).alias("created_by"),
        F.concat(F.lit("change "), k.cast("string")).alias("change_reason"),
        F.lit("customer_feed").alias("change_source"),
        _null_if(k % 227 == 0, _add_seconds(_ts(CHANGES_START),
                                            F.when(k % 29 == 0, k - 200).otherwise(k)))
        .alias("changed_at"),
    )


def event_trips(spark: SparkSession, sf_dir: str, **ranges) -> DataFrame:
    """Sub-second trips: pickup = event time, dropoff = the user's next event."""
    from tripmart.operators.sequence import next_in_key

    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    nxt = next_in_key(ev, key="user_id", order=["ts", "event_id"], value="ts",
                      out="dropoff_ts", **ranges)
    return nxt.select("event_id", "user_id", F.col("ts").alias("pickup_ts"), "dropoff_ts")


# --- fixed values: clocks of the governed-dimension runs -----------------------
ROLLBACK_AS_OF = dt.datetime(2024, 8, 1, 0, 0, 0)
APPROVE_AS_OF = dt.datetime(2024, 8, 2, 0, 0, 0)
BATCH_USER = "governance_batch"
PROBE_EPOCH = dt.datetime(2024, 1, 1)
PROBE_COMPRESSION_MICROS = 500_000_000


def zone_master_for_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone master with attributes set so that requests can be no-ops:
    borough 'B', zone FURNITURE / '' / NULL by location, service zone NULL."""
    m = zone_master(spark, sf_dir)
    loc = F.col("location_id")
    return m.withColumns({
        "borough": F.lit("B"),
        "zone": F.when(loc % 3 == 0, F.lit("FURNITURE")).when(loc % 3 == 1, F.lit("")),
        "service_zone": F.lit(None).cast("string"),
    })


def probe_trips(spark: SparkSession, sf_dir: str, key_modulus: int = 40) -> DataFrame:
    """Point-in-time probes from ``events``: location = user_id mod 40, time =
    2024-07-01 plus the event's offset in the month compressed 500 times."""
    ev = table(spark, sf_dir, "events")
    micros = F.timestamp_diff("MICROSECOND", _ts(PROBE_EPOCH), F.col("ts"))
    secs = F.floor(micros / F.lit(PROBE_COMPRESSION_MICROS)).cast("long")
    return ev.select("event_id",
                     (F.col("user_id") % key_modulus).cast("int").alias("location_id"),
                     _add_seconds(_ts(CHANGES_START), secs).alias("probe_ts"))
