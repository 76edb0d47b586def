"""One StructType per table of the data model.

Column names, order and types below must equal the reference's DDL so that a
user of the reference can point existing readers at our tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: canonical curated-trip columns, in load order ------------
CURATED_COLUMNS = [
    "vendorid", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "ratecodeid", "store_and_fwd_flag", "pulocationid", "dolocationid",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "pu_borough", "pu_zone", "pu_servicezone", "do_borough",
    "do_zone", "do_servicezone",
]

# --- fixed values: raw source names and the canonical name each maps to -----
# Identity entries of the original mapping are left out: they rename nothing.
RAW_TO_CANONICAL = {
    "VendorID": "vendorid",
    "RatecodeID": "ratecodeid",
    "PULocationID": "pulocationid",
    "DOLocationID": "dolocationid",
    "Airport_fee": "airport_fee",
    "PU_Borough": "pu_borough",
    "PU_Zone": "pu_zone",
    "PU_ServiceZone": "pu_servicezone",
    "DO_Borough": "do_borough",
    "DO_Zone": "do_zone",
    "DO_ServiceZone": "do_servicezone",
}

_D = T.DoubleType()
_S = T.StringType()
_I = T.IntegerType()
_L = T.LongType()
_TS = T.TimestampNTZType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# --- fixed values: table definitions (names, order, types, NOT NULL) -----------
CURATED_TRIPS = T.StructType([
    _f("vendorid", _I), _f("tpep_pickup_datetime", _TS), _f("tpep_dropoff_datetime", _TS),
    _f("passenger_count", _L), _f("trip_distance", _D), _f("ratecodeid", _L),
    _f("store_and_fwd_flag", _S), _f("pulocationid", _I), _f("dolocationid", _I),
    _f("payment_type", _L), _f("fare_amount", _D), _f("extra", _D), _f("mta_tax", _D),
    _f("tip_amount", _D), _f("tolls_amount", _D), _f("improvement_surcharge", _D),
    _f("total_amount", _D), _f("congestion_surcharge", _D), _f("airport_fee", _D),
    _f("cbd_congestion_fee", _D), _f("pu_borough", _S), _f("pu_zone", _S),
    _f("pu_servicezone", _S), _f("do_borough", _S), _f("do_zone", _S),
    _f("do_servicezone", _S),
])

# Staging = curated columns + load time (NOT NULL, default now()).
STAGING_TRIPS = T.StructType(CURATED_TRIPS.fields + [_f("loaded_at", T.TimestampType(), False)])

RATE_MASTER = T.StructType([
    _f("ratecode_id", _I), _f("ratecode_name", _S), _f("version", _I),
])

ZONE_MASTER = T.StructType([
    _f("location_id", _I), _f("borough", _S), _f("zone", _S), _f("service_zone", _S),
    _f("record_status", _S), _f("version", _I), _f("effective_from", _TS),
    _f("effective_to", _TS), _f("updated_at", _TS), _f("created_at", _TS),
])

# --- fixed values: fact columns in table order, without the load time.
FACT_COLUMNS = [
    "vendor_id", "pickup_ts", "dropoff_ts", "trip_duration_seconds",
    "passenger_count", "trip_distance",
    "ratecode_id", "ratecode_name",
    "store_and_fwd_flag",
    "pu_location_id", "pu_borough", "pu_zone", "pu_service_zone",
    "do_location_id", "do_borough", "do_zone", "do_service_zone",
    "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
]

FCT_TRIPS = T.StructType([
    _f("vendor_id", _I), _f("pickup_ts", _TS), _f("dropoff_ts", _TS),
    _f("trip_duration_seconds", _I), _f("passenger_count", _L), _f("trip_distance", _D),
    _f("ratecode_id", _I), _f("ratecode_name", _S), _f("store_and_fwd_flag", _S),
    _f("pu_location_id", _I), _f("pu_borough", _S), _f("pu_zone", _S),
    _f("pu_service_zone", _S), _f("do_location_id", _I), _f("do_borough", _S),
    _f("do_zone", _S), _f("do_service_zone", _S), _f("payment_type", _L),
    _f("fare_amount", _D), _f("extra", _D), _f("mta_tax", _D), _f("tip_amount", _D),
    _f("tolls_amount", _D), _f("improvement_surcharge", _D), _f("congestion_surcharge", _D),
    _f("airport_fee", _D), _f("cbd_congestion_fee", _D), _f("total_amount", _D),
    _f("loaded_at", T.TimestampType(), False),
])

METRIC_DECIMAL = T.DecimalType(38, 6)

TEST_RESULTS = T.StructType([
    _f("test_run_id", _S, False), _f("test_name", _S, False), _f("passed", T.BooleanType(), False),
    _f("metric_value", METRIC_DECIMAL), _f("threshold", METRIC_DECIMAL), _f("details", _S),
    _f("created_at", T.TimestampType(), False), _f("created_by", _S, False),
])

# --- fixed values: zone dimension columns in table order. Time columns are zone-less here so
# that the same snapshot compares equal across engines; the reference uses
# timestamptz, which a reader can cast to if needed.
ZONE_DIM_COLUMNS = [
    "zone_dim_sk", "location_id", "borough", "zone", "service_zone", "version_number",
    "effective_from", "effective_to", "is_current", "record_status", "change_reason",
    "change_source", "created_at", "created_by", "approved_at", "approved_by",
]

ZONE_DIM = T.StructType([
    _f("zone_dim_sk", _L, False), _f("location_id", _I, False), _f("borough", _S),
    _f("zone", _S), _f("service_zone", _S), _f("version_number", _I, False),
    _f("effective_from", _TS, False), _f("effective_to", _TS), _f("is_current", T.BooleanType(), False),
    _f("record_status", _S, False), _f("change_reason", _S), _f("change_source", _S),
    _f("created_at", _TS, False), _f("created_by", _S, False), _f("approved_at", _TS),
    _f("approved_by", _S),
])

# --- fixed values: column order of the version-history report (differs from table order).
HISTORY_COLUMNS = [
    "zone_dim_sk", "location_id", "borough", "zone", "service_zone", "version_number",
    "record_status", "effective_from", "effective_to", "is_current", "created_by",
    "created_at", "approved_by", "approved_at", "change_reason", "change_source",
]

# --- fixed values: legal dimension statuses ----------------------------------
ZONE_STATUSES = ["DRAFT", "APPROVED", "REJECTED", "ROLLED_BACK"]

# Batch request tables (one row per procedure call of the reference).
UPSERT_REQUESTS = T.StructType([
    _f("seq", _L, False), _f("location_id", _I), _f("borough", _S), _f("zone", _S),
    _f("service_zone", _S), _f("created_by", _S), _f("change_reason", _S),
    _f("change_source", _S), _f("changed_at", _TS),
])

# ``seq`` is the call order; a batch without it must not repeat a key.
APPROVE_REQUESTS = T.StructType([
    _f("zone_dim_sk", _L), _f("approved_by", _S), _f("reason", _S),
])

ROLLBACK_REQUESTS = T.StructType([
    _f("location_id", _I), _f("target_version", _I), _f("rolled_back_by", _S), _f("reason", _S),
])

HISTORY_REQUESTS = T.StructType([
    _f("location_id", _I), _f("from_date", _TS), _f("to_date", _TS),
])
