"""Named queries over the driver tables: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Operators that write an intermediate table (the governed dimension,
the enrichment's masters, range joins) run those jobs while the DataFrame is
built; its plan is only the last step. Names that end in ``_ranges`` or
``_shuffle`` force the path for large data (many ranges, no broadcast). Column names equal those of the matching SQL in
``tripmart.plans.oracle_sql``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.clean import clean_trips
from tripmart.operators.latest import current_zones, latest_rate
from tripmart.operators.quality import (
    audit_row_violations,
    dq_metrics,
    dq_test_rows,
    dq_tests,
    latest_test_results,
    tests_executed,
)
from tripmart.plans.fact import build_fct_trips, enriched_trips
from tripmart.sources import testdata as td
from tripmart.plans.load import load_trips
from tripmart.plans.pipeline import apply_governed_batch, location_history, run_pipeline
from tripmart.schemas import STAGING_TRIPS, TEST_RESULTS, ZONE_DIM
from tripmart.sources.sinks import read_latest, read_log
from tripmart.session import cut_lineage, scratch_path
from tripmart.sources.versioned import ROWS_PER_BUCKET
from tripmart.sources.curated import to_canonical
from tripmart.functions import duration_seconds, ntz
from tripmart.operators.checks import dim_checks
from tripmart.operators.pit import zone_as_of
from tripmart.operators.scd2 import (
    approve_versions,
    empty_dim,
    rollback_versions,
    seed_zone_dim,
    upsert_zone_scd2,
    version_history,
)

Query = Callable[[SparkSession, str], DataFrame]

# --- fixed values: run clocks of the checked test runs -----------------------
RUN_1 = dt.datetime(2024, 6, 1, 0, 0, 0)
RUN_2 = dt.datetime(2024, 6, 1, 1, 0, 0)
#: Rows per range of the queries that force many ranges.
MANY_RANGES = 5


def _fct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fct_trips(td.curated_trips(spark, sf_dir), td.rate_master(spark, sf_dir),
                           td.zone_master(spark, sf_dir), td.AS_OF)


def _unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_trips(td.curated_trips(spark, sf_dir), td.rate_master(spark, sf_dir),
                          td.zone_master(spark, sf_dir), td.AS_OF, null_negative_distance=False)


def q_trips_normalize(spark, sf_dir):
    return to_canonical(td.raw_curated_trips(spark, sf_dir))


def q_trips_clean(spark, sf_dir):
    return clean_trips(td.curated_trips(spark, sf_dir))


def q_trip_duration_subsecond(spark, sf_dir):
    ev = td.event_trips(spark, sf_dir)
    return ev.withColumn("trip_duration_seconds", duration_seconds("pickup_ts", "dropoff_ts"))


def q_rate_latest(spark, sf_dir):
    return latest_rate(td.rate_master(spark, sf_dir))


def q_zone_current(spark, sf_dir):
    return current_zones(td.zone_master(spark, sf_dir), td.AS_OF)


def q_trips_enriched(spark, sf_dir):
    return enriched_trips(td.curated_trips(spark, sf_dir), td.rate_master(spark, sf_dir),
                          td.zone_master(spark, sf_dir), td.AS_OF)


def q_fct_trips(spark, sf_dir):
    return _fct(spark, sf_dir)


def q_dq_metrics(spark, sf_dir):
    return dq_metrics(_fct(spark, sf_dir))


def q_dq_metrics_unfiltered(spark, sf_dir):
    return dq_metrics(_unfiltered(spark, sf_dir))


def q_dq_tests(spark, sf_dir):
    return dq_test_rows(dq_metrics(_fct(spark, sf_dir)))


def q_dq_tests_executed(spark, sf_dir):
    """A5: number of test rows one run writes."""
    return tests_executed(dq_tests(dq_metrics(_fct(spark, sf_dir)), RUN_2, "dq_runner"))


def q_dq_tests_latest(spark, sf_dir):
    """Results log of two runs (unfiltered input, then the fact), newest first."""
    first = dq_tests(dq_metrics(_unfiltered(spark, sf_dir)), ntz(RUN_1), "dq_runner")
    second = dq_tests(dq_metrics(_fct(spark, sf_dir)), ntz(RUN_2), "dq_runner")
    log = first.unionByName(second)
    return (latest_test_results(log)
            .select("test_name", "passed", "metric_value", "threshold", "details",
                    "created_at"))


def _base_dim(spark, sf_dir):
    """Seeded dimension whose attributes make some requests no-ops. Written
    once like a published snapshot, so later steps read it, not its lineage."""
    return cut_lineage(seed_zone_dim(td.zone_master_for_dim(spark, sf_dir), empty_dim(spark),
                                     td.AS_OF))


def _upsert(spark, sf_dir):
    return upsert_zone_scd2(_base_dim(spark, sf_dir), td.zone_changes(spark, sf_dir),
                            user=td.BATCH_USER)


def _upserted_dim(spark, sf_dir):
    """Snapshot after the upsert batch, as the next governed step reads it."""
    return cut_lineage(_upsert(spark, sf_dir).dim)


def _approvals(dim: DataFrame) -> DataFrame:
    """Current rows of even locations, some closed rows, one unknown key, one
    without a key; half of them are approved twice."""
    def calls(seq, by, reason, step):
        pick = dim.filter((F.col("is_current") & (F.col("location_id") % (2 * step) == 0))
                          | (~F.col("is_current") & (F.col("zone_dim_sk") % (7 * step) == 0)))
        return pick.select(F.lit(seq).cast("long").alias("seq"), "zone_dim_sk",
                           F.lit(by).alias("approved_by"), reason.alias("reason"))

    first = calls(1, "approver", F.concat(F.lit("ok "), F.col("zone_dim_sk").cast("string")), 1)
    second = calls(2, "second", F.lit("again"), 2)
    unknown = dim.agg((F.max("zone_dim_sk") + 1000).alias("zone_dim_sk")).select(
        F.lit(1).cast("long").alias("seq"), "zone_dim_sk", F.lit("approver").alias("approved_by"),
        F.lit("unknown").alias("reason"))
    no_key = unknown.select(F.lit(3).cast("long").alias("seq"),
                            F.lit(None).cast("long").alias("zone_dim_sk"), "approved_by",
                            F.lit("no key").alias("reason"))
    return first.unionByName(second).unionByName(unknown).unionByName(no_key)


def _rollback_dim(dim: DataFrame) -> DataFrame:
    """Location 6 without a current row, 9 with one that starts late, 12 with a
    doubled version."""
    loc = F.col("location_id")
    twice = dim.filter((loc == 12) & (F.col("version_number") == 1)).withColumns({
        "zone_dim_sk": F.col("zone_dim_sk") + 500000, "is_current": F.lit(False)})
    return cut_lineage(dim.withColumns({
        "is_current": F.col("is_current") & (loc != 6),
        "effective_from": F.when(F.col("is_current") & (loc == 9), ntz(td.ROLLBACK_AS_OF))
                           .otherwise(F.col("effective_from"))}).unionByName(twice))


def _rollbacks(dim: DataFrame) -> DataFrame:
    """Per location: target 1, the current version, or a missing one; some
    without a user, every fourth location twice, one call without location."""
    per = dim.groupBy("location_id").agg(F.max("version_number").alias("_max"))
    loc = F.col("location_id")
    req = per.select(
        F.lit(2).cast("long").alias("seq"), "location_id",
        F.when(loc % 3 == 0, F.lit(1)).when(loc % 3 == 1, F.col("_max"))
         .otherwise(F.col("_max") + 5).cast("int").alias("target_version"),
        F.when(loc % 10 == 7, F.lit(None)).otherwise(F.lit("admin")).alias("rolled_back_by"),
        F.concat(F.lit("revert "), loc.cast("string")).alias("reason"))
    later = req.filter(loc % 4 == 0).withColumn("seq", F.lit(3).cast("long"))
    earlier = req.filter(loc == 4).withColumns({"seq": F.lit(1).cast("long"),
                                                "target_version": F.lit(1)})
    no_key = per.limit(1).select(
        F.lit(1).cast("long").alias("seq"), F.lit(None).cast("int").alias("location_id"),
        F.lit(1).alias("target_version"), F.lit("admin").alias("rolled_back_by"),
        F.lit("no key").alias("reason"))
    return req.unionByName(later).unionByName(earlier).unionByName(no_key)


def _history_requests(dim: DataFrame) -> DataFrame:
    loc = F.col("location_id")
    locs = dim.select("location_id").distinct()
    window_from = ntz(td.CHANGES_START + dt.timedelta(minutes=5))
    window_to = ntz(td.CHANGES_START + dt.timedelta(minutes=20))
    as_of = ntz(td.AS_OF)
    none = F.lit(None).cast("timestamp_ntz")
    return locs.select(
        "location_id",
        F.when(loc % 4 == 1, as_of).when(loc % 4 == 3, window_from).otherwise(none)
         .alias("from_date"),
        F.when(loc % 4 == 1, as_of).when(loc % 4 == 3, window_to).otherwise(none)
         .alias("to_date"))


def _planted_faults(dim: DataFrame) -> DataFrame:
    """Faults for every rule: NULLs in each required column and the key, status,
    window, open end, extra current row, duplicated rows."""
    sk = F.col("zone_dim_sk")

    def unless(n, column):
        return F.when(sk % n != 0, F.col(column))

    faulty = dim.withColumns({
        "location_id": unless(101, "location_id"),
        "version_number": unless(103, "version_number"),
        "effective_from": unless(107, "effective_from"),
        "record_status": F.when(sk % 97 == 0, F.lit("BOGUS")).when(
            sk % 113 != 0, F.col("record_status")),
        "effective_to": F.when(sk % 89 == 0, F.col("effective_from"))
                         .when(sk % 71 == 0, F.lit(None)).otherwise(F.col("effective_to")),
        "created_by": unless(73, "created_by"),
        "created_at": unless(127, "created_at"),
        "is_current": F.when(sk % 67 == 0, F.lit(True)).when(sk % 109 != 0, F.col("is_current")),
    })
    return faulty.withColumn("zone_dim_sk", F.when(sk % 131 != 0, sk)).unionByName(
        faulty.filter(sk % 83 == 0))


def _overlapping(dim: DataFrame) -> DataFrame:
    """Every fifth version stays open for five more minutes, every eleventh for good."""
    sk = F.col("zone_dim_sk")
    more = F.col("effective_to") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(5))
    return cut_lineage(dim.withColumn("effective_to", F.when(sk % 11 == 0, F.lit(None)).when(
        sk % 5 == 0, more).otherwise(F.col("effective_to"))))


def q_zone_seed(spark, sf_dir):
    return seed_zone_dim(td.zone_master(spark, sf_dir), empty_dim(spark), td.AS_OF)


def q_zone_seed_rerun(spark, sf_dir):
    master = td.zone_master(spark, sf_dir)
    once = seed_zone_dim(master, empty_dim(spark), td.AS_OF)
    return seed_zone_dim(master, once, td.ROLLBACK_AS_OF)


def q_scd2_upsert(spark, sf_dir):
    return _upsert(spark, sf_dir).dim


def q_scd2_upsert_results(spark, sf_dir):
    return _upsert(spark, sf_dir).results


def q_scd2_approve(spark, sf_dir):
    dim = _upserted_dim(spark, sf_dir)
    return approve_versions(dim, _approvals(dim), td.APPROVE_AS_OF).dim


def q_scd2_approve_errors(spark, sf_dir):
    dim = _upserted_dim(spark, sf_dir)
    return approve_versions(dim, _approvals(dim), td.APPROVE_AS_OF).errors


def q_scd2_rollback(spark, sf_dir):
    dim = _rollback_dim(_upserted_dim(spark, sf_dir))
    return rollback_versions(dim, _rollbacks(dim), td.ROLLBACK_AS_OF).dim


def q_scd2_rollback_errors(spark, sf_dir):
    dim = _rollback_dim(_upserted_dim(spark, sf_dir))
    return rollback_versions(dim, _rollbacks(dim), td.ROLLBACK_AS_OF).errors


def q_scd2_history(spark, sf_dir):
    dim = _upserted_dim(spark, sf_dir)
    return version_history(dim, _history_requests(dim))


def q_scd2_checks(spark, sf_dir):
    return dim_checks(_planted_faults(_upserted_dim(spark, sf_dir)))


def q_zone_as_of(spark, sf_dir):
    dim = _upserted_dim(spark, sf_dir)
    return zone_as_of(td.probe_trips(spark, sf_dir), dim, "location_id", "probe_ts")


def q_zone_as_of_scan(spark, sf_dir):
    """G4 beyond the broadcast bound: join by location and time range, with
    2,000 ranges at sf0.01."""
    dim = _upserted_dim(spark, sf_dir)
    return zone_as_of(td.probe_trips(spark, sf_dir), dim, "location_id", "probe_ts",
                      strategy="ranges", rows_per_chunk=MANY_RANGES)


def q_zone_as_of_overlap(spark, sf_dir):
    dim = _overlapping(_upserted_dim(spark, sf_dir))
    return zone_as_of(td.probe_trips(spark, sf_dir), dim, "location_id", "probe_ts")


def q_zone_as_of_overlap_ranges(spark, sf_dir):
    dim = _overlapping(_upserted_dim(spark, sf_dir))
    return zone_as_of(td.probe_trips(spark, sf_dir), dim, "location_id", "probe_ts",
                      max_broadcast_rows=0, rows_per_chunk=MANY_RANGES)


def q_scd2_upsert_errors(spark, sf_dir):
    return _upsert(spark, sf_dir).errors


def q_scd2_upsert_ranges(spark, sf_dir):
    return upsert_zone_scd2(_base_dim(spark, sf_dir), td.zone_changes(spark, sf_dir),
                            user=td.BATCH_USER, rows_per_chunk=MANY_RANGES,
                            max_broadcast_rows=0).dim


def q_trip_duration_ranges(spark, sf_dir):
    t = td.event_trips(spark, sf_dir, rows_per_chunk=MANY_RANGES)
    return t.withColumn("trip_duration_seconds", duration_seconds("pickup_ts", "dropoff_ts"))


def q_fct_trips_shuffle(spark, sf_dir):
    return build_fct_trips(td.curated_trips(spark, sf_dir), td.rate_master(spark, sf_dir),
                           td.zone_master(spark, sf_dir), td.AS_OF, max_broadcast_rows=0)


def _published(spark, sf_dir, rows_per_bucket=ROWS_PER_BUCKET):
    """Folder of a governed dimension after its first batch (seed and upserts)."""
    root = scratch_path(spark, f"dim_published/{uuid.uuid4().hex}")
    apply_governed_batch(spark, root, td.AS_OF, zone_master=td.zone_master_for_dim(spark, sf_dir),
                         upserts=td.zone_changes(spark, sf_dir), user=td.BATCH_USER, strict=False,
                         rows_per_bucket=rows_per_bucket)
    return root


def q_dim_published(spark, sf_dir):
    """Two governed batches (seed and upserts, then approvals), and the
    newest snapshot read back."""
    root = _published(spark, sf_dir)
    apply_governed_batch(spark, root, td.APPROVE_AS_OF,
                         approvals=_approvals(read_latest(spark, root, ZONE_DIM)), strict=False)
    return read_latest(spark, root, ZONE_DIM)


def q_dim_buckets(spark, sf_dir):
    """K7: the same batches on a table of many buckets; the second one rewrites
    the buckets of the approved locations."""
    root = _published(spark, sf_dir, rows_per_bucket=30)
    apply_governed_batch(spark, root, td.APPROVE_AS_OF,
                         approvals=_approvals(read_latest(spark, root, ZONE_DIM)), strict=False)
    return read_latest(spark, root, ZONE_DIM)


def q_history_lookup(spark, sf_dir):
    """Histories of single locations, each from its own files."""
    root = _published(spark, sf_dir, rows_per_bucket=30)
    since = td.CHANGES_START + dt.timedelta(minutes=5)
    return (location_history(spark, root, 3).union(location_history(spark, root, 12, since))
            .union(location_history(spark, root, 17, None, since)))


def q_pipeline_run(spark, sf_dir):
    """The results log after two pipeline runs, the second of which is
    repeated, without the uuids. The runs read one landed copy of the trips, as
    they would a staging table: the join that makes them runs once, not once a run."""
    run = scratch_path(spark, f"pipeline_run/{uuid.uuid4().hex}")
    trips = cut_lineage(td.curated_trips(spark, sf_dir), "staged_trips")
    for clock, who in ((RUN_1, "first run"), (RUN_2, "broken off"), (RUN_2, "second run")):
        run_pipeline(spark, trips, td.rate_master(spark, sf_dir),
                     td.zone_master(spark, sf_dir), f"{run}/fact", f"{run}/log", td.AS_OF,
                     run_by=who, run_ts=clock)
    log = read_log(spark, f"{run}/log", TEST_RESULTS)
    return latest_test_results(log).select(
        "test_name", "passed", "metric_value", "threshold", "details",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"), "created_by")


def q_audit_violations(spark, sf_dir):
    """C8 over test rows that lost a name or a result."""
    log = dq_test_rows(dq_metrics(_fct(spark, sf_dir)))
    broken = log.withColumns({
        "test_name": F.when(F.coalesce(F.col("threshold") != 1, F.lit(True)), F.col("test_name")),
        "passed": F.when(~F.col("passed"), F.col("passed"))})
    return audit_row_violations(broken).select("test_name", "passed", "details")


def q_load_roundtrip(spark, sf_dir):
    """Curated files under raw names and with other numeric types -> load job ->
    staging snapshot, read back with its declared types; with the load time
    and the row count that the load reported. Files go to the shared
    checkpoint folder, one fresh folder per call."""
    run = scratch_path(spark, f"load_roundtrip/{uuid.uuid4().hex}")
    raw = td.raw_curated_trips(spark, sf_dir)
    renamed = {c.lower(): c for c in raw.columns}
    raw = raw.withColumns({renamed[c]: F.col(renamed[c]).cast(kind) for c, kind in (
        ("passenger_count", "double"), ("ratecodeid", "int"), ("payment_type", "double"),
        ("vendorid", "bigint"))})
    raw.write.parquet(f"{run}/curated")
    report = load_trips(spark, f"{run}/curated", f"{run}/staging", loaded_at=RUN_1)
    staging = spark.read.schema(STAGING_TRIPS).parquet(report.target)
    return staging.withColumns({"loaded_at": F.col("loaded_at").cast("timestamp_ntz"),
                                "reported_rows": F.lit(report.rows).cast("long")})


def q_load_mixed_months(spark, sf_dir):
    """Months of three layouts in one folder (raw names; canonical names
    in another order, with other numeric types; an extra column and wider types)
    through one load."""
    run = scratch_path(spark, f"load_mixed_months/{uuid.uuid4().hex}")
    raw = td.raw_curated_trips(spark, sf_dir)
    canonical = to_canonical(raw)
    renamed = {c.lower(): c for c in raw.columns}
    month = F.coalesce(F.col(renamed["vendorid"]), F.lit(0)) % 3
    layouts = [
        raw.filter(month == 0),
        canonical.filter(F.coalesce("vendorid", F.lit(0)) % 3 == 1).select(
            *reversed(canonical.columns)).withColumns({
                "passenger_count": F.col("passenger_count").cast("double"),
                "ratecodeid": F.col("ratecodeid").cast("int"),
                "vendorid": F.col("vendorid").cast("bigint")}),
        raw.filter(month == 2).withColumns({
            renamed["payment_type"]: F.col(renamed["payment_type"]).cast("double"),
            renamed["passenger_count"]: F.col(renamed["passenger_count"]).cast("int"),
            "file_note": F.lit("not loaded")}),
    ]
    for n, rows in enumerate(layouts, 1):
        rows.write.parquet(f"{run}/curated/month={n}")
    report = load_trips(spark, f"{run}/curated", f"{run}/staging", loaded_at=RUN_1)
    staging = spark.read.schema(STAGING_TRIPS).parquet(report.target)
    return staging.withColumns({"loaded_at": F.col("loaded_at").cast("timestamp_ntz"),
                                "reported_rows": F.lit(report.rows).cast("long")})


QUERIES: dict[str, Query] = {
    "trips_normalize": q_trips_normalize,
    "trips_clean": q_trips_clean,
    "trip_duration_subsecond": q_trip_duration_subsecond,
    "rate_latest": q_rate_latest,
    "zone_current": q_zone_current,
    "trips_enriched": q_trips_enriched,
    "fct_trips": q_fct_trips,
    "dq_metrics": q_dq_metrics,
    "dq_metrics_unfiltered": q_dq_metrics_unfiltered,
    "dq_tests": q_dq_tests,
    "dq_tests_latest": q_dq_tests_latest,
    "dq_tests_executed": q_dq_tests_executed,
    "zone_seed": q_zone_seed,
    "zone_seed_rerun": q_zone_seed_rerun,
    "scd2_upsert": q_scd2_upsert,
    "scd2_upsert_results": q_scd2_upsert_results,
    "scd2_approve": q_scd2_approve,
    "scd2_approve_errors": q_scd2_approve_errors,
    "scd2_rollback": q_scd2_rollback,
    "scd2_rollback_errors": q_scd2_rollback_errors,
    "scd2_history": q_scd2_history,
    "scd2_checks": q_scd2_checks,
    "zone_as_of": q_zone_as_of,
    "zone_as_of_scan": q_zone_as_of_scan,
    "load_roundtrip": q_load_roundtrip,
    "scd2_upsert_errors": q_scd2_upsert_errors,
    "scd2_upsert_ranges": q_scd2_upsert_ranges,
    "dim_published": q_dim_published,
    "trip_duration_ranges": q_trip_duration_ranges,
    "zone_as_of_overlap": q_zone_as_of_overlap,
    "zone_as_of_overlap_ranges": q_zone_as_of_overlap_ranges,
    "fct_trips_shuffle": q_fct_trips_shuffle,
    "pipeline_run": q_pipeline_run,
    "audit_violations": q_audit_violations,
    "load_mixed_months": q_load_mixed_months,
    "dim_buckets": q_dim_buckets,
    "history_lookup": q_history_lookup,
}

__all__ = ["QUERIES"]
