"""The runs that tie the operators together.

R1 (``run_pipeline``): fact -> metrics -> tests, in this order; an exception
stops the run. The ten metrics are observed while the fact is written, so
the published fact isn't read again. A run is known by its id; repeating
one replaces its rows in the results log.

E3 (``apply_governed_batch``): read the buckets of the newest dimension snapshot
that the batch's locations lie in, apply upserts, approvals and rollbacks, check
the rules on these buckets (the manifest notes what holds for the others),
and commit one new snapshot that takes the other buckets over by name. With
``strict=True`` any rejected request or failed check raises before anything
is published (all or nothing, like a failed call). A batch that loses against
another writer runs again on the other's snapshot.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions import ntz
from tripmart.operators.checks import dim_checks
from tripmart.operators.quality import (
    DQ_TESTS,
    audit_row_violations,
    dq_metrics,
    dq_tests,
    metric_columns,
)
from tripmart.operators.scd2 import (
    approve_versions,
    conform,
    history_one,
    max_surrogate_key,
    rollback_versions,
    seed_zone_dim,
    upsert_zone_scd2,
)
from tripmart.plans.fact import build_fct_trips
from tripmart.schemas import ZONE_DIM
from tripmart.session import cut_lineage, removing_cuts
from tripmart.sources.sinks import append_rows, publish_observed, with_defaults
from tripmart.sources.versioned import ROWS_PER_BUCKET, CommitConflict, VersionedTable


class GovernanceError(RuntimeError):
    """A batch had rejected requests or broke an integrity rule."""


@dataclass
class PipelineReport:
    fact_path: str
    fact_rows: int
    metrics: dict
    tests_written: int


def run_pipeline(spark: SparkSession, staging: DataFrame, rate_master: DataFrame,
                 zone_master: DataFrame, fact_root: str, results_path: str, as_of,
                 run_by: str | None = None, run_ts=None,
                 run_id: str | None = None) -> PipelineReport:
    """``as_of`` picks the masters' rows; ``run_ts`` is the run clock (default
    ``as_of``) of the load time and the test rows; ``run_id`` (default: the
    clock) names the run in the results log."""
    clock = as_of if run_ts is None else run_ts
    with removing_cuts(spark):
        fct = build_fct_trips(staging, rate_master, zone_master, as_of)
        fct = with_defaults(fct, {"loaded_at": ntz(clock).cast("timestamp")})
        fact_path, seen = publish_observed(fct, fact_root, metric_columns())
        shape = dq_metrics(fct).schema
        metrics = spark.createDataFrame([tuple(seen[f.name] for f in shape.fields)], shape)
        tests = cut_lineage(dq_tests(metrics, clock, run_by), "tests")
        if not audit_row_violations(tests).isEmpty():
            raise GovernanceError("a test row has no name or no result")
        append_rows(tests, results_path, str(clock) if run_id is None else run_id)
        return PipelineReport(fact_path, seen["total_rows"], dict(seen), len(DQ_TESTS))


@dataclass
class GovernedBatchReport:
    snapshot: str | None
    rows: int | None
    errors: dict = field(default_factory=dict)
    violations: int = 0


def apply_governed_batch(spark: SparkSession, dim_root: str, as_of, *,
                         zone_master: DataFrame | None = None,
                         upserts: DataFrame | None = None,
                         approvals: DataFrame | None = None,
                         rollbacks: DataFrame | None = None,
                         user: str | None = None, strict: bool = True, attempts: int = 3,
                         rows_per_bucket: int = ROWS_PER_BUCKET) -> GovernedBatchReport:
    """One governed batch. ``rows_per_bucket`` sizes the buckets of a new table."""
    table = dim_table(spark, dim_root, rows_per_bucket)
    for attempt in range(attempts):
        try:
            with removing_cuts(spark):
                return _governed_batch(table, as_of, zone_master, upserts, approvals, rollbacks,
                                       user, strict)
        except CommitConflict:
            if attempt + 1 == attempts:
                raise
    raise ValueError("attempts must be 1 or more")


def dim_table(spark: SparkSession, root: str,
              rows_per_bucket: int = ROWS_PER_BUCKET) -> VersionedTable:
    """The governed dimension under ``root``, bucketed by location and in order
    of (location, start)."""
    return VersionedTable(spark, root, ZONE_DIM, "location_id", "effective_from", rows_per_bucket)


def location_history(spark: SparkSession, dim_root: str, location_id: int, from_date=None,
                     to_date=None) -> DataFrame:
    """G2 for one location, from the files that the manifest has for it."""
    table = dim_table(spark, dim_root)
    rows = table.read(keys=[location_id], since=from_date, until=to_date)
    return history_one(rows, location_id, from_date, to_date)


def _touched_locations(table, base, zone_master, upserts, approvals, rollbacks) -> DataFrame:
    """Locations that a batch can change. An approval names a surrogate key; its
    location is looked up in two columns of the dimension."""
    out = table.spark.createDataFrame([], "location_id int")
    for requests in (zone_master, upserts, rollbacks):
        if requests is not None:
            out = out.union(requests.select(F.col("location_id").cast("int")))
    if approvals is not None:
        keys = approvals.select(F.col("zone_dim_sk").cast("long")).distinct()
        out = out.union(table.read(base).select("zone_dim_sk", "location_id").join(
            keys, "zone_dim_sk", "left_semi").select("location_id"))
    return out.filter(F.col("location_id").isNotNull())


def _governed_batch(table, as_of, zone_master, upserts, approvals, rollbacks, user,
                    strict) -> GovernedBatchReport:
    base = table.version()
    if base is None:
        rows = sum(r.count() for r in (zone_master, upserts) if r is not None)
        base, touched = table.plan(rows), None
    elif base.rows > 2 * base.buckets * table.rows_per_bucket:  # outgrown: deal all rows anew
        base, touched = replace(base, buckets=table.plan(base.rows).buckets), None
    else:
        touched = table.buckets_of(_touched_locations(table, base, zone_master, upserts,
                                                      approvals, rollbacks), base)
    dim = conform(table.read(base, buckets=touched) if base.manifest
                  else table.spark.createDataFrame([], ZONE_DIM))
    key, errors = base.facts.get("max_key", 0), {}
    if zone_master is not None:
        dim = cut_lineage(seed_zone_dim(zone_master, dim, as_of, first_key=key))
        key = max(key, max_surrogate_key(dim))
    steps = [
        ("upsert", upserts, lambda d, r, k: upsert_zone_scd2(d, r, user=user, first_key=k)),
        ("approve", approvals, lambda d, r, k: approve_versions(d, r, as_of)),
        ("rollback", rollbacks, lambda d, r, k: rollback_versions(d, r, as_of, first_key=k)),
    ]
    for name, requests, op in steps:
        if requests is None:
            continue
        res = op(dim, requests, key)
        n_err = res.errors.count()
        if n_err:
            errors[name] = n_err
            if strict:
                raise GovernanceError(f"{name}: {n_err} rejected requests; nothing published")
        dim = cut_lineage(res.dim)
        key = max(key, max_surrogate_key(dim))
    # Every rule but C1's is about one location, so about one bucket; keys of
    # the batch are new ones, above all others.
    found = dim_checks(dim).groupBy(table.bucket_of(F.col("location_id"), base).alias("b")).agg(
        F.count("*").alias("n"))
    broken = {r.b: r.n for r in found.collect()}  # at most one row per bucket
    violations = sum(broken.values()) + table.violations_outside(base, touched)
    if violations and strict:
        raise GovernanceError(f"{violations} integrity violations; nothing published")
    done = table.commit(base, dim, touched, {"max_key": key}, broken)
    return GovernedBatchReport(f"{table.root}/_commits/{done.number:012d}", done.rows, errors,
                               violations)
