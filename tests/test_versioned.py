"""The versioned dimension, the run log, observed metrics, files of mixed layouts."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tripmart.operators.checks import dim_checks
from tripmart.operators.scd2 import upsert_zone_scd2
from tripmart.plans import pipeline
from tripmart.plans.load import load_trips
from tripmart.plans.pipeline import (
    GovernanceError,
    apply_governed_batch,
    dim_table,
    location_history,
    run_pipeline,
)
from tripmart.schemas import TEST_RESULTS, UPSERT_REQUESTS, ZONE_DIM
from tripmart.sources import testdata as td
from tripmart.sources.curated import MissingColumnsError, layouts, to_canonical
from tripmart.sources.sinks import list_snapshots, read_latest, read_log
from tripmart.sources.versioned import CommitConflict

T0 = dt.datetime(2024, 6, 1)
SF = "/root/testdata/sf0.001"


def calls(spark, rows):
    """rows: (seq, location, zone, hour)."""
    return spark.createDataFrame([dict(
        seq=s, location_id=loc, borough="B", zone=zone, service_zone=None, created_by="u",
        change_reason=None, change_source=None, changed_at=T0 + dt.timedelta(hours=h))
        for s, loc, zone, h in rows], UPSERT_REQUESTS)


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path)
               for f in names if f.endswith(".parquet"))


def content(df):
    return sorted(map(str, df.collect()))


def test_a_small_batch_writes_its_buckets_only(spark, tmp_path):
    root = f"{tmp_path}/dim"
    first = calls(spark, [(1, loc, f"z{loc}", 0) for loc in range(20_000)])
    made = apply_governed_batch(spark, root, T0, upserts=first, rows_per_bucket=200)
    table = dim_table(spark, root)
    base = table.version()
    assert made.rows == base.rows == 20_000 and base.buckets == 100 and base.parent == 0
    before = folder_bytes(f"{root}/data")
    apply_governed_batch(spark, root, T0, upserts=calls(spark, [(1, 77, "new", 5)]))
    grown = folder_bytes(f"{root}/data") - before
    assert grown < 0.03 * before  # one bucket of a hundred
    old, new = (set(table.files(v)) for v in (base, table.version()))
    assert len(old - new) <= 2 and len(new - old) <= 2 and len(old & new) >= 99
    assert table.read().count() == 20_001 and table.read(base).count() == 20_000
    assert list_snapshots(spark, root) == [1, 2]
    # a lookup reads the files of its location
    assert len(table.files(table.version(), keys=[77])) <= 2
    rows = location_history(spark, root, 77).collect()
    assert [(r.version_number, r.zone, r.is_current) for r in rows] == [(1, "z77", False),
                                                                        (2, "new", True)]
    late = location_history(spark, root, 77, from_date=T0 + dt.timedelta(hours=1)).collect()
    assert [r.version_number for r in late] == [2]
    assert location_history(spark, root, 99_999).count() == 0


def test_the_files_of_a_hot_location_are_cut_by_start(spark, tmp_path):
    table = dim_table(spark, f"{tmp_path}/dim", rows_per_bucket=1000)
    many = spark.range(4000).select(
        F.col("id").alias("zone_dim_sk"), F.lit(5).alias("location_id"), F.lit("b").alias("borough"),
        F.lit("z").alias("zone"), F.lit(None).cast("string").alias("service_zone"),
        F.col("id").cast("int").alias("version_number"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(T0).cast("timestamp_ntz"))
         .alias("effective_from"), F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"), F.lit("DRAFT").alias("record_status"),
        F.lit(None).cast("string").alias("change_reason"),
        F.lit(None).cast("string").alias("change_source"),
        F.lit(T0).cast("timestamp_ntz").alias("created_at"), F.lit("u").alias("created_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        F.lit(None).cast("string").alias("approved_by"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = table.commit(table.plan(4000), many, None)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    every = table.files(done)
    assert len(every) > 3 and table.read(done).count() == 4000
    day = table.files(done, keys=[5], since=T0 + dt.timedelta(hours=100),
                      until=T0 + dt.timedelta(hours=110))
    assert 1 <= len(day) < len(every)
    assert table.rows_of(5, since=T0, until=T0, version=done).filter(
        "version_number = 0").count() == 1


def test_two_writers_of_one_snapshot(spark, tmp_path):
    table = dim_table(spark, f"{tmp_path}/dim", rows_per_bucket=10)
    rows = upsert_zone_scd2(table.read(), calls(spark, [(1, k, "a", 0) for k in range(30)])).dim
    base = table.commit(table.plan(30), rows, None, {"max_key": 30})
    touched = table.buckets_of(spark.createDataFrame([(3,)], "location_id int"), base)
    one = upsert_zone_scd2(table.read(base, buckets=touched), calls(spark, [(1, 3, "one", 1)])).dim
    two = upsert_zone_scd2(table.read(base, buckets=touched), calls(spark, [(1, 3, "two", 1)])).dim
    won = table.commit(base, one, touched)
    with pytest.raises(CommitConflict):
        table.commit(base, two, touched)
    assert table.version().number == won.number == 2 and won.parent == 1
    zones = {r.zone for r in table.rows_of(3).collect()}
    assert zones == {"a", "one"}
    assert not [n for n in os.listdir(f"{tmp_path}/dim/_commits") if n.startswith(".draft")]


def test_the_loser_of_two_batches_runs_again(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/dim"
    apply_governed_batch(spark, root, T0, upserts=calls(spark, [(1, k, "a", 0) for k in range(9)]),
                         rows_per_bucket=3)
    real, other = pipeline.dim_checks, [("other", 1)]

    def meanwhile(dim):  # while the first batch is checked, another one commits
        if other:
            zone, hour = other.pop()
            apply_governed_batch(spark, root, T0, upserts=calls(spark, [(1, 4, zone, hour)]))
        return real(dim)

    monkeypatch.setattr(pipeline, "dim_checks", meanwhile)
    apply_governed_batch(spark, root, T0, upserts=calls(spark, [(1, 4, "first", 2), (1, 5, "x", 2)]))
    table = dim_table(spark, root)
    got = {(r.location_id, r.version_number): r.zone for r in table.read().collect()}
    assert [got[4, v] for v in (1, 2, 3)] == ["a", "other", "first"] and got[5, 2] == "x"
    assert len({r.zone_dim_sk for r in table.read().collect()}) == len(got) == 12
    assert table.versions() == [1, 2, 3] and table.version().parent == 2
    other.append(("again", 8))
    with pytest.raises(CommitConflict):
        apply_governed_batch(spark, root, T0, upserts=calls(spark, [(2, 4, "late", 9)]), attempts=1)


def test_checks_of_touched_buckets_equal_checks_of_all(spark, tmp_path):
    rng = random.Random(6)
    root = f"{tmp_path}/dim"
    table = dim_table(spark, root, rows_per_bucket=8)
    rows = upsert_zone_scd2(table.read(), calls(
        spark, [(k, rng.randrange(40), f"z{rng.randrange(5)}", k) for k in range(120)])).dim
    broken = rows.withColumns({  # open windows that overlap, and a wrong status
        "effective_to": F.when(F.col("zone_dim_sk") % 7 == 0, F.lit(None)).otherwise(
            F.col("effective_to")),
        "record_status": F.when(F.col("zone_dim_sk") % 11 == 0, F.lit("ODD")).otherwise(
            F.col("record_status"))})
    base = table.plan(120)
    found = {r.b: r.n for r in dim_checks(broken).groupBy(
        table.bucket_of(F.col("location_id"), base).alias("b")).agg(F.count("*").alias("n")).collect()}
    first = table.commit(base, broken, None, {"max_key": 1000}, found)
    assert first.facts["violations"] == sum(found.values()) > 0
    for n in range(3):
        batch = calls(spark, [(1000 + n, rng.randrange(40), f"new{n}", 500 + n)])
        report = apply_governed_batch(spark, root, T0, upserts=batch, strict=False)
        assert report.violations == dim_checks(table.read()).count()
    with pytest.raises(GovernanceError):  # rules broken elsewhere block a strict batch too
        apply_governed_batch(spark, root, T0, upserts=calls(spark, [(2000, 1, "q", 900)]))


def test_an_outgrown_table_gets_more_buckets(spark, tmp_path):
    root = f"{tmp_path}/dim"
    apply_governed_batch(spark, root, T0, upserts=calls(spark, [(1, 1, "a", 0)]), rows_per_bucket=5)
    more = calls(spark, [(k, k % 30, f"z{k}", k) for k in range(1, 61)])
    apply_governed_batch(spark, root, T0, upserts=more, rows_per_bucket=5)
    before = content(dim_table(spark, root).read())
    assert dim_table(spark, root).version().buckets == 1
    apply_governed_batch(spark, root, T0, upserts=calls(spark, [(99, 3, "z3", 999)]),
                         rows_per_bucket=5)
    table = dim_table(spark, root)
    assert table.version().buckets > 10
    after = content(table.read())
    assert len(after) == len(before) + 1 and len(set(before) - set(after)) == 1  # one row closed
    assert content(read_latest(spark, root, ZONE_DIM)) == content(read_latest(spark, root))


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    base = str(tmp_path)
    args = (td.curated_trips(spark, SF), td.rate_master(spark, SF), td.zone_master(spark, SF),
            f"{base}/fact", f"{base}/log", td.AS_OF)
    for run, by in (("2024-06-01/a", "x"), ("2024-06-02/b", "y"), ("2024-06-01/a", "z")):
        report = run_pipeline(spark, *args, run_by=by, run_id=run)
    log = read_log(spark, f"{base}/log", TEST_RESULTS)
    assert sorted((r.created_by, r.n) for r in log.groupBy("created_by").agg(
        F.count("*").alias("n")).collect()) == [("y", 10), ("z", 10)]
    # observed while writing, equal to a query over what was written
    fact = read_latest(spark, f"{base}/fact")
    want = pipeline.dq_metrics(fact).first().asDict()
    assert report.metrics == want and report.fact_rows == want["total_rows"]
    assert read_log(spark, f"{base}/none", TEST_RESULTS).count() == 0


def test_files_of_mixed_layouts(spark, tmp_path):
    base = str(tmp_path)
    raw = td.raw_curated_trips(spark, SF)
    name = {c.lower(): c for c in raw.columns}["passenger_count"]
    kinds = ["double", "int", "bigint", "double"]
    for n, kind in enumerate(kinds):
        rows = raw.limit(10 + n).withColumn(name, F.col(name).cast(kind))
        rows.coalesce(1).write.parquet(f"{base}/trips/month={n}")
    groups = layouts(spark, f"{base}/trips")
    assert sorted(map(len, groups)) == [1, 1, 2]
    report = load_trips(spark, f"{base}/trips", f"{base}/staging")
    assert report.rows == 10 + 11 + 12 + 13
    want = sum((to_canonical(raw.limit(10 + n)).agg(F.sum("passenger_count")).first()[0] or 0)
               for n in range(4))
    got = read_latest(spark, f"{base}/staging").agg(F.sum("passenger_count")).first()[0]
    assert got == want
    raw.drop(name).limit(1).write.parquet(f"{base}/trips/month=9")
    with pytest.raises(MissingColumnsError, match="month=9"):
        load_trips(spark, f"{base}/trips", f"{base}/staging")
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{base}/empty")
        load_trips(spark, f"{base}/empty", f"{base}/staging")
