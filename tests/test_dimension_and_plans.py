"""G1-G4, sequence helpers, load job, pipeline and governed batch flow."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators.checks import dim_checks
from tripmart.operators.pit import zone_as_of
from tripmart.operators.scd2 import empty_dim, history_one, seed_zone_dim, version_history
from tripmart.operators.sequence import assign_surrogate_keys, next_in_key
from tripmart.plans.load import load_trips
from tripmart.plans.pipeline import GovernanceError, apply_governed_batch, run_pipeline
from tripmart.schemas import HISTORY_COLUMNS, UPSERT_REQUESTS, ZONE_DIM, ZONE_MASTER
from tripmart.session import checkpoint_dir
from tripmart.sources import testdata as td
from tripmart.sources.sinks import list_snapshots, read_latest

T0 = dt.datetime(2024, 6, 1)


def dim_row(sk, loc, ver, frm, to, cur, status="APPROVED", zone="z"):
    return dict(zone_dim_sk=sk, location_id=loc, borough="b", zone=zone, service_zone=None,
                version_number=ver, effective_from=frm, effective_to=to, is_current=cur,
                record_status=status, change_reason=None, change_source=None, created_at=frm,
                created_by="u", approved_at=None, approved_by=None)


def test_next_in_key_matches_plain_lead_across_chunks(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, None]), rng.randrange(60)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k int, t long")
    got = next_in_key(df, "k", ["t", "id"], "t", "nxt", rows_per_chunk=11)
    want = df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert sorted(map(tuple, got.select("id", "nxt").collect()), key=str) == \
        sorted(map(tuple, want.select("id", "nxt").collect()), key=str)


def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.createDataFrame([(v,) for v in random.Random(5).sample(range(10_000), 500)], "v long")
    got = assign_surrogate_keys(df, "v", 41, "sk", rows_per_chunk=17).collect()
    by_v = sorted(got, key=lambda r: r.v)
    assert [r.sk for r in by_v] == list(range(42, 542))


def test_seed_twice_adds_nothing(spark):
    m = spark.createDataFrame([dict(location_id=1, borough="a", zone="z", service_zone="s",
                                    record_status="active", version=None, effective_from=None,
                                    effective_to=None, updated_at=None, created_at=None),
                               dict(location_id=1, borough="a", zone="y", service_zone="s",
                                    record_status="ACTIVE", version=3, effective_from=None,
                                    effective_to=None, updated_at=None, created_at=None),
                               dict(location_id=None, borough="a", zone="x", service_zone="s",
                                    record_status="ACTIVE", version=3, effective_from=None,
                                    effective_to=None, updated_at=None, created_at=None)],
                              ZONE_MASTER)
    once = seed_zone_dim(m, empty_dim(spark), T0)
    rows = once.collect()
    assert len(rows) == 1 and rows[0].zone == "y" and rows[0].zone_dim_sk == 1
    assert rows[0].record_status == "APPROVED" and rows[0].created_by == "seed_load"
    assert seed_zone_dim(m, once, T0).count() == 1


def test_history_bounds(spark):
    d = spark.createDataFrame([
        dim_row(1, 7, 1, T0, T0 + dt.timedelta(days=1), False),
        dim_row(2, 7, 2, T0 + dt.timedelta(days=1), None, True),
        dim_row(3, 8, 1, T0, None, True)], ZONE_DIM)
    assert [r.version_number for r in history_one(d, 7).collect()] == [1, 2]
    assert history_one(d, 7).columns == HISTORY_COLUMNS
    got = history_one(d, 7, T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=1)).collect()
    assert [r.version_number for r in got] == [2]
    req = spark.createDataFrame([(7, T0, T0), (8, None, None)],
                                "location_id int, from_date timestamp_ntz, to_date timestamp_ntz")
    assert [(r.location_id, r.version_number) for r in version_history(d, req).collect()] == \
        [(7, 1), (8, 1)]


def test_checks_find_each_planted_fault(spark):
    good = [dim_row(1, 1, 1, T0, T0 + dt.timedelta(days=1), False),
            dim_row(2, 1, 2, T0 + dt.timedelta(days=1), None, True)]
    assert dim_checks(spark.createDataFrame(good, ZONE_DIM)).count() == 0
    bad = good + [
        dim_row(2, 2, 1, T0, None, True),                                         # C1
        dim_row(4, 3, 1, T0, None, True, status="BOGUS"),                          # C3
        dim_row(5, 4, 1, T0, T0, False),                                           # C4
        dim_row(6, 1, 3, T0 + dt.timedelta(days=2), None, True),                   # C5, C7
        dim_row(7, 5, 1, T0, None, True), dim_row(8, 5, 1, T0 + dt.timedelta(1), None, False),
    ]
    bad[3]["created_by"] = None                                                    # C2
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in ZONE_DIM.fields])
    rules = {r.rule for r in dim_checks(spark.createDataFrame(bad, loose)).collect()}
    assert rules == {"C1", "C2", "C3", "C4", "C5", "C6", "C7"}


def test_point_in_time_boundaries(spark):
    d = spark.createDataFrame([
        dim_row(1, 1, 1, T0, T0 + dt.timedelta(hours=1), False, zone="v1"),
        dim_row(2, 1, 2, T0 + dt.timedelta(hours=2), None, True, zone="v2")], ZONE_DIM)
    facts = spark.createDataFrame([
        (1, 1, T0 - dt.timedelta(seconds=1)),        # before the first version
        (2, 1, T0),                                  # at a start: in
        (3, 1, T0 + dt.timedelta(hours=1)),          # at an end: out (gap)
        (4, 1, T0 + dt.timedelta(hours=2)),
        (5, 9, T0)], "id long, loc int, at timestamp_ntz")
    got = {r.id: r.zone for r in zone_as_of(facts, d, "loc", "at").collect()}
    assert got == {1: None, 2: "v1", 3: None, 4: "v2", 5: None}


def test_asof_scan_equals_broadcast_join(spark):
    rng = random.Random(11)
    rows, sk = [], 0
    for loc in range(5):
        t = T0
        n = 40 if loc == 2 else rng.randint(1, 4)       # location 2 is hot
        for v in range(1, n + 1):
            sk += 1
            start = t + dt.timedelta(minutes=rng.choice([0, 5]))   # gaps
            end = start + dt.timedelta(minutes=rng.randint(1, 30))
            last = v == n
            rows.append(dim_row(sk, loc, v, start, None if last else end, last, zone=f"z{sk}"))
            t = end
    d = spark.createDataFrame(rows, ZONE_DIM)
    facts = spark.createDataFrame(
        [(i, rng.choice([0, 1, 2, 2, 2, 3, 4, None, 9]),
          None if i % 50 == 0 else T0 + dt.timedelta(minutes=rng.randrange(-10, 600)))
         for i in range(400)] + [(1000 + r["zone_dim_sk"], r["location_id"], r["effective_from"])
                                 for r in rows],
        "id long, loc int, at timestamp_ntz")
    a = zone_as_of(facts, d, "loc", "at", strategy="broadcast")
    b = zone_as_of(facts, d, "loc", "at", strategy="ranges", rows_per_chunk=13)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_load_pipeline_and_governed_batch(spark, tmp_path):
    base = str(tmp_path)
    sf = "/root/testdata/sf0.001"
    td.raw_curated_trips(spark, sf).write.parquet(f"{base}/curated")
    report = load_trips(spark, f"{base}/curated", f"{base}/staging")
    assert report.rows == 6000 and str(report).startswith("Loaded 6000 rows")
    again = load_trips(spark, f"{base}/curated", f"{base}/staging")
    assert list_snapshots(spark, f"{base}/staging") == [1, 2] and again.rows == 6000
    staging = read_latest(spark, f"{base}/staging")
    out = run_pipeline(spark, staging, td.rate_master(spark, sf), td.zone_master(spark, sf),
                       f"{base}/fct", f"{base}/dq", td.AS_OF, run_by="tester")
    assert out.fact_rows == 2872 and out.metrics["total_rows"] == 2872
    results = spark.read.parquet(f"{base}/dq")
    assert results.count() == 10 and results.filter("passed").count() == 8

    g = apply_governed_batch(spark, f"{base}/dim", td.AS_OF,
                             zone_master=td.zone_master_for_dim(spark, sf))
    seeded = g.rows
    assert seeded == td.zone_master(spark, sf).select("location_id").distinct().count()
    k = F.regexp_extract("change_reason", r"\d+", 0).cast("long")
    changes = td.zone_changes(spark, sf).filter(
        F.col("seq").isNotNull() & F.col("location_id").isNotNull()
        & F.col("changed_at").isNotNull() & (k % 29 != 0) & (k % 97 != 0) & ((k + 40) % 97 != 0))
    g = apply_governed_batch(spark, f"{base}/dim", td.AS_OF, upserts=changes, user="batch")
    assert g.violations == 0 and g.rows > seeded
    bad = spark.createDataFrame([dict(seq=1, location_id=1, borough="x", zone=None,
                                      service_zone=None, created_by=None, change_reason=None,
                                      change_source=None, changed_at=T0)], UPSERT_REQUESTS)
    with pytest.raises(GovernanceError):
        apply_governed_batch(spark, f"{base}/dim", td.AS_OF, upserts=bad)

    from tripmart.plans.catalog import register_tables
    names = register_tables(spark, {"fct_trips": f"{base}/fct", "test_results": f"{base}/dq",
                                    "zone_dim_scd2": f"{base}/dim"})
    assert names == ["fct_trips", "test_results", "zone_dim_scd2"]
    latest = spark.sql("SELECT * FROM test_results ORDER BY created_at DESC").collect()
    assert len(latest) == 10
    assert spark.sql("SELECT COUNT(*) FROM zone_dim_scd2 WHERE is_current").first()[0] > 0
    assert len(list_snapshots(spark, f"{base}/dim")) == 2


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    if configured:
        assert os.path.basename(configured.rstrip("/")) in got


def test_rollback_edge_rows_then_upsert(spark):
    from tripmart.operators.scd2 import rollback_versions, upsert_zone_scd2
    from tripmart.schemas import ROLLBACK_REQUESTS
    h = dt.timedelta(hours=1)
    d = spark.createDataFrame([
        dim_row(1, 1, 1, T0, T0 + h, False, zone="a"),
        dim_row(2, 1, 2, T0 + h, None, True, zone="b"),
        dim_row(3, 2, 1, T0, T0 + h, False, zone="c"),        # no current row at all
        dim_row(4, 3, 1, T0, None, True, zone="d"),
    ], ZONE_DIM)
    as_of = T0 + 5 * h
    req = spark.createDataFrame([(1, 1, "admin", "back to a"), (2, 1, "admin", "revive"),
                                 (3, 1, "admin", "same as current"), (4, 1, "admin", "missing")],
                                ROLLBACK_REQUESTS)
    res = rollback_versions(d, req, as_of)
    rows = {r.zone_dim_sk: r for r in res.dim.collect()}
    new = {r.location_id: r for r in rows.values() if r.record_status == "ROLLED_BACK"}
    assert new[1].version_number == 3 and new[1].zone == "a" and new[1].is_current
    assert new[1].change_source == "rollback_procedure" and new[1].approved_by is None
    assert rows[2].is_current is False and rows[2].effective_to == as_of
    assert new[2].version_number == 2 and new[2].zone == "c"
    assert new[3].version_number == 2 and new[3].zone == "d" and rows[4].effective_to == as_of
    assert [(e.location_id, e.error) for e in res.errors.collect()] == \
        [(4, "Target version 1 not found for location_id 4")]
    ch = spark.createDataFrame([dict(seq=1, location_id=1, borough="b", zone="z",
                                     service_zone=None, created_by="u", change_reason=None,
                                     change_source=None, changed_at=as_of + h)],
                               UPSERT_REQUESTS)
    up = upsert_zone_scd2(res.dim, ch)
    assert [(r.version_number, r.outcome) for r in up.results.collect()] == [(4, "new_version")]


def test_pipeline_query_joins_its_trips_once(spark, monkeypatch):
    """The three runs read one landed copy of the trips."""
    from tripmart.plans import registry

    made, staged = [], []
    curated, run = registry.td.curated_trips, registry.run_pipeline
    monkeypatch.setattr(registry.td, "curated_trips",
                        lambda *a: made.append(a) or curated(*a))
    monkeypatch.setattr(registry, "run_pipeline",
                        lambda s, trips, *a, **k: staged.append(trips) or run(s, trips, *a, **k))
    out = registry.q_pipeline_run(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == 20 and len(made) == 1 and len(staged) == 3
    for trips in staged:
        assert "Join" not in trips._jdf.queryExecution().optimizedPlan().toString()
