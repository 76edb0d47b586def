"""Paths for large data: many ranges, ranges of two levels, joins without a
broadcast, snapshots without markers, clocks under another zone."""

import datetime as dt
import random
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from tripmart.operators import pit
from tripmart.operators.pit import zone_as_of
from tripmart.operators.scd2 import empty_dim, upsert_zone_scd2
from tripmart.operators.sequence import FIRST_LEVEL, next_in_key, profile_order
from tripmart.plans.load import load_trips
from tripmart.plans.pipeline import apply_governed_batch
from tripmart.schemas import CURATED_TRIPS, STAGING_TRIPS, UPSERT_REQUESTS, ZONE_DIM
from tripmart.session import checkpoint_dir, removing_cuts, cut_lineage
from tripmart.sources.sinks import (
    SnapshotError,
    list_snapshots,
    publish_snapshot,
    read_latest,
    snapshot_path,
)

T0 = dt.datetime(2024, 6, 1)


def test_ranges_are_even_beyond_the_first_level(spark):
    rows, per = 200_000, 50
    df = spark.range(rows).withColumn("v", F.xxhash64("id"))
    chunks = profile_order(df, "v", per)
    assert chunks.count > FIRST_LEVEL and chunks.finer is not None
    ranged = chunks.assign(df, "c")
    sizes = ranged.groupBy("c").agg(F.count("*").alias("n"), F.min("v").alias("a"),
                                    F.max("v").alias("b")).orderBy("c").collect()
    assert sum(r.n for r in sizes) == rows
    assert max(r.n for r in sizes) <= 1.5 * rows / len(sizes)
    assert all(x.b < y.a for x, y in zip(sizes, sizes[1:]))


@pytest.mark.parametrize("per", [100_000, 700, 2])
def test_next_in_key_same_at_any_number_of_ranges(spark, per):
    df = spark.range(4000).select((F.col("id") % 7).alias("id7"), F.col("id").alias("id"),
                                  (F.xxhash64("id") % 1000).alias("t"))
    df = df.withColumn("k", F.when(F.col("id7") > 0, F.least(F.col("id7"), F.lit(2))))
    got = next_in_key(df, "k", ["t", "id"], "t", "nxt", rows_per_chunk=per)
    want = df.withColumn("nxt", F.expr("lead(t) over (partition by k order by t, id)"))
    assert sorted(map(str, got.select("id", "k", "t", "nxt").collect())) == sorted(
        map(str, want.select("id", "k", "t", "nxt").collect()))


def _version(sk, loc, start, end):
    return dict(zone_dim_sk=sk, location_id=loc, borough="B", zone=f"z{sk}", service_zone=None,
                version_number=sk, effective_from=start, effective_to=end,
                is_current=end is None, record_status="APPROVED", change_reason=None,
                change_source=None, created_at=start, created_by="u", approved_at=None,
                approved_by=None)


@pytest.mark.parametrize("options", [{"max_broadcast_rows": 0, "rows_per_chunk": 3},
                                     {"strategy": "ranges"}, {"strategy": "broadcast"}])
def test_overlapping_windows_have_one_answer(spark, options):
    day = [T0 + dt.timedelta(days=i) for i in range(12)]
    dim = spark.createDataFrame([_version(1, 1, day[0], day[10]), _version(2, 1, day[2], day[3]),
                                 _version(3, 1, day[10], None)], ZONE_DIM)
    facts = spark.createDataFrame([(1, 1, day[4]), (2, 1, day[2]), (3, None, day[2]), (4, 1, None),
                                   (5, 1, day[3]), (6, 1, day[10]), (7, 9, day[1])],
                                  "id int, loc int, at timestamp_ntz")
    got = sorted((r.id, r.zone_dim_sk or 0) for r in
                 zone_as_of(facts, dim, "loc", "at", **options).collect())
    assert got == [(1, 1), (2, 1), (2, 2), (3, 0), (4, 0), (5, 1), (6, 3), (7, 0)]


def _change(seq, loc, zone, day):
    return dict(seq=seq, location_id=loc, borough="B", zone=zone, service_zone=None,
                created_by="u", change_reason=None, change_source=None,
                changed_at=T0 + dt.timedelta(days=day))


def test_unchanged_requests_are_answered_whatever_their_time(spark):
    dim = spark.createDataFrame([_version(1, 1, T0, None)], ZONE_DIM)
    same = dict(zone="z1")["zone"]
    changes = [_change(1, 1, same, 5), _change(2, 1, same, 5), _change(3, 1, same, -3),
               _change(4, 1, "new", 4), _change(1, 2, "a", 1), _change(2, 2, "b", 2),
               _change(2, 3, "x", 1), _change(2, 3, "y", 2)]
    res = upsert_zone_scd2(dim, spark.createDataFrame(changes, UPSERT_REQUESTS))
    out = {(r.location_id, r.seq): (r.zone_dim_sk, r.outcome) for r in res.results.collect()}
    assert out == {(1, 1): (1, "unchanged"), (1, 2): (1, "unchanged"), (1, 3): (1, "unchanged"),
                   (1, 4): (2, "new_version"), (2, 1): (3, "created"), (2, 2): (4, "new_version")}
    assert sorted((r.location_id, r.seq) for r in res.errors.collect()) == [(3, 2), (3, 2)]


def test_snapshots_do_not_depend_on_the_committer(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for n, loc in enumerate((1, 2), 1):
            batch = spark.createDataFrame([_change(1, loc, "a", 1)], UPSERT_REQUESTS)
            apply_governed_batch(spark, f"{tmp_path}/dim", T0, upserts=batch)
            assert read_latest(spark, f"{tmp_path}/dim", ZONE_DIM).count() == n
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_unreadable_root_is_an_error(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert read_latest(spark, root) is None
    spark.range(1).write.parquet(snapshot_path(root, 1))  # a write that was never completed
    with pytest.raises(SnapshotError):
        read_latest(spark, root)
    publish_snapshot(spark.range(3), root)
    assert list_snapshots(spark, root) == [2]


def test_cut_tables_are_removed(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(f"{base}/tables")) if os.path.isdir(f"{base}/tables") else set()
    with removing_cuts(spark):
        assert cut_lineage(spark.range(3)).count() == 3
    assert set(os.listdir(f"{base}/tables")) == before
    apply_governed_batch(spark, f"{base}/removed", T0, upserts=spark.createDataFrame(
        [_change(1, 1, "a", 1)], UPSERT_REQUESTS))
    assert set(os.listdir(f"{base}/tables")) == before


def test_load_casts_to_the_staging_types(spark, tmp_path):
    row = {f.name: None for f in CURATED_TRIPS.fields} | {"vendorid": 1, "passenger_count": 2.0,
                                                          "ratecodeid": 3}
    kinds = ", ".join(f"{f.name} " + {"passenger_count": "double", "ratecodeid": "int",
                                      "vendorid": "bigint"}.get(f.name, f.dataType.simpleString())
                      for f in CURATED_TRIPS.fields)
    spark.createDataFrame([row], kinds).write.parquet(f"{tmp_path}/in")
    report = load_trips(spark, f"{tmp_path}/in", f"{tmp_path}/out", loaded_at=T0)
    got = spark.read.schema(STAGING_TRIPS).parquet(report.target).first()
    assert (got.passenger_count, got.ratecodeid, got.vendorid, report.rows) == (2, 3, 1, 1)


def test_clocks_ignore_the_zone_of_the_process(tmp_path):
    code = """
import datetime as dt
import random
from tripmart.operators.quality import dq_tests
from tripmart.session import get_spark
spark = get_spark("local[1]")
m = spark.sql("select 1L total_rows, 1.0 pickup_ts_fill_rate, 1.0 dropoff_ts_fill_rate, "
              "1.0 total_amount_fill_rate, 0L bad_time_order_count, 0L negative_distance_count, "
              "0L negative_duration_count, 1.0 pu_zone_fill_rate, 1.0 do_zone_fill_rate, "
              "1.0 ratecode_name_fill_rate")
t = dq_tests(m, dt.datetime(2024, 6, 1), "x").selectExpr("cast(created_at as string) s").first().s
print("CLOCK", t)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                         env=os.environ | {"TZ": "America/New_York", "PYTHONPATH": ROOT},
                         timeout=300)
    assert "CLOCK 2024-06-01 00:00:00" in out.stdout, out.stderr[-2000:]


def test_empty_dim_takes_a_first_batch(spark):
    res = upsert_zone_scd2(empty_dim(spark), spark.createDataFrame(
        [_change(1, 5, "a", 1)], UPSERT_REQUESTS), rows_per_chunk=1)
    assert [r.version_number for r in res.dim.collect()] == [1]


def test_results_and_history_are_ordered(spark):
    """O1, O2."""
    from tripmart.operators.quality import latest_test_results
    from tripmart.operators.scd2 import version_history
    from tripmart.schemas import HISTORY_REQUESTS

    dim = spark.createDataFrame([_version(3, 1, T0, None), _version(1, 1, T0, T0),
                                 _version(2, 0, T0, None)], ZONE_DIM)
    req = spark.createDataFrame([(1, None, None), (0, None, None)], HISTORY_REQUESTS)
    got = [(r.location_id, r.version_number) for r in version_history(dim, req).collect()]
    assert got == [(0, 2), (1, 1), (1, 3)]
    log = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=2),), (T0 + dt.timedelta(days=1),)],
                                "created_at timestamp")
    days = [r.created_at for r in latest_test_results(log).collect()]
    assert days == sorted(days, reverse=True)


def test_versions_and_cells_meet_by_number_only(spark, monkeypatch):
    """A location's versions times its ranges are never made: every join of the
    range plan has a second key, and the answer stays that of the broadcast."""
    monkeypatch.setattr(pit, "BLOCK", 3)
    rng = random.Random(4)
    moment = [T0 + dt.timedelta(hours=i) for i in range(300)]
    rows = []
    for sk in range(1, 200):
        start = rng.randrange(300)
        end = rng.choice([None, start, start + 1, start + 30, 10 ** 3])
        rows.append(_version(sk, rng.choice([1, 1, 2, 3]), moment[start], None if end is None else
                             moment[0] + dt.timedelta(hours=end, minutes=rng.choice([-20, 0]))))
    dim = spark.createDataFrame(rows, ZONE_DIM)
    facts = spark.createDataFrame(
        [(i, rng.choice([1, 1, 1, 2, 4, None]), rng.choice([None, *moment[60:200]]))
         for i in range(300)], "id int, loc int, at timestamp_ntz")
    got = zone_as_of(facts, dim, "loc", "at", strategy="ranges", rows_per_chunk=2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join " in line]
    assert len(joins) >= 2 and all(line.count(" = ") >= 2 for line in joins)
    want = zone_as_of(facts, dim, "loc", "at", strategy="broadcast")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_search_makes_the_order_value_once(spark):
    """Both levels of a search compare one column, not the expression behind it."""
    times = [T0 + dt.timedelta(seconds=(7 * i) % 5000) for i in range(5000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)] + [(-1, None)],
                               "id int, at timestamp_ntz")
    chunks = profile_order(df, "at", 2)
    assert chunks.finer is not None
    got = chunks.assign(df, "c")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("timestampdiff(") == 1
    assert got.columns == ["id", "at", "c"]
    fine = {r["_l1"]: r["_l2_bounds"] for r in chunks.finer.collect()}
    for r in got.collect():
        v = None if r.at is None else (r.at - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        high = 0 if v is None else sum(b <= v for b in chunks.bounds)
        low = 0 if v is None else sum(b <= v for b in fine[high] or [])
        assert r.c == high * chunks.finer_count + low


def test_versions_are_searched_once_in_stages_of_their_own(spark, monkeypatch):
    written = []

    def cut(df, name="intermediate"):
        written.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return cut_lineage(df, name)

    monkeypatch.setattr(pit, "cut_lineage", cut)
    dim = spark.createDataFrame([_version(i, 1, T0 + dt.timedelta(hours=i), None)
                                 for i in range(1, 20)], ZONE_DIM)
    facts = spark.createDataFrame([(i, 1, T0 + dt.timedelta(hours=i)) for i in range(40)],
                                  "id int, loc int, at timestamp_ntz")
    got = zone_as_of(facts, dim, "loc", "at", strategy="ranges", rows_per_chunk=4)
    plans = written + [("answer", got._jdf.queryExecution().optimizedPlan().toString())]
    searched = {name: re.findall(r"timestampdiff\([^#]*_(from|to)#", plan)
                for name, plan in plans}
    assert {name: ends for name, ends in searched.items() if ends} == {
        "pit_lows": ["from"], "pit_spans": ["to"]}
    assert got.count() == sum(max(1, min(i, 19)) for i in range(40))
