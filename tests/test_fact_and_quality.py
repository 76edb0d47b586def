"""B1 fact build, W1-W3, F1, F2, J1-J3 on hand-made rows; M1/U1; plan shape."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tripmart.operators.latest import current_zones, in_effect, latest_rate, seed_candidates
from tripmart.operators.quality import DQ_TESTS, dq_metrics, dq_test_rows
from tripmart.plans.fact import build_fct_trips
from tripmart.schemas import CURATED_TRIPS, FACT_COLUMNS, RATE_MASTER, ZONE_MASTER

T = dt.datetime(2024, 5, 1, 8, 0, 0)
AS_OF = dt.datetime(2024, 6, 1)


def trip(**kw):
    row = {f.name: None for f in CURATED_TRIPS.fields}
    row.update(vendorid=1, tpep_pickup_datetime=T, tpep_dropoff_datetime=T + dt.timedelta(minutes=5),
               passenger_count=1, trip_distance=1.0, ratecodeid=1, pulocationid=1, dolocationid=2,
               total_amount=10.0, pu_zone="STALE", do_zone="STALE")
    row.update(kw)
    return row


def zone(loc, name, status="ACTIVE", version=1, frm=dt.datetime(2020, 1, 1), to=None):
    return dict(location_id=loc, borough="b", zone=name, service_zone="s", record_status=status,
                version=version, effective_from=frm, effective_to=to, updated_at=None,
                created_at=None)


def masters(spark):
    rates = spark.createDataFrame([(1, "old", 1), (1, "null-version", None), (1, "new", 2),
                                   (2, "two", 1)], RATE_MASTER)
    zones = spark.createDataFrame([
        zone(1, "active-low", "Active", 1), zone(1, "retired-high", "RETIRED", 9),
        zone(2, "only-retired", "RETIRED", 3),
        zone(3, "future", frm=dt.datetime(2099, 1, 1)),
        zone(4, "ends-at-as-of", to=AS_OF), zone(4, "starts-at-as-of", frm=AS_OF, version=0),
        zone(5, "null-from", frm=None),
        zone(None, "null-location"),
    ], ZONE_MASTER)
    return rates, zones


def test_latest_rate_prefers_null_version(spark):
    rates, _ = masters(spark)
    got = {r.ratecode_id: r.ratecode_name for r in latest_rate(rates).collect()}
    assert got == {1: "null-version", 2: "two"}


def test_current_zone_rules(spark):
    _, zones = masters(spark)
    got = {r.location_id: r.zone for r in current_zones(zones, AS_OF).collect()}
    assert got[1] == "active-low"          # ACTIVE in any case beats a higher version
    assert got[2] == "only-retired"        # a retired row still wins alone
    assert 3 not in got and 5 not in got   # future start, NULL start
    assert got[4] == "starts-at-as-of"     # start = as_of is in, end = as_of is out
    assert got[None] == "null-location"
    eff = in_effect(zones, AS_OF).filter(F.col("location_id") == 4).collect()
    assert [r.zone for r in eff] == ["starts-at-as-of"]


def test_seed_candidates_ignore_effective_window(spark):
    _, zones = masters(spark)
    got = {r.location_id: r.zone for r in seed_candidates(zones).collect()}
    assert got[3] == "future" and got[5] == "null-from"


def test_fact_filter_and_enrichment(spark):
    rates, zones = masters(spark)
    rows = [
        trip(trip_distance=-1.0),                                   # kept, distance NULL
        trip(trip_distance=0.0),
        trip(trip_distance=None),
        trip(tpep_dropoff_datetime=T),                              # zero length kept
        trip(total_amount=0.0), trip(total_amount=-5.0),            # kept
        trip(total_amount=None),                                    # dropped
        trip(tpep_pickup_datetime=None),                            # dropped
        trip(tpep_dropoff_datetime=T - dt.timedelta(seconds=1)),    # dropped
        trip(pulocationid=None, dolocationid=99, ratecodeid=7),     # kept, unenriched
    ]
    staging = spark.createDataFrame(rows, CURATED_TRIPS)
    fct = build_fct_trips(staging, rates, zones, AS_OF)
    assert fct.columns == FACT_COLUMNS
    got = fct.collect()
    assert len(got) == 7
    assert sorted((r.trip_distance is None) for r in got).count(True) == 2
    assert all(r.pu_zone != "STALE" and r.do_zone != "STALE" for r in got)
    unenriched = [r for r in got if r.pu_location_id is None]
    assert unenriched[0].pu_zone is None and unenriched[0].ratecode_name is None
    assert {r.ratecode_name for r in got if r.ratecode_id == 1} == {"null-version"}
    assert {r.trip_duration_seconds for r in got} == {300, 0}


def test_fact_plan_broadcasts_reused_and_no_python(spark):
    rates, zones = masters(spark)
    staging = spark.createDataFrame([trip()], CURATED_TRIPS)
    fct = build_fct_trips(staging, rates, zones, AS_OF)
    fct.collect()
    plan = fct._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3
    assert "ReusedExchange" in plan
    best = latest_rate(rates)
    best.collect()
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_metrics_and_tests_on_fact(spark):
    rates, zones = masters(spark)
    staging = spark.createDataFrame([trip(), trip(pulocationid=77)], CURATED_TRIPS)
    fct = build_fct_trips(staging, rates, zones, AS_OF)
    m = dq_metrics(fct).first()
    assert m.total_rows == 2 and m.pu_zone_fill_rate == Decimal("0.500000")
    tests = {r.test_name: r for r in dq_test_rows(dq_metrics(fct)).collect()}
    assert len(tests) == len(DQ_TESTS) == 10
    assert tests["core.fct_trips has rows"].passed
    assert tests["core.fct_trips has rows"].threshold == Decimal("1.000000")
    assert not tests["pu_zone_fill_rate >= 0.99"].passed


def test_tests_fail_visibly_on_empty_fact(spark):
    rates, zones = masters(spark)
    empty = spark.createDataFrame([], CURATED_TRIPS)
    tests = dq_test_rows(dq_metrics(build_fct_trips(empty, rates, zones, AS_OF))).collect()
    assert len(tests) == 10 and not any(t.passed for t in tests)
    assert all(t.metric_value is None for t in tests if t.test_name != "core.fct_trips has rows")


def test_tests_fail_on_unfiltered_input(spark):
    rows = spark.createDataFrame(
        [(None, T, -1.0, -3), (T, T - dt.timedelta(seconds=3), 1.0, 2)],
        "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, trip_distance double, "
        "trip_duration_seconds int").withColumns({
            "total_amount": F.lit(None).cast("double"), "pu_zone": F.lit("z"),
            "do_zone": F.lit("z"), "ratecode_name": F.lit("r")})
    tests = {r.test_name: r.passed for r in dq_test_rows(dq_metrics(rows)).collect()}
    for name in ["pickup_ts_fill_rate >= 1.00", "total_amount_fill_rate >= 1.00",
                 "bad_time_order_count = 0", "negative_distance_count = 0",
                 "negative_duration_count = 0"]:
        assert tests[name] is False


def _ancestors(plan: str, needle: str) -> list[str]:
    lines = plan.splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if needle in line:
            out, d = [], depth(line)
            for j in range(i - 1, -1, -1):
                if depth(lines[j]) < d:
                    out.append(lines[j].strip())
                    d = depth(lines[j])
            return out
    raise AssertionError(f"{needle} not in plan")


def test_trips_are_never_shuffled_in_the_fact(spark, tmp_path):
    rates, zones = masters(spark)
    path = str(tmp_path / "staging")
    spark.createDataFrame([trip(), trip(pulocationid=2)], CURATED_TRIPS).write.parquet(path)
    fct = build_fct_trips(spark.read.parquet(path), rates, zones, AS_OF)
    fct.collect()
    plan = fct._jdf.queryExecution().executedPlan().toString()
    above_scan = _ancestors(plan, "FileScan parquet")
    assert not any("Exchange" in line for line in above_scan)


def test_dq_tests_scan_the_fact_once(spark, tmp_path):
    rates, zones = masters(spark)
    path = str(tmp_path / "fct")
    staging = spark.createDataFrame([trip(), trip(pulocationid=2)], CURATED_TRIPS)
    build_fct_trips(staging, rates, zones, AS_OF).write.parquet(path)
    tests = dq_test_rows(dq_metrics(spark.read.parquet(path)))
    tests.collect()
    plan = tests._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "ReadSchema: struct<pickup_ts" in final      # 8 of 28 columns are read
