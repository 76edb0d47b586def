"""P1-P16 expressions and the curated-trip normaliser on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tripmart.functions import (
    duration_seconds,
    fill_rate,
    null_if_negative,
    rate6,
    same_text,
    status_rank,
    violation_count,
)
from tripmart.schemas import CURATED_COLUMNS
from tripmart.sources.curated import (
    AmbiguousColumnsError,
    MissingColumnsError,
    missing_columns,
    normalize_columns,
    to_canonical,
)


def test_duration_rounds_half_away_from_zero_and_ignores_dst(spark):
    base = dt.datetime(2024, 3, 10, 0, 0, 0)
    pairs = [(base, base + dt.timedelta(seconds=0.4)),
             (base, base + dt.timedelta(seconds=1.5)),
             (base, base + dt.timedelta(seconds=2.5)),
             (base + dt.timedelta(seconds=2.5), base),
             (dt.datetime(2024, 3, 10, 1, 59, 59), dt.datetime(2024, 3, 10, 3, 0, 0)),
             (base, None)]
    df = spark.createDataFrame(pairs, "p timestamp_ntz, d timestamp_ntz")
    got = [r[0] for r in df.select(duration_seconds("p", "d")).collect()]
    assert got == [0, 2, 3, -3, 3601, None]


def test_duration_overflow_raises(spark):
    df = spark.createDataFrame([(dt.datetime(1900, 1, 1), dt.datetime(2100, 1, 1))],
                               "p timestamp_ntz, d timestamp_ntz")
    with pytest.raises(Exception):
        df.select(duration_seconds("p", "d")).collect()


def test_integer_cast_of_large_location_raises(spark):
    df = spark.createDataFrame([(2 ** 31 + 5,)], "x long")
    with pytest.raises(Exception):
        df.select(F.col("x").cast("int")).collect()


def test_null_if_negative_and_status_rank(spark):
    df = spark.createDataFrame([(-1.0, "ACTIVE"), (0.0, "Active"), (None, None), (2.0, "RETIRED")],
                               "x double, s string")
    got = df.select(null_if_negative("x").alias("x"), status_rank("s").alias("r")).collect()
    assert [tuple(r) for r in got] == [(None, 0), (0.0, 0), (None, 1), (2.0, 1)]


def test_same_text_treats_null_as_empty(spark):
    df = spark.createDataFrame([(None, ""), ("a", "a"), ("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(same_text("a", "b")).collect()] == [True, True, False, True]


def test_rates_round_half_up_before_threshold(spark):
    row = spark.range(1).select(rate6(F.lit(9999996), F.lit(10000000)).alias("a"),
                                rate6(F.lit(1), F.lit(128)).alias("b"),
                                rate6(F.lit(0), F.lit(0)).alias("c")).first()
    assert row.a == Decimal("1.000000") and row.b == Decimal("0.007813") and row.c is None


def test_fill_rate_and_violation_count_null_rules(spark):
    df = spark.createDataFrame([(None,), (None,)], "d double")
    r = df.agg(fill_rate("d").alias("f"), violation_count(F.col("d") < 0).alias("v")).first()
    assert r.f == Decimal("0.000000") and r.v is None
    empty = spark.createDataFrame([], "d double")
    r = empty.agg(fill_rate("d").alias("f"), violation_count(F.col("d") < 0).alias("v")).first()
    assert r.f is None and r.v is None


def _raw_row(**over):
    values = {c: None for c in CURATED_COLUMNS}
    values.update(over)
    return values


def test_normaliser_renames_checks_and_orders(spark):
    raw = spark.createDataFrame([Row(VendorID=1, PULocationID=3, Airport_fee=1.25, extra_col="x")])
    renamed = normalize_columns(raw)
    assert renamed.columns == ["vendorid", "pulocationid", "airport_fee", "extra_col"]
    missing = missing_columns(renamed)
    assert "vendorid" not in missing and "tpep_pickup_datetime" in missing
    with pytest.raises(MissingColumnsError) as err:
        to_canonical(raw)
    assert "Available columns" in str(err.value)
    full = spark.createDataFrame([_raw_row(vendorid=1)],
                                 ", ".join(f"{c} string" for c in CURATED_COLUMNS))
    full = full.withColumn("junk", F.lit(1))
    assert to_canonical(full).columns == CURATED_COLUMNS


def test_normaliser_refuses_two_sources_for_one_name(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        raw = spark.createDataFrame([(1.0, 2.0)], "Airport_fee double, airport_fee double")
        with pytest.raises(AmbiguousColumnsError):
            normalize_columns(raw)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
