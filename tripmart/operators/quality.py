"""M1 metrics, U1 threshold tests, C8 audit-row check, O2 latest results.

M1 is one global aggregate: every task folds its rows into a partial result
and one row per task crosses the network. U1 turns that single row into ten
test rows with a generator; nothing else scans the fact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import fill_rate, ntz, violation_count
from tripmart.schemas import METRIC_DECIMAL

# --- fixed values: metric columns in report order --------------------------------
METRIC_COLUMNS = [
    "total_rows",
    "pickup_ts_fill_rate", "dropoff_ts_fill_rate", "total_amount_fill_rate",
    "bad_time_order_count", "negative_distance_count", "negative_duration_count",
    "pu_zone_fill_rate", "do_zone_fill_rate", "ratecode_name_fill_rate",
]


def metric_columns() -> list[Column]:
    """The ten metrics as aggregates, for a query or for a write that observes them."""
    return [
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        fill_rate("pickup_ts").alias("pickup_ts_fill_rate"),
        fill_rate("dropoff_ts").alias("dropoff_ts_fill_rate"),
        fill_rate("total_amount").alias("total_amount_fill_rate"),
        violation_count(F.col("dropoff_ts") < F.col("pickup_ts")).alias("bad_time_order_count"),
        violation_count(F.col("trip_distance") < 0).alias("negative_distance_count"),
        violation_count(F.col("trip_duration_seconds") < 0).alias("negative_duration_count"),
        fill_rate("pu_zone").alias("pu_zone_fill_rate"),
        fill_rate("do_zone").alias("do_zone_fill_rate"),
        fill_rate("ratecode_name").alias("ratecode_name_fill_rate"),
    ]


def dq_metrics(fct: DataFrame) -> DataFrame:
    """One row of ten metrics over the fact (NULL rates on an empty fact)."""
    return fct.agg(*metric_columns())


# --- fixed values: the ten data tests ----------------------------------------
# (test name, metric, comparison, compared with, threshold stored, details)
DQ_TESTS = [
    ("core.fct_trips has rows", "total_rows", ">", "0", "1",
     "Expect at least 1 row in core.fct_trips"),
    ("pickup_ts_fill_rate >= 1.00", "pickup_ts_fill_rate", ">=", "1.00", "1.00",
     "Pickup timestamp should be present for all rows"),
    ("dropoff_ts_fill_rate >= 1.00", "dropoff_ts_fill_rate", ">=", "1.00", "1.00",
     "Dropoff timestamp should be present for all rows"),
    ("total_amount_fill_rate >= 1.00", "total_amount_fill_rate", ">=", "1.00", "1.00",
     "Total amount should be present for all rows"),
    ("bad_time_order_count = 0", "bad_time_order_count", "=", "0", "0",
     "No rows should have dropoff_ts < pickup_ts"),
    ("negative_distance_count = 0", "negative_distance_count", "=", "0", "0",
     "No rows should have negative trip_distance"),
    ("negative_duration_count = 0", "negative_duration_count", "=", "0", "0",
     "No rows should have negative trip_duration_seconds"),
    ("pu_zone_fill_rate >= 0.99", "pu_zone_fill_rate", ">=", "0.99", "0.99",
     "Pickup zone should be enriched for >= 99% rows"),
    ("do_zone_fill_rate >= 0.99", "do_zone_fill_rate", ">=", "0.99", "0.99",
     "Dropoff zone should be enriched for >= 99% rows"),
    ("ratecode_name_fill_rate >= 0.70", "ratecode_name_fill_rate", ">=", "0.70", "0.70",
     "Ratecode name enrichment is informational; require >= 70%"),
]

_OPS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "=": lambda a, b: a == b,
}


def _dec(text: str) -> Column:
    return F.lit(Decimal(text)).cast(METRIC_DECIMAL)


def dq_test_rows(metrics: DataFrame) -> DataFrame:
    """(test_name, passed, metric_value, threshold, details) per test.

    A NULL comparison (empty fact, or every input NULL) is recorded as
    ``passed = false`` with the NULL metric: failures are visible, and
    ``passed`` is NOT NULL in the results table.
    """
    rows = []
    for name, metric, op, bound, stored, details in DQ_TESTS:
        value = F.col(metric).cast(METRIC_DECIMAL)
        passed = F.coalesce(_OPS[op](value, _dec(bound)), F.lit(False))
        rows.append(F.struct(F.lit(name).alias("test_name"), passed.alias("passed"),
                             value.alias("metric_value"), _dec(stored).alias("threshold"),
                             F.lit(details).alias("details")))
    return metrics.select(F.inline(F.array(*rows)))


def dq_tests(metrics: DataFrame, run_ts, run_by: str | None = None) -> DataFrame:
    """Audit rows in the results-table layout, one uuid per row.

    ``run_ts`` is the run clock (one value for the whole run); ``run_by``
    defaults to the session user.
    """
    ts = run_ts if isinstance(run_ts, Column) else ntz(run_ts).cast("timestamp")
    user = F.lit(run_by) if run_by is not None else F.current_user()
    return (dq_test_rows(metrics)
            .select(F.expr("uuid()").alias("test_run_id"), "test_name", "passed",
                    "metric_value", "threshold", "details",
                    ts.alias("created_at"), user.alias("created_by")))


def audit_row_violations(results: DataFrame) -> DataFrame:
    """Rows that would break NOT NULL on the audit table."""
    return results.filter(F.col("test_name").isNull() | F.col("passed").isNull())


def latest_test_results(results: DataFrame) -> DataFrame:
    """O2: the results log, newest first."""
    return results.orderBy(F.col("created_at").desc())


def tests_executed(results: DataFrame) -> DataFrame:
    """A5: number of test rows of a run (10; the reference's count gives 1)."""
    return results.agg(F.count(F.lit(1)).alias("tests_executed"))
