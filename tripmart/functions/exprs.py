"""Scalar and aggregate column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz(value) -> Column:
    """A zone-less timestamp: a Column is kept, a datetime or text becomes a
    literal. Built from text, so neither the Python process's zone nor the
    session zone can shift it."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def to_int(col) -> Column:
    """``x::integer``. Under ANSI mode an out-of-range value raises, as in the
    reference's database, instead of wrapping."""
    return _c(col).cast("int")


def as_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types, as a typed table takes
    them in: fractions go to the nearest integer (half to even), and under ANSI
    mode what does not fit its type raises."""
    cols = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType) and isinstance(
                df.schema[f.name].dataType, (T.DoubleType, T.FloatType)):
            value = F.rint(value)
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def duration_seconds(pickup, dropoff) -> Column:
    """Whole seconds from ``pickup`` to ``dropoff``, rounded half away from
    zero (0.4 -> 0, 1.5 -> 2, 2.5 -> 3, -2.5 -> -3); NULL if either is NULL.

    Exact decimal arithmetic on the interval; rounding of a decimal is
    HALF_UP (away from zero). Zone-less timestamps subtract without any
    daylight-saving jump.
    """
    gap = (_c(dropoff) - _c(pickup)).cast("interval second").cast("decimal(18,6)")
    return to_int(F.round(gap, 0))


def null_if_negative(col) -> Column:
    """``CASE WHEN x < 0 THEN NULL ELSE x END``: NULL stays NULL."""
    return F.when(~(_c(col) < 0), _c(col))


def status_rank(col) -> Column:
    """0 when the status equals 'ACTIVE' ignoring case, else 1 (NULL -> 1)."""
    return F.when(_c(col).ilike("ACTIVE"), F.lit(0)).otherwise(F.lit(1))


def bool_to_int(pred: Column) -> Column:
    """``(pred)::int``; NULL stays NULL."""
    return pred.cast("int")


def same_text(a, b) -> Column:
    """Equality where NULL and the empty string are the same value."""
    return F.coalesce(_c(a), F.lit("")) == F.coalesce(_c(b), F.lit(""))


def author_or_user(col, user: str | None = None) -> Column:
    """``COALESCE(p_created_by, current_user)``; ``user`` overrides the session user."""
    fallback = F.lit(user) if user is not None else F.current_user()
    return F.coalesce(_c(col), fallback)


def rate6(hits: Column, total: Column) -> Column:
    """``hits / total`` rounded half-up to 6 decimals as DECIMAL(10,6).

    Exact integer arithmetic: round(h/n * 1e6) = floor((2*h*1e6 + n) / (2*n)).
    NULL when ``total`` is 0 (the average of no rows).
    """
    h = hits.cast("decimal(38,0)")
    n = total.cast("decimal(38,0)")
    numerator = h * F.lit(2 * MICROS_PER_SECOND) + n
    denominator = n * F.lit(2)
    # integer division, exact in decimal: (a - a mod b) / b
    scaled = ((numerator - numerator % denominator) / denominator).cast("decimal(38,0)")
    value = scaled / F.lit(MICROS_PER_SECOND).cast("decimal(7,0)")
    return F.when(total > 0, value.cast("decimal(10,6)"))


def fill_rate(col) -> Column:
    """Aggregate: ``AVG((col IS NOT NULL)::int)::numeric(10,6)``."""
    return rate6(F.count(_c(col)), F.count(F.lit(1)))


def violation_count(pred: Column) -> Column:
    """Aggregate: ``SUM((pred)::int)::bigint``.

    Rows where the predicate is NULL are skipped; the result is NULL (not 0)
    when no row has a non-NULL predicate. ``count_if`` would give 0.
    """
    return F.sum(bool_to_int(pred)).cast("bigint")
