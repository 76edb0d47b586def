"""Column expressions. All are built-in Spark expressions (no Python UDF),
so they stay inside whole-stage code generation."""

from tripmart.functions.exprs import (  # noqa: F401
    as_table,
    author_or_user,
    bool_to_int,
    duration_seconds,
    fill_rate,
    ntz,
    null_if_negative,
    rate6,
    same_text,
    status_rank,
    to_int,
    violation_count,
)
