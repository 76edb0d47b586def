"""Integrity rules of the zone dimension as checks.

The reference declares C1-C5 as constraints and states C6, C7 as intent.
Each rule here is a filter or a partial aggregate (one row per task and key
before the shuffle), and C7 uses the skew-safe ``next_in_key`` scan, so a
location with very many versions does not land in one task.

Output: one row per violation: rule, location_id, zone_dim_sk,
version_number, detail (columns that do not apply to a rule are NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.sequence import next_in_key
from tripmart.schemas import ZONE_STATUSES

# --- fixed values: NOT NULL columns of the dimension besides the key ----------
NOT_NULL_COLUMNS = ["location_id", "version_number", "effective_from", "is_current",
                    "record_status", "created_at", "created_by"]

VIOLATION_COLUMNS = ["rule", "location_id", "zone_dim_sk", "version_number", "detail"]


def _violation(rule: str, broken: Column, detail: Column, loc=True, sk=True,
               ver=True) -> Column:
    """A violation as a struct, or NULL where the rule holds."""
    def pick(use, name, dtype):
        return (F.col(name) if use else F.lit(None)).cast(dtype).alias(name)

    return F.when(broken, F.struct(F.lit(rule).alias("rule"), pick(loc, "location_id", "int"),
                                   pick(sk, "zone_dim_sk", "long"),
                                   pick(ver, "version_number", "int"), detail.alias("detail")))


def _violations(rows: DataFrame, found: list[Column]) -> DataFrame:
    return rows.select(F.inline(F.filter(F.array(*found), lambda v: v.isNotNull())))


def dim_checks(dim: DataFrame) -> DataFrame:
    """All violations, from one pass over the rows (C2-C4 and C1's NULLs), an
    aggregate for each key (C1, C5, C6) and one ordered scan (C7)."""
    # --- per row
    per_row = [_violation("C1", F.col("zone_dim_sk").isNull(), F.lit("zone_dim_sk is NULL"),
                          sk=False)]
    per_row += [_violation("C2", F.col(c).isNull(), F.lit(f"{c} is NULL"))
                for c in NOT_NULL_COLUMNS]
    # a NULL status is C2's concern, as for a CHECK
    per_row.append(_violation("C3", ~F.col("record_status").isin(*ZONE_STATUSES),
                              F.concat(F.lit("record_status "), F.col("record_status"))))
    per_row.append(_violation("C4", F.col("effective_to") <= F.col("effective_from"),
                              F.lit("effective_to not after effective_from")))
    out = _violations(dim, per_row)
    # --- per key
    for keys, rows, rule, detail in (
            (["zone_dim_sk"], F.col("zone_dim_sk").isNotNull(), "C1", "duplicate zone_dim_sk"),
            (["location_id"], F.col("is_current"), "C5", "more than one current row"),
            (["location_id", "version_number"], F.lit(True), "C6", "duplicate version_number")):
        groups = dim.filter(rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        out = out.unionByName(_violations(groups, [_violation(
            rule, F.col("_n") > 1, F.lit(detail), *[k in keys for k in (
                "location_id", "zone_dim_sk", "version_number")])]))
    # --- in start order: windows of a location do not overlap (a NULL start is
    # C2's concern)
    base = dim.filter(F.col("effective_from").isNotNull()).select("location_id", "zone_dim_sk", "version_number", "effective_from",
                      "effective_to")
    nxt = next_in_key(base, "location_id", ["effective_from", "version_number", "zone_dim_sk"],
                      "effective_from", "_next_from")
    overlap = F.col("_next_from").isNotNull() & (
        F.col("effective_to").isNull() | (F.col("effective_to") > F.col("_next_from")))
    return out.unionByName(_violations(nxt, [_violation(
        "C7", overlap, F.lit("window overlaps the next version"))]))
