"""Batch SCD2 operators against the call-by-call model, with chunks forced
small so that every two-level scan path (many chunks per key) is used."""

import datetime as dt
import random

import pytest

from sequential_model import apply_approvals, apply_rollbacks, apply_upserts
from tripmart.operators.scd2 import (
    approve_versions,
    conform,
    empty_dim,
    rollback_versions,
    upsert_zone_scd2,
)
from tripmart.schemas import APPROVE_REQUESTS, ROLLBACK_REQUESTS, UPSERT_REQUESTS, ZONE_DIM

T0 = dt.datetime(2024, 6, 1)


def rows(df):
    return [r.asDict() for r in df.collect()]


def key(r):
    return tuple(sorted((k, str(v)) for k, v in r.items()))


def random_dim(rng, n_locs):
    out, sk = [], 0
    for loc in range(n_locs):
        versions = rng.randint(0, 3)
        t = T0
        for v in range(1, versions + 1):
            sk += 1
            last = v == versions
            nt = t + dt.timedelta(hours=rng.randint(1, 5))
            out.append(dict(zone_dim_sk=sk, location_id=loc, borough=rng.choice(["A", None, ""]),
                            zone=rng.choice(["z1", "z2", None]), service_zone=None,
                            version_number=v, effective_from=t,
                            effective_to=None if last else nt, is_current=last,
                            record_status=rng.choice(["DRAFT", "APPROVED"]), change_reason="r",
                            change_source="s", created_at=t, created_by="u",
                            approved_at=None, approved_by=None))
            t = nt
    return out


def random_changes(rng, n, n_locs, hot):
    out = []
    base = T0 + dt.timedelta(days=1)
    for i in range(n):
        loc = hot if rng.random() < 0.4 else rng.randrange(n_locs + 3)
        step = rng.choice([1, 1, 1, 0, -1]) if rng.random() < 0.1 else 1
        out.append(dict(seq=i * 3 + 7, location_id=loc,
                        borough=rng.choice(["A", "", None]),
                        zone=rng.choice(["z1", "z2", None, ""]),
                        service_zone=rng.choice([None, "", "s"]),
                        created_by=rng.choice(["analyst", None]),
                        change_reason=f"c{i}", change_source="feed",
                        changed_at=base + dt.timedelta(seconds=i * 10 + step * 10)))
    return out


@pytest.mark.parametrize("seed,rows_per_chunk", [(1, 7), (2, 7), (3, 7), (4, 3), (5, 40)])
def test_upsert_matches_sequential_model(spark, seed, rows_per_chunk):
    rng = random.Random(seed)
    dim_rows = random_dim(rng, 6)
    changes = random_changes(rng, 160, 6, hot=2)
    dim = spark.createDataFrame(dim_rows, ZONE_DIM) if dim_rows else empty_dim(spark)
    ch = spark.createDataFrame(changes, UPSERT_REQUESTS)
    res = upsert_zone_scd2(dim, ch, user="batch", rows_per_chunk=rows_per_chunk)
    exp_dim, exp_results, exp_errors = apply_upserts(dim_rows, changes, "batch")
    got_dim = rows(res.dim)
    assert sorted(map(key, got_dim)) == sorted(map(key, exp_dim))
    got_results = sorted(tuple(r.values()) for r in rows(res.results))
    assert got_results == sorted(exp_results)
    got_errors = sorted((r["seq"], r["location_id"]) for r in rows(res.errors))
    assert got_errors == sorted(exp_errors)


def test_approve_and_rollback_match_model(spark):
    rng = random.Random(7)
    dim_rows = random_dim(rng, 12)
    changes = random_changes(rng, 80, 12, hot=3)
    dim_rows, _, _ = apply_upserts(dim_rows, changes, "batch")
    dim = spark.createDataFrame(dim_rows, ZONE_DIM)
    sks = [r["zone_dim_sk"] for r in dim_rows]
    approvals = [dict(zone_dim_sk=s, approved_by="boss", reason=f"ok{s}")
                 for s in rng.sample(sks, 15)] + [
        dict(zone_dim_sk=10_000, approved_by="boss", reason="unknown"),
        dict(zone_dim_sk=sks[0], approved_by="x", reason="dup"),
        dict(zone_dim_sk=sks[0], approved_by="y", reason="dup")]
    as_of = T0 + dt.timedelta(days=30)
    ap = approve_versions(dim, spark.createDataFrame(approvals, APPROVE_REQUESTS), as_of)
    exp_dim, exp_err = apply_approvals(dim_rows, approvals, as_of)
    assert sorted(map(key, rows(ap.dim))) == sorted(map(key, exp_dim))
    got_err = sorted(r["zone_dim_sk"] for r in rows(ap.errors)
                     if r["error"].startswith("No current"))
    assert got_err == sorted(exp_err)

    locs = sorted({r["location_id"] for r in dim_rows})
    rollbacks = []
    for loc in locs + [99]:
        rollbacks.append(dict(location_id=loc, target_version=rng.choice([1, 2, 3, 9]),
                              rolled_back_by=rng.choice(["admin", "admin", None]),
                              reason=f"rb{loc}"))
    rollbacks.append(dict(rollbacks[0]))
    rb = rollback_versions(conform(dim), spark.createDataFrame(rollbacks, ROLLBACK_REQUESTS),
                           as_of, rows_per_chunk=3)
    exp_dim, exp_err = apply_rollbacks(dim_rows, rollbacks, as_of)
    assert sorted(map(key, rows(rb.dim))) == sorted(map(key, exp_dim))
    got_err = sorted(r["location_id"] for r in rows(rb.errors)
                     if r["target_version"] is not None)
    assert got_err == sorted(exp_err)


def test_upsert_edge_cases(spark):
    """New key; no-op; NULL equals ''; a->b->a; no-op between changes; two
    changes at one time; NULL author falls back to the batch user."""
    t = T0 + dt.timedelta(days=1)
    base = [dict(zone_dim_sk=5, location_id=1, borough="B", zone=None, service_zone="",
                 version_number=1, effective_from=T0, effective_to=None, is_current=True,
                 record_status="APPROVED", change_reason="seed", change_source="m",
                 created_at=T0, created_by="seed_load", approved_at=T0, approved_by="seed_load")]

    def c(seq, loc, zone, sec, by="u"):
        return dict(seq=seq, location_id=loc, borough="B", zone=zone, service_zone=None,
                    created_by=by, change_reason=f"r{seq}", change_source="f",
                    changed_at=t + dt.timedelta(seconds=sec))
    changes = [c(1, 1, "", 1), c(2, 1, "a", 2), c(3, 1, "a", 3), c(4, 1, None, 4),
               c(5, 1, "x", 4), c(6, 2, "n", 5, by=None), c(7, 1, "a", 6)]
    res = upsert_zone_scd2(spark.createDataFrame(base, ZONE_DIM),
                           spark.createDataFrame(changes, UPSERT_REQUESTS), user="batch")
    out = {r["seq"]: (r["zone_dim_sk"], r["version_number"], r["outcome"])
           for r in rows(res.results)}
    assert out[1] == (5, 1, "unchanged")          # NULL zone == '' zone
    assert out[2] == (6, 2, "new_version")
    assert out[3] == (6, 2, "unchanged")
    assert out[4] == (7, 3, "new_version")        # back to the original value
    assert 5 not in out                           # same time as request 4
    assert out[6] == (9, 1, "created")           # keys follow (location, seq)
    assert out[7] == (8, 4, "new_version")
    assert [r["seq"] for r in rows(res.errors)] == [5]
    dim = {r["zone_dim_sk"]: r for r in rows(res.dim)}
    assert dim[5]["is_current"] is False and dim[5]["effective_to"] == t + dt.timedelta(seconds=2)
    assert dim[6]["effective_to"] == t + dt.timedelta(seconds=4)
    assert dim[8]["is_current"] and dim[8]["effective_to"] is None
    assert dim[9]["created_by"] == "batch" and dim[9]["record_status"] == "DRAFT"
    assert sum(r["is_current"] for r in dim.values()) == 2


def late_changes(rng, n, n_locs):
    """Calls at any time of a month, many of them without a change."""
    return [dict(seq=i, location_id=rng.choice([0, 0, 0, *range(n_locs)]), borough="A",
                 zone=rng.choice(["z1", "z1", "z2", ""]), service_zone=rng.choice([None, ""]),
                 created_by="u", change_reason=f"c{i}", change_source="feed",
                 changed_at=T0 + dt.timedelta(hours=rng.randint(-20, 600) if rng.random() < 0.5
                                              else i))
            for i in range(n)]


@pytest.mark.parametrize("seed,rows_per_chunk,fold_rows", [(1, 1000, 1000), (2, 9, 9),
                                                           (3, 9, 1000), (4, 40, 20)])
def test_late_calls_take_effect_as_one_call_after_another(spark, seed, rows_per_chunk, fold_rows):
    rng = random.Random(seed)
    dim_rows = random_dim(rng, 4)
    changes = late_changes(rng, 120, 5)
    changes += [dict(changes[k], change_reason="twice") for k in (5, 50)]
    res = upsert_zone_scd2(spark.createDataFrame(dim_rows, ZONE_DIM),
                           spark.createDataFrame(changes, UPSERT_REQUESTS), user="batch",
                           rows_per_chunk=rows_per_chunk, fold_rows=fold_rows)
    exp_dim, exp_results, exp_errors = apply_upserts(dim_rows, changes, "batch")
    assert sorted(map(key, rows(res.dim))) == sorted(map(key, exp_dim))
    assert sorted(tuple(r.values()) for r in rows(res.results)) == sorted(exp_results)
    assert sorted((r["seq"], r["location_id"]) for r in rows(res.errors)) == sorted(exp_errors)
