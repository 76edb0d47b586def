"""Governed zone dimension, SCD type 2: seed, upsert, approve, roll back, history.

The reference changes one key per procedure call, in place. Here each
operation is a pure function over a whole batch of requests:

    old snapshot + requests -> new snapshot (+ per-request results, errors)

so the core runs as Spark joins, windows and aggregates, and a caller writes
the new snapshot next to the old one (parquet has no in-place UPDATE).

Per-key order replaces the reference's row lock. Keys that get many requests
are split: ordered scans run over (key, seq-range chunk) windows and a second
window over one summary row per chunk (see ``operators.sequence``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import author_or_user, ntz, same_text
from tripmart.operators.enrich import DEFAULT_BROADCAST_MAX_ROWS
from tripmart.operators.latest import seed_candidates, top1_per_key
from tripmart.operators.sequence import (
    CHUNK,
    DEFAULT_ROWS_PER_CHUNK,
    assign_surrogate_keys,
    profile_order,
    total_before,
)
from tripmart.schemas import HISTORY_COLUMNS, ZONE_DIM, ZONE_DIM_COLUMNS
from tripmart.session import cut_lineage

ATTRS = ["borough", "zone", "service_zone"]

# --- fixed values: statuses, seed and rollback labels; the error texts for a
# missing current record and a missing target version below are fixed as well -----
STATUS_DRAFT = "DRAFT"
STATUS_APPROVED = "APPROVED"
STATUS_ROLLED_BACK = "ROLLED_BACK"
SEED_REASON = "initial seed load"
SEED_SOURCE = "mdm.taxi_zone_master"
SEED_USER = "seed_load"
ROLLBACK_SOURCE = "rollback_procedure"

_UNB = Window.unboundedPreceding


@dataclass
class ChangeResult:
    """New snapshot, one outcome row per accepted request, rejected requests."""
    dim: DataFrame
    results: DataFrame
    errors: DataFrame


def _ts(value) -> Column:
    return ntz(value)


def _same_attrs(left: dict[str, Column], right: dict[str, Column]) -> Column:
    """All three attributes equal, NULL and '' counted as the same value."""
    out = None
    for a in ATTRS:
        term = same_text(left[a], right[a])
        out = term if out is None else (out & term)
    return out


def conform(dim: DataFrame) -> DataFrame:
    """Columns of the dimension in table order and table types."""
    return dim.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ZONE_DIM.fields])


def empty_dim(spark) -> DataFrame:
    return spark.createDataFrame([], ZONE_DIM)


def max_surrogate_key(dim: DataFrame) -> int:
    """Largest key in use (0 for an empty dimension); one aggregate job."""
    return dim.agg(F.max("zone_dim_sk")).first()[0] or 0


# ----------------------------------------------------------------------------- G1
def seed_zone_dim(zone_master: DataFrame, dim: DataFrame, as_of,
                  rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                  first_key: int | None = None) -> DataFrame:
    """Version-1 rows from the best master row of each location, skipping
    locations that already have a version 1. Returns the new snapshot.

    A master row without a location cannot be stored (NOT NULL key) and is
    left out. Running the seed twice adds nothing the second time.
    """
    t = _ts(as_of)
    cand = seed_candidates(zone_master.filter(F.col("location_id").isNotNull()))
    have_v1 = dim.filter(F.col("version_number") == 1).select("location_id")
    fresh = cand.join(have_v1, "location_id", "left_anti")
    # Chunks from the master's keys: a superset of the new rows' keys.
    chunks = profile_order(zone_master, "location_id", rows_per_chunk)
    if first_key is None:
        first_key = max_surrogate_key(dim)
    keyed = assign_surrogate_keys(fresh, "location_id", first_key, "zone_dim_sk", chunk=chunks)
    rows = keyed.select(
        "zone_dim_sk", "location_id", *ATTRS,
        F.lit(1).alias("version_number"),
        t.alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(STATUS_APPROVED).alias("record_status"),
        F.lit(SEED_REASON).alias("change_reason"),
        F.lit(SEED_SOURCE).alias("change_source"),
        t.alias("created_at"),
        F.lit(SEED_USER).alias("created_by"),
        t.alias("approved_at"),
        F.lit(SEED_USER).alias("approved_by"),
    )
    return conform(dim).unionByName(conform(rows))


# ----------------------------------------------------------------------------- U2
def _current_rows(dim: DataFrame) -> DataFrame:
    """The current row per key (highest version if the key breaks rule C5)."""
    cur = dim.filter(F.col("is_current"))
    return top1_per_key(cur, "location_id",
                        [F.col("version_number").desc(), F.col("zone_dim_sk").desc()])


_REQUEST = ["seq", "location_id", *ATTRS, "created_by", "change_reason", "change_source",
            "changed_at"]
_STATE = [*_REQUEST, CHUNK, "_twice", "_late", "_head", "_prev", "_lchg", "_first_acc",
          "_had_first", "_cum", "_next_local", "_last", "_first", "_nlocal", "_first_local_at"]


def _scan_ranges(r: DataFrame) -> DataFrame:
    """Level 1 of the upsert: windows over (location, range). Late requests are
    masked out, so each request is compared with the previous one on time."""
    wr = Window.partitionBy("location_id", CHUNK).orderBy("seq")
    wr_desc = Window.partitionBy("location_id", CHUNK).orderBy(F.col("seq").desc())
    whole = Window.partitionBy("location_id", CHUNK)
    before, upto = (_UNB, -1), (_UNB, 0)
    acc = ~F.col("_late") & ~F.col("_twice")
    r = r.withColumns({
        "_prev": F.last(F.when(acc, F.struct(*ATTRS)), True).over(wr.rowsBetween(*before)),
        "_head": F.row_number().over(wr) == 1,
    })
    own = {a: F.col(a) for a in ATTRS}
    differs = ~_same_attrs(own, {a: F.col("_prev").getField(a) for a in ATTRS})
    r = r.withColumn("_lchg", acc & F.col("_prev").isNotNull() & differs)
    # the first request on time has no earlier one in its range to compare with
    r = r.withColumn("_first_acc", acc & F.col("_prev").isNull())
    r = r.withColumns({
        "_cum": F.sum(F.col("_lchg").cast("int")).over(wr.rowsBetween(*upto)),
        "_had_first": F.coalesce(F.max("_first_acc").over(wr.rowsBetween(*upto)), F.lit(False)),
        # "min over the following rows" as a descending running frame: the
        # unbounded-following frame re-aggregates per row (quadratic).
        "_next_local": F.min(F.when(F.col("_lchg"), F.col("changed_at")))
                        .over(wr_desc.rowsBetween(*before)),
    })
    # Per-range values for level 2, as whole-range window aggregates (one
    # linear pass, no sort-based aggregate); kept on the range's first row.
    r = r.withColumns({
        "_last": F.when(F.col("_head"), F.max(F.when(acc, F.struct("seq", *ATTRS))).over(whole)),
        "_first": F.when(F.col("_head"), F.max(F.when(F.col("_first_acc"), F.struct(
            "seq", "changed_at", *ATTRS))).over(whole)),
        "_nlocal": F.when(F.col("_head"), F.sum(F.col("_lchg").cast("int")).over(whole)),
        "_first_local_at": F.when(F.col("_head"), F.min(F.when(
            F.col("_lchg"), F.col("changed_at"))).over(whole)),
    })
    return r.select(*_STATE)


def _late_but_taken(state: DataFrame, base: DataFrame, ranges_at_once: int,
                    keys_small: bool) -> DataFrame | None:
    """(location_id, seq) of late requests that take effect all the same, because
    nothing took effect at the later times before them; None if there are none.

    What a location's state is after a request on time that surely made a
    version doesn't depend on what was before (it is that request), so
    stretches from one such request to the next are folded apart; a request
    surely makes a version if it differs from one on time just before it. A
    stretch that spans several groups of ranges is handed on from group to
    group as (attributes, start)."""
    late = state.filter("_late").select("location_id").distinct()
    late = cut_lineage(late, "late_locations")
    if late.isEmpty():
        return None
    text = [F.coalesce(F.col(a), F.lit("")) for a in ATTRS]
    calls = (state.filter(~F.col("_twice"))
             .join(F.broadcast(late) if keys_small else late, "location_id", "left_semi")
             .select("location_id", CHUNK, "seq", "changed_at", "_late",
                     F.struct(*[t.alias(a) for a, t in zip(ATTRS, text)]).alias("attrs")))
    by_seq = Window.partitionBy("location_id", CHUNK).orderBy("seq")
    calls = calls.withColumns({"_p_late": F.lag("_late").over(by_seq),
                               "_p_attrs": F.lag("attrs").over(by_seq)})
    after_on_time = ~F.col("_late") & F.coalesce(~F.col("_p_late"), F.lit(False))
    calls = calls.withColumns({
        "sure": after_on_time & (F.col("attrs") != F.col("_p_attrs")),
        # equal to one on time just before it: it changes nothing
        "silent": after_on_time & (F.col("attrs") == F.col("_p_attrs"))})
    # a stretch is named by the seq it starts with; NULL: the location's first
    own = F.last(F.when(F.col("sure"), F.col("seq")), True).over(
        by_seq.rowsBetween(_UNB, 0))
    calls = cut_lineage(calls.withColumn("own_start", own), "late_calls")
    heads = calls.groupBy("location_id", CHUNK).agg(F.max("own_start").alias("last_start"))
    heads = heads.withColumn("start_before", F.last("last_start", True).over(
        Window.partitionBy("location_id").orderBy(CHUNK).rowsBetween(_UNB, -1)))
    calls = calls.join(heads.select("location_id", CHUNK, "start_before"), ["location_id", CHUNK])
    calls = calls.withColumn("stretch", F.coalesce("own_start", "start_before"))
    key = ["location_id", "stretch"]
    rows = calls.filter(~F.col("silent")).withColumn(
        "grp", F.floor(F.col(CHUNK) / F.lit(max(1, ranges_at_once))).cast("long"))
    # one array per (stretch, group of ranges), at most fold_rows requests in it
    groups = rows.groupBy(*key, "grp").agg(
        F.sort_array(F.collect_list(F.struct("seq", "changed_at", "attrs", "_late")))
        .alias("calls"), F.max("_late").alias("some_late"))
    several = Window.partitionBy(*key)
    groups = groups.withColumns({
        "turn": F.row_number().over(several.orderBy("grp")),
        "some_late": F.max("some_late").over(several), "turns": F.count("*").over(several)})
    first = base.select("location_id", F.col("_b_from").alias("at"), F.struct(*[
        F.coalesce(F.col("_b_attrs")[a], F.lit("")).alias(a) for a in ATTRS]).alias("attrs"))
    groups = cut_lineage(groups.filter("some_late").join(first, "location_id", "left").select(
        *key, "turn", "turns", "calls", F.when(F.col("stretch").isNull() & F.col("at").isNotNull(),
                                               F.struct("attrs", "at")).alias("now")), "stretches")
    last_turn = groups.agg(F.max("turns")).first()[0] or 0
    found, carried = [], None
    for turn in range(1, last_turn + 1):
        here = groups.filter(F.col("turn") == turn)
        if carried is not None:
            here = here.drop("now").join(
                carried.withColumnRenamed("stretch", "_s"),
                (here["location_id"] == carried["location_id"])
                & here["stretch"].eqNullSafe(F.col("_s")), "left").select(
                here["location_id"], "stretch", "turns", "calls", "now")
        done = cut_lineage(here.select(*key, "turns", _fold("calls", "now").alias("f")), "folded")
        found.append(done.select("location_id", F.explode("f.taken").alias("seq")))
        carried = done.filter(F.col("turns") > turn).select(*key, F.col("f.now").alias("now"))
    out = found[0] if found else None
    for more in found[1:]:
        out = out.union(more)
    if out is None:
        return None
    out = cut_lineage(out, "late_but_taken")
    return None if out.isEmpty() else out


def _fold(calls: str, now: str) -> Column:
    """Call by call over a sorted array: the state after it (attributes, start)
    and the seqs of the late calls that took effect."""
    def step(acc, call):
        differs = acc["now"].isNull() | (acc["now"]["attrs"] != call["attrs"])
        in_time = acc["now"].isNull() | (call["changed_at"] > acc["now"]["at"])
        takes = differs & in_time
        return F.struct(
            F.when(takes, F.struct(call["attrs"].alias("attrs"), call["changed_at"].alias("at")))
             .otherwise(acc["now"]).alias("now"),
            F.when(takes & call["_late"], F.array_append(acc["taken"], call["seq"]))
             .otherwise(acc["taken"]).alias("taken"))

    start = F.struct(F.col(now).alias("now"),
                     F.array().cast("array<bigint>").alias("taken"))
    return F.aggregate(calls, start, step)


def upsert_zone_scd2(dim: DataFrame, changes: DataFrame, user: str | None = None,
                     rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                     first_key: int | None = None,
                     fold_rows: int = DEFAULT_ROWS_PER_CHUNK) -> ChangeResult:
    """Apply upsert requests in ``seq`` order within each location.

    Per request, as the reference's procedure: no current row -> version 1;
    attributes equal to the current row (NULL = '') -> no new row, the
    current key and version are returned, whatever the request's time; else
    the current row is closed at ``changed_at`` and a new current DRAFT row
    with version + 1 is added. New keys follow the order of (location, seq).

    A change that is not later than the start of the row it would replace is
    refused, as its empty window would fail the procedure's CHECK. Refused and
    unchanged requests leave no trace: a later call may carry an earlier time
    than they did. Also refused: requests without location, seq or time, and
    all requests of a location that share a seq.

    The scan over ranges first takes every request to be late that is not after
    *every* earlier time of its location. Without late requests that is
    the procedure's answer; with some, ``_late_but_taken`` folds the
    stretches of requests in which the two rules can differ, and the locations
    where they do are scanned again. ``fold_rows`` bounds the requests of one
    location that are folded at once.
    """
    req = changes.select(*_REQUEST)
    given = (F.col("location_id").isNotNull() & F.col("changed_at").isNotNull()
             & F.col("seq").isNotNull())
    bad_input = req.filter(~given)
    req = req.filter(given)

    chunks = profile_order(req, "seq", rows_per_chunk, key="location_id",
                           keys_if_over=max_broadcast_rows)
    # Proven bounds from the profile job: the touched-key list has
    # ``chunks.keys`` rows, every (location, range) summary at most
    # ``chunks.summary_rows()``, every per-location table at most ``keys``.
    keys_small = chunks.keys <= max_broadcast_rows
    small = chunks.summary_rows() <= max_broadcast_rows

    # Current rows of the locations this batch touches only: a batch on a few
    # keys does not shuffle the whole dimension.
    touched = req.select("location_id").distinct()
    current = dim.filter(F.col("is_current")).join(
        F.broadcast(touched) if keys_small else touched, "location_id", "left_semi")
    base = _current_rows(current).select(
        "location_id",
        F.col("zone_dim_sk").alias("_b_sk"), F.col("version_number").alias("_b_ver"),
        F.col("effective_from").alias("_b_from"), F.struct(*ATTRS).alias("_b_attrs"))

    wr = Window.partitionBy("location_id", CHUNK).orderBy("seq")
    wk = Window.partitionBy("location_id").orderBy(CHUNK)
    wk_desc = Window.partitionBy("location_id").orderBy(F.col(CHUNK).desc())
    before = (_UNB, -1)

    # Equal seqs of a location are neighbours in one range.
    r = chunks.assign(req, CHUNK)
    r = r.withColumn("_twice", F.coalesce(F.lag("seq").over(wr) == F.col("seq"), F.lit(False))
                     | F.coalesce(F.lead("seq").over(wr) == F.col("seq"), F.lit(False)))
    timed = F.when(~F.col("_twice"), F.col("changed_at"))

    own = {a: F.col(a) for a in ATTRS}
    # Level 2 of "latest earlier time of the location": one row per
    # (location, range), by the partitioning that the windows have.
    s1 = (r.groupBy("location_id", CHUNK).agg(F.max(timed).alias("_t_chunk"))
           .withColumn("_t_prev", F.max("_t_chunk").over(wk.rowsBetween(*before)))
           .join(base.select("location_id", "_b_from"), "location_id", "left")
           .select("location_id", CHUNK, F.greatest("_t_prev", "_b_from").alias("_t_before")))
    # One summary row per (location, range): broadcast within the bound.
    r = (r.withColumn("_t_local", F.max(timed).over(wr.rowsBetween(*before)))
          .join(F.broadcast(s1) if small else s1, ["location_id", CHUNK], "left"))
    late = F.coalesce(F.col("changed_at") <= F.greatest("_t_before", "_t_local"), F.lit(False))
    r = r.withColumn("_late", late & ~F.col("_twice"))

    # The request-level state is computed once and written once; the
    # summaries and all outputs read it, without another shuffle of requests.
    state = cut_lineage(_scan_ranges(r), "upsert_state")
    taken = _late_but_taken(state, base, fold_rows // max(1, rows_per_chunk), keys_small)
    if taken is not None:
        moved = taken.select("location_id").distinct()
        moved = cut_lineage(F.broadcast(moved) if keys_small else moved, "moved_locations")
        again = state.join(F.broadcast(moved) if keys_small else moved, "location_id", "left_semi")
        again = again.select(*_REQUEST, CHUNK, "_twice", "_late").join(
            taken.withColumn("_taken", F.lit(True)), ["location_id", "seq"], "left")
        again = again.withColumn("_late", F.col("_late") & F.col("_taken").isNull()).drop("_taken")
        state = state.join(F.broadcast(moved) if keys_small else moved, "location_id",
                           "left_anti").unionByName(
            cut_lineage(_scan_ranges(again), "upsert_state_again"))

    # Level 2: one row per (location, range), its first row.
    s2 = (state.filter("_head").select("location_id", CHUNK, "_first", "_last", "_nlocal",
                                       "_first_local_at")
               .join(base, "location_id", "left"))
    prev_last = F.last("_last", True).over(wk.rowsBetween(*before))
    s2 = s2.withColumn("_ref", F.when(prev_last.isNotNull(), F.struct(
        *[prev_last.getField(a).alias(a) for a in ATTRS])).otherwise(F.col("_b_attrs")))
    same_ref = _same_attrs({a: F.col("_first").getField(a) for a in ATTRS},
                           {a: F.col("_ref").getField(a) for a in ATTRS})
    s2 = s2.withColumn("_fchg", F.col("_first").isNotNull()
                       & (F.col("_ref").isNull() | ~same_ref))
    s2 = s2.withColumns({
        "_nchg": F.col("_nlocal") + F.col("_fchg").cast("int"),
        "_first_kept_at": F.when(F.col("_fchg"), F.col("_first.changed_at"))
                           .otherwise(F.col("_first_local_at")),
    })
    s2 = s2.withColumns({
        "_new_before": F.coalesce(F.sum("_nchg").over(wk.rowsBetween(*before)), F.lit(0)),
        "_next_kept_after": F.min("_first_kept_at").over(wk_desc.rowsBetween(*before)),
    })
    s2 = cut_lineage(s2.select("location_id", CHUNK, "_fchg", "_nchg", "_new_before",
                               "_next_kept_after", "_first_kept_at", "_ref", "_b_sk", "_b_ver"),
                     "upsert_summary")
    # Level 3: one row per location. Keys of a location start after those of
    # the locations before it.
    per_loc = s2.groupBy("location_id").agg(F.sum("_nchg").alias("_new"),
                                            F.min("_first_kept_at").alias("_expire_at"))
    per_loc = cut_lineage(total_before(per_loc, "location_id", "_new", "_key_before",
                                       rows_per_chunk), "upsert_locations")
    if first_key is None:
        first_key = max_surrogate_key(dim)

    summary = s2.join(F.broadcast(per_loc) if keys_small else per_loc, "location_id").select(
        "location_id", CHUNK, "_fchg", "_new_before", "_next_kept_after", "_ref", "_b_sk",
        "_b_ver", "_key_before")
    rows = state.join(F.broadcast(summary) if small else summary, ["location_id", CHUNK])
    new_sofar = (F.col("_new_before") + F.col("_cum")
                 + (F.col("_fchg") & F.col("_had_first")).cast("int"))
    ref = {a: F.coalesce(F.col("_prev"), F.col("_ref")).getField(a) for a in ATTRS}
    has_ref = F.col("_prev").isNotNull() | F.col("_ref").isNotNull()
    refused = F.col("_twice") | (F.col("_late") & ~(has_ref & _same_attrs(own, ref)))
    changed = F.when(F.col("_first_acc"), F.col("_fchg")).otherwise(F.col("_lchg"))
    rows = rows.withColumns({
        "_refused": refused, "_changed": changed, "_new_sofar": new_sofar,
        "version_number": (F.coalesce(F.col("_b_ver"), F.lit(0)) + new_sofar).cast("int"),
        # the version that the request made or, if unchanged, that was current
        "zone_dim_sk": F.when(new_sofar > 0, F.lit(first_key) + F.col("_key_before") + new_sofar)
                        .otherwise(F.col("_b_sk")).cast("long"),
        "effective_to": F.coalesce("_next_local", "_next_kept_after"),
    })

    new_rows = rows.filter("_changed").select(
        "zone_dim_sk", "location_id", *ATTRS, "version_number",
        F.col("changed_at").alias("effective_from"),
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
        F.lit(STATUS_DRAFT).alias("record_status"),
        "change_reason", "change_source",
        F.col("changed_at").alias("created_at"),
        author_or_user("created_by", user).alias("created_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        F.lit(None).cast("string").alias("approved_by"),
    )

    expiry = per_loc.filter(F.col("_expire_at").isNotNull()).select("location_id", "_expire_at")
    # One expiry row per touched location.
    old = conform(dim).join(F.broadcast(expiry) if keys_small else expiry, "location_id",
                            "left")
    closing = F.col("is_current") & F.col("_expire_at").isNotNull()
    old = old.withColumns({
        "effective_to": F.when(closing, F.col("_expire_at")).otherwise(F.col("effective_to")),
        "is_current": F.when(closing, F.lit(False)).otherwise(F.col("is_current")),
    }).drop("_expire_at")
    new_dim = conform(old).unionByName(conform(new_rows))

    results = rows.filter(~F.col("_refused")).select(
        "seq", "location_id", "zone_dim_sk", "version_number",
        F.when(~F.col("_changed"), F.lit("unchanged"))
         .when(F.col("_b_sk").isNull() & (F.col("version_number") == 1), F.lit("created"))
         .otherwise(F.lit("new_version")).alias("outcome"))

    errors = (bad_input.select("seq", "location_id", F.lit("missing seq, location_id or "
                                                           "changed_at").alias("error"))
              .unionByName(rows.filter("_refused").select(
                  "seq", "location_id",
                  F.when(F.col("_twice"), F.lit("seq used more than once for the location"))
                   .otherwise(F.lit("changed_at not after the start of the current version"))
                   .alias("error"))))
    return ChangeResult(new_dim, results, errors)


# ----------------------------------------------------------------------------- U3
def _with_seq(req: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests with their call order, and errors for those without a key. A
    batch without a ``seq`` column has no order: keys it repeats are errors."""
    if "seq" in req.columns:
        no_key = req.filter(F.col(key).isNull()).select(key, F.lit(f"{key} is NULL").alias("error"))
        return req.filter(F.col(key).isNotNull()), no_key
    fields = [c for c in req.columns if c != key]
    # A partial aggregate: a key repeated many times costs one row per task.
    g = req.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*fields)).alias("_r"))
    bad = g.filter((F.col("_n") > 1) | F.col(key).isNull()).select(
        key, F.when(F.col(key).isNull(), F.lit(f"{key} is NULL"))
        .otherwise(F.format_string(f"{key} requested %d times in one batch", F.col("_n")))
        .alias("error"))
    single = g.filter((F.col("_n") == 1) & F.col(key).isNotNull()).select(
        key, F.lit(1).cast("long").alias("seq"), *[F.col("_r").getField(c).alias(c) for c in fields])
    return single, bad


def approve_versions(dim: DataFrame, approvals: DataFrame, as_of,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> ChangeResult:
    """Approve current rows by surrogate key: status APPROVED, approver,
    time, and the reason overwrites ``change_reason``. Any current row
    qualifies, whatever its status. A key that is not a current row is an
    error. Repeated approvals of a key take effect in ``seq`` order, so the
    last one stays (equal seqs: the larger approver and reason).
    """
    t = _ts(as_of)
    fields = [c for c in ("seq", "zone_dim_sk", "approved_by", "reason") if c in approvals.columns]
    calls, no_key = _with_seq(approvals.select(*fields), "zone_dim_sk")
    last = calls.groupBy("zone_dim_sk").agg(
        F.max(F.struct("seq", "approved_by", "reason")).alias("_last"),
        F.count(F.lit(1)).alias("_n")).select(
        "zone_dim_sk", F.col("_last.approved_by").alias("_by"),
        F.col("_last.reason").alias("_reason"), "_n")
    # At most one row per request: check the (cheap) request table's size.
    small = approvals.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows
    d = conform(dim)
    hits = F.broadcast(last) if small else last
    j = d.join(hits, "zone_dim_sk", "left")
    hit = F.col("_n").isNotNull() & F.col("is_current")
    new_dim = conform(j.withColumns({
        "record_status": F.when(hit, F.lit(STATUS_APPROVED)).otherwise(F.col("record_status")),
        "approved_by": F.when(hit, F.col("_by")).otherwise(F.col("approved_by")),
        "approved_at": F.when(hit, t).otherwise(F.col("approved_at")),
        "change_reason": F.when(hit, F.col("_reason")).otherwise(F.col("change_reason")),
    }))
    # One join of the requested keys to the rows they hit, for both outcomes.
    current = d.filter("is_current").select("zone_dim_sk")
    found = (current.join(hits.select("zone_dim_sk"), "zone_dim_sk", "left_semi").distinct()
             .withColumn("_hit", F.lit(True)))
    answered = cut_lineage(last.select("zone_dim_sk", "_n").join(
        F.broadcast(found) if small else found, "zone_dim_sk", "left"), "approvals")
    results = (answered.filter("_hit").select(F.explode(F.array_repeat(
        "zone_dim_sk", F.col("_n").cast("int"))).alias("zone_dim_sk"))
        .withColumn("outcome", F.lit("approved")))
    missing = answered.filter(F.col("_hit").isNull()).select(F.explode(F.array_repeat(
        "zone_dim_sk", F.col("_n").cast("int"))).alias("zone_dim_sk"))
    errors = missing.select("zone_dim_sk", F.concat(
        F.lit("No current record found for zone_dim_sk="),
        F.col("zone_dim_sk").cast("string")).alias("error")).unionByName(no_key)
    return ChangeResult(new_dim, results, errors)


# ----------------------------------------------------------------------------- U4
LATE_START = "current row does not start before as_of"


def rollback_versions(dim: DataFrame, rollbacks: DataFrame, as_of,
                      rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK,
                      max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      first_key: int | None = None) -> ChangeResult:
    """Restore the attributes of a target version as a new current row.

    Per location: close the current row at ``as_of`` (if any), add version =
    max over all versions + 1 with the target's attributes, status
    ROLLED_BACK, source 'rollback_procedure', no approver. A missing target
    is an error and nothing changes for that location (the reference's close
    is undone with the failed call). Also errors: no ``rolled_back_by`` (NOT
    NULL column), a current row that does not start before ``as_of`` (the
    closed window would be empty), and a target that matches more than one
    row (the insert would add two current rows).

    Repeats of a location run in ``seq`` order: the first one without an error
    takes effect, and each valid one after it fails as its call would, since
    the row it has to close starts at the same ``as_of``. Equal seqs of a
    location are refused.
    """
    t = _ts(as_of)
    fields = [c for c in ("seq", "location_id", "target_version", "rolled_back_by", "reason")
              if c in rollbacks.columns]
    calls, no_key = _with_seq(rollbacks.select(*fields), "location_id")

    d = conform(dim)
    # Facts about each requested location, from one pass over its rows.
    per_loc = (d.join(calls.select("location_id"), "location_id", "left_semi")
                .groupBy("location_id")
                .agg(F.max("version_number").alias("_max_ver"),
                     F.max(F.when(F.col("is_current"), F.col("effective_from"))).alias("_cur_from")))
    targets = (d.join(calls.select("location_id", F.col("target_version").alias("version_number")),
                      ["location_id", "version_number"], "left_semi")
                .groupBy("location_id", "version_number")
                .agg(F.count(F.lit(1)).alias("_matches"),
                     F.first(F.struct(*ATTRS)).alias("_attrs")))
    checked = (calls
               .join(per_loc, "location_id", "left")
               .join(targets.withColumnRenamed("version_number", "target_version"),
                     ["location_id", "target_version"], "left"))
    error = (F.when(F.col("_matches").isNull(),
                    F.format_string("Target version %s not found for location_id %s",
                                    F.col("target_version"), F.col("location_id")))
              .when(F.col("_matches") > 1, F.lit("target version matches more than one row"))
              .when(F.col("rolled_back_by").isNull(), F.lit("rolled_back_by is NULL"))
              .when(F.col("_cur_from").isNotNull() & (F.col("_cur_from") >= t), F.lit(LATE_START)))
    # One row per request; valid rows, errors, keys and closes all read it.
    checked = cut_lineage(checked.withColumn("error", error), "rollback_requests")
    order = (checked.filter(F.col("error").isNull()).groupBy("location_id")
             .agg(F.min("seq").alias("_first")))
    ties = (checked.filter(F.col("error").isNull()).groupBy("location_id", "seq")
            .agg(F.count(F.lit(1)).alias("_n")))
    order = (order.join(ties, (ties["location_id"] == order["location_id"])
                        & ties["seq"].eqNullSafe(order["_first"]))
             .select(order["location_id"], "_first", "_n"))
    checked = checked.join(order, "location_id", "left").withColumn("error", F.when(
        F.col("error").isNotNull(), F.col("error"))
        .when(~F.col("seq").eqNullSafe(F.col("_first")), F.lit(LATE_START))
        .when(F.col("_n") > 1, F.lit("seq used more than once for the location")))
    checked = cut_lineage(checked, "rollback_decisions")
    valid = checked.filter(F.col("error").isNull())
    errors = (checked.filter(F.col("error").isNotNull()).select("location_id", "target_version",
                                                                "error")
              .unionByName(no_key.select("location_id", F.lit(None).cast("int")
                                         .alias("target_version"), "error")))

    # Chunks and the size bound come from the request table: the valid
    # requests are a subset of its rows and keys.
    chunks = profile_order(rollbacks, "location_id", rows_per_chunk)
    n_req = chunks.rows
    if first_key is None:
        first_key = max_surrogate_key(dim)
    keyed = assign_surrogate_keys(valid, "location_id", first_key, "zone_dim_sk", chunk=chunks)
    new_rows = keyed.select(
        "zone_dim_sk", "location_id",
        *[F.col("_attrs").getField(a).alias(a) for a in ATTRS],
        (F.col("_max_ver") + 1).alias("version_number"),
        t.alias("effective_from"),
        F.lit(None).cast("timestamp_ntz").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(STATUS_ROLLED_BACK).alias("record_status"),
        F.col("reason").alias("change_reason"),
        F.lit(ROLLBACK_SOURCE).alias("change_source"),
        t.alias("created_at"),
        F.col("rolled_back_by").alias("created_by"),
        F.lit(None).cast("timestamp_ntz").alias("approved_at"),
        F.lit(None).cast("string").alias("approved_by"),
    )
    close = valid.select("location_id", F.lit(True).alias("_close"))
    close = F.broadcast(close) if n_req <= max_broadcast_rows else close
    old = d.join(close, "location_id", "left")
    closing = F.coalesce(F.col("_close"), F.lit(False)) & F.col("is_current")
    old = old.withColumns({
        "effective_to": F.when(closing, t).otherwise(F.col("effective_to")),
        "is_current": F.when(closing, F.lit(False)).otherwise(F.col("is_current")),
    })
    new_dim = conform(old).unionByName(conform(new_rows))
    results = new_rows.select("location_id", "zone_dim_sk", "version_number",
                              F.lit("rolled_back").alias("outcome"))
    return ChangeResult(new_dim, results, errors)


# ----------------------------------------------------------------------------- G2
def version_history(dim: DataFrame, requests: DataFrame) -> DataFrame:
    """All versions of each requested location whose start lies within the
    optional inclusive bounds [from_date, to_date]; NULL bound = unbounded.
    Ordered by location and version number.

    The request table has one row per location (the reference takes one
    location per call); it is joined on the key, so it may be large.
    """
    req = requests.select("location_id", F.col("from_date").alias("_from"),
                          F.col("to_date").alias("_to"))
    j = dim.join(req, "location_id", "inner")
    keep = ((F.col("_from").isNull() | (F.col("effective_from") >= F.col("_from")))
            & (F.col("_to").isNull() | (F.col("effective_from") <= F.col("_to"))))
    return (j.filter(keep).select(*HISTORY_COLUMNS)
             .orderBy("location_id", "version_number", "zone_dim_sk"))


def history_one(dim: DataFrame, location_id: int, from_date=None, to_date=None) -> DataFrame:
    """The reference's single-location form; a NULL bound folds away."""
    cond = F.col("location_id") == F.lit(location_id)
    if from_date is not None:
        cond = cond & (F.col("effective_from") >= _ts(from_date))
    if to_date is not None:
        cond = cond & (F.col("effective_from") <= _ts(to_date))
    return dim.filter(cond).select(*HISTORY_COLUMNS).orderBy("version_number")


__all__ = ["ChangeResult", "seed_zone_dim", "upsert_zone_scd2", "approve_versions",
           "rollback_versions", "version_history", "history_one", "conform", "empty_dim",
           "ZONE_DIM_COLUMNS"]
