"""A plain call-by-call model of the governed-dimension procedures.

Used only by tests: it applies one request at a time to a list of dicts, the
way the reference's procedures act on one key per call, so the batch
operators can be compared with it.
"""

from __future__ import annotations


def _same(a, b):
    return (a or "") == (b or "")


def apply_upserts(dim: list[dict], changes: list[dict], user: str):
    """Returns (dim, results, errors). An unchanged call is answered whatever its
    time; a change that is not after the start of the row it would replace is
    refused, as are calls that share a seq."""
    dim = [dict(r) for r in dim]
    next_sk = max([r["zone_dim_sk"] for r in dim], default=0) + 1
    results, errors = [], []
    valid = []
    for ch in changes:
        if ch["location_id"] is None or ch["changed_at"] is None or ch["seq"] is None:
            errors.append((ch["seq"], ch["location_id"]))
        else:
            valid.append(ch)
    uses: dict = {}
    for ch in valid:
        uses[ch["location_id"], ch["seq"]] = uses.get((ch["location_id"], ch["seq"]), 0) + 1
    for ch in sorted(valid, key=lambda c: (c["location_id"], c["seq"])):
        loc = ch["location_id"]
        if uses[loc, ch["seq"]] > 1:
            errors.append((ch["seq"], loc))
            continue
        cur = [r for r in dim if r["location_id"] == loc and r["is_current"]]
        cur = max(cur, key=lambda r: (r["version_number"], r["zone_dim_sk"])) if cur else None
        late = cur is not None and ch["changed_at"] <= cur["effective_from"]
        if cur is not None and all(_same(cur[a], ch[a]) for a in ("borough", "zone",
                                                                  "service_zone")):
            results.append((ch["seq"], loc, cur["zone_dim_sk"], cur["version_number"],
                            "unchanged"))
            continue
        if late:
            errors.append((ch["seq"], loc))
            continue
        version = cur["version_number"] + 1 if cur else 1
        if cur is not None:
            cur["effective_to"] = ch["changed_at"]
            cur["is_current"] = False
        row = {
            "zone_dim_sk": next_sk, "location_id": loc, "borough": ch["borough"],
            "zone": ch["zone"], "service_zone": ch["service_zone"], "version_number": version,
            "effective_from": ch["changed_at"], "effective_to": None, "is_current": True,
            "record_status": "DRAFT", "change_reason": ch["change_reason"],
            "change_source": ch["change_source"], "created_at": ch["changed_at"],
            "created_by": ch["created_by"] if ch["created_by"] is not None else user,
            "approved_at": None, "approved_by": None,
        }
        next_sk += 1
        dim.append(row)
        results.append((ch["seq"], loc, row["zone_dim_sk"], version,
                        "created" if cur is None and version == 1 else "new_version"))
    return dim, results, errors


def apply_approvals(dim: list[dict], approvals: list[dict], as_of):
    dim = [dict(r) for r in dim]
    counts: dict = {}
    for a in approvals:
        counts[a["zone_dim_sk"]] = counts.get(a["zone_dim_sk"], 0) + 1
    errors = []
    for a in approvals:
        sk = a["zone_dim_sk"]
        if sk is None or counts[sk] > 1:
            continue
        hit = [r for r in dim if r["zone_dim_sk"] == sk and r["is_current"]]
        if not hit:
            errors.append(sk)
            continue
        for r in hit:
            r.update(record_status="APPROVED", approved_by=a["approved_by"], approved_at=as_of,
                     change_reason=a["reason"])
    return dim, errors


def apply_rollbacks(dim: list[dict], rollbacks: list[dict], as_of):
    dim = [dict(r) for r in dim]
    counts: dict = {}
    for b in rollbacks:
        counts[b["location_id"]] = counts.get(b["location_id"], 0) + 1
    next_sk = max([r["zone_dim_sk"] for r in dim], default=0) + 1
    errors = []
    for b in sorted(rollbacks, key=lambda x: (x["location_id"] is None, x["location_id"])):
        loc = b["location_id"]
        if loc is None or counts[loc] > 1:
            continue
        rows = [r for r in dim if r["location_id"] == loc]
        targets = [r for r in rows if r["version_number"] == b["target_version"]]
        cur = [r for r in rows if r["is_current"]]
        if len(targets) != 1 or b["rolled_back_by"] is None or \
                any(r["effective_from"] >= as_of for r in cur):
            errors.append(loc)
            continue
        version = max(r["version_number"] for r in rows) + 1
        for r in cur:
            r.update(effective_to=as_of, is_current=False)
        t = targets[0]
        dim.append({
            "zone_dim_sk": next_sk, "location_id": loc, "borough": t["borough"],
            "zone": t["zone"], "service_zone": t["service_zone"], "version_number": version,
            "effective_from": as_of, "effective_to": None, "is_current": True,
            "record_status": "ROLLED_BACK", "change_reason": b["reason"],
            "change_source": "rollback_procedure", "created_at": as_of,
            "created_by": b["rolled_back_by"], "approved_at": None, "approved_by": None,
        })
        next_sk += 1
    return dim, errors
