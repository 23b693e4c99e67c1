"""Independent test oracle: the per-install state machine, one call at a
time in plain Python (test code only)."""

from __future__ import annotations

from collections import defaultdict, deque

BYPASS = {"opt_out", "opt_in", "reset", "start", "exit"}
KNOWN = {"track", "exception", "identify", "start_session", "end_session", "opt_out", "opt_in", "reset", "flush", "start", "exit"}


def actor_err(a):
    if a is None or len(a) == 0:
        return "actor_empty"
    if len(a) > 512:
        return "actor_too_long"
    return None


def run(calls, enabled_of=lambda r: True, n_of=lambda r: 25, initial=None):
    """calls: dicts with install_id, ts, seq, op, category, explicit_actor.

    Returns {(install_id, seq): result dict} with gate/reject/accepted,
    opted_out_before, epoch, actor, session (start seq of the open
    session), breadcrumbs (list of track seqs, oldest first) and link flag.
    """
    by = defaultdict(list)
    for r in calls:
        by[r["install_id"]].append(r)
    out = {}
    for inst, rows in by.items():
        rows.sort(key=lambda r: (r["ts"], r["seq"]))
        C = bool((initial or {}).get(inst, False))
        A = ""
        S = None          # start seq of the open session
        E = 0
        B: deque = deque()
        for r in rows:
            op, ex = r["op"], r.get("explicit_actor")
            res = {"opted_out_before": C, "epoch": E, "actor_before": A, "session_before": S}
            gate = None
            if op not in BYPASS:
                if not enabled_of(r):
                    gate = "disabled"
                elif C:
                    gate = "opted_out"
            rej = None
            if gate is None:
                if op not in KNOWN:
                    rej = "unknown_op"
                elif op == "track" and (r.get("category") or "").startswith("_"):
                    rej = "reserved_category"
                elif op == "identify":
                    rej = actor_err(ex)
                elif op in ("track", "exception", "start_session") and ex is not None:
                    rej = actor_err(ex)
            acc = gate is None and rej is None
            res.update(gate=gate, reject=rej, accepted=acc, actor=None, session=None, link=False, crumbs=None)
            n = n_of(r)
            if acc:
                if op == "identify":
                    res["actor"] = ex
                    res["link"] = A != ex
                    A = ex
                elif op in ("track", "exception", "start_session"):
                    res["actor"] = ex if ex is not None else (A if A else f"device:{inst}:{E}")
                if op == "start_session":
                    if ex is not None:
                        A = ex
                    S = r["seq"]
                    res["session"] = S
                elif op in ("track", "exception"):
                    res["session"] = S
                elif op == "end_session":
                    S = None
                if op == "track" and n > 0:
                    B.append(r["seq"])
                    while len(B) > n:
                        B.popleft()
                if op == "exception":
                    res["crumbs"] = list(B) if n > 0 and B else None
            if op == "opt_out":
                C = True
            elif op == "opt_in":
                C = False
            elif op == "reset":
                S = None
                A = ""
                B.clear()
                E += 1
            elif op in ("start", "exit"):
                # A new process: only the consent and the device persist.
                S = None
                A = ""
                B.clear()
            out[(inst, r["seq"])] = res
    return out
