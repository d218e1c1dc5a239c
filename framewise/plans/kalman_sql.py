"""Kalman formulas as DuckDB SQL text, for the oracle queries.

Each function maps a dict ``field -> sql expression`` to another such dict,
so steps compose by textual substitution.
"""

from __future__ import annotations

from ..config import STD_WEIGHT_POSITION as SP, STD_WEIGHT_VELOCITY as SV
from ..functions.motion import AXES, STATE_FIELDS


def _q(axis: str, h: str, kind: str) -> str:
    if axis == "a":
        return {"q_p": "0.01", "q_v": "0.00001", "r": "0.1", "init_p": "0.01", "init_v": "0.00001"}[kind]
    scale = {"q_p": SP, "q_v": SV, "r": SP, "init_p": 2 * SP, "init_v": 10 * SV}[kind]
    return f"({scale!r} * {h})"


def columns(prefix: str) -> dict[str, str]:
    return {f: f"{prefix}{f}" for f in STATE_FIELDS}


def init(cx: str, cy: str, a: str, h: str) -> dict[str, str]:
    z = dict(zip(AXES, (cx, cy, a, h)))
    out = {}
    for k in AXES:
        p, v = _q(k, f"({h})", "init_p"), _q(k, f"({h})", "init_v")
        out[k] = f"({z[k]})"
        out[f"v_{k}"] = "0.0"
        out[f"pp_{k}"] = f"({p} * {p})"
        out[f"pv_{k}"] = "0.0"
        out[f"vv_{k}"] = f"({v} * {v})"
    return out


def predict(s: dict[str, str]) -> dict[str, str]:
    h = s["h"]
    out = {}
    for k in AXES:
        qp, qv = _q(k, h, "q_p"), _q(k, h, "q_v")
        out[k] = f"({s[k]} + {s['v_' + k]})"
        out[f"v_{k}"] = s[f"v_{k}"]
        out[f"pp_{k}"] = f"({s['pp_' + k]} + 2 * {s['pv_' + k]} + {s['vv_' + k]} + {qp} * {qp})"
        out[f"pv_{k}"] = f"({s['pv_' + k]} + {s['vv_' + k]})"
        out[f"vv_{k}"] = f"({s['vv_' + k]} + {qv} * {qv})"
    return out


def variance(s: dict[str, str], k: str) -> str:
    r = _q(k, s["h"], "r")
    return f"({s['pp_' + k]} + {r} * {r})"


def update(s: dict[str, str], z: dict[str, str]) -> dict[str, str]:
    out = {}
    for k in AXES:
        S = variance(s, k)
        pp, pv, vv = s[f"pp_{k}"], s[f"pv_{k}"], s[f"vv_{k}"]
        innov = f"(({z[k]}) - {s[k]})"
        out[k] = f"({s[k]} + {pp} / {S} * {innov})"
        out[f"v_{k}"] = f"({s['v_' + k]} + {pv} / {S} * {innov})"
        out[f"pp_{k}"] = f"({pp} - {pp} * {pp} / {S})"
        out[f"pv_{k}"] = f"({pv} - {pp} * {pv} / {S})"
        out[f"vv_{k}"] = f"({vv} - {pv} * {pv} / {S})"
    return out


def gating(s: dict[str, str], z: dict[str, str], only_position: bool = False) -> str:
    terms = []
    for k in (AXES[:2] if only_position else AXES):
        d = f"(({z[k]}) - {s[k]})"
        terms.append(f"{d} * {d} / {variance(s, k)}")
    return "(" + " + ".join(terms) + ")"


def select_list(s: dict[str, str], fields=None, round_to: int | None = 6) -> str:
    fields = fields or STATE_FIELDS
    if round_to is None:
        return ", ".join(f"cast({s[f]} as double) as {f}" for f in fields)
    return ", ".join(f"round({s[f]}, {round_to}) as {f}" for f in fields)
