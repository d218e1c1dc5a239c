"""Constant-velocity Kalman filter on (cx, cy, a, h) as Column expressions.

The transition only couples each axis with its own velocity and all noise
matrices are diagonal, so the 8x8 covariance is exactly four independent 2x2
blocks.  A state is a struct of 20 doubles: per axis ``k`` the mean ``k``, the
velocity ``v_k`` and the block ``pp_k`` (position variance), ``pv_k``
(covariance), ``vv_k`` (velocity variance).  Noise scales with the height mean
taken at the start of each step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CHI2INV95, STD_WEIGHT_POSITION as SP, STD_WEIGHT_VELOCITY as SV
from .common import col

AXES = ("x", "y", "a", "h")
STATE_FIELDS = [f for k in AXES for f in (k, f"v_{k}", f"pp_{k}", f"pv_{k}", f"vv_{k}")]
STATE_DDL = "struct<" + ",".join(f"{f}:double" for f in STATE_FIELDS) + ">"


def _noise(h: Column, axis: str, kind: str) -> Column:
    """Standard deviation of process (``q_p``, ``q_v``) or measurement (``r``)
    noise on an axis.  The aspect axis has constant noise."""
    if axis == "a":
        return F.lit({"q_p": 1e-2, "q_v": 1e-5, "r": 1e-1, "init_p": 1e-2, "init_v": 1e-5}[kind])
    scale = {"q_p": SP, "q_v": SV, "r": SP, "init_p": 2 * SP, "init_v": 10 * SV}[kind]
    return F.lit(scale) * h


def _pack(values: dict[str, Column]) -> Column:
    return F.struct(*[values[f].cast("double").alias(f) for f in STATE_FIELDS])


def initiate(cx, cy, a, h) -> Column:
    """Initial state from one measurement: zero velocity, diagonal covariance."""
    z = dict(zip(AXES, map(col, (cx, cy, a, h))))
    out = {}
    for k in AXES:
        out[k] = z[k]
        out[f"v_{k}"] = F.lit(0.0)
        p, v = _noise(z["h"], k, "init_p"), _noise(z["h"], k, "init_v")
        out[f"pp_{k}"] = p * p
        out[f"pv_{k}"] = F.lit(0.0)
        out[f"vv_{k}"] = v * v
    return _pack(out)


def predict(s) -> Column:
    """One time step: p += v; P = F P F' + Q."""
    s = col(s)
    h = s["h"]
    out = {}
    for k in AXES:
        qp, qv = _noise(h, k, "q_p"), _noise(h, k, "q_v")
        pp, pv, vv = s[f"pp_{k}"], s[f"pv_{k}"], s[f"vv_{k}"]
        out[k] = s[k] + s[f"v_{k}"]
        out[f"v_{k}"] = s[f"v_{k}"]
        out[f"pp_{k}"] = pp + 2 * pv + vv + qp * qp
        out[f"pv_{k}"] = pv + vv
        out[f"vv_{k}"] = vv + qv * qv
    return _pack(out)


def predict_n(s, steps: int) -> Column:
    """``steps`` predictions folded in one expression (no plan blow-up); none
    for 0."""
    if steps < 0:
        raise ValueError("steps must not be negative")
    if steps == 0:
        return col(s)
    if steps == 1:
        return predict(s)
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), col(s), lambda acc, _: predict(acc))


def project(s) -> Column:
    """Measurement-space mean and variance: struct(x, y, a, h, s_x, s_y, s_a, s_h)."""
    s = col(s)
    h = s["h"]
    fields = [s[k].alias(k) for k in AXES]
    for k in AXES:
        r = _noise(h, k, "r")
        fields.append((s[f"pp_{k}"] + r * r).alias(f"s_{k}"))
    return F.struct(*fields)


def update(s, cx, cy, a, h) -> Column:
    """Correction with measurement z: per axis gain (pp/S, pv/S)."""
    s = col(s)
    z = dict(zip(AXES, map(col, (cx, cy, a, h))))
    hh = s["h"]
    out = {}
    for k in AXES:
        r = _noise(hh, k, "r")
        pp, pv, vv = s[f"pp_{k}"], s[f"pv_{k}"], s[f"vv_{k}"]
        S = pp + r * r
        innov = z[k] - s[k]
        out[k] = s[k] + pp / S * innov
        out[f"v_{k}"] = s[f"v_{k}"] + pv / S * innov
        out[f"pp_{k}"] = pp - pp * pp / S
        out[f"pv_{k}"] = pv - pp * pv / S
        out[f"vv_{k}"] = vv - pv * pv / S
    return _pack(out)


def gating_distance(s, cx, cy, a, h, only_position: bool = False) -> Column:
    """Squared Mahalanobis distance of a measurement to the projected state."""
    s = col(s)
    z = dict(zip(AXES, map(col, (cx, cy, a, h))))
    hh = s["h"]
    terms = []
    for k in (AXES[:2] if only_position else AXES):
        r = _noise(hh, k, "r")
        d = z[k] - s[k]
        terms.append(d * d / (s[f"pp_{k}"] + r * r))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def gating_threshold(only_position: bool = False) -> float:
    return CHI2INV95[2 if only_position else 4]


def gate_reach(s, axis: str, threshold: float) -> Column:
    """Half-width, on one axis, of the box that contains every measurement
    inside the gate: each squared term is at most the total, so
    ``|z - p| <= sqrt(threshold * S)`` on every axis."""
    s = col(s)
    r = _noise(s["h"], axis, "r")
    return F.sqrt(F.lit(threshold) * (s[f"pp_{axis}"] + r * r))


def gate_box(s, threshold: float) -> tuple[Column, Column, Column, Column]:
    """Corners of the box around the projected centre that holds every centre inside the gate."""
    s = col(s)
    rx, ry = gate_reach(s, "x", threshold), gate_reach(s, "y", threshold)
    return s["x"] - rx, s["y"] - ry, s["x"] + rx, s["y"] + ry


def projected_box(p, threshold: float) -> tuple[Column, Column, Column, Column]:
    """:func:`gate_box` of a state that is already projected."""
    p = col(p)
    rx, ry = F.sqrt(F.lit(threshold) * p["s_x"]), F.sqrt(F.lit(threshold) * p["s_y"])
    return p["x"] - rx, p["y"] - ry, p["x"] + rx, p["y"] + ry


def projected_distance(p, cx, cy, a, h, only_position: bool = False) -> Column:
    """:func:`gating_distance` to a state that is already projected."""
    p = col(p)
    z = dict(zip(AXES, map(col, (cx, cy, a, h))))
    terms = [(z[k] - p[k]) * (z[k] - p[k]) / p[f"s_{k}"] for k in (AXES[:2] if only_position else AXES)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def state_tlwh(s) -> dict[str, Column]:
    """Box of the state mean in tlwh coding."""
    s = col(s)
    w = s["a"] * s["h"]
    return {"x": s["x"] - w / 2, "y": s["y"] - s["h"] / 2, "w": w, "h": s["h"]}
