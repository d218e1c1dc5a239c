"""Kalman filter operators over track and detection tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import INFTY_COST
from ..functions import motion as KF
from ..functions.common import col
from ..session import scratch_path
from .cells import cell_pairs
from .sorted_groups import cpu_parallelism

STATE = "kf"


def initiate_tracks(dets: DataFrame, xyah=("cx", "cy", "a", "h"), out: str = STATE) -> DataFrame:
    """Initial state per detection (measurement in xyah)."""
    return dets.withColumn(out, KF.initiate(*xyah))


def forecast_tracks(states: DataFrame, steps: int = 1, state: str = STATE,
                    age: str | None = "age", tsu: str | None = "time_since_update") -> DataFrame:
    """Predict every track ``steps`` frames ahead; age and time since update
    advance by the same amount when present."""
    out = states.withColumn(state, KF.predict_n(state, steps))
    for c in (age, tsu):
        if c and c in states.columns:
            out = out.withColumn(c, F.col(c) + steps)
    return out


def project_tracks(states: DataFrame, state: str = STATE, out: str = "proj") -> DataFrame:
    """Measurement-space mean and variance of each state."""
    return states.withColumn(out, KF.project(state))


def correct_tracks(states: DataFrame, matched: DataFrame, on, z=("z_cx", "z_cy", "z_a", "z_h"),
                   state: str = STATE) -> DataFrame:
    """Join matched measurements on ``on`` and apply the correction step."""
    j = states.join(matched, list(on))
    return j.withColumn(state, KF.update(state, *z))


def mahalanobis_pairs(tracks: DataFrame, dets: DataFrame, keys=("camera_id", "frame_no"),
                      z=("d_cx", "d_cy", "d_a", "d_h"), state: str = STATE,
                      only_position: bool = False, max_d2: float | None = None,
                      cell: float = 128.0) -> DataFrame:
    """Squared Mahalanobis distance for every (track, detection) pair of a
    frame that lies inside the gate (``d2 <= max_d2``, default chi-square
    0.95 for 4 or 2 dof).  Each term of the sum is bounded by the total, so
    candidates are detections whose centre lies in the gate's bounding box
    around the projected centre, met through cells; pairs outside it are implied gated."""
    thr = max_d2 if max_d2 is not None else KF.gating_threshold(only_position)
    pairs = cell_pairs(tracks, dets, keys, KF.gate_box(state, thr), (col(z[0]), col(z[1])) * 2, cell)
    return pairs.withColumn("d2", KF.gating_distance(state, *z, only_position=only_position)).where(F.col("d2") <= thr)


def gate_pairs(pairs: DataFrame, gate: DataFrame, on, cost: str = "cost") -> DataFrame:
    """Give the infeasible cost to pairs that are not inside the motion gate
    (``gate`` = output of :func:`mahalanobis_pairs`)."""
    g = gate.select(*on, F.lit(True).alias("_in_gate"))
    j = pairs.join(g, list(on), "left")
    return j.withColumn(cost, F.when(F.col("_in_gate"), F.col(cost)).otherwise(F.lit(INFTY_COST))) \
            .drop("_in_gate")


# --- sequential filtering of observation series ---------------------------------

def _let(value, body):
    """Bind an expression to a lambda variable, so that it is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_STRETCH = 8
_ROWS = f"array<struct<frame:bigint,observed:boolean,kf:{KF.STATE_DDL}>>"


def _filter_piece(seen: str, start: str, low, high):
    """Rows of the frames ``low`` to ``high`` of one piece.  ``seen`` are the piece's
    observations in frame order, ``start`` the state before it (null: the first frame,
    which is observed, initiates one).  The accumulator is the rows so far; the last one holds the
    state.  Spark copies an accumulator at every step, so the fold goes by stretches of a few
    observations, and only their results are gathered by an outer one."""
    before = F.array(F.struct((low - 1).alias("frame"), F.lit(False).alias("observed"), F.col(start).alias("kf"))).cast(_ROWS)
    # the frame after the last observation up to the piece's end: one entry without a measurement
    entries = F.concat(F.coalesce(F.col(seen), F.array().cast("array<struct<frame:bigint,z:struct<cx:double,cy:double,a:double,h:double>>>")),
                       F.array(F.struct(high.cast("bigint").alias("frame"), F.lit(None).cast("struct<cx:double,cy:double,a:double,h:double>").alias("z"))))

    def last(acc):
        return F.get(acc, F.size(acc) - 1)

    def frame_row(acc, f, o):
        z, here = [o["z"][c] for c in ("cx", "cy", "a", "h")], (f == o["frame"]) & o["z"].isNotNull()
        ahead = F.when(last(acc)["kf"].isNotNull(), KF.predict(last(acc)["kf"]))
        state = _let(ahead, lambda s: F.when(~here, s).when(s.isNull(), KF.initiate(*z)).otherwise(KF.update(s, *z)))
        return F.concat(acc, F.array(F.struct(f.alias("frame"), here.alias("observed"), state.alias("kf"))))

    def entry(acc, o):
        frames = F.sequence(last(acc)["frame"] + 1, o["frame"])
        return F.when(last(acc)["frame"] >= o["frame"], acc).otherwise(F.aggregate(frames, acc, lambda rows, f: frame_row(rows, f, o)))

    def stretch(acc, i):
        return F.concat(acc, F.array(F.aggregate(F.slice(entries, i * _STRETCH + 1, F.lit(_STRETCH)), F.array(last(last(acc))), entry)))

    stretches = F.sequence(F.lit(0), F.floor((F.size(entries) - 1) / _STRETCH).cast("int"))
    # every stretch begins with the last row of the one before
    return F.aggregate(stretches, F.array(before), stretch,
                       lambda acc: F.flatten(F.transform(acc, lambda rows: F.slice(rows, F.lit(2), F.size(rows)))))


def kalman_filter_tracks(obs: DataFrame, key: str = "track_id", frame: str = "frame_no",
                         z=("cx", "cy", "a", "h"), chunk: int = 2048) -> DataFrame:
    """Filtered state per frame of each observation series (one row per
    frame from the first to the last observation; ``observed`` marks frames
    with a measurement; of several in one frame the greatest counts).

    JVM expressions only.  A series is cut into pieces of ``chunk`` frames; a piece is one row,
    filtered by a fold over its observations whose accumulator is the rows so far, the last of
    which holds the 20-number state.  Pieces of different series run in parallel; the state at a
    piece's end is handed on to the series' next piece, one round of joins per piece
    of the longest series (none when every series fits one piece).  Rows with a null key or frame are left out."""
    spark = obs.sparkSession
    fields = F.struct(*[F.col(c).cast("double").alias(n) for c, n in zip(z, ("cx", "cy", "a", "h"))])
    src = obs.select(key, F.col(frame).cast("long").alias("_f"), fields.alias("z")).where(F.col(key).isNotNull() & F.col("_f").isNotNull())
    span = src.groupBy(key).agg(F.min("_f").alias("_first"), F.max("_f").alias("_last"))
    rounds = span.agg(F.max(F.floor((F.col("_last") - F.col("_first")) / chunk))).first()[0]
    at = F.floor((F.col("_f") - F.col("_first")) / chunk)
    seen = F.sort_array(F.collect_list(F.struct(F.col("_f").alias("frame"), "z")))
    pieces = src.join(span, key).withColumn("_piece", at).groupBy(key, "_piece").agg(seen.alias("_all"))
    following = lambda o, i: F.get(F.col("_all"), i + 1)["frame"]
    pieces = pieces.withColumn("_seen", F.filter("_all", lambda o, i: following(o, i).isNull() | (following(o, i) != o["frame"]))).drop("_all")
    spine = span.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_last") - F.col("_first")) / chunk))))
    # a fold is dear for its bytes: both sides keep their number of tasks
    tasks, by = cpu_parallelism(obs), [key, "_piece"]
    pieces = spine.repartition(tasks, *by).join(pieces.repartition(tasks, *by), by, "left")
    low = F.col("_first") + F.col("_piece") * chunk
    high = F.least(F.col("_last"), low + chunk - 1)

    def rows(filtered):
        return filtered.select(key, F.explode("_r").alias("_o")).select(
            key, F.col("_o.frame").alias(frame), F.col("_o.observed").alias("observed"), "_o.kf.*")

    if not rounds:
        first = pieces.withColumn("_start", F.lit(None).cast(KF.STATE_DDL))
        return rows(first.withColumn("_r", _filter_piece("_seen", "_start", low, high)))
    base = scratch_path(spark, "series")
    pieces.write.partitionBy("_piece").parquet(f"{base}/pieces")
    pieces = spark.read.schema(pieces.schema).parquet(f"{base}/pieces")
    out, states = None, None
    for k in range(rounds + 1):
        now = pieces.where(F.col("_piece") == k)
        now = now.withColumn("_start", F.lit(None).cast(KF.STATE_DDL)) if states is None else now.join(states, key)
        done = now.withColumn("_r", _filter_piece("_seen", "_start", low, high)).select(key, "_r")
        done.write.parquet(f"{base}/round={k}")
        done = spark.read.schema(done.schema).parquet(f"{base}/round={k}")
        states = done.select(key, F.element_at("_r", -1)["kf"].alias("_start"))
        out = rows(done) if out is None else out.unionByName(rows(done))
    return out
