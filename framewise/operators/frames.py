"""Frame intake: freshness, newest frame per camera, intake counters, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import col, epoch_micros, lit_or_col


def frame_age_seconds(ts, now) -> Column:
    """Whole seconds between ``now`` and the frame time (floor)."""
    now = lit_or_col(now)
    return F.floor((epoch_micros(now) - epoch_micros(ts)) / F.lit(1_000_000))


def drop_stale_frames(df: DataFrame, now, ts_col: str = "frame_ts",
                      max_age_s: int = 5) -> DataFrame:
    """Keep frames with ``0 <= floor(now - ts) <= max_age_s`` seconds.

    ``now`` is a timestamp literal, a Column (per-row batch time) or, in a
    stream, ``F.current_timestamp()`` which is fixed per micro-batch.  Future
    frames are dropped; there is no day aliasing.  Stateless, so it runs
    before any shuffle and needs no watermark.
    """
    age = frame_age_seconds(ts_col, now)
    return df.where(age.between(0, max_age_s))


def latest_frame_per_camera(df: DataFrame, order_cols=("frame_ts", "event_id"),
                            keys=("camera_id",)) -> DataFrame:
    """The last-arriving frame per key (load shedding).

    Only keys and order columns are aggregated, on the map side first, so a hot
    camera ships one small row per map task; the winning rows, images included,
    are then picked by a join with that table of one row per key.  Rows that tie
    in all order columns count as one.
    """
    keys, order_cols = list(keys), list(order_cols)
    last = df.groupBy(*keys).agg(F.max(F.struct(*[col(c) for c in order_cols])).alias("_last"))
    last = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_last")
    same = col(keys[0]).eqNullSafe(F.col("_k0"))
    for i, k in enumerate(keys[1:], 1):
        same = same & col(k).eqNullSafe(F.col(f"_k{i}"))
    for c in order_cols:
        same = same & col(c).eqNullSafe(F.col(f"_last.{c}"))
    return df.join(last, same, "left_semi").dropDuplicates(keys)


def dense_rank(df: DataFrame, key: str, order: str, bucket: int) -> DataFrame:
    """Rank rows per key by ``order`` (1, 2, ...) without one window per key:
    local row numbers per (key, order div bucket) plus a carried count of the
    key's earlier buckets (a small per-bucket summary)."""
    b = F.floor(col(order) / bucket)
    d = df.withColumn("_rb", b)
    d = d.withColumn("_rl", F.row_number().over(Window.partitionBy(key, "_rb").orderBy(order)))
    summ = d.groupBy(key, "_rb").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(key).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(key, "_rb", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_carry"))
    return d.join(summ, [key, "_rb"]).withColumn("_rank", F.col("_rl") + F.col("_carry")) \
            .drop("_rb", "_rl", "_carry")


def frame_rate(frames: DataFrame, n: int = 10, key: str = "camera_id",
               order: str = "frame_no", ts: str = "frame_ts",
               bucket: int = 4096) -> DataFrame:
    """Per frame: seconds since the previous frame, ``fps = 1/dt`` and the
    mean fps over the last ``n`` frames (previous rows, so holes in the frame
    numbering are fine).

    Frames are first ranked per camera (two-level count, no per-camera
    window).  Rows are then windowed per ``(key, rank div bucket)`` with the
    last ``n`` ranks of the previous bucket copied in as a halo, so one busy
    camera spreads over many tasks instead of one sort of its whole history.
    """
    halo = n
    if bucket <= halo:
        raise ValueError("bucket must exceed n")
    rows = dense_rank(frames.select(key, order, ts), key, order, bucket)
    r = F.col("_rank")
    shifts = F.when(r % bucket >= bucket - halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = (rows.withColumn("_shift", F.explode(shifts))
                .withColumn("_bucket", F.floor(r / bucket) + F.col("_shift")))
    w = Window.partitionBy(key, "_bucket").orderBy("_rank")
    dt = (epoch_micros(ts) - F.lag(epoch_micros(ts)).over(w)) / F.lit(1e6)
    rows = rows.withColumn("dt_s", dt).withColumn("fps", F.try_divide(F.lit(1.0), F.col("dt_s")))
    rows = rows.withColumn("fps_avg", F.avg("fps").over(w.rowsBetween(-(n - 1), 0)))
    return rows.where(F.col("_shift") == 0).drop("_shift", "_bucket", "_rank")


def processing_latency(frames: DataFrame, results: DataFrame, key: str = "camera_id",
                       frame_key: str = "frame_no", ts: str = "frame_ts",
                       done_ts: str = "done_ts") -> DataFrame:
    """Per camera: frames processed and seconds from frame time to result time
    (count, mean, min, max, median and 95th percentile by rank).  All aggregates
    merge, so a hot camera is reduced map-side; the percentiles are sketches of
    fixed size, exact while a camera has few different latencies."""
    j = frames.select(key, frame_key, ts).join(results.select(key, frame_key, done_ts),
                                               [key, frame_key])
    lat = (epoch_micros(done_ts) - epoch_micros(ts)) / F.lit(1e6)
    return (j.withColumn("latency_s", lat).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_frames"), F.avg("latency_s").alias("avg_latency_s"),
                 F.min("latency_s").alias("min_latency_s"), F.max("latency_s").alias("max_latency_s"),
                 F.percentile_approx("latency_s", 0.5, 10_000).alias("p50_latency_s"),
                 F.percentile_approx("latency_s", 0.95, 10_000).alias("p95_latency_s")))


MALFORMED, STALE, FRESH = "malformed", "stale", "fresh"


def classify_messages(messages: DataFrame, now, value_col: str = "value", max_age_s: int | None = 5) -> DataFrame:
    """Messages parsed once, with ``status`` (malformed, stale or fresh) and ``claimed``: the
    camera of a good message, or the one named in a broken one where it can be read.
    ``now`` is the batch's clock; ``max_age_s=None`` takes every age as fresh."""
    from ..sources.messages import parse_with_reason

    p = parse_with_reason(messages, value_col)
    fresh = F.lit(True) if max_age_s is None else frame_age_seconds("frame_ts", now).between(0, max_age_s)
    status = F.when(F.col("reason").isNotNull(), MALFORMED).when(fresh, FRESH).otherwise(STALE)
    claimed = F.when(F.col("reason").isNull(), F.col("camera_id")).otherwise(F.get_json_object(value_col, "$.camera_id"))
    return p.withColumn("status", status).withColumn("claimed", claimed)


def intake_metrics() -> list[Column]:
    """Counters over classified messages, for ``observe()`` in the pass that parses."""
    return [F.count(F.lit(1)).alias("received"), *[F.count_if(F.col("status") == s).alias(s) for s in (MALFORMED, STALE, FRESH)]]


def count_classified(classified: DataFrame, keys) -> DataFrame:
    """Per group: messages received, malformed, stale, superseded by a newer fresh frame, and
    processed (at most one).  Decomposable sums, aggregated on the map side first."""
    a = classified.groupBy(*keys).agg(*intake_metrics())
    return (a.withColumn("processed", F.least(F.col(FRESH), F.lit(1)).cast("bigint"))
             .withColumn("superseded", F.greatest(F.col(FRESH) - 1, F.lit(0)).cast("bigint")).drop(FRESH))


def batch_intake_counts(messages: DataFrame, now, batch_col: str = "batch_id",
                        value_col: str = "value", max_age_s: int | None = 5) -> DataFrame:
    """Per (batch, camera): messages received, malformed, stale, superseded
    by a newer fresh frame of the same camera, and processed (at most one).
    Rejects are attributed to the camera named in the message when it can
    be read.  Every message is parsed once."""
    c = classify_messages(messages, now, value_col, max_age_s).withColumn("camera_id", F.col("claimed"))
    return count_classified(c, [batch_col, "camera_id"])
