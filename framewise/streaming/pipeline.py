"""The live tracking pipeline as two Structured Streaming queries.

Query 1 (intake and detection): frame messages -> parse and freshness, once, in the
streaming plan, with counters observed in passing -> per micro-batch: the classified messages are
written to ``<base>/intake/batch_id=<n>``; from there rejects, counts per camera and the
newest fresh frame per camera -> detector model on the executors, written to
``<base>/raw`` -> NMS -> detections, frames without boxes included, in
``<base>/detections``.  All writes overwrite their batch's folder, so a
replayed batch is idempotent, and nothing is held in executors.

The batch clock of the freshness filter is ``current_timestamp()`` of the streaming
plan: Spark records it with the batch's offsets before the batch runs, and a
replayed batch gets the recorded one, so it drops the same frames.

Query 2 (tracking): detections -> per-camera tracker state
(``applyInPandasWithState``) -> all live tracks per frame and position
records of visible tracks, both written per batch id.

Two queries are needed because "newest frame per camera" is defined per
micro-batch (``foreachBatch``) while the tracker is a stateful streaming
operator, which cannot run inside ``foreachBatch``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TrackerConfig
from ..functions.common import epoch_micros
from ..operators.frames import FRESH, MALFORMED, classify_messages, count_classified, intake_metrics, latest_frame_per_camera
from ..operators.inference import score_in_batches
from ..operators.nms import nms_per_frame
from ..operators.tracking import position_records
from ..sources.messages import position_value, write_text_batch
from .progress import ProgressLog
from .tracking import track_stream

DETECTION_SCHEMA = T.StructType([
    T.StructField("camera_id", T.StringType()), T.StructField("frame_no", T.LongType()),
    T.StructField("det_id", T.LongType()), T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()), T.StructField("w", T.DoubleType()),
    T.StructField("h", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("feature", T.ArrayType(T.DoubleType()))])


@dataclass
class PipelineHandles:
    intake: object
    tracking: object
    detections: str
    tracks: str
    positions: str
    rejects: str
    counts: str
    progress: str
    listener: ProgressLog

    def stop(self) -> None:
        """Stop both queries and the progress log."""
        for q in (self.intake, self.tracking):
            q.stop()
        self.listener.settle((self.intake, self.tracking))
        self.listener.spark.streams.removeListener(self.listener)


def tracking_pipeline(spark: SparkSession, messages: DataFrame, detector_factory, base: str,
                      cfg: TrackerConfig | None = None, max_age_s: int | None = 5,
                      order_cols=None, batch_size: int = 1, max_files: int = 64) -> PipelineHandles:
    """Start both queries.  ``messages`` is a streaming frame-message source
    with a ``value`` column; ``detector_factory()`` returns a model mapping a
    pandas batch of frames (camera_id, frame_no, frame_ts, image) to rows of
    :data:`DETECTION_SCHEMA` (a frame without boxes: one row with null
    ``det_id``).  ``max_age_s=None`` disables the freshness filter (replay
    of stored footage).  Frame numbers are the frame time in microseconds,
    so they increase per camera across batches.

    The newest frame is the last by ``order_cols``: by default Kafka's partition
    and offset where the source has them, else frame time and key.  Messages
    that do not parse are kept under ``rejects``, intake counts per camera under
    ``counts``, one row per micro-batch and query with rates, seconds and observed counters under
    ``progress`` (:func:`.progress.read_progress`).  Without ``cfg`` a track keeps its last 100 samples.
    ``max_files`` bounds what one tracking trigger takes in."""
    cfg = cfg or TrackerConfig(budget=100)
    at = {n: f"{base}/{n}" for n in ("intake", "raw", "detections", "tracks", "positions", "rejects", "counts", "progress")}
    have = set(messages.columns)
    if order_cols is None:
        order_cols = ("partition", "offset") if {"partition", "offset"} <= have else ("frame_ts", "key") if "key" in have else ("frame_ts",)
    extra = [c for c in order_cols if c != "frame_ts"]
    names = {n: f"framewise-{n}-{zlib.crc32(base.encode())}" for n in ("intake", "tracking")}
    log = ProgressLog(spark, at["progress"], names.values())
    spark.streams.addListener(log)

    def intake_batch(df: DataFrame, batch_id: int):
        batch = f"batch_id={batch_id}"
        df.write.mode("overwrite").parquet(f"{at['intake']}/{batch}")      # the one pass that parses
        seen = spark.read.schema(df.schema).parquet(f"{at['intake']}/{batch}")
        seen.where(F.col("status") == MALFORMED).select(*[c for c in messages.columns], "reason") \
            .write.mode("overwrite").json(f"{at['rejects']}/{batch}")
        count_classified(seen.withColumn("camera_id", F.col("claimed")), ["camera_id"]) \
            .write.mode("overwrite").parquet(f"{at['counts']}/{batch}")
        fresh = seen.where(F.col("status") == FRESH).withColumn("frame_no", epoch_micros("frame_ts"))
        latest = latest_frame_per_camera(fresh.select("camera_id", "frame_no", "frame_ts", "image", *extra), order_cols, ("camera_id",))
        frames = latest.select("camera_id", "frame_no", "frame_ts", "image")
        # the model runs once; its output is read twice, for boxes and for frames without any
        score_in_batches(frames, detector_factory, DETECTION_SCHEMA, batch_size, one_to_one=False) \
            .write.mode("overwrite").parquet(f"{at['raw']}/{batch}")
        dets = spark.read.schema(DETECTION_SCHEMA).parquet(f"{at['raw']}/{batch}")
        kept = nms_per_frame(dets.where(F.col("det_id").isNotNull()), cfg.nms_overlap)
        out = kept.unionByName(dets.where(F.col("det_id").isNull()), allowMissingColumns=True)
        out.write.mode("overwrite").parquet(f"{at['detections']}/{batch}")

    classified = classify_messages(messages, F.current_timestamp(), max_age_s=max_age_s).observe("intake", *intake_metrics())
    q1 = (classified.writeStream.queryName(names["intake"]).foreachBatch(intake_batch)
          .option("checkpointLocation", f"{base}/ckpt-intake").start())

    stored = T.StructType([*DETECTION_SCHEMA.fields, T.StructField("pick", T.IntegerType())])
    det_stream = spark.readStream.schema(stored).option("maxFilesPerTrigger", max_files).parquet(f"{at['detections']}/*")
    tracks = track_stream(det_stream, cfg, key="camera_id", count_late=True)

    def tracking_batch(df: DataFrame, batch_id: int):
        # write once, derive positions from what was written (no second run of the stateful step)
        path = f"{at['tracks']}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(df.schema).parquet(path).where(F.col("track_id").isNotNull())
        pos = position_records(rows, ts_col=None, key="camera_id")
        write_text_batch(pos.select(position_value(pos).alias("value")), at["positions"], batch_id)

    q2 = (tracks.writeStream.queryName(names["tracking"]).foreachBatch(tracking_batch).outputMode("append")
          .option("checkpointLocation", f"{base}/ckpt-tracking").start())
    return PipelineHandles(q1, q2, at["detections"], at["tracks"], at["positions"], at["rejects"], at["counts"], at["progress"], log)
