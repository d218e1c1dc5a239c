"""Frame messages in, position records out.

A frame message is one JSON object ``{camera_id, timestamp, image}`` with the
time as ``yyyy-MM-ddTHH:mm:ss.ffffff`` (local, no zone) and the image as
base64 text.  Kafka is used when its connector is deployed; any file source
gives the same downstream plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FRAME_TIME_FORMAT

FRAME_JSON_SCHEMA = "camera_id string, timestamp string, image string"
POSITION_JSON_SCHEMA = ("camera_id string, frame_no string, ID string, timestamp string, "
                        "location_x string, w string, image string")


def read_frame_messages(spark: SparkSession, source: str = "kafka", path: str | None = None,
                        topic: str | None = "test", stream: bool = True, **opts) -> DataFrame:
    """Frame messages as ``(key, value, ...)``.

    ``source="kafka"``: subscribe to ``topic`` (options such as
    ``kafka.bootstrap.servers`` pass through); rows keep partition and
    offset for arrival order.  ``source`` in {text, json, parquet}: files
    under ``path`` with a ``value`` column (text: one message per line).
    """
    reader = spark.readStream if stream else spark.read
    if source == "kafka":
        r = reader.format("kafka").option("subscribe", topic)
        for k, v in opts.items():
            r = r.option(k, v)
        df = _kafka_gated(r.load)
        return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                         "topic", "partition", "offset", F.col("timestamp").alias("arrival_ts"))
    r = reader.format(source)
    for k, v in opts.items():
        r = r.option(k, v)
    if source == "text":
        return r.load(path)
    if stream and "schema" not in opts:
        r = r.schema("key string, value string")
    return r.load(path)


def _kafka_gated(action):
    """Run a Kafka read/write; a missing connector becomes a clear error."""
    try:
        return action()
    except Exception as e:  # connector jar absent on this cluster
        msg = str(e).lower()
        if "kafka" in msg and ("find" in msg or "not found" in msg):
            raise RuntimeError(
                "Kafka source is not deployed (spark-sql-kafka not on the classpath); use a file "
                "source/sink ('text', 'json', 'parquet') with the same plan") from e
        raise


def frame_message_value(camera_id: Column | None, ts: Column, image: Column) -> Column:
    """Serialise a frame message (producer side)."""
    fields = [F.date_format(ts, FRAME_TIME_FORMAT).alias("timestamp"), F.base64(image).alias("image")]
    if camera_id is not None:
        fields.insert(0, camera_id.alias("camera_id"))
    return F.to_json(F.struct(*fields))


def parse_with_reason(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Every message parsed once: ``camera_id``, ``frame_ts`` (timestamp), ``image``
    (bytes) and ``reason``, null for a good message, else bad_json,
    missing_camera, bad_time or bad_base64 (first rule wins).  The message and all
    other input columns pass through; no row is dropped."""
    v = F.col(value_col)
    # malformed text (truncated, not an object) lands in _corrupt
    parsed = F.from_json(v, FRAME_JSON_SCHEMA + ", _corrupt string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    ts = F.try_to_timestamp(parsed["timestamp"], F.lit(FRAME_TIME_FORMAT))
    img = F.try_to_binary(parsed["image"], F.lit("base64"))
    reason = (F.when(v.isNull() | parsed.isNull() | parsed["_corrupt"].isNotNull(), F.lit("bad_json"))
              .when(parsed["camera_id"].isNull(), F.lit("missing_camera"))
              .when(ts.isNull(), F.lit("bad_time"))
              .when(parsed["image"].isNull() | img.isNull(), F.lit("bad_base64")))
    rest = [c for c in df.columns if c != value_col]
    return df.select(*rest, v.alias(value_col), parsed["camera_id"].alias("camera_id"),
                     ts.cast("timestamp_ntz").alias("frame_ts"), img.alias("image"), reason.alias("reason"))


def parse_frame_messages(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed frames and rejects (see :func:`parse_with_reason`): good rows without the
    message, rejects with the message and its ``reason``.  Who needs both of a
    batch reads :func:`parse_with_reason` once instead."""
    out = parse_with_reason(df, value_col)
    rest = [c for c in df.columns if c != value_col]
    good = out.where(F.col("reason").isNull()).drop("reason", value_col)
    rejects = out.where(F.col("reason").isNotNull()).select(*rest, value_col, "reason")
    return good, rejects


def position_value(df: DataFrame, id_col: str = "ID", image: Column | None = None) -> Column:
    """Position record as JSON with every value a string (wire format)."""
    fields = [F.col("camera_id").cast("string").alias("camera_id"),
              F.col("frame_no").cast("string").alias("frame_no"),
              F.col(id_col).cast("string").alias("ID"),
              F.date_format("timestamp", FRAME_TIME_FORMAT).alias("timestamp"),
              F.col("location_x").cast("string").alias("location_x"),
              F.col("w").cast("string").alias("w")]
    if image is not None:
        fields.append(F.base64(image).alias("image"))
    return F.to_json(F.struct(*fields))


def write_text_batch(values: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch of text lines in a folder of its own: a batch that runs again replaces it."""
    values.write.mode("overwrite").text(f"{path.rstrip('/')}/batch_id={batch_id}")


def publish_positions(df: DataFrame, sink: str = "kafka", path: str | None = None,
                      topic: str = "position", checkpoint: str | None = None, **opts):
    """Serialise position records and write them.

    Batch DataFrames are written once; streaming ones start a query whose
    micro-batch commit replaces the per-record flush (returns the query).
    ``sink="kafka"`` needs the connector; ``text`` writes one JSON record a line,
    a stream into ``<path>/batch_id=<n>``, so that a replayed batch neither loses nor doubles
    records (``spark.read.text(path)`` reads them all).  A stream needs ``checkpoint``."""
    if sink not in ("kafka", "text"):
        raise ValueError(f"unknown sink {sink!r}: use 'kafka' or 'text'")
    key, value = F.col("camera_id").cast("string").alias("key"), position_value(df).alias("value")
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint folder to survive a restart")
        if sink == "kafka":
            w = df.select(key, value).writeStream.format("kafka").option("topic", topic)
        else:
            w = df.select(value).writeStream.foreachBatch(lambda batch, batch_id: write_text_batch(batch, path, batch_id))
        w = w.option("checkpointLocation", checkpoint)
        for k, v in opts.items():
            w = w.option(k, v)
        return _kafka_gated(w.start) if sink == "kafka" else w.start()
    if sink == "kafka":
        w = df.select(key, value).write.format("kafka").option("topic", topic)
        for k, v in opts.items():
            w = w.option(k, v)
        _kafka_gated(w.save)
    else:
        df.select(value).write.mode("overwrite").text(path)
    return None


def read_positions(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Consumer side: position JSON back to typed rows (+ image bytes)."""
    p = F.from_json(F.col(value_col), POSITION_JSON_SCHEMA)
    return df.select(
        p["camera_id"].alias("camera_id"), p["frame_no"].cast("bigint").alias("frame_no"),
        p["ID"].cast("bigint").alias("ID"),
        F.try_to_timestamp(p["timestamp"], F.lit(FRAME_TIME_FORMAT)).alias("timestamp"),
        p["location_x"].cast("double").alias("location_x"), p["w"].cast("double").alias("w"),
        F.try_to_binary(p["image"], F.lit("base64")).alias("image"))
