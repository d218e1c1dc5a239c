"""Detection log text: ``frame x y w h [x y w h ...]`` per line.

Lines end with a blank after the last number; a frame without boxes still
gets a line with its number only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_detection_log(frames: DataFrame, dets: DataFrame, keys=("camera_id",),
                        frame: str = "frame_no", box=("x", "y", "w", "h"), order: str = "det_id",
                        path: str | None = None) -> DataFrame:
    """One log line per frame, boxes in detector order.  With ``path`` the
    lines are also written as text, one directory per camera."""
    keys = list(keys)
    item = F.struct(F.col(order).alias("o"), *[F.col(c).cast("string").alias(c) for c in box])
    per_frame = dets.groupBy(*keys, frame).agg(F.array_sort(F.collect_list(item)).alias("_b"))
    f = frames.select(*keys, frame).distinct().join(per_frame, keys + [frame], "left")
    nums = F.flatten(F.transform(F.coalesce(F.col("_b"), F.array()),
                                 lambda b: F.array(*[b[c] for c in box])))
    line = F.concat(F.concat_ws(" ", F.concat(F.array(F.col(frame).cast("string")), nums)), F.lit(" "))
    out = f.select(*keys, frame, line.alias("line"))
    if path:
        out.select(*keys, F.col("line").alias("value")).write.mode("overwrite").partitionBy(*keys).text(path)
    return out


def read_detection_log(lines: DataFrame, value_col: str = "value", cast: str = "double") -> DataFrame:
    """Parse log lines into ``(frame_no, box_no, x, y, w, h)``; box order is
    kept as ``box_no`` (0-based).  Other columns (e.g. the camera
    partition) pass through."""
    rest = [c for c in lines.columns if c != value_col]
    tok = F.split(F.trim(F.col(value_col)), " +")
    t = lines.select(*rest, tok.alias("_t"))
    n = F.floor((F.size("_t") - 1) / 4)
    t = t.select(*rest, F.col("_t")[0].cast("bigint").alias("frame_no"), "_t",
                 F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), n - 1))).alias("box_no"))
    return t.select(*rest, "frame_no", F.col("box_no").cast("int").alias("box_no"),
                    *[F.element_at("_t", (F.col("box_no") * 4 + 2 + i).cast("int")).cast(cast).alias(c)
                      for i, c in enumerate(("x", "y", "w", "h"))])
