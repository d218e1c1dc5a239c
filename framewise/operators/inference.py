"""User models applied to rows in fixed-size batches (``mapInPandas``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..session import ship_package


def score_in_batches(df: DataFrame, model_factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                     out_schema, batch_size: int = 32, one_to_one: bool = True) -> DataFrame:
    """Apply a model to rows in batches of ``batch_size`` (short tail
    included); output rows follow input order within each partition.

    ``model_factory`` is called once per partition (load weights there, not
    per batch); the model maps a pandas batch to a pandas frame of the same
    length with the ``out_schema`` columns.  Arrow batch size is the Spark
    setting; model batches are cut from it.  ``one_to_one=False`` allows
    models that emit any number of rows per input (detectors).
    """

    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for pdf in batches:
            scored = []
            for s in range(0, len(pdf), batch_size):
                part = pdf.iloc[s:s + batch_size]
                part.index = range(len(part))
                out = model(part)
                if one_to_one and len(out) != len(part):
                    raise ValueError("model must return one row per input row")
                scored.append(out)
            # one frame goes back for each that came: a hand-over costs more than a small model
            if scored:
                yield scored[0] if len(scored) == 1 else pd.concat(scored, ignore_index=True)

    return df.mapInPandas(run, out_schema)


def linear_encoder(weights, inputs=("x", "y", "w", "h"), keep=(), out: str = "feature",
                   eps: float = 1e-8) -> Callable[[], Callable]:
    """A fixed linear projection followed by the encoder's output
    normalisation ``v / sqrt(eps + sum v^2)``: a test stand-in for a network
    whose result SQL can reproduce."""
    W = np.asarray(weights, dtype=float)

    def factory():
        def model(pdf: pd.DataFrame) -> pd.DataFrame:
            X = np.column_stack([pdf[c].to_numpy(dtype=float) for c in inputs])
            V = X @ W.T
            V = V / np.sqrt(eps + (V * V).sum(axis=1, keepdims=True))
            bad = np.isnan(X).any(axis=1)          # no input (e.g. empty crop) -> no vector
            vectors = np.empty(len(V), dtype=object)
            vectors[:] = [None if b else v for b, v in zip(bad, V)]
            return pd.DataFrame({**{c: pdf[c].array for c in keep}, out: vectors}, copy=False)
        return model

    return factory


def mot_feature_job(spark, det_root: str, frame_index: DataFrame, sizes: DataFrame,
                    encoder_factory, out_path: str, batch_size: int = 32,
                    glob: str = "*/det/det.txt", pattern: str = r"([^/]+)/det/[^/]+$",
                    patch=(128, 64)) -> DataFrame:
    """Offline appearance features for MOT-style detection files.

    Reads every sequence's detections in one scan, keeps frames that have an
    image (the rest are reported by :func:`frame_coverage`), computes the
    encoder crop window (float boxes), runs the encoder in batches on the
    executors, and writes per sequence the detection row followed by the
    feature vector.  Parallel over rows, not over sequences.  Returns the
    written store (read back lazily) and the detections dropped for lack of
    an image."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from ..sources.mot import frame_coverage, read_mot_detections, write_feature_store
    from .detector import crop_window
    from .sorted_groups import cpu_parallelism

    dets = read_mot_detections(spark, det_root, glob=glob, pattern=pattern)
    _, dropped = frame_coverage(dets, frame_index)
    kept = dets.join(frame_index.select("sequence", "frame_no").distinct(), ["sequence", "frame_no"])
    kept = crop_window(kept.join(sizes, "sequence"), integer_input=False, patch=patch)
    schema = T.StructType([T.StructField("sequence", T.StringType()), T.StructField("frame_no", T.IntegerType()),
                           T.StructField("row", T.ArrayType(T.DoubleType())),
                           T.StructField("feature", T.ArrayType(T.DoubleType()))])
    src = kept.select("sequence", "frame_no", "row", *[F.col(f"crop_{c}").cast("double").alias(f"crop_{c}")
                                                      for c in ("x1", "y1", "x2", "y2")])
    # joined rows are few bytes each: left to their size, they would share a few tasks
    src = src.repartition(cpu_parallelism(src), "sequence", "frame_no")
    feats = score_in_batches(src, encoder_factory, schema, batch_size)
    write_feature_store(feats.withColumn("feature", F.coalesce("feature", F.array().cast("array<double>"))),
                        out_path)
    return spark.read.parquet(out_path), dropped
