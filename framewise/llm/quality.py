"""Quality classifier: random Fourier features over document statistics.

A document becomes a short vector of statistics of its whole text.  Random
Fourier features of the standardised vector approximate a Gaussian kernel;
ridge regression on them needs only sums over rows, the normal equations, which
each partition adds up on its own.  The ridge scores are then calibrated by
isotonic regression over a fixed number of score bins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, free_name, schema_of, stored

STATS = ("log_bytes", "log_words", "word_len", "long_words", "short_words", "distinct_words", "distinct_thirds",
         "upper", "digit", "symbol", "punct", "quote_bracket", "non_ascii", "blank", "lines", "dup_lines",
         "line_len", "ends_stop", "top_word", "caps_words", "byte_entropy")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _mark(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _PUNCT, _QUOTE, _BLANK = _mark("#*$%&|<>~^=_\\@"), _mark(".,;:!?"), _mark("\"'()[]{}"), _mark(" \t\n\r\x0b\x0c")


def statistics(text: str | None) -> np.ndarray:
    """The vector STATS of a whole text; null counts as empty, whose vector is zero."""
    out = np.zeros(len(STATS))
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    k, m = max(len(words), 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.sort(np.unique(np.fromiter(map(hash, words), np.int64, len(words)), return_counts=True)[1])
    thirds = len(set(zip(words[::3], words[1::3], words[2::3], strict=False)))
    p = h[h > 0] / n
    out[:] = (math.log1p(n), math.log1p(len(words)), sizes.sum() / k, (sizes > 12).sum() / k, (sizes <= 2).sum() / k,
              len(counts) / k, thirds / max(k // 3, 1), h[_UPPER].sum() / n, h[_DIGIT].sum() / n,
              h[_SYMBOL].sum() / n, h[_PUNCT].sum() / n, h[_QUOTE].sum() / n, h[128:].sum() / n, h[_BLANK].sum() / n,
              math.log1p(len(lines)), 1 - len(set(lines)) / m, math.log1p(n / m),
              sum(x.rstrip()[-1] in ".!?" for x in lines) / m, (counts[-1] if len(counts) else 0) / k,
              sum(map(str.isupper, words)) / k, float(-(p * np.log2(p)).sum()))
    return out


@dataclass
class QualityModel:
    """``mean``/``scale`` standardise, ``freq``/``phase`` make the Fourier
    features, ``weights`` the ridge score; ``knots_x``/``knots_y`` calibrate it."""

    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None = None
    knots_x: np.ndarray | None = None
    knots_y: np.ndarray | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        rff = math.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.freq + self.phase)
        return np.concatenate([rff, z, np.ones((len(z), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1; one half where nothing was learned."""
        if not len(x):
            return np.zeros(0)
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots_x, self.knots_y), 0.0, 1.0)


def with_statistics(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """Add the statistics of each whole text as the array column ``name``."""
    col = docs.columns.index(text_col)

    def step(batches):
        for b in batches:
            flat = np.concatenate([statistics(t) for t in b.column(col).to_pylist()] or [np.zeros(0)])
            ends = pa.array(np.arange(0, len(flat) + 1, len(STATS)), pa.int32())
            made = pa.ListArray.from_arrays(ends, pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, made], names=[*b.schema.names, name])

    return docs.mapInArrow(step, schema_of(docs, [(name, T.ArrayType(T.DoubleType()))]))


def _sum_blocks(rows: DataFrame, width: int, add, scale_rows: int) -> np.ndarray:
    """Sum ``add(batch)`` (a matrix ``scale_rows`` x ``width``) over all partitions.

    Each partition sends its own sum, cut into blocks of matrix rows; the blocks
    are added up in as many tasks.  The driver gets one matrix, whose size the
    feature count fixes.
    """
    block = 64

    def part(batches):
        total = None
        for b in batches:
            m = add(b)
            total = m if total is None else total + m
        if total is not None:
            for at in range(0, scale_rows, block):
                yield pd.DataFrame({"block": [at], "cells": [np.ascontiguousarray(total[at:at + block]).tobytes()]})

    def merge(key, got):
        whole = sum(np.frombuffer(c, np.float64) for c in got["cells"])
        return pd.DataFrame({"block": [key[0]], "cells": [whole.tobytes()]})

    parts = rows.mapInPandas(part, "block int, cells binary")
    sums = parts.groupBy("block").applyInPandas(merge, "block int, cells binary").collect()
    out = np.zeros((scale_rows, width))
    for r in sums:
        m = np.frombuffer(r["cells"], np.float64).reshape(-1, width)
        out[r["block"]:r["block"] + len(m)] = m
    return out


def isotonic(y_sum: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins in order: the non-decreasing means."""
    means, sizes, bins = [], [], []
    for s, k in zip(y_sum, n, strict=True):
        means.append(s / k)
        sizes.append(k)
        bins.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            a, b = sizes[-2], sizes[-1]
            means[-2:] = [(means[-2] * a + means[-1] * b) / (a + b)]
            sizes[-2:] = [a + b]
            bins[-2:] = [bins[-2] + bins[-1]]
    return np.repeat(means, bins)


def fit_quality(labelled: DataFrame, features: int = 256, ridge: float = 1e-3, gamma: float = 0.02,
                bins: int = 512, seed: int = 7) -> QualityModel:
    """Fit on all rows of ``labelled`` (columns ``stats`` array<double>, ``y`` 0/1).

    Rows with a null label or statistics teach nothing.  With no usable row, or
    one class only, the model answers that class's share everywhere (one half
    without rows).
    """
    rows = labelled.filter("stats is not null and y is not null").select("stats", F.col("y").cast("double").alias("y"))
    d = len(STATS)

    def matrix(b):
        return np.stack(b["stats"].to_numpy()) if len(b) else np.zeros((0, d))

    def moments(b):
        x = matrix(b)
        return np.stack([x.sum(0), (x * x).sum(0), np.full(d, float(len(x))), np.full(d, float(b["y"].sum()))])

    s = _sum_blocks(rows, d, moments, 4)
    n, ones = s[2, 0], s[3, 0]
    rng = np.random.default_rng(seed)
    freq = rng.normal(0, math.sqrt(2 * gamma), (d, features))
    phase = rng.uniform(0, 2 * math.pi, features)
    mean = s[0] / max(n, 1)
    scale = np.sqrt(np.maximum(s[1] / max(n, 1) - mean ** 2, 0))
    model = QualityModel(mean, np.where(scale < 1e-9, 1.0, scale), freq, phase)
    if n == 0:
        return model
    if ones in (0, n):
        model.weights = np.zeros(features + d + 1)
        model.knots_x, model.knots_y = np.array([0.0]), np.array([ones / n])
        return model
    width = features + d + 1
    weight = (n / (2 * (n - ones)), n / (2 * ones))  # both labels count alike

    def normal(b):
        z, y = model.features(matrix(b)), b["y"].to_numpy()
        w = np.where(y > 0, weight[1], weight[0])
        return np.concatenate([z.T @ (z * w[:, None]), (z.T @ (w * y))[:, None]], 1)

    eq = _sum_blocks(rows, width + 1, normal, width)
    model.weights = np.linalg.solve(eq[:, :-1] + ridge * n * np.eye(width), eq[:, -1])
    low, high = -0.5, 1.5

    def tally(b):
        y = b["y"].to_numpy()
        x = np.clip(model.raw(matrix(b)), low, high)
        at = np.minimum(((x - low) / (high - low) * bins).astype(int), bins - 1)
        return np.stack([np.bincount(at, minlength=bins), np.bincount(at, y, bins), np.bincount(at, x, bins)]).astype(float)

    t = _sum_blocks(rows, bins, tally, 3)
    full = t[0] > 0
    model.knots_x = t[2, full] / t[0, full]
    model.knots_y = isotonic(t[1, full], t[0, full])
    # a slight slope inside the pooled steps keeps the ridge score's order
    model.knots_y = np.clip(model.knots_y * 0.998 + 0.002 * np.linspace(0, 1, len(model.knots_y)), 0, 1)
    return model


def _training(docs: DataFrame, labels: DataFrame, use) -> DataFrame:
    """Statistics and label of each labelled document that ``use`` keeps.

    Repeated ids in ``labels`` are settled by the larger label; null ids and
    labels are left out.  Repeated documents count as often as they occur.
    """
    y = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("k"))
    y = y.agg(F.max("quality").alias("y")).filter(use("k"))
    rows = docs.select(F.col("doc_id").alias("i"), F.col("text").alias("t")).filter(use("i"))
    made = with_statistics(rows, "t", "stats").select("i", "stats")
    return made.join(y, made["i"] == y["k"]).select("stats", "y")


def learnable(col: str):
    return crc_mod(col, 3) != 1


def quality_model(docs: DataFrame, labels: DataFrame, use=learnable, **params) -> QualityModel:
    """Fit on the labelled documents whose id ``use`` admits (default: crc32 of the id modulo 3 is not 1)."""
    return fit_quality(stored(_training(docs, labels, use), "quality-train"), **params)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", keep_from: float | None = None) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from 0.5 on) to every row.

    With ``keep_from`` the rows scoring below it go instead, and no column is
    added.  Null and empty texts are scored by the zero vector; an empty table
    gives an empty table; input columns named like the added ones are replaced.
    """
    if keep_from is None:
        docs = docs.drop("score", "predicted")
    col, names = docs.columns.index(text_col), docs.columns

    def step(batches):
        for b in batches:
            texts = b.column(col).to_pylist()
            s = model.score(np.stack([statistics(t) for t in texts])) if texts else np.zeros(0)
            if keep_from is not None:
                yield b.filter(pa.array(s >= keep_from, pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()),
                                                  pa.array((s >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    if keep_from is not None:
        return docs.mapInArrow(step, docs.schema)
    return docs.mapInArrow(step, schema_of(docs, [("score", T.DoubleType()), ("predicted", T.IntegerType())]))


def op8_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: labels only from rows whose crc32 remainder is not 1, a score for every document."""
    held = free_name(docs, "held")
    rows = docs.select("doc_id", "text", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias(held))
    out = score_quality(rows, quality_model(docs, labels))
    return out.select("doc_id", F.col(held).alias("held_out"), "score", "predicted")
