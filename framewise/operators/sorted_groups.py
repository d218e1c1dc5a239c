"""Run a pandas function over key-ordered partitions.

``repartition(keys)`` + ``sortWithinPartitions(keys + order)`` + one
``mapInPandas``: rows of a group arrive contiguous and in order, Arrow
batches stream through, and the caller's function keeps only its per-key
state between batches.  Many groups are handled per call (no per-group
Python invocation); memory is bounded by one batch plus that state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..session import ship_package


def cpu_parallelism(df: DataFrame) -> int:
    """Partition count for CPU-bound stages (Python, folds over arrays).  Their shuffle input is
    small in bytes, so size-based coalescing (AQE) would squeeze them into a
    few tasks; an explicit count keeps every core busy."""
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


def _group_breaks(pdf: pd.DataFrame, keys: list[str]) -> pd.Series:
    changed = pd.Series(False, index=pdf.index)
    for k in keys:
        changed |= pdf[k].ne(pdf[k].shift())
    return changed


def map_sorted_groups(df: DataFrame, keys, order, schema,
                      fn_factory: Callable[[], Callable[[pd.DataFrame | None], pd.DataFrame | None]],
                      num_partitions: int | None = None) -> DataFrame:
    """Stream key-ordered partitions through a stateful pandas function.

    ``fn_factory()`` is called once per partition and returns ``fn``; ``fn``
    receives the ordered Arrow batches as they come and ``None`` at the end
    of the partition, and carries whatever per-key state it needs across
    batch boundaries (a recurrence keeps its current state, never the group).
    A fresh function per partition means a retried task never sees state
    left over from an earlier attempt in a reused Python worker.
    """
    keys, order = list(keys), list(order)
    ship_package(df.sparkSession)
    parted = df.repartition(num_partitions or cpu_parallelism(df), *keys)
    ordered = parted.sortWithinPartitions(*(keys + order))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = fn_factory()
        for pdf in batches:
            if len(pdf):
                out = fn(pdf)
                if out is not None and len(out):
                    yield out
        done = fn(None)
        if done is not None and len(done):
            yield done

    return ordered.mapInPandas(run, schema)


def iter_groups(pdf: pd.DataFrame, keys) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Contiguous groups of an ordered frame, without a hash groupby."""
    keys = list(keys)
    if not len(pdf):
        return
    starts = _group_breaks(pdf, keys).to_numpy().nonzero()[0].tolist() + [len(pdf)]
    for a, b in zip(starts[:-1], starts[1:]):
        g = pdf.iloc[a:b]
        yield tuple(g.iloc[0][k] for k in keys), g
