"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks, and its target is its part of a fluid that
serves all sources with rows left in proportion to their weights; when a source
runs out the others share its part.  Block k of a source is released at the slot
in which the fluid begins it and due when the fluid has finished it; in every
slot the released block with the earliest deadline goes next.  Every block then
meets its window, so that after any number of slots every source is within one
block of its target.  Weights are taken as they are (a float is a fraction), in
integer arithmetic, so nothing is rounded and no error adds up; no document is
dropped or repeated.

The order of blocks is one pass over a heap on the driver, handed on in stretches
of bounded size; the rows themselves are placed by DataFrame functions only.
"""

from __future__ import annotations

import heapq
import math
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import split_rank

PERIOD = 1024
#: Blocks whose places leave the driver at a time.
STRETCH = 1 << 18


def shares(weights: list[float], period: int) -> list[int]:
    """Whole shares of ``period`` near the weights, at least one each (largest
    remainder).  For timetables of one period; :func:`mix` rounds no weight."""
    total = sum(weights)
    ideal = [w / total * period for w in weights]
    got = [max(1, int(x)) for x in ideal]
    order = sorted(range(len(got)), key=lambda i: (got[i] - ideal[i], i))
    step = 1 if sum(got) < period else -1
    k = 0
    while sum(got) != period:
        i = order[k % len(order)] if step > 0 else order[-1 - k % len(order)]
        if got[i] + step >= 1:
            got[i] += step
        k += 1
    return got


def deal(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int]]:
    """(source, block) of each slot: earliest deadline first among the released
    blocks, ties to the earlier source.  Weights are positive.

    Up to the end of source g (in the order in which the fluid finishes them) the
    fluid has served ``gone[g] + rate[g] * v`` blocks at virtual time v, and source i
    has had k of them at v = k / q[i], so every window is a whole-number division.
    """
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(x.denominator for x in exact))
    q = [int(x * scale) for x in exact]
    if any(x <= 0 for x in q):
        raise ValueError("weights must be positive")
    ends = sorted((i for i, b in enumerate(blocks) if b), key=lambda i: Fraction(blocks[i], q[i]))
    close = [blocks[i] / q[i] for i in ends]
    gone = [0, *accumulate(blocks[i] for i in ends)]
    rate = [*accumulate((q[i] for i in reversed(ends)), initial=0)][::-1]

    def served(i: int, k: int) -> tuple[int, int]:
        """What the fluid has served when source i has had k blocks, rounded down and up."""
        g = bisect_left(close, k / q[i])
        while g < len(ends) and blocks[ends[g]] * q[i] < k * q[ends[g]]:
            g += 1
        while g and blocks[ends[g - 1]] * q[i] >= k * q[ends[g - 1]]:
            g -= 1
        whole, rest = divmod(rate[g] * k, q[i])
        return gone[g] + whole, gone[g] + whole + (rest > 0)

    waiting = [(0, i, 0) for i in sorted(ends)]  # release, source, block
    ready: list[tuple[int, int, int, int]] = []
    for t in range(gone[-1]):
        while waiting and waiting[0][0] <= t:
            _, i, k = heapq.heappop(waiting)
            following, due = served(i, k + 1)
            heapq.heappush(ready, (due, i, k, following))
        due, i, k, following = heapq.heappop(ready)
        assert due > t, "Pfair windows always fit: the fluid fills every slot"
        yield i, k
        if k + 1 < blocks[i]:
            heapq.heappush(waiting, (following, i, k + 1))


def timetable(parts: list[int]) -> list[int]:
    """Source of each slot when sources with ``parts`` blocks end together."""
    return [i for i, _ in deal(parts, parts)]


def schedule(blocks: list[int], weights: list[float], period: int = PERIOD) -> tuple[list[dict], list[tuple]]:
    """The order of :func:`deal` cut into periods, each with its own timetable.

    A segment row has, for one source: seg, src, first block, number of blocks,
    share of the period, first slot.  A timetable row: seg, src, j (the source's
    j-th block within the period), slot.
    """
    segments: dict[tuple[int, int], dict] = {}
    slots = []
    for t, (i, k) in enumerate(deal(blocks, weights)):
        seg = t // period
        s = segments.setdefault((seg, i), {"seg": seg, "src": i, "first": k, "blocks": 0, "share": 0, "start": seg * period})
        slots.append((seg, i, s["blocks"], t % period))
        s["blocks"] += 1
        s["share"] += 1
    return list(segments.values()), slots


def source_weights(sizes: dict[str | None, int], temperature: float) -> dict[str | None, float]:
    """Target weights from row counts: proportional to count ** temperature."""
    return {s: float(n) ** temperature for s, n in sizes.items()}


def _places(spark: SparkSession, order: Iterator[tuple[int, int]], counts: list[int], block: int) -> DataFrame:
    """__tsrc, __j, __first: the number of rows before each block, from the blocks in
    order.  Written by stretches, so the driver never holds them all; a source's
    last block can be short."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/mix-{uuid.uuid4().hex[:12]}"
    names, before, more = ["__tsrc", "__j", "__first"], 0, True
    while more:
        src, nth, first = array("i"), array("q"), array("q")
        more = False
        for i, k in order:
            src.append(i)
            nth.append(k)
            first.append(before)
            before += min(block, counts[i] - k * block)
            if len(src) == STRETCH:
                more = True
                break
        rows = pa.table([pa.array(src, pa.int32()), pa.array(nth, pa.int64()), pa.array(first, pa.int64())], names=names)
        spark.createDataFrame(rows).write.mode("append").parquet(path)
    return spark.read.schema("__tsrc int, __j long, __first long").parquet(path)


def mix(docs: DataFrame, ident: list[str], weights=None, source_col: str = "source", block: int = 8,
        temperature: float = 0.5, max_sources: int | None = None) -> DataFrame:
    """Add ``position``: the gapless place of each row in the mixed order.

    ``weights`` maps sources to target weights (default: row counts to the power
    of ``temperature``); sources of any type are told apart by their text form.  A null source is a source of its own.  Every source is
    mixed by itself, however many there are; the driver holds one small row per
    source.  Sources to which ``weights`` gives nothing have no target: they come
    after all others, mixed among themselves by the default weights.  A caller who
    gives ``max_sources`` has the sources of least weight beyond ``max_sources - 1``
    mixed as one with their summed weight, all rows kept.  Inside a source the
    order is by hash and value of ``ident``.  Repeated rows each get a place; an
    empty table gives an empty one.
    """
    sizes = {r["s"]: r["n"] for r in docs.groupBy(F.col(source_col).cast("string").alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(sizes.values())
    usual = source_weights(sizes, temperature)
    given = {s if s is None else str(s): w for s, w in (weights or {}).items()}
    goal = usual if weights is None else {s: given[s] for s in sizes if given.get(s)}
    by_weight = sorted(goal, key=lambda s: (-goal[s], s is not None, s))
    alone = by_weight if max_sources is None else by_weight[:max_sources - 1]
    groups = [[s] for s in alone] + [[s] for s in sizes if s not in goal]
    pool = by_weight[len(alone):]
    if pool:
        groups.insert(len(alone), pool)
    place = {s: i for i, g in enumerate(groups) for s in g}
    counts = [sum(sizes[s] for s in g) for g in groups]
    aimed = len(alone) + bool(pool)
    target = [sum(goal[s] for s in g) for g in groups[:aimed]] + [usual[s] for (s,) in groups[aimed:]]
    spark = docs.sparkSession
    mapped = spark.createDataFrame(pa.table({"__s": pa.array(list(place), pa.string()), "__src": pa.array(list(place.values()), pa.int32())}))
    kept = [c for c in docs.columns if c.lower() != "position"]
    # the row's own columns travel as one, so that their names meet no other
    out = docs.select(F.struct(*kept).alias("__row"), F.col(source_col).cast("string").alias("__source"), F.struct(*ident).alias("__id"))
    out = out.join(F.broadcast(mapped), F.col("__source").eqNullSafe(F.col("__s")), "left")
    out = out.select("__row", "__id", "__src")
    out = split_rank(out, "__src", F.col("__id"), rows)
    blocks = [-(-n // block) for n in counts]
    rest = ((i + aimed, k) for i, k in deal(blocks[aimed:], target[aimed:]))
    table = _places(spark, chain(deal(blocks[:aimed], target[:aimed]), rest), counts, block)
    out = out.withColumn("__k", F.expr(f"rank div {block}"))
    out = out.join(table, (F.col("__src") == F.col("__tsrc")) & (F.col("__k") == F.col("__j")))
    out = out.withColumn("position", F.col("__first") + F.expr(f"rank % {block}"))
    return out.select("__row.*", F.col("position").cast("long"))


def in_mixed_order(docs: DataFrame, ident: list[str], source_col: str = "source", **params) -> DataFrame:
    """The rows in mixed order, with the columns of ``docs`` alone."""
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col(source_col), *ident)
    return mix(held, ident, source_col=source_col, **params).orderBy("position").select("row.*")


def op6_mix(docs: DataFrame) -> DataFrame:
    """Every document's place in a mix whose weights are the square roots of the sources' sizes."""
    return mix(docs.select("doc_id", "source"), ["doc_id"])
