"""MOTChallenge-style inputs and the offline feature store.

Layout: ``<root>/<sequence>/det/det.txt`` (comma-separated numbers; column 0
frame, 2-5 box) and ``<root>/<sequence>/img1/<frame>.<ext>``.  Sequences are
taken from the file path, so every sequence is read by one parallel scan.
"""

from __future__ import annotations

import os
import re
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sorted_groups import cpu_parallelism


def read_mot_detections(spark: SparkSession, root: str, detection_root: str | None = None,
                        pattern: str = r"([^/]+)/det/[^/]+$", glob: str = "*/det/det.txt") -> DataFrame:
    """Detection rows of every sequence: ``sequence``, ``frame_no`` (int of
    column 0), ``x, y, w, h`` (columns 2-5) and all columns of the line, however
    many, as ``row``."""
    base = (detection_root or root).rstrip("/")
    lines = spark.read.text(f"{base}/{glob}")
    seq = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    row = F.transform(F.split("value", ","), lambda c: F.trim(c).try_cast("double"))
    rows = lines.where(F.trim("value") != "").select(seq.alias("sequence"), row.alias("row"))
    box = [F.get("row", F.lit(i)).alias(c) for i, c in ((2, "x"), (3, "y"), (4, "w"), (5, "h"))]
    return rows.select("sequence", F.get("row", F.lit(0)).cast("int").alias("frame_no"), *box, "row")


def read_frame_index(spark: SparkSession, root: str, glob: str = "*/img1/*",
                     pattern: str = r"([^/]+)/img1/[^/]+$", frame_pattern: str = r"/([0-9]+)\.[^/.]*$",
                     recursive: bool = False) -> DataFrame:
    """Image listing: ``sequence``, ``frame_no`` (integer file stem), ``path``.
    Only paths are selected, so file contents are never read.  A tree with a folder
    a frame (``sequence=<s>/frame_no=<n>/<any name>``) is listed with
    :data:`FRAME_TREE` as keyword arguments.  A glob is looked up by the driver, folder by folder; with ``recursive`` the folders
    below those that it names are listed by Spark's tasks, and files whose path does not match ``pattern`` are left out.
    Folders and files are many and small, so a task takes its share of them and not a few."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    tasks = cpu_parallelism(spark.range(0))
    with _listing_tasks(spark, tasks):
        files = reader.load(f"{root.rstrip('/')}/{glob}").select("path").coalesce(tasks)
    if recursive:
        files = files.where(F.col("path").rlike(pattern))
    stem = F.regexp_extract("path", frame_pattern, 1)
    return files.select(F.regexp_extract("path", pattern, 1).alias("sequence"),
                        stem.try_cast("int").alias("frame_no"), "path").where(F.col("frame_no").isNotNull())


@contextmanager
def _listing_tasks(spark: SparkSession, tasks: int):
    """Listings use ``tasks`` tasks a level at most; Spark's default is one a folder, up to 10,000."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(tasks))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_frame_tree(rows: DataFrame, root: str, sequence: str = "sequence", frame: str = "frame_no", value: str = "value") -> None:
    """A text file of its ``value`` lines for each sequence and frame (integers), in a folder of its own: the tree of :data:`FRAME_TREE`.

    Where ``root`` is a mounted folder, tasks write the files themselves.  Hadoop's local file system would start a
    process (chmod) for every folder, file and checksum.  Elsewhere Spark's partitioned writer makes the tree."""
    rows = rows.select(F.col(sequence).alias("sequence"), F.col(frame).alias("frame_no"), F.col(value).cast("string").alias("value"))
    rows = rows.repartition(cpu_parallelism(rows), "sequence", "frame_no")
    local = re.fullmatch(r"(?:file:(?://)?)?(/[^/].*)", root.rstrip("/"))
    if not local:
        # tasks move their folders, not the driver
        rows.write.partitionBy("sequence", "frame_no").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(root)
        return
    top = local.group(1)

    def write(batches):
        name, last, n = f"part-{TaskContext.get().partitionId():05d}.txt", None, 0
        for batch in batches:
            for *at, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                folder = "/".join([top, *(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in zip(("sequence", "frame_no"), at, strict=True))])
                if at != last:
                    os.makedirs(folder, exist_ok=True)
                # a task that runs again writes the same files
                with open(f"{folder}/{name}", "a" if at == last else "w", encoding="utf-8") as f:
                    f.write(f"{text or ''}\n")
                n, last = n + (at != last), at
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.sortWithinPartitions("sequence", "frame_no").mapInArrow(write, "n long").agg(F.sum("n")).first()


#: Listing of a tree that a partitioned writer makes: one folder a frame.
FRAME_TREE = {"glob": "sequence=*", "recursive": True, "pattern": r"sequence=([^/]+)/frame_no=[^/]+/[^/]+$", "frame_pattern": r"/frame_no=([0-9]+)/[^/]+$"}


def frame_coverage(dets: DataFrame, frame_index: DataFrame, key: str = "sequence",
                   frame: str = "frame_no", block: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Every frame between the first and last detected frame of a sequence,
    with ``has_dets`` / ``has_image``; plus the detections dropped because
    their frame has no image.  The frame spine is generated in blocks of
    ``block`` frames (two-level explode), so no row ever holds a whole long
    sequence.  Blocks, detections and images are shuffled together by sequence and block,
    before the blocks become frames: all tasks make frames, and no frame is shuffled."""
    rng = dets.groupBy(key).agg(F.min(frame).alias("_lo"), F.max(frame).alias("_hi"))
    blocks = rng.select(key, "_lo", "_hi", F.explode(F.sequence(F.floor(F.col("_lo") / block),
                                                               F.floor(F.col("_hi") / block))).alias("_b"))
    lo = F.greatest(F.col("_lo"), (F.col("_b") * block).cast("int"))
    hi = F.least(F.col("_hi"), (F.col("_b") * block + block - 1).cast("int"))
    blocks = blocks.select(key, "_b", lo.cast("int").alias("_lo"), hi.cast("int").alias("_hi"), F.lit(0).alias("_kind"))

    def seen(df: DataFrame, kind: int) -> DataFrame:
        at = F.col(frame).try_cast("int")  # a frame that is no int is on no spine
        if df.schema[frame].dataType.typeName() not in ("byte", "short", "integer", "long"):
            at = F.when(at == F.col(frame), at)
        return df.where(F.col(key).isNotNull() & at.isNotNull()).select(
            key, F.floor(at / block).alias("_b"), at.alias("_lo"), at.alias("_hi"), F.lit(kind).alias("_kind"))

    rows = blocks.unionByName(seen(dets, 1)).unionByName(seen(frame_index, 2)).repartition(cpu_parallelism(dets), key, "_b")
    rows = rows.select(key, "_b", "_kind", F.explode(F.sequence("_lo", "_hi")).alias(frame))
    cov = rows.groupBy(key, "_b", frame).agg(*[F.max(F.col("_kind") == k).alias(n) for k, n in enumerate(("_spine", "has_dets", "has_image"))])
    cov = cov.where("_spine").select(key, frame, "has_dets", "has_image")
    have_i = frame_index.select(key, frame).distinct()
    dropped = dets.join(have_i, [key, frame], "left_anti")
    return cov, dropped


def write_feature_store(df: DataFrame, path: str, key: str = "sequence", frame: str = "frame_no",
                        row: str = "row", feature: str = "feature", span: int = 4096) -> None:
    """Per sequence, the original detection columns followed by the feature
    vector, rows in frame order; Parquet partitioned by sequence.  Tasks take
    stretches of ``span`` frames, so a long sequence is many files."""
    out = df.select(key, frame, F.concat(F.col(row).cast("array<double>"),
                                         F.col(feature).cast("array<double>")).alias("values"))
    stretch = F.floor(F.col(frame) / span)
    # a fixed count: few bytes of rows would be put together into a few tasks that sort very many
    (out.repartition(cpu_parallelism(out), F.col(key), stretch).sortWithinPartitions(key, frame)
        .write.mode("overwrite").partitionBy(key).parquet(path))
