"""Class-name and anchor dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_dimensions(spark: SparkSession, classes_path: str, anchors_path: str) -> tuple[DataFrame, DataFrame]:
    """Class names (one per line, stripped, id = line number from 0) and
    anchors (first line, comma separated, consecutive pairs = (w, h)).

    Files are read whole (``wholetext``) so line order is explicit and never
    depends on how rows are split into partitions."""
    ct = spark.read.text(classes_path, wholetext=True)
    # every line counts, blank ones too; only what follows the last line end is no line
    lines = F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")
    classes = ct.select(F.posexplode(lines).alias("class_id", "class_name")) \
                .select(F.col("class_id").cast("int"), F.trim("class_name").alias("class_name"))
    at = spark.read.text(anchors_path, wholetext=True)
    # the line is cut into pairs first and their numbers are read row by row, so a long line is read once
    first = F.split("value", "\r?\n", 2)[0]
    pairs = F.split(F.regexp_replace(first, "([^,]*),([^,]*)(,|$)", "$1,$2\n"), "\n")
    cut = at.select(F.posexplode(pairs).alias("anchor_id", "_pair")).where(F.contains("_pair", F.lit(",")))
    w, h = (F.trim(F.split("_pair", ",")[i]).cast("double") for i in (0, 1))
    return classes, cut.select("anchor_id", w.alias("anchor_w"), h.alias("anchor_h"))
