"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir, ship_package

#: Characters that part words, as the contracts fix them: blank and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a fresh table below ``spark.checkpoint.dir`` and read it
    back: cuts the lineage and survives lost executors.  ``options`` go to the writer."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def schema_of(df: DataFrame, extra: Iterable[tuple[str, T.DataType]]) -> T.StructType:
    """The fields of ``df`` followed by ``extra``."""
    return T.StructType(list(df.schema.fields) + [T.StructField(n, t) for n, t in extra])


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet (names clash without regard to case)."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{stem}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{stem}_{k}"
    return name


def crc_mod(col: str | Column, m: int) -> Column:
    """crc32 of the column's text form, modulo ``m`` (null for null)."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.crc32(c.cast("string").cast("binary")) % F.lit(m)).cast("int")


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that it is evaluated once per row
    however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_rank(df: DataFrame, key: str, ident: Column, rows: int, target: int = 4096,
               order: list[Column] | None = None) -> DataFrame:
    """Add ``rank``: the gapless 0-based place of each row among the rows of its
    ``key`` (a non-null column), without a window over a whole key.

    Each key is split into as many hash groups of ``ident`` as its row count asks
    for (about ``target`` rows each), so a key that holds a third of all rows is
    spread over many tasks.  The place is the groups' offset plus the place inside
    the group, ordered by ``order``.  Rows with one ``ident`` share a group.

    The keys must be few (a bounded number: sources, cells), as their counts are
    broadcast.  The group table has at most ``max(rows / target, 1e6) + keys`` rows;
    ``target`` grows with ``rows`` to keep that bound.
    """
    target = max(target, math.ceil(rows / 1_000_000))
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    keys = keys.select(F.col(key).alias("__k"), F.ceil(F.col("__n") / target).cast("int").alias("__splits"))
    held = df.join(F.broadcast(keys), df[key] == F.col("__k"), "left").drop("__k")
    held = held.withColumn("__sub", F.pmod(F.xxhash64(ident), F.col("__splits")).cast("int")).drop("__splits")
    groups = held.groupBy(key, "__sub").agg(F.count(F.lit(1)).alias("__g"))
    before = Window.partitionBy(key).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col(key).alias("__k"), F.col("__sub").alias("__s"),
                           F.coalesce(F.sum("__g").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(key, "__sub").orderBy(*(order or [ident]))
    ranked = held.withColumn("__rn", F.row_number().over(inside))
    return (ranked.join(groups, (ranked[key] == groups["__k"]) & (ranked["__sub"] == groups["__s"]), "left")
            .withColumn("rank", F.col("__off") + F.col("__rn") - 1)
            .drop("__k", "__s", "__sub", "__rn", "__off"))


def about(df: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows of ``df``, at most twice as many: each is taken with the
    same chance, so nothing is sorted and no task sends more than its share."""
    n = df.count()
    return df if n <= rows else df.filter(F.rand(seed) < rows / n).limit(2 * rows)


def bounded_rows(df: DataFrame, most: int) -> list:
    """Collect a table whose size a parameter bounds; more rows are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"expected at most {most} rows")
    return rows


class WordCache(dict):
    """chunk of text -> ``make(chunk)``, kept for as long as there is room: two
    generations of at most ``most`` entries bound the memory of a task."""

    def __init__(self, make, most: int = 300_000):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, chunk):
        value = self.old.get(chunk)
        if value is None:
            value = self.make(chunk)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[chunk] = value
        return value


def chunks(text: str) -> list[str]:
    """The runs between blanks and line ends, empty ones included."""
    return text.replace("\n", " ").split(" ")
