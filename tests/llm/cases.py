"""Small tables that every operator must take: nulls, empty and long texts, ties, repeated and clashing things."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns that operators add or use inside; the input may have them already.
CLASHING = ["score", "rank", "position", "shard", "stats", "spans", "kept", "n_words", "sequence_id", "label", "cls", "__cell", "__src", "k"]


def prose(rnd, n):
    return " ".join("".join(rnd.choice(["th", "er", "on", "an", "re", "in", "he"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def edge_rows():
    rnd = random.Random(4)
    base = prose(rnd, 120)
    near = " ".join(["changed", *base.split()[1:]])
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n\x0b", "en", None, 3), (3, "word", None, "a", 4), (4, "日本語 😀 é́", "fr", "b", 9),
            (5, base, "en", "a", len(base)), (6, base, "de", "b", len(base)), (7, near, "en", None, len(near)), (5, base, "en", "a", len(base)),
            (8, "call +1 (269) 555-3296 4524132264652876 or a.b@x.example.com 10.0.0.256 1.2.3.4", "en", "a", 70),
            (None, "no id at all", None, None, None), (None, None, None, None, None), (9, prose(rnd, 60_000), "en", "c", None),
            (10, "12345\n12345\n" * 30, "xx", "c", 360), (11, "### $$$ !!! " * 40, "en", "c", 480)]
    rows += [(20 + i, prose(rnd, rnd.randint(1, 300)), rnd.choice(["en", "fr"]), rnd.choice("abcd"), 10) for i in range(40)]
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING})
