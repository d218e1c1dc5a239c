"""SpotSigs fingerprints: chains of content words that follow common words.

Common words ("the", "der", "les", "que") are anchors, and so are words picked by
their hash, which every language and every list has; an anchor and the next
content words after it form one signature.  A text's fingerprint is the set of
its signatures, and likeness is the Jaccard index of two sets.  Sets are filed
under a length partition, and a pair whose lengths alone rule out a likeness is
not intersected.  DataFrame functions only.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, stored

#: One word in so many begins a chain for its hash alone.
PICKED = 2


class Anchors(list):
    """The listed words, which iteration gives; words picked by their hash belong too."""

    def __contains__(self, word) -> bool:
        return super().__contains__(word) or zlib.crc32(word.encode()) % PICKED == 0


#: Words that begin a chain (fixed values; English, German, French, Spanish), besides the picked ones.
ANCHORS = Anchors(["the", "of", "is", "was", "der", "die", "und", "ist", "le", "les", "est", "et", "el", "los", "que", "es"])
#: Further common words that a chain steps over (fixed values).
STEPPED = ["a", "an", "and", "to", "in", "for", "on", "that", "it", "with", "as", "be", "by", "are", "this", "from",
           "das", "den", "ein", "eine", "zu", "von", "mit", "auf", "la", "de", "des", "du", "en", "un", "une", "las", "del", "por", "con", "y"]
#: Removed wherever they stand, so that they hide no anchor.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»‘“”„…–—•·、。，！？：；（）「」"
HEAD, REACH, CHAIN = 16, 7, 2


def spots(text: Column) -> Column:
    """The words of a text for chaining: lower case, without common marks."""
    bare = F.trim(F.lower(F.translate(F.coalesce(text, F.lit("")), MARKS, "")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))


def signatures(text: Column) -> Column:
    """The sorted set of a text's signatures (40-bit hashes).

    Every anchor begins a chain of the next CHAIN content words among the REACH
    words behind it.  The first HEAD words begin one each too, so that short texts
    have signatures.  Where no anchor follows them and their chains do not reach
    the end, every word begins one, so no text goes by its first words alone.  (A
    run of repeated words that are no anchors still adds nothing between or behind
    later anchors.)  A null text, or one that is only marks and blanks, has none.
    """
    common = [*ANCHORS, *STEPPED]

    def begins(x: Column) -> Column:
        return x.isin([*ANCHORS]) | (F.crc32(x.cast("binary")) % PICKED == 0)

    def chain(w: Column, i: Column) -> Column:
        after = F.filter(F.slice(w, i + 2, REACH), lambda x: ~x.isin(common))
        return F.pmod(F.xxhash64(F.get(w, i), F.slice(after, 1, CHAIN)), F.lit(1 << 40))

    def chains(w: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(w) - 1)
        some = F.filter(every, lambda i: (i < HEAD) | begins(F.get(w, i)))
        at = let(some, lambda a: F.when((F.size(w) > HEAD + REACH) & (F.element_at(a, -1) < HEAD), every).otherwise(a))
        return F.array_sort(F.array_distinct(F.transform(at, lambda i: chain(w, i))))

    return let(spots(text), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(chains(w)))


def fingerprint(sigs: Column) -> Column:
    """A signature set as text: hexadecimal numbers in rising order."""
    return F.array_join(F.transform(sigs, F.hex), " ")


def length_partition(sigs: Column, at_least: float = 0.8) -> Column:
    """Number of the length range a set falls in; sets whose likeness reaches
    ``at_least`` are in the same range or in neighbouring ones."""
    return F.floor(F.log(F.greatest(F.size(sigs), F.lit(1)).cast("double")) / -math.log(at_least) + 1e-9).cast("int")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard index of two signature sets, 1 for two empty ones.

    The shorter length over the longer one is the most it can be: where that is
    under ``at_least`` the answer is 0 without an intersection.
    """
    na, nb = F.size(a), F.size(b)
    both = let(F.size(F.array_intersect(a, b)), lambda n: n / (na + nb - n).cast("double"))
    return (F.when((na == 0) & (nb == 0), 1.0).when((na == 0) | (nb == 0), 0.0)
            .when(F.least(na, nb) < F.greatest(na, nb) * at_least, 0.0).otherwise(both))


def with_next(docs: DataFrame, id_col: str, text_col: str, target: int = 1000) -> DataFrame:
    """Rows dealt in id ranges: adds ``__bucket`` and ``__guest``.

    Ids are cut into equal stretches, and a stretch with many rows into finer
    buckets, from one count per stretch.  Buckets follow falling id; the first
    row of each bucket is also a guest at the end of the bucket before it (the
    very first one at the end of the last bucket), so that every row finds the
    next one in its own bucket.  Null ids come last.  There are at most 100,000
    buckets and as many guests.
    """
    cells = 4096
    s = docs.agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).first()
    lo, hi = int(s["lo"] or 0), int(s["hi"] or 0)
    width = max(1, -(-(hi - lo + 1) // cells))
    target = max(target, -(-s["n"] // 90_000))
    back = F.lit(hi).cast("decimal(20,0)") - F.col(id_col)  # falling ids count up
    cell = F.coalesce(F.floor(back / width).cast("int"), F.lit(cells))
    held = docs.withColumn("__cell", cell).withColumn("__part", F.coalesce((back % width).cast("double") / width, F.lit(0.0)))
    sizes = held.groupBy("__cell").count().collect()  # at most ``cells`` + 1 rows
    rows, base = [], 0
    for r in sorted(sizes, key=lambda r: r["__cell"]):
        splits = 1 if r["__cell"] == cells else max(1, math.ceil(r["count"] / target))
        rows.append((r["__cell"], base, splits))
        base += splits
    spark = docs.sparkSession
    table = spark.createDataFrame(rows, "__c int, __base int, __splits int")
    held = held.join(F.broadcast(table), held["__cell"] == table["__c"])
    held = held.withColumn("__bucket", F.col("__base") + F.floor(F.col("__part") * F.col("__splits")).cast("int"))
    held = held.drop("__cell", "__part", "__c", "__base", "__splits")
    tops = held.groupBy("__bucket").agg(F.max(id_col).alias("__top"))
    order = Window.orderBy("__bucket")  # at most 100,000 rows
    last = F.max("__bucket").over(Window.partitionBy())
    tops = tops.select("__top", F.col("__bucket").alias("__own"), F.coalesce(F.lag("__bucket").over(order), last).alias("__to"))
    guests = held.join(F.broadcast(tops), (held["__bucket"] == tops["__own"]) & held[id_col].eqNullSafe(tops["__top"]))
    guests = guests.select(*[c for c in held.columns if c != "__bucket"], F.col("__to").alias("__bucket"), F.lit(True).alias("__guest"))
    return held.withColumn("__guest", F.lit(False)).unionByName(guests)


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``signatures``, ``edited`` (the text whose last third is replaced by
    the beginning of the next document, by falling id) and ``next_signatures``.

    Rows with one id follow by falling text; after the last row comes the first,
    so a lone document is its own next.  Null texts count as empty.
    """
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    dealt = with_next(rows, id_col, text_col).repartition("__bucket").withColumn("signatures", signatures(F.col(text_col)))
    order = Window.partitionBy("__bucket").orderBy("__guest", F.col(id_col).desc_nulls_last(), F.col(text_col).desc())
    out = dealt.withColumns({"__next": F.lead(text_col).over(order), "next_signatures": F.lead("signatures").over(order)})
    out = out.filter(~F.col("__guest"))
    n = F.length(text_col)
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col(text_col), F.lit(1), n - cut), F.substring(F.col("__next"), F.lit(1), cut))
    return out.withColumn("edited", edited).drop("__next", "__guest", "__bucket")


def op9_spotsigs(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    out = edited_texts(docs).withColumn("edited_signatures", signatures(F.col("edited")))
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      fingerprint(F.col("signatures")).alias("fingerprint"), fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
                      likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
                      likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
                      length_partition(F.col("signatures")).alias("length_partition"))


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.8) -> DataFrame:
    """SpotSigs match: ``a`` < ``b`` and ``likeness`` for all pairs of rows whose
    likeness reaches ``at_least`` (over 0, under 1), near or far by id.

    Rows with equal sets are one class, and classes meet through their rarest
    signatures: two sets of that likeness share one of the first
    n - ceil(at_least * n) + 1 of each, in order of rising document frequency.  A
    signature is joined within equal and neighbouring length partitions only, and a
    pair whose lengths rule the level out is not intersected.  Rows with null ids,
    and rows without signatures, are in no pair.  The result has a row for every
    pair, so a group of m copies gives m * (m - 1) / 2 of them.
    """
    slack = 1e-9  # level times size is a float
    sets = docs.select(F.col(id_col).alias("id"), signatures(F.col(text_col)).alias("sigs")).filter(F.col("id").isNotNull() & (F.size("sigs") > 0))
    sets = stored(sets.withColumn("cls", F.sha2(F.array_join("sigs", ",").cast("binary"), 256)), "spots")
    classes = stored(sets.groupBy("cls").agg(F.first("sigs").alias("sigs")), "spot-classes")
    each = classes.select("cls", F.size("sigs").alias("n"), length_partition(F.col("sigs"), at_least).alias("part"), F.explode("sigs").alias("sig"))
    often = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    rarest = Window.partitionBy("cls").orderBy("df", "sig")
    prefix = each.join(often, "sig").withColumn("__rn", F.row_number().over(rarest))
    prefix = stored(prefix.filter(F.col("__rn") <= F.col("n") - F.ceil(F.col("n") * at_least - slack) + 1).select("cls", "n", "part", "sig"), "spot-prefixes")
    # a class goes to its own partition and, as a guest, to the one above
    guests = prefix.withColumn("at", F.explode(F.array("part", F.col("part") + 1)))
    x, y = guests.alias("x"), prefix.alias("y")
    apart = (F.col("x.part") < F.col("y.part")) | (F.col("x.cls") < F.col("y.cls"))
    long_enough = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * at_least - slack
    met = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.at") == F.col("y.part")) & apart & long_enough)
    met = met.select(F.col("x.cls").alias("c"), F.col("y.cls").alias("d")).distinct()
    met = met.join(classes.select(F.col("cls").alias("c"), F.col("sigs").alias("s")), "c").join(classes.select(F.col("cls").alias("d"), F.col("sigs").alias("t")), "d")
    alike = met.select("c", "d", likeness(F.col("s"), F.col("t"), at_least - slack).alias("likeness")).filter(F.col("likeness") >= at_least - slack)
    ids = sets.select("id", "cls")
    left, right = ids.select(F.col("id").alias("i"), F.col("cls").alias("c")), ids.select(F.col("id").alias("j"), F.col("cls").alias("d"))
    across = alike.join(left, "c").join(right, "d").select("i", "j", "likeness")
    within = left.join(right, (F.col("c") == F.col("d")) & (F.col("i") < F.col("j"))).select("i", "j", F.lit(1.0).alias("likeness"))
    return across.union(within).select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "likeness")
