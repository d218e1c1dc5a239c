import hashlib
import re

from pyspark.sql import functions as F

from framewise.llm import fingerprints as fp
from framewise.llm.common import read_documents

from .cases import edge_rows

SF = "/root/testdata/sf0.01"


def chains(text):
    """The chains behind a text's signatures."""
    t = (text or "").translate({ord(c): None for c in fp.MARKS}).lower()
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    common = {*fp.ANCHORS, *fp.STEPPED}
    at = [i for i in range(len(w)) if i < fp.HEAD or w[i] in fp.ANCHORS]
    return {(w[i], *[x for x in w[i + 1:i + 1 + fp.REACH] if x not in common][:fp.CHAIN]) for i in at}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode("utf-8", "surrogatepass")), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n, cut = len(t), len(t) // 3
        e = t[:n - cut] + nxt[:cut]
        out.append((str(i), n, hashlib.sha256(e.encode()).hexdigest(), round(jaccard(chains(t), chains(e)), 9), round(jaccard(chains(t), chains(nxt)), 9)))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in fp.op9_spotsigs(df).collect())


def test_documents_equal_brute_force(spark):
    docs = read_documents(spark, SF)
    assert got(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)
    assert got(spark.createDataFrame([(5, "alone here")], "doc_id long, text string")) == brute([(5, "alone here")])


def test_sparse_and_far_ids(spark):
    rows = [(i ** 9 - 10 ** 17, f"the text of number {i} is so") for i in range(1, 90)] + [(-(1 << 63), "least"), ((1 << 63) - 1, "greatest")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_equal_texts_have_equal_fingerprints_and_edits_stay_near(spark):
    out = fp.op9_spotsigs(read_documents(spark, SF)).join(read_documents(spark, SF).select("doc_id", "text"), "doc_id").toPandas()
    assert out.groupby("text").fingerprint.nunique().max() == 1
    long = out[out.n_chars > 300]
    assert (long.near_edited > long.near_next).mean() > 0.97
    assert (out.near_edited.between(0, 1) & out.near_next.between(0, 1)).all()


def test_pruning_only_drops_pairs_below_the_level(spark):
    rows = [([1, 2, 3], [1, 2, 3, 4]), ([1], [1, 2, 3]), ([], []), ([], [1])]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    r = df.select(fp.likeness(F.col("a"), F.col("b")).alias("x"), fp.likeness(F.col("a"), F.col("b"), 0.7).alias("y")).collect()
    assert [(round(a.x, 3), round(a.y, 3)) for a in r] == [(0.75, 0.75), (0.333, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_whole_texts_count_in_any_language_and_in_lists(spark):
    """Texts that differ only behind their first 23 words have different fingerprints."""
    spare = [w for i in range(200) if (w := f"z{i}") not in fp.ANCHORS]
    head = [f"kolo{i}" for i in range(16)] + spare[:7]
    tails = {"italian": "il mare non era mai stato cosi calmo come quella mattina di maggio".split(),
             "russian": "море никогда не было таким спокойным как в то майское утро".split(),
             "list": [x for i in range(12) for x in ("|", f"item{i}")],
             "marks": [f"w{i}&&&" for i in range(12)],
             "one word": ["lalala"] * 12,
             "chinese": ["海从来没有", "像五月的", "那个早晨", "一样平静", "过海从来", "没有像", "五月的那", "个早晨一", "样平静过"]}
    rows = [(n, k, " ".join(head + [x + "q" * k for x in t])) for n, t in tails.items() for k in range(4)]
    # no word behind the 16th is an anchor, listed or picked
    rows += [("bare", k, " ".join(head + [w] * 30)) for k, w in enumerate(spare[7:10])]
    df = spark.createDataFrame(rows, "kind string, k int, text string")
    out = df.select("kind", fp.fingerprint(fp.signatures(F.col("text"))).alias("f")).toPandas()
    assert out.f.is_unique


def test_marks_hide_no_anchor(spark):
    df = spark.createDataFrame([("of%%% the&&& sea*** “the” calm$$$",), ("of the sea the calm",)], "text string")
    assert df.select(fp.fingerprint(fp.signatures(F.col("text"))).alias("f")).distinct().count() == 1


def test_picked_words_are_the_same_in_python_and_spark(spark):
    words = [f"wörd{i}" for i in range(300)] + ["море", "海", "the", "que"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    picked = {r["w"] for r in df.filter((F.crc32(F.col("w").cast("binary")) % fp.PICKED == 0) | F.col("w").isin([*fp.ANCHORS])).collect()}
    assert picked == {w for w in words if w in fp.ANCHORS}


def test_near_pairs_equal_all_pairs(spark):
    """Pairs far apart by id are found, in equal and in neighbouring length partitions."""
    base = [r["text"] for r in read_documents(spark, SF).filter(F.length("text").between(300, 1500)).limit(60).collect()]
    texts = base + [t + " some more words behind the end" for t in base] + [t[: len(t) * 9 // 10] for t in base] + base[:5] + ["", None, "short", "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {r[0]: set(r[1]) for r in df.select("doc_id", fp.signatures(F.col("text"))).collect() if r[1]}
    parts = {r[0]: r[1] for r in df.select("doc_id", fp.length_partition(fp.signatures(F.col("text")), 0.7)).collect()}
    want = {(i, j): jaccard(a, b) for i, a in sets.items() for j, b in sets.items() if i < j and jaccard(a, b) >= 0.7}
    rows = fp.near_pairs(df, at_least=0.7).collect()
    assert len(rows) == len(want)
    assert {(r["a"], r["b"]): round(r["likeness"], 9) for r in rows} == {k: round(v, 9) for k, v in want.items()}
    assert any(parts[i] != parts[j] for i, j in want) and any(j - i > 60 for i, j in want)
