import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import packing
from framewise.llm.common import read_documents

from .cases import edge_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path("word_bpe_49k.json"))


def test_word_tokenizer_equals_the_library(plain, spark):
    tok = packing.WordTokenizer(packing.vocabulary_path("word_bpe_49k.json"))
    assert tok.by_word
    texts = [r["text"] for r in read_documents(spark, SF).collect()][:80]
    texts += [r[1][:3000] for r in edge_rows() if r[1]]
    texts += ["it's o'clock 'll don't <|endoftext|> a<|endoftext|>b x|> 12.5%", "İstanbul ΣΑΣ ﬁ ſ ß ẞ", "é ́x a b c\x1cd\x85e", "Ünïcödé! ÀB--cd..", "a\tb\r\nc", "ªº µ"]
    for t in texts:
        assert tok.ids(t) == struct.pack(f"<{len(i := plain.encode(t, add_special_tokens=False).ids)}I", *i), t[:80]


def test_other_tokenizers_see_whole_texts():
    from tokenizers import Tokenizer

    path = packing.vocabulary_path("byte_bpe_50k.json")
    tok, whole = packing.WordTokenizer(path), Tokenizer.from_file(path)
    assert not tok.by_word
    t = "two  blanks\n and lines"
    assert np.frombuffer(tok.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def check(out, capacity):
    out = out.sort_values(["sequence_id", "offset"])
    ends = out.groupby("sequence_id").length.cumsum()
    assert ((ends - out.length) == out.offset).all()
    assert ends.max() <= capacity
    return out.sequence_id.nunique()


def test_pieces_and_packing(spark, plain):
    docs = read_documents(spark, SF)
    out = packing.pack_documents(docs).toPandas()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for d, g in out.groupby("doc_id"):
        ids = np.array([*plain.encode(text[d] or "", add_special_tokens=False).ids, 0], "<u4")
        g = g.sort_values("piece")
        assert g.piece.tolist() == list(range(-(-len(ids) // 2048)))
        assert g.start.tolist() == [2048 * k for k in range(len(g))] and g.length.sum() == len(ids)
        assert g.ids_crc32.tolist() == [zlib.crc32(ids[a:a + 2048].tobytes()) for a in g.start]
    counts = np.bincount(out.length, minlength=2049)
    assert check(out, 2048) <= packing.lower_bound(counts, 2048) + 1  # 200 documents leave little choice


def brute_bins(sizes, capacity):
    """Fewest bins by exhaustive search."""
    best = len(sizes)

    def go(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(sizes):
            best = len(free)
            return
        for k in range(len(free)):
            if free[k] >= sizes[i] and free[k] not in free[:k]:
                go(i + 1, [*free[:k], free[k] - sizes[i], *free[k + 1:]])
        go(i + 1, [*free, capacity - sizes[i]])

    go(0, [])
    return best


def test_bound_never_exceeds_the_optimum():
    rng = np.random.default_rng(3)
    for _ in range(150):
        cap = int(rng.integers(6, 30))
        sizes = sorted(rng.integers(1, cap + 1, rng.integers(1, 9)).tolist(), reverse=True)
        low = packing.lower_bound(np.bincount(sizes, minlength=cap + 1), cap)
        for pack in (packing.best_fit, packing.fill_up):
            bins, places, free = pack(np.array(sizes), cap)
            assert low <= brute_bins(sizes, cap) <= len(free)
            for b in range(len(free)):
                own = sorted((p, s) for p, s, k in zip(places, sizes, bins, strict=True) if k == b)
                assert sum(s for _, s in own) == cap - free[b]
                assert all(p + s == q for (p, s), (q, _) in zip(own, own[1:], strict=False))


def test_thresholds_beat_the_volume():
    assert packing.lower_bound(np.bincount([6] * 5, minlength=11), 10) == 5


def test_exchange_closes_gaps(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 0, 0, int(x), i) for i, x in enumerate(rng.integers(1, 100, 6000))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack_pieces(pieces, capacity=100, part_rows=300).toPandas()
    assert len(out) == 6000 and out.doc_id.is_unique
    bound = packing.lower_bound(np.bincount([r[3] for r in rows], minlength=101), 100)
    assert check(out, 100) <= bound * 1.01


def test_assembled_sequences_hold_the_ids(spark):
    docs = read_documents(spark, SF).limit(40)
    pieces = packing.stored(packing.token_pieces(docs, with_ids=True), "p")
    packed = packing.stored(packing.pack_pieces(pieces), "q")
    seqs = {r["sequence_id"]: r["ids"] for r in packing.assemble(packed).collect()}
    for r in packed.collect():
        part = seqs[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


def test_stored_rows_keep_the_order_of_their_files(spark, tmp_path):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, F.repeat(F.lit("x"), 5)).otherwise(F.repeat(F.col("id").cast("string"), 400)).alias("text"))
    df.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").write.parquet(str(tmp_path / "t"))
    out = packing.as_written(spark.read.parquet(str(tmp_path / "t"))).toPandas()
    assert out["__file"].nunique() == 5
    assert out.sort_values(["__file", "__row"]).doc_id.tolist() == list(range(900))
    assert packing.as_written(df.repartition(3)).toPandas().groupby("__file")["__row"].nunique().sum() == 900


def test_packing_in_order_is_whole_and_near_the_bound(spark):
    docs = read_documents(spark, SF)
    out = packing.pack_in_order(docs, stretch=50).toPandas()
    want = packing.pack_documents(docs).toPandas()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out[cols].to_numpy().tolist())) == sorted(map(tuple, want[cols].to_numpy().tolist()))
    bound = packing.lower_bound(np.bincount(out.length, minlength=2049), 2048)
    assert check(out, 2048) <= bound + 2 * -(-docs.count() // 50)
