import random

import pytest

from framewise.llm import token_counts as tc
from framewise.llm.common import read_documents

from .cases import edge_rows

SF = "/root/testdata/sf0.001"


def library(v):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(v.pieces, v.unknown, v.byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(tc.MARK, "always", True)
    return t


def texts():
    rnd = random.Random(2)
    out = ["", "a", " ", "  a b ", "\n\n", "日本語 テキスト", "a\tb", "▁▁x", " lead", "trail  ", "ÿÿ", "\x00", "é́", "x\n y", "\n", " \n"]
    out += ["".join(rnd.choice("ab tion \n▁é日😀12.#,  then") for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    return out + [r[1][:2000] for r in edge_rows() if r[1]]


def test_counts_equal_the_library(spark):
    v = tc.load_vocabulary(tc.vocabulary_path("piece_bpe_32k.model"))
    c, t = tc.Counter(v), library(v)
    more = [r["text"] for r in read_documents(spark, SF).collect()][:60]
    for x in texts() + more:
        assert c.count(x) == len(t.encode(x, add_special_tokens=False).ids), x[:60]


@pytest.mark.parametrize("fallback", [False])
def test_ties_and_unknown_runs(fallback):
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("ba", -1.5), ("aba", -3.0)]
    v = tc.Vocabulary(pieces, 0, fallback)
    c, t = tc.Counter(v), library(v)
    rnd = random.Random(5)
    for _ in range(800):
        x = "".join(rnd.choice("ab zq") for _ in range(rnd.randint(0, 14)))
        assert c.count(x) == len(t.encode(x, add_special_tokens=False).ids), repr(x)


def test_query_covers_all_documents(spark):
    docs = read_documents(spark, SF)
    out = {r["doc_id"]: r["n_tokens"] for r in tc.op7_token_counts(docs).collect()}
    c = tc.Counter(tc.load_vocabulary(tc.vocabulary_path("piece_bpe_32k.model")))
    assert out == {r["doc_id"]: c.count(r["text"]) for r in docs.collect()}
