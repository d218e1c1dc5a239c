"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from framewise.llm import ranked_search as rs

from .cases import SCHEMA, edge_docs, edge_rows, empty_docs, with_clashes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in terms(text) if t in b)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scored[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def corpus(n, seed, words=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    docs = [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 3, 20, 60])))) for i in range(n)]
    docs += [(i, docs[7][1]) for i in range(n, n + 30)]  # ties
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 12)))) for k in range(25)]
    return docs, [*items, (3, "w1 W1 w59"), (77, None), (78, "..."), (None, "w2"), (79, "unheard of"), (80, "w0")]


@pytest.mark.parametrize(("short", "window", "block"), [(1 / 16, 4096, 32768), (1 / 3, 16, 50), (0.0, 7, 400), (5.0, 64, 64)])
def test_equals_full_scoring(spark, monkeypatch, short, window, block):
    monkeypatch.setattr(rs, "BLOCK_DOCS", block)
    monkeypatch.setattr(rs.Block.__init__, "__defaults__", (short, window))
    docs, items = corpus(400, 3)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert rows_of(rs.search(d, spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_chunks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(rs, "CHUNK_ITEMS", 7)
    docs, items = corpus(100, 5)
    assert rows_of(rs.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS))) == brute(docs, items)


def test_skipping_saves_work():
    """Frequent terms are probed, not read, once the tenth best score is out of their reach."""
    import pyarrow as pa

    rnd = random.Random(2)
    vocabulary, weights = [f"w{k}" for k in range(400)], [1 / (k + 1) for k in range(400)]
    bags = [Counter(rnd.choices(vocabulary, weights, k=40)) for _ in range(8000)]
    posts = sorted((int(t[1:]), d, k) for d, b in enumerate(bags) for t, k in b.items())
    term = sorted({t for t, _, _ in posts})
    df = Counter(t for t, _, _ in posts)
    start = [0]
    for t in term:
        start.append(start[-1] + df[t])
    row = {"doc_id": pa.array(range(8000)), "lens": pa.array([40] * 8000, pa.int64()), "term": pa.array(term), "start": pa.array(start),
           "doc": pa.array([d for _, d, _ in posts]), "tf": pa.array([k for _, _, k in posts])}
    import numpy as np
    w = np.array([math.floor(1000 * math.log(16002 / (2 * df[t] + 1))) for t in range(400)])
    block = rs.Block(row, rs.Corpus(8000, 320000, w), window=256)
    query = [(0, 1), (1, 1), (2, 1), (150, 1), (390, 1)]
    best = rs.Best(10)
    work = block.answer(query, best)
    assert work < sum(df[t] for t, _ in query) / 2
    scores = np.zeros(8000, dtype=np.int64)
    for t, k in query:
        a, b = block.lists[t]
        scores[block.doc[a:b]] += k * w[t] * block.impact[a:b]
    order = np.lexsort((np.arange(8000), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()


def test_awkward_rows(spark):
    items = [(1, "word the 日本語"), (2, edge_rows()[5][1]), (3, ""), (3, "12345 call"), (4, "no id")]
    i = spark.createDataFrame(items, ITEMS)
    want = brute([(r[0], r[1]) for r in edge_rows()], items)
    assert rows_of(rs.op13_ranked_search(edge_docs(spark), i)) == want
    assert rows_of(rs.op13_ranked_search(with_clashes(edge_docs(spark)), with_clashes(i))) == want
    assert {r[1] for r in want if r[0] == 4} == {1} and any(r[2] is None for r in want)


def test_empty_tables(spark):
    i = spark.createDataFrame([(1, "word")], ITEMS)
    assert rs.op13_ranked_search(empty_docs(spark), i).count() == 0
    assert rs.op13_ranked_search(edge_docs(spark), spark.createDataFrame([], ITEMS)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0)], SCHEMA)
    assert rs.op13_ranked_search(blank, i).count() == 0
