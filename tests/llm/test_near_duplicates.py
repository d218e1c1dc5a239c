import random

import numpy as np
import pytest

from framewise.llm import near_duplicates as nd
from framewise.llm.common import read_documents

from .cases import edge_rows, prose

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = [bytes(x) for x in (text or "").encode("utf-8", "surrogatepass").lower().split()]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """doc position -> (set size, smallest id of its component) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    lists = {}
    for i, s in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    seen = set()
    for m in lists.values():
        for k, a in enumerate(m):
            for b in m[k + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                        root[find(a)] = find(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = min(low.get(r, d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def run(spark, rows, **params):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.jaccard_components(df, **params).collect())


def test_documents_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in read_documents(spark, SF).collect()]
    want = brute(rows)
    assert run(spark, rows) == want
    assert len({c for _, _, c in want}) < len(want)


def family(rnd, size, words, edits):
    base = prose(rnd, words).split()
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = prose(rnd, 1) + str(rnd.random())
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("params", [{}, {"chunk_tokens": 3000, "hot": 2}, {"block_rows": 7}, {"block_tokens": 1500}, {"block_rows": 3, "chunk_tokens": 900, "hot": 1}])
def test_families_and_shared_passages(spark, params):
    rnd = random.Random(8)
    passage = prose(rnd, 60)
    texts = [t for size, words, edits in ((40, 150, 6), (25, 60, 3), (12, 30, 1), (9, 5, 1), (30, 200, 9)) for t in family(rnd, size, words, edits)]
    texts += [prose(rnd, 8) + " " + passage + " " + prose(rnd, rnd.randint(1, 9)) for _ in range(40)]
    texts += [texts[0]] * 20 + ["one two", "ONE  two", "one two three", "", " ", None]
    rnd.shuffle(texts)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    assert run(spark, rows, **params) == brute(rows)


def test_threshold_is_exact():
    a = np.arange(100, dtype=np.uint64)
    for shared in range(70, 101):
        b = np.concatenate([a[:shared], np.arange(1000, 1100 - shared, dtype=np.uint64)])
        want = 100 * shared >= 80 * (200 - shared)
        edges = nd.search_block(np.array([1, 2]), np.array([100, 100]), [a, b], np.array([1, 2]), None)
        assert bool(edges) == want, shared


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(2)
    for _ in range(200):
        sets = [np.sort(rng.choice(40, rng.integers(1, 30), replace=False)).astype(np.uint64) for _ in range(12)]
        sizes = np.array([len(s) for s in sets])
        lists = {}
        for i, s in enumerate(sets):
            for x in s.tolist():
                lists.setdefault(x, []).append(i)
        lists = {k: np.array(v) for k, v in lists.items()}
        got = set(nd.divide_skip(sets[0], int(sizes[0]), lists, sizes, np.arange(12) > 0).tolist())
        both = [len(np.intersect1d(sets[0], s)) for s in sets]
        assert got == {i for i in range(1, 12) if 100 * both[i] >= 80 * (sizes[0] + sizes[i] - both[i])}


def test_shingle_sets_of_awkward_texts():
    s = nd.Shingler()
    for r in edge_rows():
        assert len(s.shingles(r[1])) == len(shingles(r[1]))
    assert (s.shingles("A b C d E") == s.shingles("a\tB\nc D e")).all()
    assert len(s.shingles("É x")) == 1 and (s.shingles("É x") != s.shingles("é x")).all()


def test_one_document_of_each_group_stays(spark):
    docs = read_documents(spark, SF)
    want = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in docs.collect()])}
    kept = nd.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
