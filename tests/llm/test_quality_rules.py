import random
import re

from framewise.llm import quality_rules as qr
from framewise.llm.common import read_documents

from .cases import edge_rows

SF = "/root/testdata/sf0.01"


def brute(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for p in at.values() if len(p) > 1 for i in p for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def compare(rows, docs):
    got = {r["doc_id"]: r for r in qr.op4_rules(docs).collect()}
    for i, t in rows:
        o, want = got[i], brute(t)
        assert (o["n_words"], o["word_chars"], o["n_symbols"], o["n_dup_lines"], o["n_repeat_words"]) == want, (i, (t or "")[:60])
        assert o["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (o["base_failed"] and o["kept"])


def test_counts_equal_brute_force(spark):
    docs = read_documents(spark, SF)
    compare([(r["doc_id"], r["text"]) for r in docs.collect()], docs)


def test_counts_on_random_and_awkward_texts(spark):
    rnd = random.Random(0)
    texts = ["".join(rnd.choice("ab \n\t#|\x0b\x1c ") for _ in range(rnd.randint(0, 80))) for _ in range(400)]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts + [None] + [r[1] for r in edge_rows()])]
    compare(rows, spark.createDataFrame(rows, "doc_id long, text string"))


def test_verdict_does_not_depend_on_the_order(spark):
    docs = qr.with_counts(read_documents(spark, SF))
    a = docs.filter(~qr.cascade(qr.RULES)).count()
    assert a == docs.filter(~qr.cascade(qr.RULES[::-1])).count()


def test_estimates_order_by_rejection_per_cost(spark):
    docs = read_documents(spark, SF)
    order = qr.estimate(docs, qr.RULES, rows=300)
    assert {r.name for r, _, _ in order} == {r.name for r in qr.RULES}
    first, cost, rate = order[0]
    assert cost > 0 and rate >= 0


def test_good_documents_stay(spark):
    docs, labels = read_documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    out = qr.op4_rules(docs).join(labels, "doc_id").filter("not base_failed").groupBy("quality").agg({"*": "count", "kept": "count_if"}).collect()
    n = {r["quality"]: r["count_if(kept)"] / r["count(1)"] for r in out}
    assert n[1] > 0.98 and n[0] < 0.7
