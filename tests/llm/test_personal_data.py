import hashlib
import re

import numpy as np
import pytest

from framewise.llm import personal_data as pd_
from framewise.llm.common import read_documents

SF = "/root/testdata/sf0.001"
FORMS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    """The contract's patterns as they stand."""
    out = []
    for k, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = (k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split(".")) or k == 3 and 10 <= len(d) <= 15
                  or k == 2 and 14 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0)
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(0)
    alphabets = ["0123456789. -+()", "ab.@-_%+1", "12.3 4", "4539 -@.a+("]
    cases = ["".join(rng.choice(list(a), rng.integers(1, 60))) for a in alphabets for _ in range(3000)]
    cases += ["a@b.c@d.e", "@@a@b.c.", "é1.2.3.4", "1.2.3.4.5.6.7.8", "+1 (269) 555-3296 4524132264652876", "4111 1111 1111 1111", "999.1.1.1", "x@y"]
    for t in cases:
        assert pd_.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@" * 1000, "1." * 150_000, "1 " * 200_000, "a@" * 100_000):
        assert isinstance(pd_.base_spans(t), list)


@pytest.fixture(scope="module")
def model(spark):
    return pd_.fit_tagger(read_documents(spark, "/root/testdata/sf0.01"), windows=600)


def test_tagger_finds_what_patterns_label(spark, model):
    texts = [r["text"] for r in read_documents(spark, SF).collect()]
    want = [set(pd_.base_spans(t)) for t in texts]
    got = [set(s) for s in model.spans(texts)]
    hit = sum(len(a & b) for a, b in zip(want, got, strict=True))
    assert hit >= 0.9 * sum(map(len, want))
    extra = sum(len(b - a) for a, b in zip(want, got, strict=True))
    assert extra <= 0.1 * sum(map(len, want)) + 2


def test_two_numbers_in_a_row_are_told_apart(model):
    t = "ordin the thand on erou +1 (269) 555-3296 4524132264652876 and onrend of the"
    assert pd_.base_spans(t) == []
    kinds = {k for _, k, _ in pd_._all_spans([t], model)[0][1]}
    assert kinds & {2, 3}


def test_gradient(model):
    rng = np.random.default_rng(1)
    m = pd_.Tagger.fresh(size=3, hidden=4)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    ids = rng.integers(0, pd_._CLASSES, (3, 7)).astype(np.int8)
    tags = np.array([[0, 1, 2, 0, 3, 4, 0], [0] * 7, [7, 8, 8, 0, 0, 5, 6]])
    _, g = m.loss_and_gradient(ids, tags)
    for k in m.p:
        at = tuple(rng.integers(0, s) for s in m.p[k].shape) if k != "E" else (int(ids[0, 1]), 1)
        was = m.p[k][at]
        m.p[k][at] = was + 1e-5
        up = m.loss_and_gradient(ids, tags)[0]
        m.p[k][at] = was - 1e-5
        down = m.loss_and_gradient(ids, tags)[0]
        m.p[k][at] = was
        assert abs((up - down) / 2e-5 - g[k][at]) < 2e-3, k


def test_windows_agree_with_one_long_window(model):
    t = "on the 10.2.3.4 and +1 (269) 555-3296 here a.b@mail3.example.com there " * 6
    found = pd_._all_spans([t], model)[0][1]
    assert all(a < b for a, _, b in found) and len(found) >= 18


def test_query_digests(spark):
    docs = read_documents(spark, SF)
    out = {r["doc_id"]: r for r in pd_.op3_personal_data(docs).collect()}
    for r in docs.collect():
        base, o = brute(r["text"] or ""), out[r["doc_id"]]
        assert [o["n_email"], o["n_ip"], o["n_card"], o["n_phone"]] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert o["base_sha256"] == hashlib.sha256(pd_.listed(base).encode()).hexdigest()
        assert set(pd_.listed(base).split(",")) - {""} <= set(o["spans"].split(","))


def test_masking_leaves_nothing_behind_and_clean_texts_alone(spark, model):
    docs = read_documents(spark, SF)
    out = {r["doc_id"]: r for r in pd_.mask_personal_data(docs, model).collect()}
    for r in docs.collect():
        new = out[r["doc_id"]]
        assert brute(new["text"]) == [] and new["n_chars"] == len(new["text"])
        if not re.search("[0-9@]", r["text"]):
            assert new["text"] == r["text"]
