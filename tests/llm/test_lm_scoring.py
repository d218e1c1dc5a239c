"""Language-model scores against sums over all tokens, bit by bit."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewise.llm import lm_scoring as lm
from framewise.llm.common import read_documents

from .cases import SCHEMA, edge_docs, edge_rows, empty_docs, prose, with_clashes

SF = "/root/testdata/sf0.001"


def tokens(text):
    return [w + b" " for w in (text or "").encode().lower().split()] + [b"\n "]


def training(rows):
    return [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 5 != 1]


def spelled(token):
    return "".join(f"{b:08b}" for b in token)


def brute_bits(token, paths, tables, mixer):
    """One token's bits, bit by bit: ``paths`` counts every spelling of whole bits."""
    total, text, path = 0.0, spelled(token), spelled(token[:lm.PATH])
    words = lm.Spelled([token])
    contexts, cells = words.contexts(), mixer.cells()
    for i in range(len(text)):
        place, k, bit = i // 8, i % 8, int(text[i])
        node = np.array([int("1" + text[8 * place:i], 2)])
        pairs = [(paths[text[:i] + "0"], paths[text[:i] + "1"]) if i < len(path) else (0, 0)]
        for t, c in zip(tables, contexts, strict=True):
            s = lm.slots(c[place:place + 1], node)[0]
            pairs.append((t[0, s], t[1, s]))
        inputs = [math.log(one + lm.DELTA) - math.log(zero + lm.DELTA) for zero, one in pairs]
        level = min(int(math.log2(sum(pairs[0]) + 1)), 11)
        gate = level * 4 + min(int(math.log2(sum(pairs[3]) + 1)) // 3, 3)
        z = sum(w * x for w, x in zip(mixer.weights[:, gate], [*inputs, 1.0], strict=True))
        z = min(max(z, -16), 16)
        at = (min(max(z, -8), 8) + 8) * 2
        low = min(int(at), lm.CELLS - 2)
        row = min(level // 3, 3) * 8 + k
        refined = cells[row, low] * (1 - at + low) + cells[row, low + 1] * (at - low)
        p = (1 / (1 + math.exp(-z)) + refined) / 2
        total -= math.log2(p if bit else 1 - p)
    return total


def some_docs(n=60):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, rnd.randint(1, 60)), "en", "a", 1) for i in range(n)]
    return [*rows, (900, "x" * 90 + " the the The\tTHE", "en", "a", 1), (901, "x" * 90 + " übel", None, None, 0), (1000, None, None, None, None), (None, "the", None, None, 0)]


def test_every_token_equals_bit_by_bit(spark, monkeypatch):
    monkeypatch.setattr(lm, "RANGE", 40)
    rows = some_docs()
    held = F.coalesce(lm.crc_mod("doc_id", 5) == 1, F.lit(False))
    blocks = lm.stored(lm.token_blocks(spark.createDataFrame(rows, SCHEMA).repartition(3), "text", held, ["doc_id"]), "test-blocks")
    counts = lm.stored(lm.token_counts(blocks), "test-counts")
    want = Counter(t for r in training(rows) for t in tokens(r[1]))
    every = {t for r in rows for t in tokens(r[1])}
    assert {bytes(r["token"]): r["c"] for r in counts.collect()} == {t: want[t] for t in every}
    tables = lm.context_tables(counts)
    plain = [np.zeros_like(t) for t in tables]
    for t, n in want.items():
        words = lm.Spelled([t])
        for table, context in zip(plain, words.contexts(), strict=True):
            for bit, node in words.bits():
                for s, b in zip(lm.slots(context, node), bit, strict=True):
                    table[b, s] += n
    assert all((a == b).all() for a, b in zip(tables, plain, strict=True))
    shared = spark.sparkContext.broadcast(tables)
    ranges = lm.spelled_ranges(counts, len(every))
    mixer = lm.fit_mixer(ranges, shared, len(every))
    assert (mixer.weights != lm.Mixer.fresh().weights).any() and mixer.seen.sum() > 0
    paths = Counter(spelled(t[:lm.PATH])[:i] for t in want.elements() for i in range(8 * min(len(t), lm.PATH) + 1))
    got = {bytes(r["token"]): r["bits"] for r in lm.spell(ranges, shared, mixer).collect()}
    assert set(got) == every and len(every) > 80
    for t, bits in got.items():
        assert bits == pytest.approx(brute_bits(t, paths, tables, mixer), rel=1e-4)


def test_mixer_learns_from_every_training_token(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEARN", 10, raising=False)
    monkeypatch.setattr(lm, "RANGE", 40)
    rows = some_docs()
    held = F.coalesce(lm.crc_mod("doc_id", 5) == 1, F.lit(False))
    blocks = lm.stored(lm.token_blocks(spark.createDataFrame(rows, SCHEMA), "text", held, ["doc_id"]), "test-blocks")
    counts = lm.stored(lm.token_counts(blocks), "test-counts")
    types = counts.count()
    shared = spark.sparkContext.broadcast(lm.context_tables(counts))
    mixer = lm.fit_mixer(lm.spelled_ranges(counts, types), shared, types)
    assert mixer.seen.sum() == sum(8 * len(t) for r in training(rows) for t in tokens(r[1]))


def test_probabilities_of_all_spellings_add_up_to_one():
    rnd = random.Random(1)
    seen = Counter(bytes([rnd.choice(b"abc "), rnd.choice(b"ab ")]) for _ in range(300))
    every = [bytes([a, b]) for a in range(256) for b in range(256)]
    here = lm.Range(pa.table({"token": pa.array(every, pa.binary()), "c": pa.array([seen[t] for t in every], pa.int64())}))
    tables = [np.array(np.random.default_rng(2).integers(0, 5, (2, 1 << lm.TABLE_BITS)), dtype=np.float32) for _ in lm.ORDERS]
    learner = lm.Learner()
    here.learn({}, tables, learner)
    logs = here.log_probabilities({}, learner.mixer, tables)
    assert np.exp2(logs).sum() == pytest.approx(1, abs=1e-5)


def test_step_follows_the_gradient():
    rnd = np.random.default_rng(4)
    pairs = [tuple(rnd.integers(0, 4, (2, 500)).astype(np.float32)) for _ in range(len(lm.ORDERS) + 1)]
    bit, weight = rnd.integers(0, 2, 500), rnd.integers(1, 5, 500).astype(float)

    def predictions(weights):
        third = pairs[3]
        return lm.Predictions.of(weights, [lm.log_odds(*p) for p in pairs], sum(pairs[0]), sum(third))

    def loss(weights):
        z = predictions(weights).mixed
        return (weight * np.log1p(np.exp(np.where(bit == 1, -z, z)))).sum()

    learner = lm.Learner()
    start = learner.mixer.weights.copy()
    learner.learn(bit, 3, weight, pairs)
    gate = predictions(start).gate
    for g in np.unique(gate)[:4]:
        for i in range(lm.INPUTS):
            step = np.zeros_like(start)
            step[i, g] = 1e-4
            slope = -(loss(start + step) - loss(start - step)) / 2e-4 / weight[gate == g].sum()
            assert slope ** 2 == pytest.approx(learner.squares[i, g], rel=1e-2, abs=1e-7)
            assert np.sign(slope) == np.sign(learner.mixer.weights[i, g] - start[i, g])


def test_adaptation_equals_token_by_token():
    rnd = random.Random(3)
    for _ in range(20):
        bag = Counter(rnd.choices("abcdefgh", k=rnd.randint(1, 200)))
        bits = {t: rnd.uniform(0.01, 1500) for t in bag}
        order = list(bag.elements())
        rnd.shuffle(order)
        had, want = Counter(), 0.0
        for n, t in enumerate(order):
            new = math.log(lm.ADAPT) - bits[t] * math.log(2)
            want -= (np.logaddexp(new, math.log(had[t])) if had[t] else new) / math.log(2) - math.log2(lm.ADAPT + n)
            had[t] += 1
        got = lm.adapted_bits(np.array([bits[t] for t in bag]), np.array(list(bag.values())), np.array([0]))
        assert got[0] == pytest.approx(want, rel=1e-9)


def digest(rows):
    known = Counter(t for r in training(rows) for t in tokens(r[1]))
    n, v = sum(known.values()), len(known)
    out = []
    for r in rows:
        ts = tokens(r[1])
        base = sum(math.log10((known[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        out.append((str(r[0]), r not in training([r]), len(ts), sum(known[t] > 0 for t in ts), n, round(base, 5), sum(map(len, ts))))
    return sorted(out)


def rows_of(df):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), r["n_bytes"])
                  for r in df.collect())


def test_counts_and_base_score(spark):
    rows = some_docs()
    out = lm.op12_lm_scoring(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert rows_of(out) == digest(rows)
    for r in out.collect():
        assert r["score"] < 0 and r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / r["n_bytes"])


def test_blocks_of_any_size_score_alike(spark, monkeypatch):
    docs = read_documents(spark, SF)
    one = {r["doc_id"]: r["score"] for r in lm.op12_lm_scoring(docs.coalesce(1)).collect()}
    other = {r["doc_id"]: r["score"] for r in lm.op12_lm_scoring(docs.repartition(7)).collect()}
    assert one.keys() == other.keys() and all(other[d] == pytest.approx(s, rel=1e-6) for d, s in one.items())


def test_held_out_texts_beat_shuffled_letters_and_single_contexts(spark):
    """Learned spelling: held-out documents cost fewer bits a byte than the same letters in disorder."""
    docs = read_documents(spark, "/root/testdata/sf0.01").filter("length(text) < 3000").limit(400).collect()
    rnd = random.Random(6)
    rows = [(r["doc_id"], r["text"], "en", "a", 0) for r in docs]
    held = [r for r in rows if r not in training([r])]
    twins = [(next(k for k in range(10**6 + 1000 * i, 10**9) if zlib.crc32(str(k).encode()) % 5 == 1),
              " ".join("".join(rnd.sample(w, len(w))) for w in (r[1] or "").split()), "en", "a", 0) for i, r in enumerate(held)]
    out = {r["doc_id"]: r for r in lm.op12_lm_scoring(spark.createDataFrame(rows + twins, SCHEMA)).collect()}
    better = [out[r[0]]["bits_per_byte"] < out[t[0]]["bits_per_byte"] for r, t in zip(held, twins, strict=True) if len((r[1] or "").split()) > 20]
    assert len(better) > 30 and np.mean(better) > 0.95


def test_awkward_rows(spark):
    assert rows_of(lm.op12_lm_scoring(edge_docs(spark))) == digest(edge_rows())
    clash = with_clashes(edge_docs(spark)).withColumn("token", F.lit("x")).withColumn("block", F.lit("y"))
    assert rows_of(lm.op12_lm_scoring(clash)) == digest(edge_rows())
    kept = lm.score_texts(clash, "text", F.lit(False), ["doc_id", "token", "block", "score", "k"])
    assert kept.columns[:4] == ["doc_id", "token", "block", "k"] and dict(kept.dtypes)["score"] == "double"


def test_empty_and_untrained(spark):
    assert lm.op12_lm_scoring(empty_docs(spark)).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    r = lm.op12_lm_scoring(spark.createDataFrame([(held, "a", None, None, 1)], SCHEMA)).collect()[0]
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert r["score"] == pytest.approx(-(32 + math.log2((lm.ADAPT + 1) / lm.ADAPT)) * math.log10(2), rel=1e-3)


def test_order_gain_equals_token_by_token():
    rnd = random.Random(5)
    words = [w.encode() for w in "abcdefgh"] + [b"\n"]
    docs = [[rnd.randrange(8) for _ in range(rnd.randint(0, 40))] + [8] for _ in range(30)]
    docs += [docs[0], docs[1]]
    learned = np.array([rnd.random() < 0.7 for _ in docs])
    bits = np.array([rnd.uniform(0.5, 1500) for _ in words])
    number, lens = np.array([t for d in docs for t in d], dtype=np.int32), np.array([len(d) for d in docs])
    halves = [slice(0, 12), slice(12, len(docs))]
    asked, where = [], []
    for h, half in enumerate(halves):  # two blocks with dictionaries of their own order
        names = list(dict.fromkeys(t for d in docs[half] for t in d))
        mine = np.array([names.index(t) for d in docs[half] for t in d], dtype=np.int32)
        pairs, times, place = lm.pair_shares([words[t] for t in names], mine, lens[half], np.repeat(learned[half], lens[half]))
        asked += [{"block": h, "bucket": b, "pairs": p, "times": t} for b, (p, t) in enumerate(zip(pairs, times, strict=True))]
        where.append((names, mine, np.frombuffer(place, np.uint8)))
    told = [r for b in range(lm.BUCKETS) for r in lm.pair_sums(pa.Table.from_pylist([x for x in asked if x["bucket"] == b])).to_pylist()]
    follows = [Counter(zip([None, *d], d)) for d in docs]
    got = []
    for h, half in enumerate(halves):
        names, mine, bucket = where[h]
        first, second, which = lm.neighbours(mine, lens[half])
        sums = np.empty(len(bucket), dtype=np.int64)
        much = np.bincount(bucket, minlength=lm.BUCKETS).tolist()
        sums[np.argsort(bucket, kind="stable")] = np.concatenate([lm.unpacked(r["sums"], k) for r, k in zip([r for r in told if r["block"] == h], much, strict=True)])
        every = sum((f for f, k in zip(follows, learned, strict=True) if k), Counter())
        assert sums.tolist() == [every[(names[a - 1] if a else None, names[b])] for a, b in zip(first, second, strict=True)]
        c = Counter(t for d, k in zip(docs, learned, strict=True) if k for t in d)
        after = np.array([c[8] if not a else c[names[a - 1]] for a in first])
        got += lm.order_gain(mine, lens[half], lm.Bag.of(mine, lens[half]), bits[names], which, sums, after, learned[half]).tolist()
    for d, (doc, gain) in enumerate(zip(docs, got, strict=True)):
        rest = sum((f for e, (f, k) in enumerate(zip(follows, learned, strict=True)) if k and e != d), Counter())
        had, want = Counter(), 0.0
        for i, (a, b) in enumerate(zip([None, *doc], doc)):
            new = math.log(lm.ADAPT) - bits[b] * math.log(2)
            plain = (np.logaddexp(new, math.log(had[b])) if had[b] else new) - math.log(lm.ADAPT + i)
            seen = sum(x for (y, _), x in rest.items() if y == a)
            told_p = math.log(lm.ORDER / (seen + lm.ORDER)) + plain
            if rest[(a, b)]:
                told_p = np.logaddexp(told_p, math.log(rest[(a, b)] / (seen + lm.ORDER)))
            want += (told_p - plain) / math.log(2)
            had[b] += 1
        assert gain == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_order_of_words_counts(spark):
    """A held-out text costs less than its words in another order, and a text that comes twice less than one that comes once."""
    rnd = random.Random(2)
    vocabulary = [f"word{i}" for i in range(300)]
    rnd.shuffle(vocabulary)
    lines = [" ".join(vocabulary[i:i + 10]) for i in range(0, 300, 10)]
    ids = iter(range(10**6))

    def next_id(held):
        return next(k for k in ids if (zlib.crc32(str(k).encode()) % 5 == 1) == held)

    rows = [(next_id(False), "\n".join(rnd.sample(lines, 6)), "en", "a", 1) for _ in range(60)]
    text = "\n".join(rnd.sample(lines, 8))
    words = text.split()
    rnd.shuffle(words)
    known, other = next_id(True), next_id(True)
    rows += [(known, text, "en", "a", 1), (other, " ".join(words), "en", "a", 1)]
    fresh = [" ".join(rnd.choices(vocabulary, k=60)) for _ in range(2)]
    once, twice, again = next_id(False), next_id(False), next_id(False)
    rows += [(once, fresh[0], "en", "a", 1), (twice, fresh[1], "en", "a", 1), (again, fresh[1], "en", "a", 1)]
    out = {r["doc_id"]: r["bits_per_byte"] for r in lm.op12_lm_scoring(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert out[known] < 0.9 * out[other]
    assert out[twice] == pytest.approx(out[again]) and out[twice] < 0.9 * out[once]
