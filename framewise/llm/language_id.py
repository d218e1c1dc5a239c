"""Language identification: averaged hashed subword embeddings, linear softmax.

A document is the average of the embeddings of its subwords (byte n-grams of
its letter runs, hashed into a fixed table); a softmax over the learned
languages sits on top.  Both layers are trained together by stochastic gradient
descent in numpy.  A temperature, fitted on rows kept out of the descent,
calibrates the probabilities, and a threshold on them rejects doubtful texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, free_name, schema_of, stored

LETTERS = re.compile(r"[^\W\d_]+")
BUCKETS, DIM, N_MIN, N_MAX = 1 << 15, 16, 2, 4
SEED = 13


def _letters_only() -> bytes:
    """Byte table: letters stay (bytes of non-ASCII characters count as letters), the rest is a blank."""
    return bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))


KEEP = _letters_only()
SLICE = 1 << 20  # bytes handled at once, so that memory does not follow the text's length


def subwords(text: str):
    """Yield arrays of table rows: the byte n-grams of the lower-cased text's
    letter runs, a blank at either end marking the run's bounds.  No n-gram
    crosses a run."""
    raw = b" " + text.lower().encode("utf-8", "surrogatepass").translate(KEEP) + b" "
    every = np.frombuffer(raw, np.uint8)
    for at in range(0, len(every), SLICE):
        x = every[at:at + SLICE + N_MAX - 1].astype(np.uint32)
        blank = x == 32
        starts = min(SLICE, len(every) - at)
        h = x * np.uint32(0x9E3779B1)
        inner = np.zeros(len(x), bool)  # a blank between the first and the last byte so far
        for n in range(2, N_MAX + 1):
            m = len(x) - n + 1
            if m <= 0:
                break
            h = (h[:m] ^ x[n - 1:]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
            if n > 2:
                inner = inner[:m] | blank[n - 2:n - 2 + m]
            else:
                inner = inner[:m]
            take = ~inner & ~(blank[:m] & blank[n - 1:n - 1 + m])
            take[starts:] = False
            if n >= N_MIN:
                yield (h[take] >> np.uint32(17)).astype(np.intp)


@dataclass
class LanguageModel:
    """``table`` is BUCKETS x DIM, ``out`` DIM x languages; ``temperature`` scales the logits."""

    langs: list[str]
    table: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def scorer(self):
        """A function from texts to (language index or -1, probability)."""
        per_row = np.ascontiguousarray(self.table @ self.out)  # averaging is linear: logits per table row

        def score(text: str | None) -> tuple[int, float]:
            if not text or not LETTERS.search(text):
                return -1, 0.0
            total, n = np.zeros(len(self.langs)), 0
            for rows in subwords(text):
                total += per_row[rows].sum(0, dtype=np.float64)
                n += len(rows)
            z = (total / n + self.bias) / self.temperature
            e = np.exp(z - z.max())
            best = int(e.argmax())
            return best, float(e[best] / e.sum())

        return score


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of a text and how often each occurs, as shares."""
    n = sum(np.bincount(rows, minlength=BUCKETS) for rows in subwords(text)) if LETTERS.search(text) else np.zeros(1)
    ids = np.flatnonzero(n)
    return ids, (n[ids] / max(n.sum(), 1)).astype(np.float32)


def train(texts: list[str], langs: list[str], epochs: int = 3, rate: float = 20.0,
          reject_share: float = 0.01, seed: int = SEED) -> LanguageModel:
    """Fit on the given rows; every fifth one is kept for the calibration.

    Texts without letters teach nothing.  Without any usable row the model has
    no languages and its scorer answers -1.
    """
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs], np.int64)
    bags = [bag(t) for t in texts]
    use = [i for i, b in enumerate(bags) if len(b[0])]
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1.0 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    model = LanguageModel(names, table, out, bias)
    fit = [i for k, i in enumerate(use) if k % 5 or len(use) < 10]
    held = [i for k, i in enumerate(use) if k % 5 == 0] or fit
    if not fit:
        return LanguageModel([], table, np.zeros((DIM, 0), np.float32), np.zeros(0, np.float32))
    share = np.bincount(y[fit], minlength=len(names)) / len(fit)
    weight = 1.0 / np.maximum(share * (share > 0).sum(), 1e-9)  # classes count alike
    steps = epochs * len(fit)
    done = 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            lr = rate * (1 - done / steps) * min(float(weight[y[i]]), 5.0) / 20
            ids, s = bags[i]
            v = s @ table[ids]
            z = v @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= lr * np.outer(v, p)
            bias -= np.float32(0.05 * lr) * p
            table[ids] -= (lr * s)[:, None] * back
            done += 1
    z = np.stack([bags[i][1] @ table[bags[i][0]] @ out + bias for i in held])
    t = y[held]

    def loss(temp: float) -> float:
        a = z / temp
        a = a - a.max(1, keepdims=True)
        return float((np.log(np.exp(a).sum(1)) - a[np.arange(len(t)), t]).mean())

    model.temperature = float(min(np.geomspace(0.2, 20, 61), key=loss))
    a = z / model.temperature
    p = np.exp(a - a.max(1, keepdims=True))
    p = (p / p.sum(1, keepdims=True)).max(1)
    model.reject_below = float(np.quantile(p, reject_share))
    return model


def fit_language_model(docs: DataFrame, per_lang: int = 800, most_rows: int = 160_000,
                       id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Train on about ``per_lang`` whole texts of each language, fewer where there are so many
    languages that this would exceed ``most_rows`` in all (documented bounds).  Every language is learned.

    The rows of a language are those whose hash of id and text falls below a
    level set from the language's row count; so the sample needs no sort and no
    group in one task.  Rows that are equal in id, text and language count once.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    rows = rows.filter("t is not null and l is not null")
    sizes = stored(rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")), "languages")
    langs = sizes.count()
    if not langs:
        return train([], [])
    share = max(1, min(per_lang, most_rows // langs))
    h = F.pmod(F.xxhash64("i", "t"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.join(sizes, "l").filter(h * F.col("n") < share).select("i", "t", "l").dropDuplicates()
    got = picked.collect()
    got.sort(key=lambda r: (str(r["i"]), r["l"], r["t"]))
    return train([r["t"] for r in got], [r["l"] for r in got])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` (``und`` for null texts and texts without letters),
    ``score`` (calibrated probability, 0 for ``und``) and ``lang_rejected``
    (the probability is under the model's level, or the text is ``und``).

    Columns of these names in the input are replaced.  An empty table gives an
    empty table; repeated rows get equal answers.
    """
    docs = docs.drop("lang_pred", "score", "lang_rejected")
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("lang_rejected", T.BooleanType())]
    col = docs.columns.index(text_col)

    def step(batches):
        score = model.scorer() if model.langs else (lambda text: (-1, 0.0))
        for b in batches:
            found = [score(t) for t in b.column(col).to_pylist()]
            lang = pa.array([model.langs[k] if k >= 0 else "und" for k, _ in found], pa.string())
            p = pa.array([s for _, s in found], pa.float64())
            no = pa.array([k < 0 or s < model.reject_below for k, s in found], pa.bool_())
            names = [*b.schema.names, *(n for n, _ in fields)]
            yield pa.RecordBatch.from_arrays([*b.columns, lang, p, no], names=names)

    return docs.mapInArrow(step, schema_of(docs, fields))


def op10_language_id(docs: DataFrame) -> DataFrame:
    """The contract's columns: learn only from documents whose crc32 of the id
    modulo 4 is not 2, predict for every document.  A null doc_id counts as not held out."""
    rest = F.coalesce(crc_mod("doc_id", 4), F.lit(0)) == 2
    model = fit_language_model(docs.filter(~rest))
    held = free_name(docs, "held")
    rows = docs.select("doc_id", "text", rest.alias(held))
    return identify(rows, model).select("doc_id", F.col(held).alias("held_out"), "lang_pred", "score", "lang_rejected")
