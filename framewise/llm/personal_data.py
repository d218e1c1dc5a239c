"""Personal data: fixed patterns and a character-level BiLSTM-CRF.

The patterns find emails, addresses, card and phone numbers in whole texts.  A
bidirectional LSTM over character classes with CRF transitions, trained in numpy
on spans that the patterns label, adds what they miss, such as two numbers in a
row that they read as one.  It runs on overlapping windows; the windows' scores
are averaged for each character and one decoding per stretch reconciles them.

Every kind holds a digit or an at sign, so windows are laid around these; text
without them needs none.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import about, schema_of

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # none, then first and further character of each kind
WINDOW, STRIDE, AROUND = 96, 48, 40

_TRIGGER = re.compile("[0-9@]")
# Each form matches what the fixed pattern matches, without going back over long runs.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def valid(kind: str, s: str) -> bool:
    """The kind's own test of a matched string."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        d = s.replace(" ", "").replace("-", "")
        return 14 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= sum("0" <= c <= "9" for c in s) <= 15
    return True


def _emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.fullmatch(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' valid matches, by start, then kind."""
    if not _TRIGGER.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    for kind, form in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(m.start(), kind, m.end()) for m in form.finditer(text) if valid(KINDS[kind], m[0])]
    return sorted(out)


def doubtful(text: str) -> list[tuple[int, int]]:
    """Long numbers that a pattern matched and its test turned down: what they hold is unlabelled."""
    return [(m.start(), m.end()) for kind, form in (("card", _CARD), ("phone", _PHONE)) for m in form.finditer(text)
            if not valid(kind, m[0]) and sum("0" <= c <= "9" for c in m[0]) >= 10]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


#: Characters with a class of their own; others share one for small letters, capitals, digits, other letters, white space and the rest.
_OWN = "@.-+()_%/:,;='\"<>#*&|!?"
_CLASSES = 7 + len(_OWN)  # class 0 pads


def _class_of(c: str) -> int:
    if c in _OWN:
        return 7 + _OWN.index(c)
    if "a" <= c <= "z":
        return 1
    if "A" <= c <= "Z":
        return 2
    if "0" <= c <= "9":
        return 3
    if c.isalpha():
        return 4
    return 5 if c.isspace() else 6


_ASCII = np.array([_class_of(chr(c)) for c in range(128)], np.int8)


def classes(text: str) -> np.ndarray:
    """Class of each code point."""
    if text.isascii():
        return _ASCII[np.frombuffer(text.encode(), np.uint8)]
    return np.fromiter((_ASCII[ord(c)] if c < "\x80" else _class_of(c) for c in text), np.int8, len(text))


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text within AROUND characters of a digit or an at sign."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _window_starts(n: int) -> list[int]:
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _squash(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


# A kind's further character follows its first or a further one only.
_BARRED = np.zeros((TAGS, TAGS), np.float32)
for _k in range(len(KINDS)):
    _BARRED[:, 2 + 2 * _k] = -1e4
    _BARRED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = 0
_BARRED_START = np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0) > 0, 0, -1e4).astype(np.float32)


def _logsum(x, axis):
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


@dataclass
class Tagger:
    """Parameters: class embedding, two LSTMs, output layer, CRF transitions."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, size: int = 8, hidden: int = 16, seed: int = 5) -> Tagger:
        r = np.random.default_rng(seed)
        p = {"E": r.normal(0, 0.5, (_CLASSES, size)), "O": r.normal(0, 0.3, (2 * hidden, TAGS)), "o": np.zeros(TAGS),
             "A": np.zeros((TAGS, TAGS)), "s": np.zeros(TAGS)}
        for d in "fb":
            p[f"X{d}"] = r.normal(0, size ** -0.5, (size, 4 * hidden))
            p[f"H{d}"] = r.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
            p[f"c{d}"] = np.concatenate([np.ones(hidden), np.zeros(3 * hidden)])  # gates: forget, input, output, value
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, ids: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (T, B, hidden) of one direction; ``keep`` gets what the way back needs."""
        p = self.p
        table, inner = p["E"] @ p[f"X{d}"] + p[f"c{d}"], p[f"H{d}"]
        n = inner.shape[0]
        h = c = np.zeros((ids.shape[0], n), np.float32)
        out = np.empty((ids.shape[1], ids.shape[0], n), np.float32)
        for t in range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1):
            g = table[ids[:, t]] + h @ inner
            f, i, o = np.split(_squash(g[:, :3 * n]), 3, axis=1)
            v = np.tanh(g[:, 3 * n:])
            before, c = c, f * c + i * v
            tc = np.tanh(c)
            if keep is not None:
                keep.append((t, h, before, f, i, o, v, tc))
            h = o * tc
            out[t] = h
        return out

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores (B, T, TAGS) of windows of classes (B, T)."""
        h = np.concatenate([self._run(ids, "f", None), self._run(ids, "b", None)], 2)
        return (h @ self.p["O"] + self.p["o"]).transpose(1, 0, 2)

    def loss_and_gradient(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag sequences, and its gradient."""
        p, (size, steps) = self.p, ids.shape
        kept: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._run(ids, d, kept[d]) for d in "fb"], 2)
        e = h @ p["O"] + p["o"]  # (T, B, TAGS)
        a, s = p["A"] + _BARRED, p["s"] + _BARRED_START
        ahead = np.empty_like(e)
        ahead[0] = s + e[0]
        for t in range(1, steps):
            ahead[t] = _logsum(ahead[t - 1][:, :, None] + a, 1) + e[t]
        back = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            back[t] = _logsum(a + (e[t + 1] + back[t + 1])[:, None, :], 2)
        z = _logsum(ahead[-1], 1)
        rows, y = np.arange(size), tags.T
        gold = s[y[0]] + sum(e[t][rows, y[t]] for t in range(steps)) + sum(a[y[t - 1], y[t]] for t in range(1, steps))
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        de = np.exp(ahead + back - z[None, :, None])
        grad["s"] += de[0].sum(0)
        np.subtract.at(grad["s"], y[0], 1)
        for t in range(1, steps):
            grad["A"] += np.exp(ahead[t - 1][:, :, None] + a + (e[t] + back[t])[:, None, :] - z[:, None, None]).sum(0)
            np.subtract.at(grad["A"], (y[t - 1], y[t]), 1)
        for t in range(steps):
            de[t][rows, y[t]] -= 1
        grad["O"] = np.tensordot(h, de, ([0, 1], [0, 1]))
        grad["o"] = de.sum((0, 1))
        dh_all = de @ p["O"].T
        n = p["Hf"].shape[0]
        for k, d in enumerate("fb"):
            dh, dc = np.zeros((size, n), np.float32), np.zeros((size, n), np.float32)
            dtable = np.zeros((_CLASSES, 4 * n), np.float32)
            for t, h0, c0, f, i, o, v, tc in reversed(kept[d]):
                dh = dh + dh_all[t][:, k * n:(k + 1) * n]
                dc = dc + dh * o * (1 - tc * tc)
                dg = np.concatenate([dc * c0 * f * (1 - f), dc * v * i * (1 - i), dh * tc * o * (1 - o), dc * i * (1 - v * v)], 1)
                np.add.at(dtable, ids[:, t], dg)
                grad[f"H{d}"] += h0.T @ dg
                dh, dc = dg @ p[f"H{d}"].T, dc * f
            grad[f"X{d}"] = p["E"].T @ dtable
            grad[f"c{d}"] = dtable.sum(0)
            grad["E"] += dtable @ p[f"X{d}"].T
        return float((z - gold).mean()), {k: v / size for k, v in grad.items()}

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best tag sequence of each stretch's scores (n, TAGS)."""
        a, s = self.p["A"] + _BARRED, self.p["s"] + _BARRED_START
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(scores)
        order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
        for at in range(0, len(order), 256):
            group = order[at:at + 256]
            longest = len(scores[group[-1]])
            size = np.array([len(scores[i]) for i in group])
            e = np.zeros((longest, len(group), TAGS), np.float32)
            for j, i in enumerate(group):
                e[:size[j], j] = scores[i]
            best, frm = s + e[0], np.empty((longest, len(group), TAGS), np.int8)
            for t in range(1, longest):
                x = best[:, :, None] + a
                frm[t] = x.argmax(1)
                best = np.where((t < size)[:, None], x.max(1) + e[t], best)
            for j, i in enumerate(group):
                tags = np.empty(size[j], np.int8)
                k = int(best[j].argmax())
                for t in range(size[j] - 1, -1, -1):
                    tags[t] = k
                    if t:
                        k = frm[t, j, k]
                out[i] = tags
        return out

    def tag(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """Tags of stretches of classes: windows scored together, their scores
        averaged by nearness to the window's middle, one decoding per stretch."""
        where = [(i, a) for i, x in enumerate(parts) for a in _window_starts(len(x))]
        total = [np.zeros((len(x), TAGS), np.float32) for x in parts]
        share = [np.zeros((len(x), 1), np.float32) for x in parts]
        ramp = (1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)[:, None]
        for at in range(0, len(where), 1024):
            group = where[at:at + 1024]
            ids = np.zeros((len(group), WINDOW), np.int8)
            for j, (i, a) in enumerate(group):
                x = parts[i][a:a + WINDOW]
                ids[j, :len(x)] = x
            for (i, a), sc in zip(group, self.scores(ids), strict=True):
                m = min(WINDOW, len(parts[i]) - a)
                total[i][a:a + m] += sc[:m] * ramp[:m]
                share[i][a:a + m] += ramp[:m]
        return self.decode([t / s for t, s in zip(total, share, strict=True)])

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Tagged spans of each text that pass their kind's test."""
        places = [(i, a, b) for i, t in enumerate(texts) for a, b in stretches(t)]
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for (i, a, _), tags in zip(places, self.tag([classes(texts[i][a:b]) for i, a, b in places]), strict=True):
            for first in np.flatnonzero(tags % 2 == 1):
                end = first + 1
                while end < len(tags) and tags[end] == tags[first] + 1:
                    end += 1
                kind, s = int(tags[first]) // 2, texts[i][a + first:a + end]
                if _whole(KINDS[kind], s):
                    found[i].append((int(a + first), kind, int(a + end)))
        return found


_WHOLE = {"email": re.compile(_LOCAL.pattern + "@" + _DOMAIN.pattern), "ip": _IP, "card": _CARD, "phone": _PHONE}


def _whole(kind: str, s: str) -> bool:
    """The string as a whole has the kind's form and passes its test."""
    return bool(_WHOLE[kind].fullmatch(s)) and valid(kind, s)


def train(rows: list[tuple[bytes, bytes]], steps: int = 160, batch: int = 48, rate: float = 0.02, seed: int = 5) -> Tagger | None:
    """Fit on windows (classes, tags); None if no window holds a span."""
    if not rows or not any(any(t) for _, t in rows):
        return None
    ids = np.stack([np.frombuffer(a, np.int8) for a, _ in rows])
    tags = np.stack([np.frombuffer(b, np.int8) for _, b in rows]).astype(np.int64)
    model, r = Tagger.fresh(seed=seed), np.random.default_rng(seed)
    m1, m2 = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, r.permutation(len(ids))])
        pick, order = order[:batch], order[batch:]
        _, g = model.loss_and_gradient(ids[pick], tags[pick])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        for k, v in g.items():
            v = v * np.float32(min(1.0, 5.0 / max(norm, 1e-9)))
            m1[k] = 0.9 * m1[k] + 0.1 * v
            m2[k] = 0.99 * m2[k] + 0.01 * v * v
            move = m1[k] / (1 - 0.9 ** step) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-6)
            model.p[k] = (model.p[k] - rate * (1 - 0.9 * step / steps) * move).astype(np.float32)
    return model


def fit_tagger(docs: DataFrame, windows: int = 1500, text_col: str = "text") -> Tagger | None:
    """Train on at most ``windows`` labelled windows (a documented bound) around
    the digits and at signs of about as many whole texts that have any, without
    windows in which a pattern matched a long number but turned it down.
    Characters in two spans take the earlier kind's tag."""

    def step(batches):
        for b in batches:
            out = []
            for text in b["text"]:
                spans = base_spans(text)
                tags, unsure = np.zeros(len(text), np.int8), doubtful(text)
                for a, k, e in reversed(spans):
                    tags[a:e] = 2 + 2 * k
                    tags[a] = 1 + 2 * k
                for a, e in stretches(text):
                    x = classes(text[a:e])
                    for w in _window_starts(len(x)):
                        if any(p < a + w + WINDOW and a + w < q for p, q in unsure):
                            continue
                        ids, y = np.zeros(WINDOW, np.int8), np.zeros(WINDOW, np.int8)
                        part = tags[a + w:min(a + w + WINDOW, e)].copy()
                        if part[0] and part[0] % 2 == 0:  # a span that began before the window begins with it here
                            part[0] -= 1
                        ids[:len(part)], y[:len(part)] = x[w:w + WINDOW], part
                        out.append((hashlib.blake2b(text[a + w:a + w + WINDOW].encode("utf-8", "surrogatepass"), digest_size=8).hexdigest(),
                                    ids.tobytes(), y.tobytes()))
            yield pd.DataFrame(out, columns=["h", "ids", "tags"])

    texts = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    got = about(texts, windows).mapInPandas(step, "h string, ids binary, tags binary").limit(20 * windows).collect()
    got.sort(key=lambda r: (r["h"], r["ids"], r["tags"]))
    return train([(bytes(r["ids"]), bytes(r["tags"])) for r in got[:windows]])


def _all_spans(texts: list[str], model: Tagger | None) -> list[tuple[list, list]]:
    """(fixed patterns' spans, all spans) of each text; added ones touch no other span."""
    fixed = [base_spans(t) for t in texts]
    more = model.spans(texts) if model else [[] for _ in texts]
    out = []
    for base, added in zip(fixed, more, strict=True):
        spans = list(base)
        for a, k, b in added:
            if all(b <= x or y <= a for x, _, y in spans):
                spans.append((a, k, b))
        out.append((base, sorted(spans)))
    return out


def find_personal_data(docs: DataFrame, model: Tagger | None, text_col: str = "text") -> DataFrame:
    """Add n_email, n_ip, n_card, n_phone and base_sha256 (fixed patterns) and
    ``spans`` (all, as kind:start:end in code points) to every row.

    Null and empty texts hold nothing: zero counts, the hash of an empty list and
    an empty string.  Input columns of these names are replaced; repeated rows get
    equal answers, an empty table gives an empty one.
    """
    made = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in made])
    col, names = docs.columns.index(text_col), [*docs.columns, *made]

    def step(batches):
        for b in batches:
            found = _all_spans([t or "" for t in b.column(col).to_pylist()], model)
            n = [pa.array([sum(x[1] == k for x in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, *n, sha, pa.array([listed(s) for _, s in found], pa.string())], names=names)

    kinds = [T.LongType()] * len(KINDS) + [T.StringType()] * 2
    return docs.mapInArrow(step, schema_of(docs, list(zip(made, kinds, strict=True))))


def mask_personal_data(docs: DataFrame, model: Tagger | None, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """Every row with each span replaced by its kind in brackets; overlapping
    spans become one, named for the first.  Null texts stay null.  A whole-number
    column ``length_col`` follows the new text's length where it is not null."""
    col = docs.columns.index(text_col)
    has = length_col in docs.columns and isinstance(docs.schema[length_col].dataType, T.IntegralType)
    n_col = docs.columns.index(length_col) if has else -1

    def masked(text: str, spans: list) -> str:
        out, last = [], 0
        for a, k, b in spans:
            if a >= last:
                out += [text[last:a], f"[{KINDS[k].upper()}]"]
            last = max(last, b)
        return "".join(out) + text[last:]

    def step(batches):
        for b in batches:
            texts = b.column(col).to_pylist()
            new = [None if t is None else masked(t, s) if s else t for t, (_, s) in zip(texts, _all_spans([t or "" for t in texts], model), strict=True)]
            cols = list(b.columns)
            cols[col] = pa.array(new, b.schema.field(col).type)
            if n_col >= 0:
                cols[n_col] = pa.array([n if t is None or n is None else len(t) for t, n in zip(new, cols[n_col].to_pylist(), strict=True)],
                                       b.schema.field(n_col).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(step, docs.schema)


def op3_personal_data(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text")
    return find_personal_data(rows, fit_tagger(rows)).drop("text")
