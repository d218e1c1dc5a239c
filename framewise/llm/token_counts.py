"""Token counts of a unigram vocabulary without making tokens.

An Aho-Corasick automaton finds every vocabulary piece in a stretch of text;
dynamic programming over its characters carries the best score and the number
of pieces on that path, nothing else.

Rules, as a unigram tokenizer has them: each blank becomes the word mark and one
word mark stands before the text; words are segmented alone; where two paths
score alike, the one whose last piece starts further left stays; a character
that no piece covers costs the lowest score less ten; such a character counts
one id per UTF-8 byte if the vocabulary has byte pieces for all of its run, else
a run of them counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import WordCache, schema_of
from .packing import vocabulary_path

MARK = "▁"
UNKNOWN_COST = 10.0


@dataclass
class Vocabulary:
    """Pieces with their scores in id order; ``unknown`` is the id of the unknown piece."""

    pieces: list[tuple[str, float]]
    unknown: int = 0
    byte_fallback: bool = True


def load_vocabulary(path: str) -> Vocabulary:
    """Normal and byte pieces of a SentencePiece model file, in its id order."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    pieces = [(sp.id_to_piece(i), float(sp.get_score(i))) for i in range(sp.get_piece_size())]
    return Vocabulary(pieces, sp.unk_id(), any(sp.is_byte(i) for i in range(len(pieces))))


class Counter:
    """Counts the ids of texts."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        scores = [s for _, s in vocabulary.pieces]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_COST
        for i, (piece, score) in enumerate(vocabulary.pieces):
            if piece and i != vocabulary.unknown:
                self.found.add_word(piece, (len(piece), score))
        if len(self.found):
            self.found.make_automaton()
        names = {p for p, _ in vocabulary.pieces}
        self.bytes = {b for b in range(256) if f"<0x{b:02X}>" in names} if vocabulary.byte_fallback else set()
        self.single = {p for i, (p, _) in enumerate(vocabulary.pieces) if len(p) == 1 and i != vocabulary.unknown}
        self.joined = {p[i:i + 2] for p in names for i in range(len(p) - 1)}  # neighbours inside some piece
        # ids of a line end that no piece holds and that its byte piece stands for; 0: it is no certain cut
        self.line_end = int(10 in self.bytes and not any("\n" in p for p in names))
        self.cache = WordCache(self.count_word)

    def count_word(self, word: str) -> int:
        """Ids of one word, its mark included.  Between two known characters
        that stand together in no piece every segmentation has a cut; so marks
        at a word's end mostly count alone."""
        core = word.rstrip(".,!?;:")
        if core and core != word and word[len(core) - 1:len(core) + 1] not in self.joined:
            if self.single.issuperset(word[len(core) - 1:]):
                return self.cache[core] + self.cache[word[len(core):]]
        return self.count_part(word) if self.single.issuperset(word) else self.count_any(word)

    def count_part(self, part: str) -> int:
        """Ids of a stretch of known characters."""
        n = len(part)
        best, count = [0.0] + [-float("inf")] * n, [0] * (n + 1)
        for end, (size, score) in self.found.iter(part):  # for each end the longest piece comes first
            start = end + 1 - size
            s = best[start] + score
            if s > best[end + 1]:
                best[end + 1], count[end + 1] = s, count[start] + 1
        return count[n]

    def count_any(self, word: str) -> int:
        """Ids of a word that may hold unknown characters."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if len(self.found):
            for end, (size, score) in self.found.iter(word):
                ends[end + 1].append((size, score))
        best, count, run = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)  # run: unknown characters that end here
        for e in range(1, n + 1):
            top, frm = None, 0
            single = False
            for size, score in sorted(ends[e], reverse=True):  # longest first: starts furthest left
                single |= size == 1
                s = best[e - size] + score
                if top is None or s > top:
                    top, frm = s, e - size
            if not single:
                s = best[e - 1] + self.unknown_score
                if top is None or s > top:
                    top, frm = s, -1
            best[e] = top
            if frm >= 0:
                count[e] = count[frm] + 1
            else:
                run[e] = run[e - 1] + 1
                before = e - run[e]
                raw = word[before:e].encode("utf-8", "surrogatepass")
                count[e] = count[before] + (len(raw) if self.bytes.issuperset(raw) else 1)
        return count[n]

    def count(self, text: str | None) -> int:
        """Ids of a whole text; none for null and empty texts."""
        if not text:
            return 0
        lines = text.replace(MARK, " ").split("\n") if self.line_end else [text.replace(MARK, " ")]
        first, *rest = lines[0].split(" ")
        # a blank in front is the mark that would be put there
        words = [MARK + w for w in (rest if rest and not first else [first, *rest])]
        for line in lines[1:]:
            first, *rest = line.split(" ")
            words.append(first)
            words += [MARK + w for w in rest]
        return sum(map(self.cache.__getitem__, words)) + (len(lines) - 1) * self.line_end


_COUNTERS: dict[str, Counter] = {}


def counter(name: str) -> Counter:
    """One counter, with its memory, per worker process and vocabulary."""
    if name not in _COUNTERS:
        _COUNTERS[name] = Counter(load_vocabulary(vocabulary_path(name)))
    return _COUNTERS[name]


def token_counts(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` to every row (0 for null and empty texts; an input column
    of that name is replaced).  Repeated rows get equal counts, an empty table
    gives an empty table."""
    docs = docs.drop("n_tokens")
    col, names = docs.columns.index(text_col), [*docs.columns, "n_tokens"]

    def step(batches):
        count = counter(vocabulary).count
        for b in batches:
            n = pa.array([count(t) for t in b.column(col).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, n], names=names)

    return docs.mapInArrow(step, schema_of(docs, [("n_tokens", T.LongType())]))


def op7_token_counts(docs: DataFrame) -> DataFrame:
    return token_counts(docs.select("doc_id", "text")).select("doc_id", "n_tokens")
