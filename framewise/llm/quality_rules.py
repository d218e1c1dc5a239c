"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Each rule's cost and selectivity are estimated on a sample; the rules then form
one CASE expression in that order, so a rule is evaluated only for documents that
all rules before it let pass.  DataFrame functions only.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, about, free_name, let, stored

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Runs of characters other than blank and 0x09 to 0x0D; none for null."""
    bare = F.trim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(bare), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))


def without(text: Column, chars: str) -> Column:
    """The text without the given characters."""
    return F.translate(text, chars, "")


def word_chars(text: Column) -> Column:
    return F.coalesce(F.length(without(text, SPACES)), F.lit(0)).cast("long")


def symbols(text: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(without(text, SYMBOLS)), F.lit(0)).cast("long")


def capitals(text: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(without(text, UPPER)), F.lit(0)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found at least twice, the first finding included.

    Windows are compared by their 64-bit hash.  Most texts repeat no window, which
    a distinct count settles; only for the others are windows sorted by hash to
    find the repeated ones and the union of their words.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - 2),
                          lambda i: F.xxhash64(F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))

    def covered(at: Column) -> Column:
        """Words under windows that start at the given rising places."""
        return F.aggregate(F.transform(at, lambda v, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - v, F.lit(3)))),
                           F.lit(0), lambda a, b: a + b)

    def repeats(s: Column) -> Column:
        again = F.filter(s, lambda p, k: F.coalesce(F.get(s, k + 1)["h"] == p["h"], F.lit(False))
                         | F.when(k > 0, F.get(s, k - 1)["h"] == p["h"]).otherwise(False))
        return let(F.array_sort(F.transform(again, lambda p: p["i"])), covered)

    def count(h: Column) -> Column:
        sorted_windows = F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(sorted_windows, repeats))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows, count)).cast("long")


#: name -> count of a whole text.
COUNTS: dict[str, Callable[[Column], Column]] = {
    "word_chars": word_chars,
    "n_symbols": symbols,
    "n_dup_lines": duplicate_lines,
    "n_capitals": capitals,
    "n_lines": lambda t: F.size(F.split(F.coalesce(t, F.lit("")), "\n")).cast("long"),
}


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add n_words, n_repeat_words and the COUNTS; null texts count nothing."""
    text = F.col(text_col)
    both = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    held = free_name(docs, "words")
    made = docs.withColumn(held, both).withColumns({n: f(text) for n, f in COUNTS.items()})
    return made.withColumns({n: F.col(held)[n] for n in ("n_words", "n_repeat_words")}).drop(held)


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition over the counts named in ``uses``; a null condition rejects nothing."""

    name: str
    uses: tuple[str, ...]
    rejects: str


RULES = [
    Rule("too_few_words", ("n_words",), "n_words < 50"),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * n_symbols > 5 * n_words"),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), "100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule("capitals", ("word_chars", "n_capitals"), "100 * n_capitals > 50 * word_chars"),
]


def estimate(docs: DataFrame, rules: list[Rule], text_col: str = "text", rows: int = 2000) -> list[tuple[Rule, float, float]]:
    """The rules in cascade order with estimated cost (seconds on the sample) and
    share of the documents reaching them that they reject.

    The sample has about ``rows`` texts (a documented bound; it decides the order
    of evaluation only, never a verdict).  A rule's cost is
    the time of a pass that counts its inputs from the text and tests it, less an
    empty pass.  Rules are then taken greedily by rejection per cost among the
    texts that the rules before let pass.
    """
    text = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    sample = stored(about(text, rows), "rules-sample")

    def seconds(df: DataFrame) -> float:
        took = []
        for _ in range(2):
            began = time.perf_counter()
            df.first()
            took.append(time.perf_counter() - began)
        return min(took)

    w = words(F.col("text"))
    inputs = {**{n: f(F.col("text")) for n, f in COUNTS.items()}, "n_words": F.size(w).cast("long"),
              "n_repeat_words": let(w, repeated_words)}
    base = seconds(sample.agg(F.sum(F.length("text"))))
    cost = {r.name: max(1e-3, seconds(sample.select(*[inputs[u].alias(u) for u in r.uses]).agg(F.count_if(F.expr(r.rejects)))) - base)
            for r in rules}
    counted = with_counts(sample, "text")
    mask = sum((F.when(F.expr(r.rejects), 1 << i).otherwise(0) for i, r in enumerate(rules)), F.lit(0))
    found = {r["m"]: r["count"] for r in counted.groupBy(mask.alias("m")).count().collect()}  # at most 2^rules rows
    order, left = [], list(range(len(rules)))
    while left:
        total = max(1, sum(found.values()))
        rate = {i: sum(c for m, c in found.items() if m >> i & 1) / total for i in left}
        best = max(left, key=lambda i: (rate[i] / cost[rules[i].name], -i))
        order.append((rules[best], cost[rules[best].name], rate[best]))
        found = {m: c for m, c in found.items() if not m >> best & 1}
        left.remove(best)
    return order


def cascade(rules: list[Rule]) -> Column:
    """True where some rule rejects; later rules are not evaluated after the first that does."""
    first, *rest = rules
    out = F.when(F.expr(first.rejects), True)
    for r in rest:
        out = out.when(F.expr(r.rejects), True)
    return out.otherwise(False)


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """Add the counts and ``kept``, the verdict of the rules in estimated order.

    Null and empty texts have no words and are rejected by the first rule.  The
    verdict of a row depends on its text alone; repeated rows get equal ones, an
    empty table gives an empty one.  Input columns named like the counts or
    ``kept`` are replaced.
    """
    rules = rules or RULES
    order = [r for r, _, _ in estimate(docs, rules, text_col)]
    made = {"n_words", "n_repeat_words", "kept", *COUNTS} - {text_col}
    counted = with_counts(docs.drop(*[c for c in docs.columns if c.lower() in made]), text_col)
    return counted.withColumn("kept", ~cascade(order))


def op4_rules(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    out = apply_rules(docs.select("doc_id", "text"))
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))
