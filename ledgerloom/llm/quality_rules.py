"""Quality rules as a short-circuit cascade of SQL expressions.

A rule says when a text fails. On a bounded sample each rule is timed and its
share of failures is counted; the cascade then asks the rules by failures per
second, most first, and stops at the first failure. The order changes the work,
never the verdict. All expressions are built-in functions.

Edge cases: a null text counts as empty and fails as too short; an empty table
gives an empty result; repeated rows are judged one by one; other columns pass
through unread. A text of any length is judged whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, let, once

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5

Measure = Callable[[Column], Column]


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def repeated_words(words: Column) -> Column:
    """Words inside a window of five words that the text holds twice or more.

    Windows are compared by 64-bit hashes of word hashes. Most texts repeat no
    window, which one distinct count shows; only the others sort theirs.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def twice(s: Column) -> Column:
            return F.filter(
                s,
                lambda e, k: F.coalesce(e["x"] == F.get(s, k - 1)["x"], F.lit(False))
                | F.coalesce(e["x"] == F.get(s, k + 1)["x"], F.lit(False)),
            )

        starts = let(placed, lambda s: F.array_sort(F.transform(twice(s), lambda e: e["i"])))
        return F.aggregate(
            starts,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda a, i: F.struct(
                i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")
            ),
            lambda a: a["n"],
        )

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))

    return (
        F.when(F.size(words) < WINDOW + 1, F.lit(0))
        .otherwise(let(let(hashes, windows), count))
        .cast("long")
    )


def _filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


# Each measure of a text that is not null.
MEASURES: dict[str, Measure] = {
    "n_words": lambda t: F.regexp_count(t, F.lit(WORD)).cast("long"),
    "word_chars": lambda t: F.length(F.regexp_replace(t, SPACES, "")).cast("long"),
    "n_symbols": lambda t: F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
    "n_lines": lambda t: F.size(_filled_lines(t)).cast("long"),
    "n_dup_lines": lambda t: let(
        _filled_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))
    ).cast("long"),
    "n_repeat_words": lambda t: let(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), repeated_words),
    "n_capitals": lambda t: F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long"),
}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    """``fails`` gets a function from the name of a measure to its column."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


# The first two are the base rules.
RULES = (
    Rule("too_short", lambda m: m("n_words") < 10),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("symbols", lambda m: 100 * m("n_symbols") > 10 * m("n_words")),
    # One or two repeated lines are no fault of a short text.
    Rule("repeated_lines", lambda m: (m("n_dup_lines") >= 3) & (100 * m("n_dup_lines") > 30 * m("n_lines"))),
    Rule("long_words", lambda m: m("word_chars") > 30 * m("n_words")),
    Rule("capitals", lambda m: 100 * m("n_capitals") > 50 * m("word_chars")),
)


class Profile(NamedTuple):
    rule: Rule
    rejected: float
    seconds: float

    @property
    def rate(self) -> float:
        return self.rejected / self.seconds


def profile(
    docs: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text", sample_rows: int = 1000
) -> list[Profile]:
    """Cost and share of failures of each rule on a random sample of about ``sample_rows`` rows.

    Each rule is timed alone, less the time of a job that only reads the sample.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.select(_text(F.col(text)).alias("text")).sample(share, seed=1).persist()
    try:
        rows = sample.count()

        def timed(failing: Column) -> tuple[int, float]:
            best = None
            for _ in range(2):  # the first run also compiles the code
                start = time.perf_counter()
                found = sample.agg(F.count_if(failing).alias("n")).first()["n"]
                best = time.perf_counter() - start
            return found, best

        _, reading = timed(F.length("text") < 0)
        measured = []
        for rule in rules:
            found, seconds = timed(rule.fails(lambda name: MEASURES[name](F.col("text"))))
            measured.append(Profile(rule, found / max(rows, 1), max(seconds - reading, 1e-4)))
        return measured
    finally:
        sample.unpersist()


def cascade(profiles: Iterable[Profile]) -> list[Rule]:
    """The rules by rejections per second, most first; equal rates by cost, then name."""
    order = sorted(profiles, key=lambda p: (-p.rate, p.seconds, p.rule.name))
    return [p.rule for p in order]


def first_failure(rules: Iterable[Rule], measure: Callable[[str], Column]) -> Column:
    """Name of the first rule that fails, or null; later rules are not computed."""
    chain = F.lit(None).cast("string")
    for rule in reversed(list(rules)):
        chain = F.when(rule.fails(measure), F.lit(rule.name)).otherwise(chain)
    return chain


def judge(docs: DataFrame, rules: Iterable[Rule], text: str = "text") -> DataFrame:
    """``documents`` -> ``doc_id``, the base measures, ``base_failed`` and ``kept``."""
    value = _text(F.col(text))
    measured = once(docs, {"value": value} | {n: MEASURES[n](value) for n in BASE}, "doc_id")

    def measure(name: str) -> Column:
        return F.col(name) if name in BASE else MEASURES[name](F.col("value"))

    base = RULES[0].fails(measure) | RULES[1].fails(measure)
    kept = ~base & first_failure(rules, measure).isNull()
    return measured.select("doc_id", *BASE, base.alias("base_failed"), kept.alias("kept"))


def keep(docs: DataFrame, rules: Iterable[Rule], text: str = "text") -> DataFrame:
    """The rows that fail no rule, unchanged."""
    value = _text(F.col(text))
    return docs.where(first_failure(rules, lambda name: MEASURES[name](value)).isNull())
