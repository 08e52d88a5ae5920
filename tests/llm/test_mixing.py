from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from ledgerloom.llm import mixing
from ledgerloom.llm.common import configure

SCHEMA = "doc_id long, text string, source string, size string, rid string, place string, number string"


def shared(sizes: list[int], weights: list[int], percent: int, limit: int) -> list[Fraction]:
    """Targets by sharing the excess again and again."""
    total, held = Fraction(percent * sum(sizes), 100), set()
    while True:
        left = total - sum(limit * sizes[i] for i in held)
        open_weight = sum(w for i, w in enumerate(weights) if i not in held)
        goal = [Fraction(limit * s) if i in held else left * w / max(open_weight, 1) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
        more = {i for i, g in enumerate(goal) if g > limit * sizes[i]}
        if not more:
            return goal
        held |= more


def brute(rows):
    words = [(d, s, len((t or "").split())) for d, t, s, *_ in rows]
    sources = sorted({s for _, s, _ in words if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for _, s, _ in words)
    sizes = [sum(n for _, s, n in words if s == source) for source in sources]
    goals = shared(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))], 150, 2)
    out = []
    for source, size, goal in zip(sources, sizes, goals, strict=True):
        budget, seen, keyed = int(goal + Fraction(1, 2)), defaultdict(int), []
        for d, s, n in words:
            if s == source:
                who = "" if d is None else str(d)
                draw = hashlib.md5(f"{who}:{n}:{seen[who, n]}".encode()).hexdigest()
                seen[who, n] += 1
                keyed.append((draw, d, n))
        epochs = budget // size if size else 0
        rest = budget - epochs * size
        for _, d, n in sorted(keyed, key=lambda k: k[0]):
            out.append((d, source, n, size, float(goal), epochs * n + max(0, min(n, rest))))
            rest -= n
    return Counter(out)


def test_sharing_in_rounds():
    r = random.Random(5)
    assert shared([100, 100, 100], [3, 1, 2], 150, 2) == [200, Fraction(250, 3), Fraction(500, 3)]
    for _ in range(50):
        sizes = [r.choice([0, 1, 10, 1000, 100_000]) for _ in range(r.randint(1, 9))]
        goals = shared(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 150, 2)
        assert sum(goals) == Fraction(150 * sum(sizes), 100) and all(g <= 2 * s for g, s in zip(goals, sizes, strict=True))


@pytest.mark.parametrize("ranges", [1, 1000])
def test_equals_the_plain_mix(spark, monkeypatch, ranges):
    configure(spark)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10 if ranges > 1 else 50_000)
    r = random.Random(6)
    names = ["hot"] * 30 + ["b", "ä", "Z", "tiny", None, "none"]
    rows = [(i, " ".join(["w"] * r.randint(0, 40)), r.choice(names[:-2])) for i in range(400)]
    rows += [(7, "same row", "hot")] * 40 + [(None, "no id\x0bat all", "b")] * 2 + [(900, None, "none"), (901, "", "none"), (902, "x " * 9000, None), (903, " \t", "b")]
    rows += [(i, "one", f"s{i % 7}") for i in range(1000, 1030)]
    docs = spark.createDataFrame([(*row, None, None, None, None) for row in rows], SCHEMA).repartition(7)
    got = [tuple(x) for x in mixing.mix(docs).collect()]
    want = brute(rows)
    assert {x[:4] + x[5:] for x in got} == {x[:4] + x[5:] for x in want}
    assert Counter((*x[:4], round(x[4], 6), x[5]) for x in got) == Counter({(*k[:4], round(k[4], 6), k[5]): 0 for k in want}) + Counter(
        x for k, n in want.items() for x in [(*k[:4], round(k[4], 6), k[5])] * n
    )
    taken = defaultdict(int)
    for x in got:
        taken[x[1]] += x[5]
        assert 0 <= x[5] <= 2 * x[2]
    assert all(abs(taken[x[1]] - x[4]) <= 0.5 for x in got)


def test_no_documents_and_only_empty_ones(spark):
    configure(spark)
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, None, None, None, None, None, None), (2, "", "a", None, None, None, None)], SCHEMA)
    assert {tuple(x) for x in mixing.mix(docs).collect()} == {(1, None, 0, 0, 0.0, 0), (2, "a", 0, 0, 0.0, 0)}
