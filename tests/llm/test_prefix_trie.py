from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from ledgerloom.llm import prefix_trie as p
from ledgerloom.llm.common import configure

SCHEMA = "conv_id long, turn long, role string, text string, pos string, block string, rep string"


def brute(rebuilt: dict[int, list[tuple[str, int]]]) -> set[tuple]:
    """Nodes from all openings of all sequences of (turn, words)."""
    nodes: dict[tuple, list[int]] = {}
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes.setdefault(tuple(rebuilt[c][:d]), []).append(c)
    children: dict[tuple, list[tuple]] = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    sums = {}
    for path in sorted(nodes, key=len, reverse=True):
        below = [sums[x] for x in children.get(path, [])]
        own = (len(nodes[path]) - 1) * path[-1][1] if path else 0
        sums[path] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return {
        (
            members[0],
            len(path),
            nodes[path[:-1]][0] if path else None,
            len(members),
            len(children.get(path, [])),
            *sums[path],
            hashlib.sha256(",".join(str(c) for c in members if len(rebuilt[c]) == len(path)).encode()).hexdigest(),
        )
        for path, members in nodes.items()
    }


def given(spark, rebuilt):
    turns = [(c, i, hashlib.md5(t.encode()).hexdigest(), w) for c, ts in rebuilt.items() for i, (t, w) in enumerate(ts)]
    return (
        spark.createDataFrame(turns, "conv_id long, pos long, mark string, words long"),
        spark.createDataFrame([(c,) for c in rebuilt], "conv_id long"),
    )


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(count, longest, letters, seed):
    r = random.Random(seed)
    words = {x: r.randint(0, 9) for x in letters}
    found = {c: [(x, words[x]) for x in r.choices(letters, k=r.randint(0, longest))] for c in r.sample(range(1000), count)}
    ids = list(found)
    for c in ids[: count // 3]:  # a large group of copies
        found[c] = found[ids[-1]]
    return found


@pytest.mark.parametrize(("fan", "run_rows", "starts"), [(2, 3, (0, 2, 4)), (64, 20_000, p.STARTS)])
def test_equals_all_openings(spark, monkeypatch, fan, run_rows, starts):
    monkeypatch.setattr(p, "STARTS", starts)
    monkeypatch.setattr(p, "LAST_BLOCK", 3 if len(starts) < 4 else p.LAST_BLOCK)
    configure(spark)
    rebuilt = made(120, 9, "ab", 1) | {5000 + c: ts for c, ts in made(60, 4, "vwxyz", 2).items()}
    assert result(p.trie(*given(spark, rebuilt), fan=fan, run_rows=run_rows)) == brute(rebuilt)


def test_forests_of_runs_merge_to_the_forest_of_all():
    rebuilt = made(300, 8, "abc", 3)
    distinct = {tuple(ts): min(c for c in rebuilt if rebuilt[c] == ts) for ts in rebuilt.values()}
    order = sorted((["".join(hashlib.md5(t.encode()).hexdigest() for t, _ in ts), ts, c] for ts, c in distinct.items()))

    def parts(some):
        copies = lambda ts: sum(tuple(x) == ts for x in rebuilt.values())
        return [p.Part("", m, [w for _, w in ts], len(ts), copies(ts), c, end=c) for m, ts, c in some]

    def forest(items, open_ends):
        return p.Forest(items, [p.common(a, b) for a, b in zip(items, items[1:], strict=False)], 0, open_ends)

    whole = {tuple(sorted((k, v) for k, v in r.items() if k not in ("key", "parent_key") and v is not None)) for r in forest(parts(order), False).rows}
    for size in (1, 2, 7, 50):
        runs = [forest(parts(order[i : i + size]), True) for i in range(0, len(order), size)]
        rows = [r for run in runs for r in run.rows]
        bones = [b for run in runs for b in run.bones]
        lcps = []
        for run in runs:
            inner = [min(a.depth, b.depth) for a, b in zip(run.bones, run.bones[1:], strict=False)]
            lcps += [*([p.common(bones[len(lcps)], run.bones[0])] if lcps or run is not runs[0] else []), *inner]
        last = p.Forest(bones, lcps, 0, False)
        rows += last.rows
        keys = {r["key"]: r["conv_id"] for r in rows if r.get("key") is not None}
        for r in rows:
            if r.get("parent_key") is not None:
                r["parent_conv_id"] = keys[r["parent_key"]]
        merged = [tuple(sorted((k, v) for k, v in r.items() if k not in ("key", "parent_key") and v is not None)) for r in rows]
        assert len(merged) == len(set(merged)) and set(merged) == whole


def rebuilt_by_hand(rows):
    own: dict[int, list] = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), role, mark, len(text.split())))
    turns = {c: [(mark, words) for _, _, mark, words in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + ts[h:]
    return out


def test_rebuilt_conversations_with_odd_rows(spark):
    configure(spark)
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "b b", "c  d e"])) for c in range(0, 70) for t in range(r.randint(1, 5)) if c != 40]
    rows += [(20, None, None, None), (21, 0, "user", ""), (22, 1, None, "x " * 5000), (23, None, "user", "tie"), (23, None, "user", "tie")]
    rows += [(24, 2, "user", "tie a"), (24, 2, "user", "tie b"), (None, 0, "user", "nobody's"), (60, 9, "", None), (300, 0, "user", "alone")]
    full = [(*row, None, None, None) for row in rows]
    turns, ids = p.with_shared_heads(p.ordered_turns(spark.createDataFrame(full, SCHEMA)))
    want = rebuilt_by_hand(rows)
    got: dict[int, list] = {c[0]: [] for c in ids.collect()}
    for c, _, mark, words in sorted(tuple(x) for x in turns.select("conv_id", "pos", "mark", "words").collect()):
        got[c].append((mark, words))
    assert got == want and any(not ts for ts in want.values())
    strings = {c: [(mark, w) for mark, w in ts] for c, ts in want.items()}
    assert result(p.trie(turns, ids)) == brute(strings)


def test_no_conversations(spark):
    configure(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert p.trie(*p.with_shared_heads(p.ordered_turns(empty))).collect() == []
