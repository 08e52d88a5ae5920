import random

from ledgerloom.llm import packing as p


def test_best_fit_keeps_its_promises():
    r = random.Random(2)
    for sizes in ((16,), (4, 16, 64), p.CAPACITIES):
        pieces = [r.randint(1, max(sizes)) for _ in range(400)]
        bins = p.best_fit(pieces, sizes)
        filled = [0] * len(bins.capacity)
        spans = {}
        for n, b, at in zip(pieces, bins.bin_of, bins.offset, strict=True):
            filled[b] += n
            spans.setdefault(b, []).append((at, at + n))
        assert filled == bins.used
        for b, places in spans.items():
            places.sort()
            assert places[0][0] == 0 and all(x[1] == y[0] for x, y in zip(places, places[1:], strict=False))
            fitting = [c for c in sizes if c >= filled[b]]
            assert bins.capacity[b] == min(fitting)  # downsized to its contents
        # No bin could have been spared by moving all it holds into another.
        if len(sizes) == 1:
            assert sum(f <= max(sizes) / 2 for f in filled) <= 1


def test_waste_is_small():
    r = random.Random(4)
    pieces = [min(4096, int(r.paretovariate(0.8) * 40)) for _ in range(3000)]
    bins = p.best_fit(pieces)
    assert sum(pieces) / sum(bins.capacity) > 0.95
    first_only = sum(min(c for c in p.CAPACITIES if c >= n) for n in pieces)
    assert sum(map(p.cost, bins.capacity)) < 1.1 * sum(map(p.cost, [4096])) * sum(pieces) / 4096 or sum(bins.capacity) < first_only


def test_filling_from_the_waiting_pieces():
    assert p._filled(10, [3, 4], {3: 1, 4: 2}) == 8
    assert p._filled(10, [3, 4], {3: 2, 4: 1}) == 10
    assert p._filled(2, [3, 4], {3: 2, 4: 1}) == 0


def test_rows(documents):
    long = " ".join(f"w{i}" for i in range(9000))
    rows = [(1, "a b  c "), (2, None), (3, " \n"), (4, long), (None, "x"), (1, "a b  c ")]
    found = p.pack(documents(rows), with_text=True).collect()
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    assert sorted(by, key=str) == [1, 4, None]
    assert [r["text"] for r in by[1]] == ["a b  c", "a b  c"] and len({(r["bin_id"], r["bin_offset"]) for r in by[1]}) == 2
    parts = sorted(by[4], key=lambda r: r["start"])
    assert [r["n_words"] for r in parts] == [4096, 4096, 808] and " ".join(r["text"] for r in parts) == long
    assert p.pack(documents([])).count() == 0


def test_whole_table(spark, sf):
    from ledgerloom.llm.common import table

    docs = table(spark, sf, "documents")
    found = p.pack(docs).toPandas()
    words = {r["doc_id"]: len(r["text"].encode().split()) for r in docs.collect()}
    assert found.groupby("doc_id").n_words.sum().to_dict() == {k: v for k, v in words.items() if v}
    bins = found.groupby("bin_id")
    assert (bins.n_words.sum() == bins.bin_words.first()).all() and (bins.bin_words.first() <= bins.capacity.first()).all()
