import cProfile
import collections
import itertools
import os
import pstats

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import segmentation as sg
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def words():
    return sg.vocabulary(MODEL)


def paths(lattices, text):
    """All segmentations of a text with their probabilities, by listing them."""

    def of(node, pieces, log):
        if node < 0:
            yield pieces, log
            return
        first = lattices.first.data[node]
        for arc in range(first, first + lattices.count.data[node]):
            yield from of(lattices.to.data[arc], (*pieces, int(lattices.piece.data[arc])), log + lattices.log.data[arc])

    cut = sg.units(text, lattices.words.unit)
    every = itertools.product(*[list(of(root, (), 0.0)) for root in lattices.roots(cut)])
    return {sum((p for p, _ in way), ()): np.exp(sum(x for _, x in way)) for way in every}


def by_hand(words, text, alpha):
    """The same from the vocabulary's pieces alone."""
    pieces = {}
    for i, w in zip(words.ids, words.weights, strict=True):
        pieces[words.letters[words.ends[i - 1] : words.ends[i]].tobytes().decode()] = (int(i), w)

    def of(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, min(16, len(rest)) + 1):
            if rest[:n] in pieces:
                i, w = pieces[rest[:n]]
                for more, x in of(rest[n:]):
                    yield (i, *more), alpha * w + x

    every = dict(of(" " + text))
    total = sum(np.exp(x) for x in every.values())
    return {k: np.exp(x) / total for k, x in every.items()}


@pytest.mark.parametrize(("text", "alpha"), [("the on", 1.0), ("abc, d", 0.3), ("  hi", 0.5), ("them.", 0.1)])
def test_lattice_holds_all_segmentations(words, text, alpha):
    found, want = paths(sg.Lattices(words, alpha), text), by_hand(words, text, alpha)
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], rel=1e-5) for k in want)


def test_samples_without_replacement_follow_the_distribution(words):
    lattices = sg.Lattices(words, 0.25)
    p = paths(lattices, "abc d")
    n = 6000
    keys = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    found = [s for at in range(0, n, 500) for s in sg.sample(lattices, ["abc d"] * 500, keys[at : at + 500], 3)]
    pairs = collections.Counter((tuple(s[0].pieces), tuple(s[1].pieces)) for s in found)
    likely = sorted(p, key=p.get, reverse=True)[:4]
    for a, b in itertools.permutations(likely, 2):
        want = p[a] * p[b] / (1 - p[a])
        assert abs(pairs[a, b] / n - want) < 5 * (want / n) ** 0.5 + 1e-3
    for s in found:
        assert len({tuple(x.pieces) for x in s}) == 3
        assert s[0].value > s[1].value > s[2].value
        assert all(x.log_prob == pytest.approx(np.log(p[tuple(x.pieces)]), abs=1e-5) for x in s)
    # Inclusion scores make sums over the samples unbiased.
    weighted = [sum(np.exp(x.log_prob) / x.inclusion for x in s) for s in found]
    assert np.mean(weighted) == pytest.approx(1.0, abs=5 * np.std(weighted) / n**0.5 + 1e-3)


def test_all_segmentations_come_out_in_the_end(words):
    lattices = sg.Lattices(words, 0.5)
    p = paths(lattices, "ab c")
    (found,) = sg.sample(lattices, ["ab c"], np.array([9], dtype=np.uint64), len(p) + 5)
    assert {tuple(s.pieces) for s in found} == p.keys() and found[-1].inclusion == 1.0


@pytest.mark.parametrize("alpha", [1.0, 3.0, 5.0, 40.0])
@pytest.mark.parametrize("text", ["the", "hello", "the on", "é日 a"])
def test_all_segmentations_come_out_at_any_sharpness(words, text, alpha):
    # The lattice of a flat model lists the paths, however unlikely a sharp one makes them.
    p = paths(sg.Lattices(words, 0.01), text)
    (found,) = sg.sample(sg.Lattices(words, alpha), [text], np.array([9], dtype=np.uint64), len(p) + 5)
    assert {tuple(s.pieces) for s in found} == p.keys() and len(found) == len(p)
    assert found[-1].inclusion == 1.0 and all(np.isfinite(s.log_prob) for s in found)


def test_decisions_beyond_the_listed_ones(words, monkeypatch):
    lattices = sg.Lattices(words, 0.5)
    p = paths(lattices, "ab c")
    for reach in (1, 2):
        monkeypatch.setattr(sg, "REACH", reach)
        keys = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        found = sg.sample(lattices, ["ab c"] * 400, keys, len(p) + 5)
        assert all({tuple(s.pieces) for s in samples} == p.keys() for samples in found)
        second = collections.Counter(tuple(samples[1].pieces) for samples in found)
        for way in sorted(p, key=p.get, reverse=True)[:3]:
            want = sum(p[a] * p[way] / (1 - p[a]) for a in p if a != way)
            assert abs(second[way] / 400 - want) < 5 * (want / 400) ** 0.5 + 1e-2


def test_scores_weigh_a_unigram_model_and_ranks_any_other():
    ids = np.array([3, 4, 9])
    assert sg.log_weights(ids, np.array([-0.5, -2.25, -3.0])).tolist() == [-0.5, -2.25, -3.0]
    assert sg.log_weights(ids, np.array([0.0, -1.0, -6.0])).tolist() == pytest.approx((-np.log([4, 5, 10])).tolist())


def test_slices_hold_every_text_once():
    texts = ["a" * 400_000] * 4 + ["b" * 3_000_000, ""] + ["c"] * 600
    cut = list(sg._slices(texts))
    assert [i for s in cut for i in range(s.start, s.stop)] == list(range(len(texts)))
    assert all(s.stop - s.start <= sg.SLICE_ROWS for s in cut) and list(sg._slices([])) == []
    assert all(sum(map(len, texts[s])) <= sg.SLICE_CHARS or s.stop - s.start == 1 for s in cut)


TEXTS = ["", "a", "Hello  world\nfoo\tbar  ", " lead", "▁x y▁▁", "é日本😀 ﷐", "\n\n", "ab" * 3000, "x1234.5,6", "nul\x00\x0b", "A" * 50 + "日" * 30]


def test_round_trip(words):
    lattices = sg.Lattices(words, 1.0)
    for text, samples in zip(TEXTS, sg.sample(lattices, TEXTS, np.arange(len(TEXTS), dtype=np.uint64), 3), strict=True):
        assert samples and all(sg.decode(words, sg.piece_ids(words, s.pieces)) == text for s in samples)
        assert len({tuple(s.pieces) for s in samples}) == len(samples)


def test_the_library_decodes_our_pieces(words):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lattices = sg.Lattices(words, 1.0)
    texts = ["Hello world, this is text.", "é日本 x", "two  blanks"]
    for text, samples in zip(texts, sg.sample(lattices, texts, np.arange(3, dtype=np.uint64), 2), strict=True):
        assert all(model.decode(sg.piece_ids(words, s.pieces).tolist()) == text for s in samples)


def test_rows(documents):
    rows = [(1, "some text"), (2, None), (3, ""), (None, "a"), (1, "some text"), (4, "long word " * 5000), *((10 + i, t) for i, t in enumerate(TEXTS))]
    found = sg.segment(documents(rows), MODEL, k=3).collect()
    assert all(r["round_trip"] for r in found)
    by = collections.Counter(r["doc_id"] for r in found)
    assert by[1] == 6 and by[2] == 1 and by[3] == 1 and by[None] == 2 and by[4] == 3
    equal = [tuple(r["ids"]) for r in found if r["doc_id"] == 1]
    assert len(set(equal)) == 3 and collections.Counter(equal).most_common()[-1][1] == 2
    # The same samples whatever else is in the batch, others for another seed.
    alone = {(r["sample"], tuple(r["ids"])) for r in sg.segment(documents(rows[:1]), MODEL, k=3).collect()}
    assert alone == {(r["sample"], tuple(r["ids"])) for r in found if r["doc_id"] == 1}
    other = {(r["sample"], r["value"]) for r in sg.segment(documents(rows[:1]), MODEL, k=3, seed=1).collect()}
    assert other.isdisjoint({(r["sample"], r["value"]) for r in found})
    assert sg.segment(documents([]), MODEL).count() == 0


def test_the_query_returns_the_pieces_of_four_samples(spark, sf, words):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").limit(40).collect()}
    found = collections.defaultdict(list)
    for r in QUERIES["op3_sampled_segmentations"](spark, sf).where(F.col("doc_id").isin(list(texts))).collect():
        found[r["doc_id"]].append(tuple(r["ids"]))
    assert found.keys() == texts.keys()
    for i, samples in found.items():
        assert len(samples) == len(set(samples)) == 4 or len(texts[i]) < 5
        assert all(sg.decode(words, np.array(ids, dtype=np.int64)) == texts[i] for ids in samples)


def test_known_units_are_forgotten_beyond_a_bound(words, monkeypatch):
    monkeypatch.setattr(sg, "MOST_ARCS", 50)
    lattices = sg.Lattices(words, 1.0)
    for i in range(5):
        texts = [f"word{chr(97 + i)} and more text"] * 2
        for samples in sg.sample(lattices, texts, np.arange(2, dtype=np.uint64), 2):
            assert all(sg.decode(words, sg.piece_ids(words, s.pieces)) == texts[0] for s in samples)
    assert os.path.exists(MODEL)


def test_sampling_texts_together_shares_their_calls(words):
    lattices, n = sg.Lattices(words, 1.0), 100
    texts = ["some words of a text that is cut in many ways " * 12] * n
    keys = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sg.sample(lattices, texts, keys, 4)
    profile = cProfile.Profile()
    profile.runcall(sg.sample, lattices, texts, keys, 4)
    assert pstats.Stats(profile).total_calls < 470 * n


def test_lattices_do_not_depend_on_what_is_worked_out_together(words, monkeypatch):
    texts = [*TEXTS, "units of several lengths, met together or alone"]
    keys = np.arange(len(texts), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    told = lambda: [[(s.pieces.tolist(), s.log_prob, s.value) for s in x] for x in sg.sample(sg.Lattices(words, 0.7), texts, keys, 3)]
    whole = told()
    for most in (1, 20):
        monkeypatch.setattr(sg, "BUILT_CHARS", most)
        assert told() == whole


def test_pieces_are_found_by_their_hashes(words):
    there, place = words.find(np.concatenate([words.hashes, words.hashes + np.uint64(1)]))
    assert there[: len(words.hashes)].tolist() == list(range(len(words.hashes))) and (place[: len(words.hashes)] == there[: len(words.hashes)]).all()
    assert (words.likely(words.hashes) & 1).all()
    pieces = [words.letters[words.ends[i - 1] : words.ends[i]].tobytes().decode().replace(" ", sg.BLANK) for i in words.ids]
    starts = {p[:i] for p in pieces for i in range(1, len(p))}
    assert (words.likely(np.array([sg._hash(x) for x in starts], dtype=np.uint64)) & 2).all()
