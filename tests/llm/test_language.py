import zlib

import numpy as np

from ledgerloom.llm import language as la
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import QUERIES


def test_grams_and_kernel_against_sets():
    texts = ["Abc abc", "xyé ß", "a", "abca bc日本", "12 !"]

    def fold(text):
        return [ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 37 if c.isalpha() else 0 for c in text.lower()]

    def sets(text):
        c = fold(text)
        return {tuple(c[i : i + n]) for n in (1, 2, 3) for i in range(len(c) - n + 1)}

    rows = [("x" if i % 2 else "y", la.grams(t)) for i, t in enumerate(texts)]
    for text, (_, g) in zip(texts, rows, strict=True):
        assert len(g) == len(sets(text))
    model = la.fit_grams(rows)
    marks = [texts[i] for i in (1, 3, 0, 2, 4)]  # by language, then in order
    exact = [[len(sets(a) & sets(b)) / (len(sets(a)) * len(sets(b))) ** 0.5 for b in marks] for a in texts]
    assert np.allclose(la.kernel(model, [g for _, g in rows]), exact, atol=1e-6)


def test_held_out_accuracy(spark, sf):
    rows = QUERIES["op4_language_id"](spark, sf).collect()
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(documents):
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(12)] + [(20 + i, f"der hund und die katze {i}", "de") for i in range(12)]
    odd = [(100, None, "en"), (101, "", None), (102, "12 ... ²", "de"), (103, "the " * 50_000, None), (104, "der", None), (104, "der", None), (None, "the dog", "fr")]
    docs = documents(rows + odd)
    model = la.fit(docs)
    assert model.languages == ["de", "en"]  # a row without an id is not learned from
    found = {r["doc_id"]: r for r in la.identify(docs, model).collect()}
    assert [found[i]["lang_pred"] for i in (100, 101, 102, 103, 104)] == ["und", "und", "und", "en", "de"]
    assert found[None]["held_out"] and found[None]["lang_pred"] == "en" and found[100]["score"] == 0.0
    kept = la.keep(docs, model, 0.2)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()}.isdisjoint({100, 101, 102})


def test_copies_do_not_lower_the_number_of_texts_drawn(documents, monkeypatch):
    taken = []
    monkeypatch.setattr(la, "fit_grams", lambda rows: taken.extend(n for n, _ in rows))
    hot = [(i, "the same text again", "en") for i in range(4000)]
    many = [(10_000 + i, f"the dog and the cat number {i}", "en") for i in range(40)]
    more = [(20_000 + i, f"der hund und die katze {i}", "de") for i in range(400)]
    marks = [(30_000 + i, f"{i} ...", "fr") for i in range(400)] + [(40_000 + i, f"le chien {i}", "fr") for i in range(12)]
    rows = hot + many + more + marks
    la.fit(documents(rows), per_language=20)

    def texts(lang):
        return {t for i, t, n in rows if n == lang and zlib.crc32(str(i).encode()) % 4 != 2 and la.has_letter(t)}

    assert {n: taken.count(n) for n in ("en", "de", "fr")} == {n: min(20, len(texts(n))) for n in ("en", "de", "fr")}


def test_nothing_to_learn_from(documents):
    docs = documents([(1, "some words", None)])
    assert [(r["lang_pred"], r["score"]) for r in la.identify(docs, la.fit(docs)).collect()] == [("und", 0.0)]
    empty = documents([])
    assert la.identify(empty, la.fit(empty)).count() == 0


def test_ties_go_to_the_first_language():
    model = la.fit_grams([("b", la.grams("same text")), ("a", la.grams("same text"))])
    assert la.predict(model, ["same text"])[0] == ["a"]


def test_without_labels_texts_with_letters_stay(documents):
    docs = documents([(1, "some words", None), (1, "some words", None), (2, "é", None), (3, "12 ... ²", None), (4, None, None), (5, "", None)])
    assert la.fit(docs) is None
    kept = la.keep(docs, None, 0.2)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 2]
