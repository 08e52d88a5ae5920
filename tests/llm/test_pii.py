import hashlib
import random
import re

from ledgerloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain(text):
    """The base spans by the patterns as they are stated."""
    digits = lambda t: re.sub("[^0-9]", "", t)
    out = [(m.start(), "email", m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), "card", m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return [(a, b, k) for a, k, b in sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1]), s[2]))]


def test_base_spans_against_the_stated_patterns():
    r = random.Random(3)
    for _ in range(5000):
        text = "".join(r.choice("ab.@ -+()12 3é") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(text) == plain(text), text
    for text, _ in pii.labelled_rows(11, 500):
        assert pii.base_spans(text) == plain(text), text


def test_viterbi_finds_the_best_labelling():
    import itertools

    import numpy as np

    random_ = np.random.default_rng(1)
    words = ["+1", "(234)", "555-1234"]
    index = {f: i for i, f in enumerate({f for t, w in enumerate(words) for f in pii.features(w, words[t - 1] if t else None, words[t + 1] if t < 2 else None)})}
    k = len(pii.LABELS)
    field = pii.Field(index, random_.normal(size=(len(index) + 1, k)), random_.normal(size=(k, k)), random_.normal(size=k))
    field.weights[-1] = 0
    emit = field.weights[pii._padded(index, [words], 3)].sum(axis=2)[0]

    def total(p):
        return field.first[p[0]] + sum(emit[t, p[t]] for t in range(3)) + sum(field.pairs[p[t], p[t + 1]] for t in range(2))

    best = max(itertools.product(range(k), repeat=3), key=total)
    assert tuple(pii.viterbi(field, [words])[0]) == best


def test_the_field_on_held_out_rows():
    field = pii.fit()
    rows = pii._sequences(pii.labelled_rows(99, 400))
    found = pii.viterbi(field, [w for w, _ in rows])
    assert sum(list(p) == y for p, (_, y) in zip(found, rows, strict=True)) >= 0.97 * len(rows)


def test_added_spans_and_decoys():
    field = pii.fit()
    texts = [
        "call (258) 555-9170 now",
        "host 38.253.197.126 4880761348116108 end",
        "version 1.2.3, 2024-01-02 and 12.5 of 999.1.1.1 or 4111 1111 1111 1112",
    ]
    _, every = pii.spans_of(field, texts)
    assert [pii._written(s) for s in every] == ["phone:5:19", "ip:5:19,card:20:36", ""]


def test_rows_masks_and_edges(documents):
    field = pii.fit()
    long = "x " * 60_000 + "a.b@c.org"
    rows = [(1, "mail a.b@c.org, 10.0.0.1"), (2, None), (3, ""), (3, ""), (4, long), (None, "+1 (988) 555-2485")]
    docs = documents(rows)
    found = {r["doc_id"]: r for r in pii.find(docs, field).collect()}
    assert found[1]["spans"] == "email:5:14,ip:16:24" and found[1]["n_email"] == 1
    assert found[1]["base_sha256"] == hashlib.sha256(b"email:5:14,ip:16:24").hexdigest()
    assert found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and found[2]["spans"] == ""
    assert found[4]["spans"] == "email:120000:120009" and found[None]["n_phone"] == 1
    clean = pii.mask(docs, field)
    assert clean.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in clean.collect() if r["doc_id"] in (1, 2, None)} == {
        1: "mail <email>, <ip>",
        2: None,
        None: "<phone>",
    }
    assert pii.find(documents([]), field).count() == 0


def test_fit_from_a_table(spark):
    field = pii.fit(pii.labelled_table(spark).limit(200))
    assert pii.spans_of(field, ["nothing here"]) == ([[]], [[]])
