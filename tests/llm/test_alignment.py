from __future__ import annotations

import hashlib
import json
from collections import Counter

import pytest

from ledgerloom.llm import alignment as al
from ledgerloom.llm.common import configure

P = pytest.importorskip("public_tokenizers")
A_FILE, B_FILE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, rid string, ids string, codes string, n_a string"
ODD = ["", None, "a", " ", "  ", "\n\n x", "<|endoftext|> <s> </s> <unk>", "▁x y", "Zażółć gęślą 日本語 🙂🙂", "aaaa aaa aaaaaaaa", "\u0000x", "é ﬁ", "tab\tq  ", "<0x41> x", "don't DON'T 123 4567"]


@pytest.fixture(scope="module")
def both():
    return al.load(A_FILE, B_FILE)


def tokens(text):
    """(id, from, to) of both sides by the public libraries, or nothing."""
    import sentencepiece
    import tokenizers

    if not hasattr(tokens, "cached"):
        a = tokenizers.Tokenizer.from_file(A_FILE)
        a.encode_special_tokens = True
        with open(A_FILE, encoding="utf-8") as file:
            names = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
        tokens.cached = a, sentencepiece.SentencePieceProcessor(model_file=B_FILE), names, al.byte_alphabet()
    a, b, names, alphabet = tokens.cached
    raw = (" " + (text or "")).encode()
    sides = []
    for ids, bytes_of in (
        (a.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: bytes(alphabet[c] for c in names[i])),
        (b.encode(text or ""), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        side, at = [], 0
        for i in ids:
            side.append((i, at, at + len(bytes_of(i))))
            at = side[-1][2]
        if not text or b"".join(bytes_of(i) for i in ids) != raw:
            return [], []
        sides.append(side)
    return sides


def brute(rows):
    links, texts = {}, {}
    for n, text in enumerate(rows):
        a, b = tokens(text)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [
            "|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in (a, b)) for lo, hi in zip([0, *cuts], cuts, strict=False)
        ]
        links[n] = [(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e]
        texts[n] = len(a), len(b), len(cuts), len(links[n]), ";".join(groups)
    counts = Counter(x for found in links.values() for x in found)
    best: Counter = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (*texts[n][:4], sum(counts[x] == best[x[1]] for x in links[n]), sum(counts[x] for x in links[n]), texts[n][4]) for n in range(len(rows))
    ]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None, None) for i, t in enumerate(texts)], SCHEMA)


def test_equals_links_by_hand(spark, both, sf):
    configure(spark)
    real = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 40").select("text").collect()]
    texts = [*ODD, *ODD, *[(t or "")[:1500] for t in real], "x" * 20_000]
    want = {i: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for i, w in enumerate(brute(texts))}
    for shipped in (al.MOST_SHIPPED, 30):  # the rest of the pairs goes through a join
        got = {r[0]: tuple(r)[1:] for r in al.score(documents(spark, texts), both, shipped).collect()}
        assert got == want


def test_groups_are_handed_out(spark, both, monkeypatch):
    configure(spark)
    texts = ["", None, "aaaa aaa don't", "Zażółć 日本語"]
    monkeypatch.setattr(al, "PIECE_BYTES", 1)
    rows = al.align(documents(spark, texts), both, with_groups=True).select("doc_id", "groups").collect()
    assert {r[0]: r[1] for r in rows} == {i: w[6] for i, w in enumerate(brute(texts))}


def test_mates_have_the_same_bytes(both):
    met = [(a, b) for a, b in enumerate(both.mate) if b >= 0]
    assert len(met) > 5000 and all(both.a_bytes[a] == both.b_bytes[b] for a, b in met)


def test_no_documents(spark, both):
    configure(spark)
    assert al.score(documents(spark, []), both).collect() == []
