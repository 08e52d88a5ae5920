"""Personal data by patterns and a linear-chain conditional random field.

Four patterns with checks give the base spans. The field reads the shapes of the
words that hold a digit or an ``@`` and of their neighbours, and finds what the
patterns miss: numbers written next to other numbers, phones without a plus sign.
A word with neither digit nor ``@`` is always outside, so the best labelling of a
whole text falls apart into runs of the other words, which Viterbi decodes in
batches. A found span must pass its kind's check and overlap no base span.

Edge cases: a null text counts as empty and has no spans; texts of any length are
read whole in linear time; repeated rows give repeated results; an empty table an
empty one. Columns other than ``doc_id`` and the text are passed on by ``mask``
and dropped by ``find``. Offsets count code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
MAX_LABELLED = 5000

Span = tuple[int, int, str]  # start, end, kind

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGNAL = re.compile(r"[0-9@]")
CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(parts: Iterable[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that pass its check, by start, then kind."""
    found: list[Span] = []
    if "@" in text:
        end = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                end = m.end()
                found.append((start, end, "email"))
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if _is_ip(m.groups())]
    found += [(m.start(), m.end(), "card") for m in CARD.finditer(text) if m.end() - m.start() > 11 and _is_card(m[0])]
    if "+" in text:
        found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if _is_phone(m[0])]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


# Where a kind's span lies within the words that the field has labelled.
INSIDE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+(?![0-9])"),
    "phone": re.compile(r"\+?\(?[0-9][\x20().0-9/-]*[0-9]"),
}


def _checked(kind: str, text: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return _is_ip(text.split("."))
    return _is_card(text) if kind == "card" else _is_phone(text)


# --- words, shapes, features ---------------------------------------------


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Neighbouring words that hold a digit or an ``@``, as places in the text."""
    found: list[list[tuple[int, int]]] = []
    end = -2
    for m in CANDIDATE.finditer(text):
        if found and not text[end : m.start()].strip(" "):
            found[-1].append(m.span())
        else:
            found.append([m.span()])
        end = m.end()
    return found


def shape(word: str) -> str:
    """The word with runs of letters as x and of digits as d, without closing punctuation."""
    return re.sub(r"[0-9]+", "d", re.sub(r"[^\W\d_]+", "x", word.rstrip(".,;:!?\"'")))


def _amount(word: str) -> str:
    n = len(_digits(word))
    return str(n) if n < 5 else "5-8" if n < 9 else "9-11" if n < 12 else "12-19" if n < 20 else "20+"


def features(word: str, before: str | None, after: str | None) -> list[str]:
    """Shape features of a word and of its neighbours in the run."""
    s, n = shape(word), _amount(word)
    b = f"{shape(before)}/{_amount(before)}" if before is not None else "-"
    a = f"{shape(after)}/{_amount(after)}" if after is not None else "-"
    return ["1", f"s={s}", f"n={n}", f"sn={s}/{n}", f"b={b}", f"a={a}", f"bs={b}|{s}/{n}", f"as={s}/{n}|{a}", f"f={word[:1] if not word[:1].isalnum() else 'w'}"]


class Field(NamedTuple):
    """A trained field: number of each feature, weights by feature and label, and of label pairs."""

    index: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray


def _padded(index: dict[str, int], sequences: Sequence[Sequence[str]], length: int) -> np.ndarray:
    """Feature numbers by sequence, place and feature; a last, empty feature fills up."""
    none = len(index)
    out = np.full((len(sequences), length, 9), none, dtype=np.int32)
    for r, words in enumerate(sequences):
        for t, word in enumerate(words):
            near = (words[t - 1] if t else None), (words[t + 1] if t + 1 < len(words) else None)
            out[r, t] = [index.get(f, none) for f in features(word, *near)]
    return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(sequences: Sequence[tuple[Sequence[str], Sequence[int]]], steps: int = 120, decay: float = 0.02) -> Field:
    """Maximum likelihood with a squared penalty, by Adam over the whole table."""
    index: dict[str, int] = {}
    for words, _ in sequences:
        for t, word in enumerate(words):
            for f in features(word, words[t - 1] if t else None, words[t + 1] if t + 1 < len(words) else None):
                index.setdefault(f, len(index))
    k, rows, longest = len(LABELS), len(sequences), max(len(w) for w, _ in sequences)
    x = _padded(index, [w for w, _ in sequences], longest)
    y = np.zeros((rows, longest), dtype=np.int64)
    real = np.zeros((rows, longest), dtype=bool)
    for r, (_, labels) in enumerate(sequences):
        y[r, : len(labels)], real[r, : len(labels)] = labels, True
    theta = [np.zeros((len(index) + 1, k)), np.zeros((k, k)), np.zeros(k)]
    gold = [np.zeros_like(p) for p in theta]
    places = (x[real][:, :, None].astype(np.int64) * k + np.arange(k)).ravel()
    truth = np.eye(k)[y[real]][:, None, :].repeat(9, axis=1)
    gold[0] = np.bincount(places, truth.ravel(), theta[0].size).reshape(theta[0].shape)
    np.add.at(gold[1], (y[:, :-1][real[:, 1:]], y[:, 1:][real[:, 1:]]), 1.0)
    np.add.at(gold[2], y[:, 0], 1.0)
    m, v = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
    for step in range(1, steps + 1):
        w, pairs, first = theta
        emit = w[x].sum(axis=2)
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0] + first
        for t in range(1, longest):
            new = _logsumexp(alpha[:, t - 1, :, None] + pairs, axis=1) + emit[:, t]
            alpha[:, t] = np.where(real[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _logsumexp(pairs + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], new, beta[:, t + 1])
        z = _logsumexp(alpha[:, -1], axis=1)
        single = np.exp(alpha + beta - z[:, None, None]) * real[:, :, None]
        grads = [np.bincount(places, single[real][:, None, :].repeat(9, axis=1).ravel(), theta[0].size)]
        grads = [grads[0].reshape(theta[0].shape), np.zeros_like(pairs), single[:, 0].sum(axis=0)]
        for t in range(1, longest):
            joint = alpha[:, t - 1, :, None] + pairs + (emit[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            grads[1] += np.exp(joint[real[:, t]]).sum(axis=0)
        for i, p in enumerate(theta):
            g = (gold[i] - grads[i]) / rows - decay / 10 * p
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            p += 0.1 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
        theta[0][-1] = 0.0
    return Field(index, theta[0], theta[1], theta[2])


def viterbi(field: Field, sequences: Sequence[Sequence[str]]) -> list[np.ndarray]:
    """Best labels of each word sequence; sequences of like length are decoded together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(sequences)
    order = sorted(range(len(sequences)), key=lambda r: len(sequences[r]))
    at = 0
    while at < len(order):
        longest = max(8, 2 * len(sequences[order[at]]))
        group = []
        while at < len(order) and len(sequences[order[at]]) <= longest and len(group) * longest < 100_000:
            group.append(order[at])
            at += 1
        lengths = np.array([len(sequences[r]) for r in group])
        longest = int(lengths.max())
        emit = field.weights[_padded(field.index, [sequences[r] for r in group], longest)].sum(axis=2)
        best, back = emit[:, 0] + field.first, np.zeros((len(group), longest, len(LABELS)), dtype=np.int8)
        back[:, 0] = np.arange(len(LABELS))
        for t in range(1, longest):
            scores = best[:, :, None] + field.pairs
            live = (t < lengths)[:, None]
            back[:, t] = np.where(live, scores.argmax(axis=1), np.arange(len(LABELS)))
            best = np.where(live, scores.max(axis=1) + emit[:, t], best)
        path = np.zeros((len(group), longest), dtype=np.int64)
        path[:, -1] = best.argmax(axis=1)
        rows = np.arange(len(group))
        for t in range(longest - 1, 0, -1):
            path[:, t - 1] = back[rows, t, path[:, t]]
        for r, labels, n in zip(group, path, lengths, strict=True):
            out[r] = labels[:n]
    return out


# --- the labelled table ----------------------------------------------------


def labelled_rows(seed: int = 7, rows: int = 1500) -> list[tuple[str, list[Span]]]:
    """Short texts with their spans, made by rule: each kind in its notations, and numbers that are none."""
    r = random.Random(seed)

    def number(n: int) -> str:
        return "".join(r.choice("0123456789") for _ in range(n))

    def word() -> str:
        return "".join(r.choice("abcdefghilmnoprstuvw") for _ in range(r.randint(2, 9)))

    def card() -> str:
        body = r.choice("3456") + number(r.choice((14, 14, 14, 13, 12)))
        last = next(d for d in "0123456789" if _luhn(body + d))
        digits = body + last
        if len(digits) == 16 and r.random() < 0.4:
            return r.choice(" -").join(digits[i : i + 4] for i in range(0, 16, 4))
        return digits

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return r.choice((f"+{r.randint(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}) {b} {c}", f"+{r.randint(1, 99)} {a} {b} {c}", f"+{number(2)} {number(2)} {number(4)} {number(3)}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{number(11)}", f"00{number(2)} {a} {number(7)}"))

    def ip() -> str:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))

    def email() -> str:
        return f"{word()}{r.choice(('', '.' + word(), '.' + number(2), '_' + word(), '+' + word(), number(3)))}@{word()}{r.choice(('', number(1)))}.{r.choice(('com', 'org', 'net', 'example.com', 'co.uk'))}"

    def other() -> str:
        return r.choice((number(4), number(2), number(1) + ".", f"{number(1)}.{number(1)}.", f"{number(1)}.{number(1)}", f"{number(1)}.{number(2)}.{number(1)}", f"20{number(2)}-{number(2)}-{number(2)}", f"{number(2)}/{number(2)}/20{number(2)}", f"{number(2)}:{number(2)}", f"{number(2)}:{number(2)}:{number(2)}", f"{number(3)},{number(3)}", f"{number(2)}.{number(2)}", f"{number(2)}%", f"{number(2)}-{number(2)}", number(6), number(8), number(9), number(10), number(11), f"{word()}{number(2)}", f"{word()}={word()}{number(8)}{word()}{number(3)}", f"{word().upper()}{number(1)}{word().upper()}", f"@{word()}", f"{word()}@{word()}", f"#{number(3)}", f"({number(4)})", f"{number(3)}-{number(4)}", f"{number(2)} {number(2)} {number(2)}", f"{number(3)} {number(3)}", f"{number(3)}.{number(3)}.{number(3)}.{number(3)}.{number(3)}"))

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(rows):
        text, spans = "", []
        for _ in range(r.randint(1, 4)):
            if r.random() < 0.5:
                text += word() + " "
            kind = r.choice((*KINDS, *KINDS, "-", "-", "-"))
            value = other() if kind == "-" else makers[kind]()
            if kind != "-":
                spans.append((len(text), len(text) + len(value), kind))
            text += value + r.choice((" ", " ", " ", ". ", ", ", f" {word()} "))
        out.append((text, spans))
    return out


def _sequences(rows: Iterable[tuple[str, list[Span]]]) -> list[tuple[list[str], list[int]]]:
    """Runs of words with the label that the spans give each word."""
    out = []
    for text, spans in rows:
        for run in runs(text):
            labels, used = [], set()
            for start, end in run:
                hit = next((s for s in spans if s[0] < end and start < s[1]), None)
                labels.append(LABELS.index(f"{'I' if hit in used else 'B'}-{hit[2]}") if hit else 0)
                used.add(hit)
            out.append(([text[a:b] for a, b in run], labels))
    return out


def fit(labelled: DataFrame | None = None) -> Field:
    """Train on a labelled table ``text, spans array<struct<start, end, kind>>``.

    The first ``MAX_LABELLED`` rows by text are used; without a table, the rows
    that ``labelled_rows`` makes.
    """
    if labelled is None:
        return train(_sequences(labelled_rows()))
    rows = labelled.where("text is not null").orderBy("text").limit(MAX_LABELLED).collect()
    table = [(r["text"], [(s["start"], s["end"], s["kind"]) for s in r["spans"] or ()]) for r in rows]
    return train(_sequences(table) or [(["0"], [0])])


# --- applying it ------------------------------------------------------------


def added_spans(field: Field, texts: Sequence[str], base: Sequence[list[Span]]) -> list[list[Span]]:
    """Per text, the checked spans of the field that overlap no base span."""
    places = [(i, run) for i, text in enumerate(texts) if SIGNAL.search(text) for run in runs(text)]
    labels = viterbi(field, [[texts[i][a:b] for a, b in run] for i, run in places])
    out: list[list[Span]] = [[] for _ in texts]
    taken = [sorted(b) for b in base]
    for (i, run), path in zip(places, labels, strict=True):
        t = 0
        while t < len(run):
            label = LABELS[path[t]]
            if not label.startswith("B-"):
                t += 1
                continue
            kind, end = label[2:], t + 1
            while end < len(run) and LABELS[path[end]] == f"I-{kind}":
                end += 1
            start = run[t][0]
            for found in INSIDE[kind].finditer(texts[i][start : run[end - 1][1]]):
                span = (start + found.start(), start + found.end(), kind)
                if _checked(kind, found[0]) and not any(s[0] < span[1] and span[0] < s[1] for s in taken[i]):
                    out[i].append(span)
            t = end
    return out


def spans_of(field: Field, texts: Sequence[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans of each text, in order."""
    base = [base_spans(t) if SIGNAL.search(t) else [] for t in texts]
    added = added_spans(field, texts, base)
    return base, [sorted(b + a, key=_order) if a else b for b, a in zip(base, added, strict=True)]


def _written(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``doc_id`` with counts and digest of the base spans, all spans, and how many the field added."""

    @F.pandas_udf(
        "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    )
    def found(texts: pd.Series) -> pd.DataFrame:
        base, every = spans_of(field, texts.fillna("").tolist())
        out = {f"n_{k}": [sum(s[2] == k for s in b) for b in base] for k in KINDS}
        out["base_sha256"] = [hashlib.sha256(_written(b).encode()).hexdigest() for b in base]
        out["spans"] = [_written(s) for s in every]
        out["n_added"] = [len(s) - len(b) for b, s in zip(base, every, strict=True)]
        return pd.DataFrame(out)

    return docs.select("doc_id", found(F.col(text)).alias("found")).select("doc_id", "found.*")


def masked(text: str, spans: Iterable[Span]) -> str:
    """The text with each span replaced by its kind; what overlaps becomes one mask."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join((*parts, text[at:]))


def mask(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The same columns with personal data in the text masked; null stays null."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        values = texts.fillna("").tolist()
        _, every = spans_of(field, values)
        clean = [masked(t, s) if s else t for t, s in zip(values, every, strict=True)]
        return pd.Series(clean, dtype=object).where(texts.notna().to_numpy(), None)

    return docs.withColumn(text, cleaned(F.col(text)))


def labelled_table(spark: SparkSession) -> DataFrame:
    """The rows that ``fit`` uses by default, as a table."""
    return spark.createDataFrame(
        [(t, [(a, b, k) for a, b, k in s]) for t, s in labelled_rows()],
        "text string, spans array<struct<start: int, end: int, kind: string>>",
    )
