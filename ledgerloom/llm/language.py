"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the character 1-, 2- and
3-grams that both hold, divided by the root of the product of the numbers that
each holds. Landmark texts span a Nyström approximation of it, in which kernel
ridge regression, one language against the rest, is fitted on a bounded sample of
labelled rows. Texts are scored in batches by matrix products.

Characters are folded to 64 classes: a to z, 37 classes for other letters by code
point, and one for all else. So a text's features fit a fixed table, whatever its
length, and the model has a fixed greatest size.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is
every text when nothing can be learned; equal scores go to the first language by
name; repeated rows get equal results; an empty table gives an empty one. Long
texts are read whole. Other columns pass through ``keep`` unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import remainder

UNKNOWN = "und"
CLASSES = 64
FEATURES = CLASSES + CLASSES**2 + CLASSES**3
SAMPLE_PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 16
RIDGE = 0.05
BATCH = 256

_LATIN = re.compile(r"[a-zA-Z]")


def _fold_table() -> np.ndarray:
    """Class of each code point below 0x2100: letters by kind, all else 0."""
    table = np.zeros(0x2100, dtype=np.int32)
    for point in range(len(table)):
        if chr(point).isalpha():
            table[point] = point - 96 if 97 <= point <= 122 else 27 + point % 37
    return table


FOLD = _fold_table()


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_LATIN.search(text)) or any(c.isalpha() for c in text))


def grams(text: str) -> np.ndarray:
    """Sorted numbers of the 1-, 2- and 3-grams that the folded text holds."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(points) == 0:
        return np.zeros(0, dtype=np.int64)
    top = points >= len(FOLD)
    c = FOLD[np.where(top, 0, points)]
    if top.any():
        c = np.where(top, 27 + points % 37, c).astype(np.int32)
    seen = np.zeros(FEATURES, dtype=bool)
    seen[c] = True
    if len(c) > 1:
        two = c[:-1] * CLASSES + c[1:]
        seen[two + CLASSES] = True
        if len(c) > 2:
            seen[two[:-1] * CLASSES + c[2:] + (CLASSES + CLASSES**2)] = True
    return np.flatnonzero(seen)


class Model(NamedTuple):
    """``columns`` maps a gram to its row in ``landmarks`` (grams x landmarks, presence over root of size)."""

    languages: list[str]
    columns: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray


def fit_grams(rows: list[tuple[str, np.ndarray]]) -> Model | None:
    """Fit on (language, grams) rows; the first of each language become landmarks."""
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    chosen = [
        g for language in languages for g in [x for n, x in rows if n == language][:LANDMARKS_PER_LANGUAGE]
    ]
    used = np.unique(np.concatenate(chosen))
    columns = np.full(FEATURES, -1, dtype=np.int32)
    columns[used] = np.arange(len(used))
    landmarks = np.zeros((len(used), len(chosen)), dtype=np.float32)
    for j, g in enumerate(chosen):
        landmarks[columns[g], j] = 1.0 / np.sqrt(len(g))
    nothing = Model(languages, columns, landmarks, np.zeros((len(chosen), len(languages))))
    between = kernel(nothing, chosen)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    values = np.maximum(values, 1e-6 * values.max())
    root = vectors / np.sqrt(values) @ vectors.T
    mapped = kernel(nothing, [g for _, g in rows]) @ root
    targets = np.array([[float(n == language) for language in languages] for n, _ in rows])
    gram = mapped.T @ mapped + RIDGE * np.eye(mapped.shape[1])
    return nothing._replace(weights=root @ np.linalg.solve(gram, mapped.T @ targets))


def kernel(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Kernel values between texts, given by their grams, and the landmarks."""
    out = np.zeros((len(texts), model.landmarks.shape[1]))
    for at in range(0, len(texts), BATCH):
        part = texts[at : at + BATCH]
        x = np.zeros((len(part), len(model.landmarks)), dtype=np.float32)
        for r, g in enumerate(part):
            at_columns = model.columns[g]
            x[r, at_columns[at_columns >= 0]] = 1.0
        size = np.sqrt([max(len(g), 1) for g in part])
        out[at : at + len(part)] = (x @ model.landmarks) / size[:, None]
    return out


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, scores
    rows = [i for i, t in enumerate(texts) if has_letter(t)]
    for at in range(0, len(rows), BATCH):
        part = rows[at : at + BATCH]
        values = kernel(model, [grams(texts[i]) for i in part]) @ model.weights
        for i, best, value in zip(part, values.argmax(axis=1), values.max(axis=1), strict=True):
            names[i], scores[i] = model.languages[best], min(max(float(value), 0.0), 1.0)
    return names, scores


def held_out(doc_id: str = "doc_id"):
    """True for rows never learned from; a row without an id is not learned from either."""
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(True))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Learn from ``per_language`` distinct texts of each language, or all if there are fewer.

    Texts are drawn by their own hash, so copies are drawn once, and the share drawn
    follows the number of distinct texts, so copies do not lower it. Only grams come to
    the driver, whose size does not depend on the length of a text.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    distinct = known.groupBy("lang", "h").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("n"))
    counts = {r["lang"]: r["n"] for r in distinct.collect()}
    if not counts:
        return None
    space = 1 << 31
    share = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, min(space, 4 * per_language * space // n))]
    )
    drawn = (
        known.where(F.pmod("h", F.lit(space)) < share[F.col("lang")])
        .withColumn("draw", F.pmod("h", F.lit(space)))
        .dropDuplicates(["lang", "h"])
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b["text"].map(has_letter).astype(bool)]
            yield pd.DataFrame({"lang": b["lang"], "draw": b["draw"], "h": b["h"], "grams": b["text"].map(grams)})

    rows = drawn.mapInPandas(features, "lang string, draw long, h long, grams array<int>").toPandas()
    taken = rows.sort_values(["lang", "draw", "h"]).groupby("lang").head(per_language)
    return fit_grams([(n, np.asarray(g, dtype=np.int64)) for n, g in zip(taken["lang"], taken["grams"], strict=True)])


def _predicted(model: Model | None):
    shared = model

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = predict(shared, texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predicted


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    found = docs.select("doc_id", held_out().alias("held_out"), _predicted(model)("text").alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def keep(docs: DataFrame, model: Model | None, min_score: float) -> DataFrame:
    """The rows whose language is told with at least this score, unchanged.

    When nothing could be learned no language can be told apart: all rows with a letter stay.
    """
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = _predicted(model)("text")
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= min_score))
