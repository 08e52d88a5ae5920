"""Near-duplicate documents by circulant MinHash.

A document's set holds 64-bit hashes of its distinct word shingles. Two fixed
permutations of the 32-bit numbers make the whole signature: the second, applied
to the first shifted by 0, 1, 2, ..., gives one coordinate per shift, the minimum
over the set. Four coordinates make a band; 32 bands find a pair at similarity 0.8
with probability 1 - 5e-8, a more similar one more surely.

Documents with equal sets are folded first. In each bucket of a band every member
is compared on full sets with the smallest one; that joins nearly all groups
without forming their pairs. What is left are buckets whose members still belong
to several components. There the signatures tell which members may have a link to
another component, and these are compared on full sets, within bounded blocks, so
that no link that would join two components is lost. Only links leave a task.

Edge cases: a null or empty text has an empty set and is linked with nothing; with
fewer words than a shingle takes, the whole sequence is one shingle; equal rows
and equal ids each give a row. A row without an id takes part, and its component
is named by the smallest id in it (null if there is none). Texts of any length are
read whole. Other columns are not read, and pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lower_words, written
from ledgerloom.llm.components import components

BANDS, ROWS = 32, 4
PERCENT = 80
# Signatures of a pair at 0.8 agree in fewer than 77 of 128 places with probability 1e-8.
AGREEING = 77
# Members of a bucket that are compared in one task; larger buckets are cut into blocks.
BLOCK = 2048
# Rows of 16 bytes up to which the side of a join is sent to every task.
BROADCAST_ROWS = 500_000
KNOWN_WORDS = 400_000

_U32 = np.uint32


def _scrambled(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> _U32(16)
    x *= _U32(first)
    x ^= x >> _U32(13)
    x *= _U32(second)
    x ^= x >> _U32(16)
    return x


class Shingler:
    """Word hashes are kept between texts, up to a bound."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted set of shingle hashes."""
        found = lower_words(text)
        if not found:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        known = self.known
        hashes = np.empty(len(found), dtype=np.uint64)
        for i, word in enumerate(found):
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word)
            hashes[i] = value
        size = min(self.words, len(found))
        n = len(found) - size + 1
        mixed = np.full(n, size, dtype=np.uint64)
        for k in range(size):
            mixed = (mixed ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 128 coordinates, cut to 16 bits."""
    count = BANDS * ROWS
    shifts = np.arange(count, dtype=_U32)
    placed = _scrambled((shingles >> np.uint64(32)).astype(_U32), 0x85EBCA6B, 0xC2B2AE35)
    best = np.full(count, 0xFFFFFFFF, dtype=_U32)
    for at in range(0, len(placed), 1024):
        moved = _scrambled(placed[at : at + 1024, None] + shifts, 0x7FEB352D, 0x846CA68B)
        np.minimum(best, moved.min(axis=0), out=best)
    return best.astype(np.uint16)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row: ``rid``, ``doc_id``, ``text_key``, size and fingerprint of its set, and the band keys.

    A band key is its four 16-bit coordinates, so the keys hold the whole signature.
    """

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler(t) for t in batch["text"]]
            marks = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "n_shingles": [len(s) for s in sets],
                    "mark": [f"{m:032x}" for m in marks],
                    "keys": [signature(s).view(np.int64) if len(s) else None for s in sets],
                }
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = "doc_id long, text_key long, n_shingles long, mark string, keys array<long>"
    made = rows.mapInPandas(sketch, schema).withColumn("rid", F.monotonically_increasing_id())
    return written(made, "sketches")


def row_key(text_key: Column) -> Column:
    """Tells rows apart by id and text."""
    return F.xxhash64(F.col("doc_id"), text_key)


def _small(side: DataFrame) -> DataFrame:
    """The side of a join, sent to every task if its counted rows are few."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def shingle_sets(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """``cid, shingles`` for the classes in ``wanted`` (``cid, row_key``)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            yield pd.DataFrame({"cid": batch["cid"], "shingles": [shingler(t).view(np.int64) for t in batch["text"]]})

    texts = docs.select(row_key(F.xxhash64("text")).alias("row_key"), "text").join(_small(wanted), "row_key")
    found = written(texts.select("cid", "text").mapInPandas(cut, "cid long, shingles array<long>"), "sets")
    if found.count() > wanted.count():  # rows that are equal in id and text
        found = written(found.dropDuplicates(["cid"]), "sets")
    return found


def _linked(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= PERCENT * (F.size(a) + F.size(b) - both)


def _grouped(batches: Iterator[pd.DataFrame], group: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of sorted rows, whole, across batches."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        keys = batch[group].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(batch)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.iloc[start:end]
            if rest and not (rest[-1][group].to_numpy()[-1] == part[group].to_numpy()[0]).all():
                yield pd.concat(rest) if len(rest) > 1 else rest[0]
                rest = []
            rest.append(part)
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]


GROUP = ["band", "key", "bi", "bj"]


def suspects(members: DataFrame) -> DataFrame:
    """Members with a likely link into another component, each pair looked at in its first common band.

    ``members``: the group columns, ``cid, label, block, n_shingles, keys``.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _grouped(batches, GROUP):
            label, block, size = (rows[c].to_numpy() for c in ("label", "block", "n_shingles"))
            keys = np.array(rows["keys"].tolist(), dtype=np.int64)
            short = keys.view(np.uint16)
            band, bi, bj = (int(rows[c].iat[0]) for c in ("band", "bi", "bj"))
            flagged = np.zeros(len(rows), dtype=bool)
            values, counts = np.unique(label, return_counts=True)
            few = np.flatnonzero(label != values[counts.argmax()])  # every pair between labels has one of these
            for i in few:
                other = label != label[i]
                other &= (np.minimum(size, size[i]) * 100 >= PERCENT * np.maximum(size, size[i]))
                if bi != bj:
                    other &= block != block[i]
                at = np.flatnonzero(other)
                if band and len(at):
                    at = at[~(keys[at, :band] == keys[i, :band]).any(axis=1)]
                if len(at):
                    at = at[(short[at] == short[i]).sum(axis=1) >= AGREEING]
                if len(at):
                    flagged[at] = flagged[i] = True
            if flagged.any():
                yield rows.loc[flagged, [*GROUP, "cid", "label"]]

    schema = "band int, key long, bi int, bj int, cid long, label long"
    return members.mapInPandas(look, schema)


def verified(members: DataFrame) -> DataFrame:
    """Links ``a, b`` between components among the suspects of each group, on full sets.

    ``members``: the group columns, ``cid, label, shingles``.
    """

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _grouped(batches, GROUP):
            cid, label = rows["cid"].to_numpy(), rows["label"].to_numpy()
            sets = rows["shingles"].tolist()
            size = np.array([len(s) for s in sets])
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            known, local = np.unique(np.concatenate(sets), return_inverse=True)
            mark = np.zeros(len(known), dtype=np.int32)
            values, counts = np.unique(label, return_counts=True)
            found = []
            for i in np.flatnonzero(label != values[counts.argmax()]):
                own = local[starts[i] : starts[i] + size[i]]
                mark[own] = 1
                both = np.add.reduceat(mark[local], starts)
                mark[own] = 0
                hit = (100 * both >= PERCENT * (size + size[i] - both)) & (label != label[i])
                # One link into each other component joins it.
                _, firsts = np.unique(label[hit], return_index=True)
                found += [(cid[i], b) for b in cid[hit][firsts]]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return members.mapInPandas(compare, "a long, b long")


def _blocked(rows: DataFrame) -> DataFrame:
    """Each row once per pair of blocks that its own block is in; one block unless the bucket is large."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}).drop("other")


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "cid")


def near_duplicates(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """The sketches, and ``rid, label`` with the smallest ``rid`` of each row's component (rows without a set left out)."""
    made = sketches(docs, words)
    filled = made.where("n_shingles > 0")
    classes = written(filled.groupBy("mark").agg(F.min("rid").alias("cid")), "classes")
    chosen = made.select(F.col("rid").alias("cid"), row_key(F.col("text_key")).alias("row_key"), "n_shingles", "keys")
    first = written(chosen.join(classes.select("cid"), "cid", "left_semi"), "firsts")

    bands = first.select("cid", F.posexplode("keys").alias("band", "key"))
    buckets = (
        bands.groupBy("band", "key")
        .agg(F.min("cid").alias("head"), F.max("cid").alias("tail"))
        .where("head < tail")
        .select("band", "key", "head")
    )
    members = written(bands.join(buckets, ["band", "key"]), "members")
    wanted = first.join(members.select("cid").distinct(), "cid", "left_semi").select("cid", "row_key")
    sets = shingle_sets(docs, words, written(wanted, "wanted"))

    pairs = members.where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")).distinct()
    compared = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b"
    )
    stars = written(compared.where(_linked(F.col("x"), F.col("y"))).select("a", "b"), "stars")
    labels = components(stars)

    known = members.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(
        "band", "key", "cid", F.coalesce("label", "cid").alias("label")
    )
    known = written(known, "known")
    open_buckets = (
        known.groupBy("band", "key")
        .agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("band", "key", "members")
    )
    left = known.join(open_buckets, ["band", "key"]).join(first.select("cid", "n_shingles", "keys"), "cid")
    suspected = written(suspects(_sorted(_blocked(left))), "suspects")
    links = written(verified(_sorted(suspected.join(sets, "cid"))), "links")
    if not links.isEmpty():
        labels = components(stars.unionByName(links))
    final = labels.withColumnRenamed("node", "cid")

    per_class = classes.join(final, "cid", "left").select("mark", F.coalesce("label", "cid").alias("label"))
    return made, filled.select("rid", "doc_id", "text_key", "mark").join(per_class, "mark").drop("mark")


def component_ids(docs: DataFrame, words: int = 2) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    made, placed = near_duplicates(docs, words)
    placed = written(placed.select("rid", "doc_id", "label"), "placed")
    names = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(names, "label").select("rid", "doc_id", "component_id")
    sized = made.select("rid", "doc_id", "n_shingles")
    out = sized.join(named.select("rid", "component_id"), "rid", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def keep_one(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows with one of each component, the one with the smallest id; rows without a set stay."""
    made, placed = near_duplicates(docs, words)
    placed = placed.select("label", "doc_id", "rid", row_key(F.col("text_key")).alias("row_key"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    best = placed.groupBy("label").agg(F.min(order).alias("best")).select(F.col("best.rid").alias("rid"))
    gone = placed.join(best, "rid", "left_anti").select("row_key", "rid")
    # Equal rows share a key: if one of them stays, its copies are told apart by a count.
    stays = placed.join(best, "rid", "left_semi").select("row_key").withColumn("stays", F.lit(True))
    gone = gone.join(stays.distinct(), "row_key", "left").select("row_key", F.coalesce("stays", F.lit(False)).alias("stays")).distinct()
    gone = written(gone, "gone")
    # The whole row travels in one column, so no name of its own can clash.
    whole = docs.select(row_key(F.xxhash64("text")).alias("row_key"), F.struct(*docs.columns).alias("row"))
    apart = whole.join(_small(gone), "row_key", "left")
    single = apart.where(F.col("stays").isNull())
    repeated = apart.where("stays").dropDuplicates(["row_key"])
    return single.unionByName(repeated).select("row.*")
