"""Alignment of two tokenizers over a corpus, with a fast path for tokens that are the same in both.

Tokenizer A is a byte-level BPE (a JSON file), B a SentencePiece model. Both cut the same bytes: A reads a
space and the text, B the text, to which it adds the space itself. Where tokens of both end at the same byte, groups
are cut; an A and a B token are linked where their bytes overlap. A link lies between two neighbouring
token ends of either side, so the links of a text are its distinct token ends and the groups its common ones.

Which B id has the bytes of an A id is worked out once, as an array over A's ids. Links between such mates, which
all regular one-to-one groups are, are counted in vectors of the length of A's vocabulary. Only links of irregular
groups enter a shuffle of id pairs, counted per task before. For the columns that need the corpus-wide count of each
pair, the vector and the ``MOST_SHIPPED`` most frequent other pairs go to the tasks, a fixed size whatever the corpus; all
rarer pairs are joined by shuffle, which no frequent pair can skew.

Bounds: a task works on pieces of ``PIECE_BYTES`` of text, or one longer text; the driver sees one count per
A id, the shipped pairs, and a histogram of counts.

Edge cases: texts null, empty, or that a tokenizer does not give back byte by byte (a text with U+2581, or one that B's
normalizer changes) have no tokens: zeros and an empty hash. Special tokens' strings are plain text. Equal rows
count one by one; an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

# Fixed value: how the byte-level BPE parts a text before its merges (the pattern of its public files).
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_BYTES = 1 << 21
# Frequent irregular pairs that go to every task: 24 bytes each.
MOST_SHIPPED = 1 << 17
# Distinct pairs that a task holds before it hands on their counts.
MOST_HELD = 1 << 20
STEPS = 8  # per doubling, in the histogram of counts

TEXT_COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
PAIR_COLUMNS = "ids array<int>, id_times array<int>, codes array<long>, code_times array<int>"


def byte_alphabet() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable ones are themselves, the others follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizers:
    """Both vocabularies as bytes by id, what is needed to encode, and the B id with the bytes of each A id, or -1."""

    ranks: dict[bytes, int]
    model: bytes
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    mate: np.ndarray

    def encoders(self):
        import sentencepiece
        import tiktoken

        a = tiktoken.Encoding("a", pat_str=PARTS, mergeable_ranks=self.ranks, special_tokens={})
        return a.encode_ordinary, sentencepiece.SentencePieceProcessor(model_proto=self.model).encode


def load(a_file: str, b_file: str) -> Tokenizers:
    """Read both files on the driver; tasks get them with their code."""
    import sentencepiece

    with open(a_file, encoding="utf-8") as file:
        a = json.load(file)
    vocabulary, merges = a["model"]["vocab"], a["model"]["merges"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    if a["normalizer"] or a["pre_tokenizer"]["type"] != "ByteLevel" or any(x >= y for x, y in itertools.pairwise(made)):
        raise ValueError(f"{a_file}: not a byte-level BPE whose ids follow its merges")
    alphabet = byte_alphabet()
    special = {t["content"] for t in a["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        a_bytes[i] = token

    with open(b_file, "rb") as file:
        model = file.read()
    b = sentencepiece.SentencePieceProcessor(model_proto=model)
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    ]
    # Of B ids with equal bytes the last counts, which is a piece and not a byte; links to the others are irregular.
    own = {token: i for i, token in enumerate(b_bytes) if not (b.is_control(i) or b.is_unknown(i))}
    mate = np.array([own.get(token, -1) if token else -1 for token in a_bytes], dtype=np.int64)
    return Tokenizers(ranks, model, a_bytes, b_bytes, mate)


def _labels(size: int, marks: bytes) -> np.ndarray:
    """The decimal ids with each mark behind, as fixed-width bytes: row ``mark``, column ``id``."""
    return np.array([[b"%d%c" % (i, mark) for i in range(size)] for mark in marks])


def _differences(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over runs that end before each of ``ends``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[np.concatenate([[0], ends])])


class Aligner:
    """Encodes and aligns pieces of a table; one per task."""

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        self.encode_a, self.encode_b = tokenizers.encoders()
        self.a_sizes = np.array([len(x) for x in tokenizers.a_bytes])
        self.b_sizes = np.array([len(x) for x in tokenizers.b_bytes])
        self.a_labels = _labels(len(tokenizers.a_bytes), b",|")
        self.b_labels = _labels(len(tokenizers.b_bytes), b",;")
        width = max(self.a_labels.dtype.itemsize, self.b_labels.dtype.itemsize)
        self.label = np.dtype(f"S{width}")

    def encoded(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers; none for a text that they do not both give back."""
        a_ids = [self.encode_a(" " + t) if t else [] for t in texts]
        b_ids = self.encode_b([t or "" for t in texts], num_threads=1)
        for i, text in enumerate(texts):
            raw = b" " + text.encode() if text else b""
            if not raw or b"".join(map(self.t.a_bytes.__getitem__, a_ids[i])) != raw or b"".join(map(self.t.b_bytes.__getitem__, b_ids[i])) != raw:
                a_ids[i], b_ids[i] = [], []
        return a_ids, b_ids

    def align(self, texts: list[str | None], with_groups: bool) -> dict[str, pa.Array]:
        """The columns ``TEXT_COLUMNS``, ``PAIR_COLUMNS`` and, if asked for, ``groups`` of some texts."""
        a_ids, b_ids = self.encoded(texts)
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a_ids, b_ids))
        a, b = (np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64) for ids in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        size = int(a_ends[-1]) + 1 if len(a) else 1
        in_a, in_b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        in_a[a_ends] = True
        in_b[b_ends] = True
        ends = np.flatnonzero(in_a | in_b)  # one link ends at each
        in_a, in_b = in_a[ends], in_b[ends]
        cut = in_a & in_b
        group = np.cumsum(cut) - cut
        a_of, b_of = a[np.cumsum(in_a) - in_a], b[np.cumsum(in_b) - in_b]
        bounds = np.concatenate([[0], a_ends])[np.cumsum(n_a)]  # last byte of each text
        link_ends = np.searchsorted(ends, bounds, side="right")
        n_links, n_groups = np.diff(link_ends, prepend=0), _differences(cut, link_ends)

        # The text of the groups: every token's label at its place, A before B within a group.
        a_group, b_group = group[in_a], group[in_b]
        groups = int(cut.sum())
        a_before = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=groups))])
        b_before = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=groups))])
        labels = np.zeros(len(a) + len(b), dtype=self.label)
        labels[np.arange(len(a)) + b_before[a_group]] = self.a_labels[cut[in_a].astype(int), a]
        labels[np.arange(len(b)) + a_before[b_group + 1]] = self.b_labels[cut[in_b].astype(int), b]
        stops = np.cumsum(n_a + n_b)
        texts_of = [
            labels[lo:hi].tobytes().translate(None, b"\0")[:-1] for lo, hi in zip(np.concatenate([[0], stops]), stops, strict=False)
        ]
        hashes = [hashlib.sha256(t).hexdigest() if t else "" for t in texts_of]

        # Distinct id pairs of each text and how often they are linked.
        base_b = len(self.t.b_bytes)
        space = len(self.t.a_bytes) * base_b
        text = np.repeat(np.arange(len(texts)), n_links)
        keys, times = np.unique(text * space + a_of * base_b + b_of, return_counts=True)
        text, codes = keys // space, keys % space
        same = self.t.mate[codes // base_b] == codes % base_b
        out = {
            "n_a": pa.array(n_a),
            "n_b": pa.array(n_b),
            "n_groups": pa.array(n_groups),
            "n_links": pa.array(n_links),
            "groups_sha256": pa.array(hashes, pa.string()),
        }
        for name, kind, mask, values in (("id", np.int32, same, codes // base_b), ("code", np.int64, ~same, codes)):
            offsets = np.searchsorted(text[mask], np.arange(len(texts) + 1)).astype(np.int32)
            out[f"{name}s"] = pa.ListArray.from_arrays(offsets, values[mask].astype(kind))
            out[f"{name}_times"] = pa.ListArray.from_arrays(offsets, times[mask].astype(np.int32))
        if with_groups:
            out["groups"] = pa.array([t.decode() for t in texts_of], pa.string())
        return out


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``PIECE_BYTES`` of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def align(docs: DataFrame, tokenizers: Tokenizers, with_groups: bool = False) -> DataFrame:
    """``rid, doc_id``, the figures of each text, its id pairs with their numbers, and on request its ``groups``.

    ``ids`` are the A ids linked with their mate, ``codes`` the other pairs as ``a * size of B + b``. The
    groups are written as ``a1,a2|b1;a3|b2,b3``. ``rid`` numbers the rows of this table once it is written.
    """
    kept = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ids", "id_times", "codes", "code_times"]
    kept += ["groups"] if with_groups else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizers)
        for batch in batches:
            for piece in _pieces(batch):
                found = aligner.align(piece.column("text").to_pylist(), with_groups)
                columns = [piece.column("rid"), piece.column("doc_id"), *[found[name] for name in kept]]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "doc_id", *kept])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"rid long, doc_id {kind}, {TEXT_COLUMNS}, {PAIR_COLUMNS}" + (", groups string" if with_groups else "")
    return rows.mapInArrow(run, schema)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(keys, return_inverse=True)
    out = np.zeros(len(found), dtype=np.int64)
    np.add.at(out, place, values)
    return found, out


def pair_counts(aligned: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``code, same, n, is_best``: how many links hold each id pair, whether the ids are mates, and whether no A id is
    linked more often with that B id. ``code div size of B`` is the A id, the rest the B id.

    Mates are counted in a vector per task, other pairs by sorting what a task holds; only then are counts shuffled.
    """
    mate, base_b = tokenizers.mate, len(tokenizers.b_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(mate), dtype=np.int64)
        codes, counts, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def rows(codes, same, n):
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(np.full(len(codes), same)), pa.array(n)], names=["code", "same", "n"])

        def folded():
            parts = [(codes, counts), *waiting]
            waiting.clear()
            return _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

        for batch in batches:
            np.add.at(vector, batch.column("ids").flatten().to_numpy(), batch.column("id_times").flatten().to_numpy())
            waiting.append((batch.column("codes").flatten().to_numpy(), batch.column("code_times").flatten().to_numpy()))
            if sum(len(w[0]) for w in waiting) > MOST_HELD:
                codes, counts = folded()
                if len(codes) > MOST_HELD:
                    yield rows(codes, False, counts)
                    codes, counts = codes[:0], counts[:0]
        yield rows(*(lambda c, n: (c, False, n))(*folded()))
        met = np.flatnonzero(vector)
        yield rows(met * base_b + mate[met], True, vector[met])

    partial = aligned.select("ids", "id_times", "codes", "code_times").mapInArrow(run, "code long, same boolean, n long")
    counts = partial.groupBy("code", "same").agg(F.sum("n").alias("n"))
    # A B id has no more pairs than A has ids, so its rows fit any task.
    best = F.max("n").over(Window.partitionBy(F.expr(f"code % {base_b}")))
    return counts.withColumn("is_best", F.col("n") == best)


def _least_shipped(counts: DataFrame, most: int) -> int:
    """The lowest step of the histogram of counts from which on at most ``most`` pairs are found."""
    steps = counts.groupBy("step").agg(F.count("*").alias("pairs")).collect()
    low, total = 1 << 30, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["pairs"]
        if total > most:
            break
        low = row["step"]
    return low


def score(docs: DataFrame, tokenizers: Tokenizers, most_shipped: int = MOST_SHIPPED) -> DataFrame:
    """``doc_id``, the figures of each text, and two that compare its links with the whole corpus.

    ``n_best`` counts the links whose pair is the most frequent one of its B id (ties included), ``count_sum`` adds up the
    corpus-wide counts of the pairs of all links.
    """
    aligned = written(align(docs, tokenizers), "aligned")
    counts = pair_counts(aligned, tokenizers).withColumn("step", F.floor(F.log2("n") * STEPS).cast("int"))
    counts = written(counts, "pairs")
    others = counts.where("not same")
    low = _least_shipped(others, most_shipped)
    base_b = len(tokenizers.b_bytes)

    mates = counts.where("same").select("code", "n", "is_best").toPandas()  # at most one per A id
    vector = np.zeros((2, len(tokenizers.mate)), dtype=np.int64)
    vector[0, mates["code"].to_numpy(np.int64) // base_b] = mates["n"]
    vector[1, mates["code"].to_numpy(np.int64) // base_b] = mates["is_best"]
    shipped = others.where(F.col("step") >= low).select("code", "n", "is_best").toPandas().sort_values("code")
    shipped = tuple(shipped[c].to_numpy(np.int64) for c in ("code", "n", "is_best"))

    def looked_up(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the shipped pairs, and whether the pair is there."""
        if not len(shipped[0]):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        place = np.minimum(np.searchsorted(shipped[0], codes), len(shipped[0]) - 1)
        return place, shipped[0][place] == codes

    names = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, id_times = (batch.column(c).flatten().to_numpy() for c in ("ids", "id_times"))
            codes, code_times = (batch.column(c).flatten().to_numpy() for c in ("codes", "code_times"))
            id_ends, code_ends = (np.cumsum(batch.column(c).value_lengths().to_numpy()) for c in ("ids", "codes"))
            place, there = looked_up(codes)
            sums = []
            for row in (0, 1):
                of_codes = np.where(there, shipped[row + 1][place], 0) if len(shipped[0]) else np.zeros(len(codes), np.int64)
                sums.append(_differences(vector[row][ids] * id_times, id_ends) + _differences(of_codes * code_times, code_ends))
            columns = [*[batch.column(c) for c in names], pa.array(sums[1]), pa.array(sums[0])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, times = (batch.column(c).flatten().to_numpy() for c in ("codes", "code_times"))
            rid = np.repeat(batch.column("rid").to_numpy(), batch.column("codes").value_lengths().to_numpy())
            left = ~looked_up(codes)[1]
            yield pa.RecordBatch.from_arrays([pa.array(rid[left]), pa.array(codes[left]), pa.array(times[left].astype(np.int64))], names=["rid", "code", "times"])

    kind = aligned.schema["doc_id"].dataType.simpleString()
    figures = aligned.mapInArrow(known, f"rid long, doc_id {kind}, {TEXT_COLUMNS}, n_best long, count_sum long")
    scarce = others.where(F.col("step") < low)
    if not scarce.isEmpty():
        rows = aligned.select("rid", "codes", "code_times").mapInArrow(rare, "rid long, code long, times long")
        found = rows.join(scarce, "code").groupBy("rid").agg(
            F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
        figures = figures.join(found, "rid", "left")
        figures = figures.withColumns(
            {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
        )
    return figures.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
