"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the largest length are cut into full sequences and a rest.
The pieces of a bounded number of rows are packed together, longest first: each
goes to the open bin that it fills best. Where none has room a bin is opened, of
the length whose cost per word is least when filled from the pieces still waiting.
At the end each bin takes the shortest permitted length that holds its contents.

Rows are dealt by a hash of id and text, so no key collects rows; a task packs run
after run of at most ``RUN_ROWS`` rows or ``RUN_WORDS`` words, so its memory does not
grow with the table. Only the last few bins of a run are not full.

Edge cases: a null text or one without words has no piece and gives no row; equal
rows are packed one by one; an empty table gives an empty one. Lengths are words,
``[^\\x20\\x09-\\x0D]+``; the text of a piece runs from its first word to its last.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD

CAPACITIES = (256, 512, 1024, 2048, 4096)
RUN_ROWS = 4_000
RUN_WORDS = 2_000_000
WHITE = " \t\n\v\f\r"


def cost(capacity: int) -> float:
    """Cost of a sequence: a share for each word, and attention, which grows with the square."""
    return capacity + capacity * capacity / 16384.0


class Bins(NamedTuple):
    """Per piece its bin and place in it; per bin its capacity and contents."""

    bin_of: list[int]
    offset: list[int]
    capacity: list[int]
    used: list[int]


def _filled(room: int, lengths: list[int], counts: dict[int, int]) -> int:
    """Words that go into the room, taking the longest waiting piece that fits again and again."""
    start, taken = room, {}
    at = bisect_right(lengths, room) - 1
    while at >= 0 and room > 0:
        length = lengths[at]
        left = counts[length] - taken.get(length, 0)
        if left <= 0:
            at -= 1
            continue
        n = min(left, room // length)
        taken[length] = taken.get(length, 0) + n
        room -= n * length
        at = min(at - 1, bisect_right(lengths, room, 0, at) - 1)
    return start - room


def best_fit(pieces: Sequence[int], capacities: Sequence[int] = CAPACITIES) -> Bins:
    """Pack pieces, each of length 1 to the largest capacity, given in any order."""
    sizes = sorted(capacities)
    counts: dict[int, int] = {}
    for length in pieces:
        counts[length] = counts.get(length, 0) + 1
    lengths = sorted(counts)
    bin_of, offset = [0] * len(pieces), [0] * len(pieces)
    capacity: list[int] = []
    used: list[int] = []
    rooms: list[tuple[int, int]] = []  # room left and bin, sorted
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i], i)):
        length = pieces[i]
        counts[length] -= 1
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            fitting = sizes[bisect_left(sizes, length) :]
            room = min(fitting, key=lambda c: (cost(c) / (length + _filled(c - length, lengths, counts)), c))
            b = len(capacity)
            capacity.append(room)
            used.append(0)
        bin_of[i], offset[i] = b, used[b]
        used[b] += length
        if room > length:
            insort(rooms, (room - length, b))
        if not counts[length] and lengths and lengths[-1] == length:
            lengths.pop()
    capacity = [sizes[bisect_left(sizes, n)] for n in used]
    return Bins(bin_of, offset, capacity, used)


def _parts(n_words: int, longest: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document."""
    return [(at, min(longest, n_words - at)) for at in range(0, n_words, longest)]


def _texts(text: str, parts: list[tuple[int, int]]) -> list[str]:
    if len(parts) == 1:
        return [text.strip(WHITE)]
    spans = [m.span() for m in re.finditer(WORD, text)]
    return [text[spans[at][0] : spans[at + n - 1][1]] for at, n in parts]


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, with_text: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, n_words, bin_id, bin_offset, bin_words, capacity`` and, if asked for, ``text``."""
    longest = max(capacities)
    columns = ["doc_id", "n_words"] + ["text"] * with_text
    deal = F.xxhash64("doc_id", F.xxhash64("text"))
    rows = docs.select("doc_id", "text", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), deal.alias("deal"))
    rows = rows.where("n_words > 0").select("deal", *columns)
    parts = 1 + docs.count() // RUN_ROWS
    dealt = rows.repartition(parts, "deal").sortWithinPartitions("deal", "n_words", "doc_id")

    def packed(run: list[tuple], first: int) -> tuple[pd.DataFrame, int]:
        whole = [(row, piece, at, n) for row in run for piece, (at, n) in enumerate(_parts(row[1], longest))]
        bins = best_fit([n for _, _, _, n in whole], capacities)
        out = {
            "doc_id": [row[0] for row, _, _, _ in whole],
            "piece": [piece for _, piece, _, _ in whole],
            "start": [at for _, _, at, _ in whole],
            "n_words": [n for _, _, _, n in whole],
            "bin_id": [first + b for b in bins.bin_of],
            "bin_offset": bins.offset,
            "bin_words": [bins.used[b] for b in bins.bin_of],
            "capacity": [bins.capacity[b] for b in bins.bin_of],
        }
        if with_text:
            out["text"] = [t for row in run for t in _texts(row[2], _parts(row[1], longest))]
        frame = pd.DataFrame(out)
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame, first + len(bins.capacity)

    def packing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 32
        run: list[tuple] = []
        words = 0
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            for row in zip((None if x is pd.NA else x for x in ids), *(batch[c] for c in columns[1:]), strict=True):
                run.append(row)
                words += row[1]
                if len(run) >= RUN_ROWS or words >= RUN_WORDS:
                    frame, first = packed(run, first)
                    run, words = [], 0
                    yield frame
        if run:
            yield packed(run, first)[0]

    schema = "doc_id long, piece int, start long, n_words int, bin_id long, bin_offset int, bin_words int, capacity int"
    return dealt.mapInPandas(packing, schema + ", text string" * with_text)
