"""Prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

Turns are digests, a conversation is its sequence of digests. Equal conversations are contracted to one first, the
one with the smallest id. The rest are range-sorted, so that those below a node lie side by side, and cut
into runs. In each run the edges between neighbours, as long as their common prefix, are taken in descending depth: a
merge of two components makes the branching node at that depth, and the nodes on the way down to each component, which
have the same members, are written out. What contains a run's first or last conversation is still open: it is
contracted to a chain of bones, one per branching node, that hold the sums of all that is closed
below them. The chains of neighbouring runs are merged by the same union-find, ``FAN`` partitions at a time, until one forest is left.

Bounds: a run holds at most ``RUN_ROWS`` conversations or ``RUN_BYTES`` of digests; its chain has no more bones than
its first and last conversation have branching turns. Long conversations are cut into blocks of 512 turns, growing up to 65,536, and
the blocks are treated from the last to the first: the forest below a full block enters the block before as one
leaf. A conversation with a third of all turns, and a group of copies with a third of all conversations, are
spread over many tasks; the hash of a node's ids is fed chunk by chunk, as a hash has to be.

Edge cases: a null role or text is an empty one; turns are ordered by number (null first), those with the same
number by role, then by the digest of role and text, and equal rows are turns of their own; rows without a
conversation id belong to no conversation; empty and long texts count as turns like any other; an empty table has no node, not
even a root. Digests are MD5 sums of role and text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, written

RUN_ROWS = 20_000
RUN_BYTES = 16 << 20
FAN = 64
# First turn of each block; later blocks have LAST_BLOCK turns each.
STARTS = (0, 512, 2560, 10752, 43520)
LAST_BLOCK = 65536
CHUNK_IDS = 4096
MARK = 32  # hex digits of a digest

NODE, BONE, ROOT = 0, 1, 2
FOREST = (
    "kind int, part long, run int, place int, lcp int, base string, marks string, words array<long>, conv_id long, depth long, "
    "parent_conv_id long, parent_key string, key string, n_convs long, n_children long, n_leaves long, saved_tokens long, ended long, keyed boolean"
)
COLUMNS = [c.split(" ")[0] for c in FOREST.split(", ")]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, mark, words``: the turns of each conversation, numbered from 0.

    Rows are range-sorted, so a conversation of any length is numbered in parallel: inside each range, raised by
    its rows in the ranges before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["turn", "role", "mark"]
    ranged = written(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) - 1
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    counts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    numbered = ranged.withColumn("inside", inside).join(counts, ["conv_id", "part"])
    return numbered.select("conv_id", (F.col("ahead") + F.col("inside")).alias("pos"), "mark", "words")


def with_shared_heads(turns: DataFrame, every: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns and all conversation ids: every conversation opens with turns of the first one of its ``every``.

    Of the conversation ``c - c % every`` the first ``h`` turns are taken, or all if it has fewer, then ``c``'s own turns from the
    ``h``-th on, where ``h`` is the crc32 of the id modulo ``most + 1``.
    """
    taken = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    ids = turns.select("conv_id").distinct()
    ids = ids.select("conv_id", taken.cast("int").alias("h"), F.expr(f"conv_id - conv_id % {every}").alias("first"))
    opening = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    opening = opening.groupBy(F.col("conv_id").alias("first")).agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "words"))).alias("opening"))
    heads = ids.join(opening, "first", "left").select("conv_id", "h", F.slice("opening", 1, F.col("h")).alias("head"))
    heads = written(heads, "heads")
    k = F.when(F.col("head").isNull(), 0).otherwise(F.size("head")).alias("k")
    own = turns.join(heads.select("conv_id", "h", k), "conv_id").where("pos >= h")
    own = own.select("conv_id", F.expr("pos - h + k").alias("pos"), "mark", "words")
    rebuilt = heads.select("conv_id", F.inline("head")).unionByName(own)
    return written(rebuilt, "rebuilt"), heads.select("conv_id")


def _block(pos: Column) -> Column:
    later = (len(STARTS) - 1 + F.floor((pos - STARTS[-1]) / LAST_BLOCK)).cast("int")
    found = F.when(pos < STARTS[1], 0)
    for k, start in enumerate(STARTS[2:], 1):
        found = found.when(pos < start, k)
    return found.otherwise(later)


def _start(block: int) -> int:
    return STARTS[block] if block < len(STARTS) else STARTS[-1] + (block - len(STARTS) + 1) * LAST_BLOCK


def _md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


class Part:
    """A component: a node at ``depth`` of its block, and the sums of what is closed below it.

    ``words`` and ``marks`` are those of a member, ``tops`` the rows of closed children. An open component
    contains the run's first or last row and keeps the bones on that side.
    """

    __slots__ = ("base", "marks", "words", "depth", "n", "low", "children", "leaves", "saved", "end", "keyed", "tops", "first", "last", "left", "right")

    def __init__(self, base, marks, words, depth, n=0, low=None, children=0, leaves=0, saved=0, end=None, keyed=False):
        self.base, self.marks, self.words, self.depth = base, marks, words, depth
        self.n, self.low, self.children, self.leaves, self.saved, self.end, self.keyed = n, low, children, leaves, saved, end, keyed
        self.tops, self.first, self.last, self.left, self.right = [], False, False, [], []

    def key(self) -> str:
        return _md5(self.base + _md5(self.marks[: MARK * self.depth])) if self.depth else self.base

    def fold(self, other: Part) -> None:
        """Takes in the right neighbour, a component at the same node."""
        self.n += other.n
        self.low = min((x for x in (self.low, other.low) if x is not None), default=None)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.end = other.end if self.end is None else self.end
        self.keyed |= other.keyed
        self.tops += other.tops
        self.last, self.right = other.last, other.right


def common(a: Part, b: Part) -> int:
    """Turns that both begin with; -1 if they are of different forests."""
    if a.base != b.base:
        return -1
    low, high = 0, min(a.depth, b.depth)
    if a.marks[: MARK * high] == b.marks[: MARK * high]:
        return high
    while low + 1 < high:  # equal up to low, different up to high
        middle = (low + high) // 2
        same = a.marks[MARK * low : MARK * middle] == b.marks[MARK * low : MARK * middle]
        low, high = (middle, high) if same else (low, middle)
    return low


class Forest:
    """The trie nodes of some sorted neighbours; with ``open_ends`` more may follow on both sides."""

    def __init__(self, parts: list[Part], lcps: list[int], start: int, open_ends: bool):
        self.rows: list[dict] = []
        self.roots: list[Part] = []
        self.bones: list[Part] = []
        self.start = start
        parts[0].first = parts[-1].last = open_ends
        up = list(range(len(parts)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for i in sorted((i for i, lcp in enumerate(lcps) if lcp >= 0), key=lambda i: -lcps[i]):
            x, y = find(i), find(i + 1)
            left, right = self._raised(parts[x], lcps[i]), self._raised(parts[y], lcps[i])
            left.fold(right)
            parts[x], up[y] = left, x
        for i in [i for i in range(len(parts)) if up[i] == i]:
            part = parts[i]
            if part.first or part.last:
                self.bones += [*part.left, self._frozen(part), *part.right]
            else:
                self._root(self._raised(part, 0))

    def _raised(self, part: Part, depth: int) -> Part:
        """The component as a node at a lesser depth; what it was becomes its child, or a bone if it is open."""
        if part.depth == depth:
            return part
        parent = Part(part.base, part.marks, part.words, depth)
        parent.first, parent.last = part.first, part.last
        if part.first:
            parent.left = [*part.left, self._frozen(part)]
        elif part.last:
            parent.right = [self._frozen(part), *part.right]
        else:
            parent.n, parent.low, parent.children = part.n, part.low, 1
            parent.leaves, parent.saved = self._closed(part, depth)
            parent.tops = [len(self.rows) - 1]
        return parent

    def _closed(self, part: Part, above: int) -> tuple[int, int]:
        """Writes out the node and those on the way up to, but without, depth ``above``; its leaves and saved words."""
        leaves, saved = part.leaves if part.children else 1, part.saved
        for row in part.tops:
            self.rows[row]["parent_conv_id"] = part.low
        for depth in range(part.depth, above, -1):
            bottom = depth == part.depth
            saved += (part.n - 1) * part.words[depth - 1]
            self.rows.append(
                {
                    "kind": NODE,
                    "conv_id": part.low,
                    "depth": self.start + depth,
                    "parent_conv_id": part.low if depth > above + 1 else None,
                    "key": part.key() if bottom and part.keyed else None,
                    "n_convs": part.n,
                    "n_children": part.children if bottom else 1,
                    "n_leaves": leaves,
                    "saved_tokens": saved,
                    "ended": part.end if bottom else None,
                }
            )
        return leaves, saved

    def _wait(self, part: Part) -> None:
        """Children written out so far will look up their parent by its key."""
        part.keyed |= bool(part.tops)
        for row in part.tops:
            self.rows[row]["parent_key"] = part.key()
        part.tops = []

    def _frozen(self, part: Part) -> Part:
        self._wait(part)
        bone = Part(part.base, part.marks[: MARK * part.depth], part.words[: part.depth], part.depth, part.n, part.low)
        bone.children, bone.leaves, bone.saved, bone.end, bone.keyed = part.children, part.leaves, part.saved, part.end, part.keyed
        return bone

    def _root(self, part: Part) -> None:
        if self.start:  # the node belongs to the block before
            self._wait(part)
            self.roots.append(part)
            return
        for row in part.tops:
            self.rows[row]["parent_conv_id"] = part.low
        self.rows.append(
            {
                "kind": NODE,
                "conv_id": part.low,
                "depth": 0,
                "key": part.key() if part.keyed else None,
                "n_convs": part.n,
                "n_children": part.children,
                "n_leaves": part.leaves if part.children else 1,
                "saved_tokens": part.saved,
                "ended": part.end,
            }
        )

    def frame(self, part: int, run: int) -> pd.DataFrame:
        found = list(self.rows)
        for kind, parts in ((BONE, self.bones), (ROOT, self.roots)):
            for place, p in enumerate(parts):
                lcp = None
                if kind == BONE and place:
                    before = parts[place - 1]
                    lcp = min(before.depth, p.depth) if before.base == p.base else -1
                found.append(
                    {"kind": kind, "part": part, "run": run, "place": place, "lcp": lcp, "base": p.base, "marks": p.marks, "words": p.words}
                    | {"conv_id": p.low, "depth": p.depth, "n_convs": p.n, "n_children": p.children, "n_leaves": p.leaves}
                    | {"saved_tokens": p.saved, "ended": p.end, "keyed": p.keyed}
                )
        table = pd.DataFrame({c: pd.Series([r.get(c) for r in found], dtype=object) for c in COLUMNS})
        numbers = ("part", "run", "place", "lcp", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended")
        return table.astype(dict.fromkeys(("kind", *numbers), "Int64") | {"keyed": "boolean"})


def _parts(rows: pd.DataFrame) -> list[Part]:
    whole = lambda x: None if pd.isna(x) else int(x)
    return [
        Part(r.base, r.marks, [int(w) for w in r.words], int(r.depth), int(r.n_convs), whole(r.conv_id), int(r.n_children), int(r.n_leaves), int(r.saved_tokens), whole(r.ended), bool(r.keyed))
        for r in rows.itertuples(index=False)
    ]


def _forests(items: DataFrame, start: int, fan: int, run_rows: int) -> DataFrame:
    """Rows of kind ``NODE`` and ``ROOT`` of all items of a block; items have ``base, marks, words`` and a node's sums."""

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here = TaskContext.get().partitionId()
        held, size, runs = [], 0, itertools.count()
        for frame in frames:
            for part in _parts(frame):
                if held and (len(held) >= run_rows or size + len(part.marks) > RUN_BYTES):
                    yield Forest(held, [common(a, b) for a, b in itertools.pairwise(held)], start, True).frame(here, next(runs))
                    held, size = [], 0
                held.append(part)
                size += len(part.marks)
        if held:
            yield Forest(held, [common(a, b) for a, b in itertools.pairwise(held)], start, True).frame(here, next(runs))

    def merged(last: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["part", "run", "place"])
            parts = _parts(rows)
            lcps = [
                common(a, b) if pd.isna(lcp) else int(lcp) for (a, b), lcp in zip(itertools.pairwise(parts), rows["lcp"].iloc[1:], strict=True)
            ]
            return Forest(parts, lcps, start, not last).frame(int(key[0]), 0)

        return run

    columns = ["base", "marks", "words", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended", "keyed"]
    order = ["base", "marks", "conv_id"]
    sorted_items = items.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    level = written(sorted_items.mapInPandas(first, FOREST), "forest")
    found = []
    while True:
        found.append(level.where(F.col("kind") != BONE))
        bones = level.where(F.col("kind") == BONE)
        most = bones.agg(F.max("part")).first()[0]
        if most is None:
            return reduce(DataFrame.unionByName, found)
        grouped = bones.groupBy(F.expr(f"part div {fan}").alias("_bucket"))
        level = written(grouped.applyInPandas(merged(most < fan), FOREST), "forest")


def _ends(members: DataFrame) -> DataFrame:
    """``ended, ends_sha256``: the hash of the ids of each group of equal conversations."""

    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rep, ids in frame.groupby("rep", sort=False)["conv_id"]:
                for at in range(0, len(ids), CHUNK_IDS):
                    some = ids.iloc[at : at + CHUNK_IDS]
                    yield pd.DataFrame({"rep": [rep], "first": [some.iloc[0]], "listed": [",".join(map(str, some))]})

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rep = state = None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if state is not None and r.rep == rep:
                    state.update(b"," + r.listed.encode())
                    continue
                if state is not None:
                    yield pd.DataFrame({"ended": [rep], "ends_sha256": [state.hexdigest()]})
                rep, state = r.rep, hashlib.sha256(r.listed.encode())
        if state is not None:
            yield pd.DataFrame({"ended": [rep], "ends_sha256": [state.hexdigest()]})

    alone = members.where("copies = 1").select(F.col("rep").alias("ended"), F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    shared = members.where("copies > 1").select("rep", "conv_id")
    listed = shared.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInPandas(chunks, "rep long, first long, listed string")
    lists = listed.repartition("rep").sortWithinPartitions("rep", "first")
    return alone.unionByName(lists.mapInPandas(hashed, "ended long, ends_sha256 string"))


def trie(turns: DataFrame, ids: DataFrame, fan: int = FAN, run_rows: int = RUN_ROWS) -> DataFrame:
    """One row per distinct opening sequence of turns.

    ``turns`` has ``conv_id, pos, mark, words``, positions without gaps from 0; ``ids`` all conversations, also those without
    turns. Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``. The turn of a node is that of its ``conv_id`` at ``depth - 1``.
    """
    spot = F.xxhash64("pos", "mark"), F.xxhash64(F.lit("second"), "pos", "mark")
    whole = turns.groupBy("conv_id").agg(F.count("*").alias("n"), *[F.bit_xor(s).alias(f"x{i}") for i, s in enumerate(spot)])
    whole = ids.join(whole, "conv_id", "left").fillna(0, ["n", "x0", "x1"])
    whole = written(whole, "whole")
    groups = whole.groupBy("n", "x0", "x1").agg(F.min("conv_id").alias("rep"), F.count("*").alias("copies"))
    groups = written(groups, "groups")
    members = whole.join(groups, ["n", "x0", "x1"]).select("rep", "conv_id", "copies")

    kept = turns.join(groups.select(F.col("rep").alias("conv_id")), "conv_id", "left_semi").withColumn("block", _block(F.col("pos")))
    listed = kept.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "mark", "words"))).alias("listed"))
    blocks = listed.select("conv_id", "block", F.array_join("listed.mark", "").alias("marks"), F.col("listed.words").alias("words"))
    empty = groups.where("n = 0").select(F.col("rep").alias("conv_id"), F.lit(0).alias("block"), F.lit("").alias("marks"), F.expr("cast(array() as array<long>)").alias("words"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chain = F.aggregate(F.collect_list(F.md5("marks")).over(before), F.lit(""), lambda base, x: F.md5(F.concat(base, x)))
    last = F.max("block").over(Window.partitionBy("conv_id")) == F.col("block")
    blocks = blocks.unionByName(empty).withColumns({"base": chain, "is_last": last})
    sizes = groups.select(F.col("rep").alias("conv_id"), "copies")
    blocks = written(blocks.join(sizes, "conv_id"), "blocks")
    most = blocks.agg(F.max("block")).first()[0]

    found, below = [], None
    zero = F.lit(0).cast("long")
    for block in range(most if most is not None else -1, -1, -1):
        here = blocks.where(F.col("block") == block)
        items = here.where("is_last").select(
            "base", "marks", "words", "conv_id", F.size("words").cast("long").alias("depth"), F.col("copies").alias("n_convs"),
            zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"), F.col("conv_id").alias("ended"), F.lit(False).alias("keyed"),
        )
        if below is not None:
            roots = below.where(F.col("kind") == ROOT).select("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ended", F.lit(True).alias("keyed"))
            place = here.select("conv_id", "base", "marks", "words", F.size("words").cast("long").alias("depth"))
            items = items.unionByName(roots.join(place, "conv_id").select(*items.columns))
        below = _forests(items, _start(block), fan, run_rows)
        found.append(below.where(F.col("kind") == NODE))
    if not found:
        found = [turns.sparkSession.createDataFrame([], FOREST)]
    nodes = reduce(DataFrame.unionByName, found)

    waiting = nodes.where("parent_key is not null").drop("parent_conv_id")
    parents = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.where("parent_key is null").unionByName(waiting.join(parents, "parent_key"))
    ended = nodes.where("ended is not null").join(_ends(members), "ended")
    passed = nodes.where("ended is null").withColumn("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    return ended.unionByName(passed).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
