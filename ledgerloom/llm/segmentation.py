"""Sampled SentencePiece segmentations without replacement, and their decoding.

All segmentations of a text form a lattice, whose paths have probabilities by the
weights of their pieces. Adding Gumbel noise to the log-probabilities and taking the
``k`` largest samples ``k`` distinct paths without replacement. An A-star search finds
them without listing paths: its queue holds regions, sets of paths that follow an
emitted path up to some decision and then leave it, each ranked by the largest noisy
value in it. That value is drawn top-down, below the value of the path it was split
from. The best region yields the next path; what is left of it goes back.

No piece crosses the start of a run of blanks, so the lattice is a chain of units
(a word with the blanks before it). The lattice of a unit is worked out once per task
and met again by its text; paths walk through all units of a batch of texts together.
Probabilities are kept as logarithms, that of leaving a path at a decision as the sum
of the other arcs, so no decision is too unlikely to be counted, whatever ``alpha``.
Noise depends on the row's id, its text and the seed alone.

Each path comes with an inclusion score, the probability that its noisy value exceeds
the largest one that was not emitted.

Edge cases: a null or empty text has one path without pieces; a text with fewer than
``k`` segmentations gives them all, with inclusion 1; characters without a piece are
spelt in bytes, as is a literal U+2581, so decoding gives back any text; equal rows get
equal samples; an empty table gives an empty one. Long texts are segmented whole. Other
columns are not read. Texts are not normalised.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
ESCAPED = "\ud800"  # stands for a literal U+2581; valid text holds no lone surrogate
MOST_ARCS = 8_000_000
BUILT_CHARS = 1 << 16  # characters of units whose lattices are worked out together
# Texts that are sampled together: so many, and so many characters unless one alone is longer.
SLICE_ROWS, SLICE_CHARS = 250, 1_000_000
UNIT = re.compile(f"{BLANK}*[^{BLANK}\n\t]+|{BLANK}+|[\n\t]")
# Where no piece goes on from a letter to another kind of character, units end there too.
LETTER = r"[^\W\d_]"
FINE_UNIT = re.compile(rf"{BLANK}*(?:(?!{LETTER})[^{BLANK}\n\t])*{LETTER}+|{BLANK}*(?:(?!{LETTER})[^{BLANK}\n\t])+|{BLANK}+|[\n\t]")

_U64 = np.uint64
_STEP = _U64(0x9E3779B97F4A7C15)
_TAIL = _U64((1 << 22) - 1)
_WORD = (1 << 64) - 1


class Vocabulary(NamedTuple):
    """Pieces by id: where their bytes end in ``letters``; sorted hashes with ids and weights; ids of the byte pieces."""

    letters: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    byte_ids: np.ndarray
    byte_weight: float
    longest: int
    unit: re.Pattern
    by_head: np.ndarray  # by the first slot of a hash (22 bits), a piece that has it
    by_tail: np.ndarray  # by the second slot, a piece that another one keeps from its first
    sieve: np.ndarray  # by 20 bits of the first slot, whether a piece has them (1), the start of a longer one (2), or both

    def likely(self, hashes: np.ndarray) -> np.ndarray:
        """What the hashes may be those of: 1 a piece, 2 the start of a longer one, 3 both; seldom more than is so."""
        return self.sieve[hashes * _STEP >> _U64(44)]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of pieces, and their places among these."""
        mixed = hashes * _STEP
        place = self.by_head[mixed >> _U64(42)]
        late = np.flatnonzero(self.hashes[place] != hashes)
        place[late] = self.by_tail[(mixed[late] >> _U64(20)) & _TAIL]
        there = np.flatnonzero(self.hashes[place] == hashes)
        return there, place[there]


def log_weights(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Log-weights of pieces: their scores, or Zipf's law in the order of ids where the scores are whole numbers.

    The scores of a unigram model are log-probabilities; those of a BPE model only
    count its merges.
    """
    return -np.log(ids + 1.0) if (scores == np.round(scores)).all() else scores


def vocabulary(model_file: str) -> Vocabulary:
    """Read a SentencePiece model; ``log_weights`` weighs its pieces, the bytes less than any of them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    spelt, byte_ids, texts, ids = [], np.zeros(256, dtype=np.int64), [], []
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelt.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelt.append(b"")
        else:
            spelt.append(piece.replace(BLANK, " ").encode())
            texts.append(piece)
            ids.append(i)
            if "\n" in piece or "\t" in piece or BLANK in piece.lstrip(BLANK):
                raise ValueError(f"piece {piece!r} crosses units")
    hashes = np.array([_hash(t) for t in texts], dtype=np.uint64)
    order = np.argsort(hashes)
    ids = np.array(ids, dtype=np.int64)[order]
    weights = log_weights(ids, np.array([model.get_score(int(i)) for i in ids], dtype=np.float64))
    byte_weight = min(-np.log(n + 1.0), float(weights.min(initial=0.0)))
    onward = re.compile(rf"{LETTER}(?!{LETTER})[^{BLANK}]")
    unit = UNIT if any(onward.search(t) for t in texts) else FINE_UNIT
    hashes = hashes[order]
    place = np.arange(len(hashes), dtype=np.int32)
    by_head, by_tail, sieve = np.zeros(1 << 22, dtype=np.int32), np.zeros(1 << 22, dtype=np.int32), np.zeros(1 << 20, dtype=np.uint8)
    mixed = hashes * _STEP
    head, tail = mixed >> _U64(42), (mixed >> _U64(20)) & _TAIL
    starts = np.array(list({_hash(t[:i]) for t in texts for i in range(1, len(t))}), dtype=np.uint64)
    sieve[starts * _STEP >> _U64(44)] = 2
    sieve[head >> _U64(2)] |= 1
    by_head[head] = place
    late = place[by_head[head] != place]
    by_tail[tail[late]] = late
    if (by_tail[tail[late]] != late).any():
        raise ValueError("pieces share both slots")
    letters, ends = np.frombuffer(b"".join(spelt), dtype=np.uint8), np.cumsum([len(b) for b in spelt])
    return Vocabulary(
        letters, ends, hashes, ids, weights, byte_ids, byte_weight, max(map(len, texts)), unit, by_head, by_tail, sieve
    )


def _hash(text: str) -> int:
    value = 0
    for c in text:
        value = (value * 0x100000001B3 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def units(text: str, unit: re.Pattern = UNIT) -> list[str]:
    """The text's units, with a blank in front and blanks for spaces."""
    if BLANK in text:
        text = text.replace(BLANK, ESCAPED)
    return unit.findall(BLANK + text.replace(" ", BLANK)) if text else []


class _Grown:
    """An array that grows by doubling."""

    def __init__(self, kind) -> None:
        self.data, self.size = np.empty(1 << 16, dtype=kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.empty(max(need, len(self.data)), dtype=self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need


class _Numbers(dict):
    """Numbers units in the order they are first met."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class Lattices:
    """The lattices of units: per node its arcs, per arc its piece, end, running sum, and logs of taking and of not taking it."""

    def __init__(self, words: Vocabulary, alpha: float) -> None:
        self.words = words
        self.weights, self.byte_weight = alpha * words.weights, 3 * alpha * words.byte_weight
        self.reset()

    def reset(self) -> None:
        self.numbers = _Numbers()
        self.root = _Grown(np.int64)
        self.first, self.count = _Grown(np.int64), _Grown(np.int32)
        self.piece, self.to = _Grown(np.int32), _Grown(np.int32)
        self.log, self.leave, self.sum = _Grown(np.float32), _Grown(np.float32), _Grown(np.float32)

    def roots(self, found: Iterable[str], count: int = -1) -> np.ndarray:
        """The first node of each unit; new units are worked out."""
        if self.piece.size > MOST_ARCS:
            self.reset()
        number = np.fromiter(map(self.numbers.__getitem__, found), dtype=np.int64, count=count)
        new, done = self.numbers.new, self.root.size
        sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        self.root.add(np.zeros(len(new), dtype=np.int64))
        ends = np.cumsum(sizes)
        at = 0
        while at < len(new):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BUILT_CHARS, side="right")))
            self.root.data[done + at : done + end] = self._build(new[at:end], sizes[at:end])
            at = end
        new.clear()
        return self.root.data[number]

    def _build(self, group: list[str], sizes: np.ndarray) -> np.ndarray:
        """Add the lattices of units; returns their first nodes.

        Nodes are numbered by what is left of their units, so that those that are as near to an end lie together.
        """
        words = self.words
        points = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        n, ends = len(points), np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(n)
        length = int(sizes.max())
        order = np.argsort(left.astype(np.uint16) if length < 1 << 16 else left, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        longest = min(words.longest, length)
        # By node and falling size, which is the order of the arcs.
        cells = np.full(n * longest, -1, dtype=np.int32)
        value, here = np.zeros(n, dtype=np.uint64), np.arange(n)
        for size in range(1, longest + 1):
            value = value * _U64(0x100000001B3) + points[here + (size - 1)] + _U64(1)
            likely = words.likely(value)
            maybe = np.flatnonzero(likely & 1)
            there, place = words.find(value[maybe])
            cells[rank[here[maybe[there]]] * longest + (longest - size)] = place
            on = np.flatnonzero((likely & 2).astype(bool) & (left[here] > size))
            value, here = value[on], here[on]
        # A character without a piece is spelt in bytes: one arc, marked by a number below -1.
        single = cells[longest - 1 :: longest]
        single[single < 0] = -2
        at = np.flatnonzero(cells != -1)
        found = cells[at]
        node, back = np.divmod(at, longest)
        weight, piece = self.weights[found], words.ids[found]
        spelt = np.flatnonzero(found < 0)
        weight[spelt] = self.byte_weight
        piece[spelt] = -2 - points[order[node[spelt]]].astype(np.int64)
        counts = np.bincount(node, minlength=n)
        ends_at = np.cumsum(counts)
        starts_at = ends_at - counts
        after = order[node] + (longest - back)
        goal = np.where(left[order][node] == longest - back, n, rank[np.minimum(after, n - 1)])
        # Logs of the sums over all ways to the end.
        rest = np.zeros(n + 1)
        log = np.empty(len(at))
        bounds = np.cumsum(np.bincount(left, minlength=length + 1)).tolist()
        for low, high in itertools.pairwise(bounds):
            nodes, arcs = slice(low, high), slice(starts_at[low], ends_at[high - 1])
            way = weight[arcs] + rest[goal[arcs]]
            starts, several = starts_at[nodes] - starts_at[low], counts[nodes]
            top = np.maximum.reduceat(way, starts)
            way -= np.repeat(top, several)
            total = np.log(np.add.reduceat(np.exp(way), starts))
            way -= np.repeat(total, several)
            rest[nodes] = top + total
            log[arcs] = way
        q = np.exp(log)
        # An arc over one half is known by the sum of the others, which does not round to nothing.
        main = q > 0.5
        others = np.repeat(np.logaddexp.reduceat(np.where(main, -np.inf, log), starts_at), counts)
        leave = np.where(main, others, np.log1p(-np.minimum(q, 0.5)))
        log[main] = np.log1p(-np.exp(others[main]))
        running = np.cumsum(q)
        running -= np.repeat(np.concatenate([[0.0], running])[starts_at], counts)
        running = np.minimum(running, 1.0 - 2.0**-24)  # only a node's last arc reaches 1, also when rounded
        running[ends_at - 1] = 1.0
        base = self.first.size
        self.to.add(np.where(goal < n, base + goal, -1).astype(np.int32))
        self.piece.add(piece)
        self.first.add(self.log.size + starts_at)
        self.count.add(counts.astype(np.int32))
        self.log.add(log)
        self.leave.add(leave)
        self.sum.add(running)
        return base + rank[ends - sizes]


def _noise(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) by row key plus counter times step; the argument is overwritten."""
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return ((x >> _U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def walk(lattices: Lattices, nodes: np.ndarray, keys: np.ndarray, counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ways from the nodes to the ends of their units: all arcs, in order, and how many each took.

    ``counters`` start each way's noise; a way uses 64 numbers apart from its step.
    """
    first, to, total = lattices.first.data, lattices.to.data, lattices.sum.data
    noise = keys + counters.astype(np.uint64) * _STEP
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    taken = np.zeros(len(nodes), dtype=np.int64)
    live, node = np.arange(len(nodes)), nodes
    while len(live):
        u = _noise((noise if len(live) == len(nodes) else noise[live]) + _U64(len(steps) * int(_STEP) & _WORD))
        arc = first[node]
        on = np.flatnonzero(total[arc] < u)
        while len(on):  # a node's last arc reaches 1, which no number does
            after = arc[on] + 1
            arc[on] = after
            on = on[total[after] < u[on]]
        steps.append((live, arc))
        taken[live] += 1
        node = to[arc]
        going = node >= 0
        live, node = live[going], node[going]
    offset = np.cumsum(taken) - taken
    out = np.empty(int(taken.sum()), dtype=np.int64)
    for step, (at, arc) in enumerate(steps):
        out[offset[at] + step] = arc
    return out, taken


def _gumbel(u: float) -> float:
    return -math.log(-math.log(u))


def _below(location: float, u: float, limit: float) -> float:
    """A Gumbel value at this location, given that it is under the limit."""
    a, b = location - limit, math.log(-math.log(u))
    return location - (max(a, b) + math.log1p(math.exp(-abs(a - b))))


class _Path(NamedTuple):
    """An emitted path: its arcs, and the decision where its region starts."""

    arcs: np.ndarray
    logs: np.ndarray
    start: int
    barred: tuple[int, ...]
    value: float


def _total(mass: np.ndarray) -> float:
    top = float(mass.max())
    return top + math.log(float(np.exp(mass - top).sum()))


class _Region(NamedTuple):
    """The paths of an emitted path's region that leave it at one of these decisions."""

    path: _Path
    at: np.ndarray
    mass: np.ndarray  # log-probability of leaving at each
    total: float


class _Tail(NamedTuple):
    """The same for all decisions from one on, which are listed once the tail is the best."""

    path: _Path
    start: int
    total: float


# Decisions of a path that are listed at once; later ones are seldom reached.
REACH = 48


def _near(lattices: Lattices, paths: list[_Path]) -> list[_Region]:
    """The ways to leave each path at the first ``REACH`` decisions of its region; at the very first some arcs are barred."""
    if not paths:
        return []
    ends = [min(p.start + REACH, len(p.arcs)) for p in paths]
    sizes = np.array([end - p.start for p, end in zip(paths, ends, strict=True)], dtype=np.int64)
    inside = np.arange(REACH) < sizes[:, None]
    arcs = np.zeros(inside.shape, dtype=np.int64)
    arcs[inside] = np.concatenate([p.arcs[p.start : end] for p, end in zip(paths, ends, strict=True)])
    logs = lattices.log.data[arcs].astype(np.float64)
    mass = np.cumsum(logs, axis=1) - logs + np.array([p.logs[: p.start].sum(dtype=np.float64) for p in paths])[:, None]
    first = mass[:, 0].copy()
    mass += lattices.leave.data[arcs]
    for i, path in enumerate(paths):
        if path.barred and sizes[i]:
            mass[i, 0] = first[i] + np.logaddexp.reduce(lattices.log.data[_choices(lattices, path, path.start)], initial=-np.inf)
    mass[~inside] = -np.inf
    top = mass.max(axis=1, initial=-np.inf)
    with np.errstate(invalid="ignore", divide="ignore"):
        total = (top + np.log(np.exp(mass - top[:, None]).sum(axis=1))).tolist()
    places = np.arange(REACH)
    whole = (mass > -np.inf).all(axis=1).tolist()
    out = []
    for i, path in enumerate(paths):
        at = places if whole[i] else np.flatnonzero(mass[i] > -np.inf)
        out.append(_Region(path, at + path.start, mass[i, at], total[i]))
    return out


def _rest(lattices: Lattices, path: _Path, start: int) -> _Region:
    """The ways to leave a path at the decisions from ``start`` on, which is not its first one."""
    logs = path.logs[start:].astype(np.float64)
    mass = np.cumsum(logs) - logs + path.logs[:start].sum(dtype=np.float64)
    mass += lattices.leave.data[path.arcs[start:]]
    at = np.flatnonzero(mass > -np.inf)
    return _Region(path, at + start, mass[at], _total(mass[at]))


def _tail(path: _Path, start: int) -> _Tail | None:
    """All ways to leave a path after its first decision, from ``start`` on: those that follow it to there but not to its end."""
    rest = float(path.logs[start:].sum(dtype=np.float64))
    return _Tail(path, start, float(path.logs[:start].sum(dtype=np.float64)) + math.log(-math.expm1(rest))) if rest < 0.0 else None


def _choices(lattices: Lattices, path: _Path, decision: int) -> np.ndarray:
    """Arcs by which the path can be left at a decision."""
    arc = int(path.arcs[decision])
    ends = lattices.sum.data
    low = arc
    while low > 0 and ends[low - 1] < 1.0:
        low -= 1
    high = arc
    while ends[high] < 1.0:
        high += 1
    gone = {arc, *path.barred} if decision == path.start else {arc}
    return np.array([a for a in range(low, high + 1) if a not in gone], dtype=np.int64)


class Sample(NamedTuple):
    pieces: np.ndarray
    log_prob: float
    value: float
    inclusion: float


class _Search:
    """The search over one text: its queue of regions and the paths emitted so far."""

    def __init__(self, lattices: Lattices, key: int) -> None:
        self.lattices, self.key = lattices, key
        self.queue: list[tuple[float, int, _Region | _Tail]] = []
        self.paths: list[_Path] = []
        self.drawn = 0

    def uniform(self) -> float:
        """The next number of the row's own noise, as ``_noise`` makes it."""
        self.drawn += 1
        x = (self.key + ((1 << 62) + self.drawn) * 0x9E3779B97F4A7C15) & _WORD
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _WORD
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _WORD
        return (((x ^ (x >> 31)) >> 11) + 0.5) * 2.0**-53

    def push(self, region: _Region | _Tail, limit: float) -> None:
        heapq.heappush(self.queue, (-_below(region.total, self.uniform(), limit), self.drawn, region))

    def emit(self, path: _Path, near: _Region) -> None:
        """Take in a new path, with the region of all ways to leave it."""
        self.paths.append(path)
        if len(near.at):
            self.push(near, path.value)
        if tail := _tail(path, path.start + REACH):
            self.push(tail, path.value)

    def leave(self) -> tuple[_Path, int, int, float] | None:
        """Take the best region: the path to follow, the decision to leave it at, the arc to take and the value."""
        if not self.queue:
            return None
        value, _, region = heapq.heappop(self.queue)
        if isinstance(region, _Tail):
            region = _rest(self.lattices, region.path, region.start)
        mass, top = region.mass, region.mass.max()
        shares = np.exp(mass - top)
        weights = shares.cumsum()
        i = min(int(weights.searchsorted(self.uniform() * weights[-1])), len(weights) - 1)
        decision = int(region.at[i])
        if len(mass) > 1:
            shares[i] = 0.0
            mass = np.concatenate((mass[:i], mass[i + 1 :]))
            # The sum is worked out anew where the others are next to nothing beside the one that goes.
            total = float(top) + math.log(left) if (left := float(shares.sum())) > 1e-200 else _total(mass)
            self.push(_Region(region.path, np.concatenate((region.at[:i], region.at[i + 1 :])), mass, total), -value)
        arcs = _choices(self.lattices, region.path, decision)
        logs = self.lattices.log.data[arcs]
        weights = np.exp(logs - logs.max(), dtype=np.float64).cumsum()
        arc = arcs[min(int(weights.searchsorted(self.uniform() * weights[-1])), len(arcs) - 1)]
        return region.path, decision, int(arc), -value


def sample(lattices: Lattices, texts: list[str], keys: np.ndarray, k: int) -> list[list[Sample]]:
    """``k`` distinct segmentations of each text, or all if there are fewer, by falling noisy value."""
    cut = [units(t, lattices.words.unit) for t in texts]
    lengths = np.array([len(c) for c in cut], dtype=np.int64)
    roots = lattices.roots(itertools.chain.from_iterable(cut), int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    searches = [_Search(lattices, int(key)) for key in keys]

    def walked(which: np.ndarray, after: np.ndarray, turn: int):
        """Free ways through the units of these texts from given places on: arcs, and each text's share."""
        sizes = lengths[which] - after
        ends = np.cumsum(sizes)
        place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - after, sizes)
        at = place + np.repeat(starts[which], sizes)
        arcs, taken = walk(lattices, roots[at], np.repeat(keys[which], sizes), (place + np.int64(turn << 40)) * 64)
        return arcs, np.concatenate([[0], np.cumsum(taken)])[np.concatenate([[0], ends])]

    every = np.arange(len(texts))
    arcs, bounds = walked(every, np.zeros(len(texts), dtype=np.int64), 0)
    logs, to = lattices.log.data, lattices.to.data
    all_logs = logs[arcs]
    spans = [slice(a, b) for a, b in itertools.pairwise(bounds)]
    paths = [_Path(arcs[own], all_logs[own], 0, (), _gumbel(s.uniform())) for s, own in zip(searches, spans, strict=True)]
    for s, path, near in zip(searches, paths, _near(lattices, paths), strict=True):
        s.emit(path, near)
    for turn in range(1, k):
        going = [(i, left) for i, s in enumerate(searches) if (left := s.leave())]
        if not going:
            break
        which = np.array([i for i, _ in going])
        units_left = np.array([np.count_nonzero(to[path.arcs[:decision]] < 0) for _, (path, decision, _, _) in going], dtype=np.int64)
        arcs, bounds = walked(which, units_left + 1, turn)
        node = np.array([to[arc] for _, (_, _, arc, _) in going], dtype=np.int64)
        inside = node >= 0
        rest, taken = walk(lattices, node[inside], keys[which[inside]], (units_left[inside] + np.int64(turn << 40)) * 64 + 32)
        cuts = np.zeros(len(going) + 1, dtype=np.int64)
        cuts[1:][inside] = taken
        cuts = np.cumsum(cuts)
        all_logs, rest_logs = logs[arcs], logs[rest]
        paths = []
        for j, (_, (path, decision, arc, value)) in enumerate(going):
            middle, end = slice(cuts[j], cuts[j + 1]), slice(bounds[j], bounds[j + 1])
            own = np.concatenate((path.arcs[:decision], (arc,), rest[middle], arcs[end]))
            own_logs = np.concatenate((path.logs[:decision], logs[arc : arc + 1], rest_logs[middle], all_logs[end]))
            barred = (int(path.arcs[decision]), *(path.barred if decision == path.start else ()))
            paths.append(_Path(own, own_logs, decision, barred, value))
        for i, path, near in zip(which, paths, _near(lattices, paths), strict=True):
            searches[i].emit(path, near)
    out = []
    for s in searches:
        limit = -s.queue[0][0] if s.queue else -np.inf
        found = []
        for path in s.paths:
            log_prob = float(path.logs.sum())
            inclusion = -np.expm1(-np.exp(log_prob - limit)) if limit > -np.inf else 1.0
            found.append(Sample(lattices.piece.data[path.arcs], log_prob, path.value, float(inclusion)))
        out.append(found)
    return out


def _with_bytes(words: Vocabulary, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces, characters without a piece as ids of their bytes; and how many ids each became."""
    width = np.ones(len(marked), dtype=np.int64)
    out = np.flatnonzero(marked < 0)
    if not len(out):
        return marked, width
    kinds, which = np.unique(marked[out], return_inverse=True)
    chars = [chr(-2 - int(m)) for m in kinds]
    spellings = [words.byte_ids[list((BLANK if c == ESCAPED else c).encode())] for c in chars]
    width[out] = np.array([len(x) for x in spellings])[which]
    ids = np.repeat(marked, width)
    ids[ids < 0] = np.concatenate([spellings[i] for i in which])
    return ids, width


def piece_ids(words: Vocabulary, marked: np.ndarray) -> np.ndarray:
    """Ids of the pieces; characters without a piece become the ids of their bytes."""
    return _with_bytes(words, marked)[0]


def spelt(words: Vocabulary, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes that the pieces spell, one after another, and where each piece's end."""
    offsets = np.concatenate([[0], words.ends]).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(words.ends), [None, pa.py_buffer(offsets), pa.py_buffer(words.letters)])
    found = pieces.take(pa.array(ids))
    _, after, letters = found.buffers()
    after = np.frombuffer(after, dtype=np.int64, count=len(ids) + 1)[1:]
    return letters.to_pybytes() if letters else b"", after


def decode(words: Vocabulary, ids: np.ndarray) -> str:
    """The text that the pieces spell, without the blank in front."""
    return spelt(words, ids)[0][1:].decode()


def _slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts to sample together."""
    start = held = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= SLICE_ROWS or held + len(t) > SLICE_CHARS):
            yield slice(start, i)
            start, held = i, 0
        held += len(t)
    if texts:
        yield slice(start, len(texts))


def _rows(words: Vocabulary, doc_ids: pa.Array, texts: list[str], found: list[list[Sample]], with_ids: bool) -> pa.RecordBatch:
    """The samples of some texts as rows."""
    counts = [len(samples) for samples in found]
    every = [s for samples in found for s in samples]
    ids, width = _with_bytes(words, np.concatenate([s.pieces for s in every]))
    ids = np.ascontiguousarray(ids, dtype="<i4")
    ends = np.concatenate([[0], np.cumsum(width)])[np.cumsum([0, *(len(s.pieces) for s in every)])]
    letters, after = spelt(words, ids)
    cuts = np.concatenate([[0], after])[ends].tolist()
    raw = [t.encode() for t in texts]
    of = np.repeat(np.arange(len(texts)), counts)
    bounds = ends.tolist()
    columns = {
        "doc_id": doc_ids.take(pa.array(of)),
        "sample": pa.array(np.concatenate([np.arange(1, c + 1) for c in counts]), pa.int32()),
        "n_pieces": pa.array(np.diff(ends), pa.int64()),
        "log_prob": pa.array([s.log_prob for s in every], pa.float64()),
        "value": pa.array([s.value for s in every], pa.float64()),
        "inclusion": pa.array([s.inclusion for s in every], pa.float64()),
        "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in itertools.pairwise(bounds)], pa.int64()),
        # The pieces of a text begin with a blank of their own.
        "round_trip": pa.array([letters[a + 1 : b] == raw[i] for (a, b), i in zip(itertools.pairwise(cuts), of, strict=True)], pa.bool_()),
    }
    if with_ids:
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
    return pa.RecordBatch.from_pydict(columns)


def segment(docs: DataFrame, model_file: str, k: int = 2, alpha: float = 1.0, seed: int = 0, with_ids: bool = True) -> DataFrame:
    """One row per sample: ``doc_id, sample`` (from 1), ``n_pieces, log_prob, value, inclusion, ids_crc32, round_trip`` and, if asked for, ``ids``."""
    words = vocabulary(model_file)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text", F.lit(seed)).alias("key"))

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(words, alpha)
        for batch in batches:
            doc_ids = batch.column("doc_id").cast(pa.int64())
            every = [t or "" for t in batch.column("text").to_pylist()]
            keys = batch.column("key").to_numpy().view(np.uint64)
            for own in _slices(every):
                found = sample(lattices, every[own], keys[own], k)
                yield _rows(words, doc_ids[own], every[own], found, with_ids)

    schema = "doc_id long, sample int, n_pieces long, log_prob double, value double, inclusion double, ids_crc32 long, round_trip boolean"
    return rows.mapInArrow(segmented, schema + ", ids array<int>" * with_ids)
