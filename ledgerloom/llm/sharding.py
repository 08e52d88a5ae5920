"""Even shards by balanced label propagation.

Documents with equal texts are linked. Linked documents start in shards drawn by a
hash. Large groups, of more than a sixty-fourth of a shard's quota of bytes, so that there are few of them, move in one round, the
largest first: a group is given the shards that hold most of it, as few as its size needs, and running
totals in hash order tell which of its documents go to which. Then, round by round, the other groups ask for the shard that
holds most of them among those with room for the whole group, and as many groups move as the quotas let in, drawn by a hash, until no group
asks or nothing moves any more. At the end the unlinked documents, which
cut no edge wherever they are, are dealt out in hash order, large ones first, to fill
each shard to the same number of bytes.

The law is ``bytes``: shard sizes are equal up to about one small document, as long as
unlinked documents can make up for the groups' uneven sizes.

Edge cases: a null text has no bytes, crc32 0 and no links; equal rows are placed
one by one; an empty table gives an empty one; a group larger than a shard's quota
fills whole shards and shares one with others. Other columns are not read.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

# A large group has more than this share of a shard's bytes; the driver sees at most this many a shard.
LARGE = 64
OVERHEAD = 16
STRIPE_ROWS = 50_000
SPACE = 1 << 30
# Least size of the documents that are dealt out together.
TIERS = (16384, 2048, 0)


def _stripes(rows: int) -> int:
    return max(16, rows // STRIPE_ROWS)


def _draw(salt: int) -> Column:
    return F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(SPACE))


def running_total(df: DataFrame, value: str, stripes: int, salt: int, group: list[str] | None = None) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier rows of the group in the order of a hash.

    Rows are cut into stripes of the hash; a stripe's rows are summed in one task
    and the stripes' totals, few per group, are summed ahead of them. Groups that
    were cut by a hash need one of another salt here, or they fall into few stripes.
    """
    group = group or []
    df = df.withColumn("draw", _draw(salt)).withColumn("stripe", F.expr(f"cast(draw * {stripes} div {SPACE} as int)"))
    ahead = Window.partitionBy(*group).orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, "stripe").agg(F.sum(value).alias("total"))
    totals = totals.withColumn("ahead", F.coalesce(F.sum("total").over(ahead), F.lit(0))).drop("total")
    inside = Window.partitionBy(*group, "stripe").orderBy("draw", "rid").rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        summed.join(totals, [*group, "stripe"])
        .withColumn("before", F.col("ahead") + F.col("inside"))
        .drop("draw", "stripe", "ahead", "inside")
    )


def quotas(asked: dict[tuple[int, int], int], load: list[int], quota: float) -> list[float]:
    """Share of the bytes asking for each shard that it lets in.

    Departures make room, but only those that are let in elsewhere; the shares
    start at nought and grow to the point where no shard exceeds its quota.
    """
    shards = len(load)
    share = [0.0] * shards
    into = [sum(v for (_, t), v in asked.items() if t == j) for j in range(shards)]
    for _ in range(50):
        leaving = [sum(v * share[t] for (s, t), v in asked.items() if s == j) for j in range(shards)]
        share = [min(1.0, max(0.0, quota - load[j] + leaving[j]) / into[j]) if into[j] else 0.0 for j in range(shards)]
    return share


def allot(sizes: dict[str, int], held: dict[tuple[str, int], int], shards: int, quota: float) -> dict[str, list[tuple[int, float]]]:
    """Shards of each group, with the bytes that go there: as few as there can be, and those that hold most of it."""
    room, out = [quota] * shards, {}
    for mark in sorted(sizes, key=lambda m: (-sizes[m], m)):
        left, out[mark] = float(sizes[mark]), []
        while left > 0:
            fitting = [j for j in range(shards) if room[j] >= left]
            if fitting:  # the last shard of the group: where most of it is, then the fullest
                best = max(fitting, key=lambda j: (held.get((mark, j), 0), -room[j], -j))
            else:
                best = max(range(shards), key=lambda j: (room[j], held.get((mark, j), 0), -j))
            taken = left if fitting or room[best] <= 0 else room[best]
            out[mark].append((best, taken))
            room[best] -= taken
            left -= taken
    return out


def _gathered(linked: DataFrame, sizes: dict[str, int], shards: int, quota: float, stripes: int) -> DataFrame:
    """``rid, mark, size, shard`` of the large groups, each on the shards it is allotted."""
    spark = linked.sparkSession
    found = linked.groupBy("mark", "shard").agg(F.sum("size").alias("bytes")).collect()  # of large groups only
    plan = allot(sizes, {(r["mark"], r["shard"]): r["bytes"] for r in found}, shards, quota)
    rows = [(m, [j for j, _ in parts], list(itertools.accumulate(b for _, b in parts))[:-1]) for m, parts in plan.items()]
    table = spark.createDataFrame(rows, "mark string, places array<int>, ends array<double>")
    numbered = running_total(linked.drop("shard"), "size", stripes, 12, ["mark"])
    middle = F.col("before") + F.col("size") / 2
    at = F.size(F.filter("ends", lambda e: e <= middle))
    return numbered.join(table, "mark").select("rid", "mark", "size", F.get("places", at).alias("shard"))


def propagate(linked: DataFrame, shards: int, quota: float, stripes: int = 16) -> DataFrame:
    """``rid, mark, size, shard`` when no group asks for another shard, starting from shards drawn by a hash."""
    state = linked.withColumn("shard", F.pmod(F.xxhash64("rid", F.lit(11)), F.lit(shards)).cast("int"))
    groups = written(linked.groupBy("mark").agg(F.sum("size").alias("all_bytes")), "totals")
    large = {r["mark"]: r["all_bytes"] for r in groups.where(F.col("all_bytes") > quota / LARGE).collect()}
    settled, loads = None, [0] * shards
    if large:
        marks = groups.where(F.col("all_bytes") > quota / LARGE).select("mark")
        settled = written(_gathered(state.join(marks, "mark"), large, shards, quota, stripes), "gathered")
        loads = _loads(settled, shards)
        state = state.join(marks, "mark", "left_anti")
    state = written(state.select("rid", "mark", "size", "shard"), "state")
    idle = 0
    for round_ in itertools.count():
        held = state.groupBy("mark", "shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
        held = written(held.join(groups, "mark"), "held")
        load = [a + b for a, b in zip(loads, _loads(held.withColumnRenamed("bytes", "size"), shards), strict=True)]
        room = F.array(*[F.lit(float(quota - x)) for x in load])
        fits = F.get(room, F.col("shard")) >= F.col("all_bytes") - F.col("bytes")
        order = F.struct("n", F.xxhash64("mark", "shard").alias("tie"), "shard")
        best = held.where(fits).groupBy("mark").agg(F.max(order).alias("best"))
        wish = held.join(best, "mark").where(F.col("shard") != F.col("best.shard"))
        wish = written(wish.select("mark", "shard", F.col("best.shard").alias("to"), "bytes"), "wishes")
        asked = {(r["shard"], r["to"]): r["bytes"] for r in wish.groupBy("shard", "to").agg(F.sum("bytes").alias("bytes")).collect()}
        if not asked:
            break
        share = quotas(asked, load, quota)
        let_in = F.array(*[F.lit(int(s * SPACE)) for s in share])
        # A group moves as a whole.
        drawn = F.pmod(F.xxhash64("mark", F.lit(100 + round_)), F.lit(SPACE)) < F.get(let_in, F.col("to"))
        moving = written(wish.where(drawn).select("mark", "shard", "to"), "moving")
        if moving.isEmpty():
            idle += 1
            if idle == 3:
                break
            continue
        idle = 0
        moved = state.join(moving, ["mark", "shard"], "left")
        state = written(moved.select("rid", "mark", "size", F.coalesce("to", "shard").alias("shard")), "state")
    return state if settled is None else state.unionByName(settled)


def _loads(placed: DataFrame, shards: int) -> list[int]:
    load = [0] * shards
    for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes")).collect():
        load[r["shard"]] = r["bytes"]
    return load


def _filled(rows: DataFrame, load: list[int], stripes: int) -> DataFrame:
    """``rid, size, shard``: rows in hash order fill the shards in turn, each up to one common level."""
    level = _level(load, sum(load) + rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    ends = list(itertools.accumulate(max(0.0, level - held) for held in load))
    middle = F.col("before") + F.col("size") / 2
    at = F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends[:-1]]), lambda e: e <= middle))
    return running_total(rows, "size", stripes, 7).select("rid", "size", at.cast("int").alias("shard"))


def place(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5("text").alias("mark"),
    )
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    quota = total / shards
    groups = rows.where("mark is not null").groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    groups = written(groups, "groups")
    slim = rows.select("rid", "mark", "size")
    linked = propagate(slim.join(groups, "mark", "left_semi"), shards, quota, _stripes(count))

    single = slim.join(groups, "mark", "left_anti").select("rid", "size")
    placed = [linked.select("rid", "size", "shard")]
    load = _loads(linked, shards)
    # Large documents first: the later, smaller ones even out what they leave.
    for low, high in zip(TIERS, (None, *TIERS), strict=False):
        tier = single.where(F.col("size") >= low)
        tier = tier if high is None else tier.where(F.col("size") < high)
        dealt = written(_filled(tier, load, _stripes(count)), "dealt")
        placed.append(dealt)
        load = [a + b for a, b in zip(load, _loads(dealt, shards), strict=True)]
    placed = functools.reduce(DataFrame.unionByName, placed).select("rid", "shard")
    # A number within each shard: a running count of ones.
    slots = running_total(placed.withColumn("one", F.lit(1)), "one", _stripes(count // shards), 8, ["shard"])
    out = rows.join(slots.select("rid", "shard", F.col("before").alias("slot")), "rid")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _level(load: list[int], total: int) -> float:
    """Height to which shards are filled so that all bytes find room."""
    rest = total - sum(load)
    ordered = sorted(load)
    for k, low in enumerate(ordered):
        height = (rest + sum(ordered[: k + 1])) / (k + 1)
        if k + 1 == len(ordered) or height <= ordered[k + 1]:
            return max(height, float(low))
    return 0.0
