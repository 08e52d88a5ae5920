"""Mixing sources to target weights, by hash-random keys and distributed prefix sums.

The size of a document is its number of words. Sources, in the order of their code points
and with the null source last, weigh 3, 1, 2, 3, 1, 2, ... and share a percentage of all
words. A source's target stops at ``limit`` times its size; what is over is shared anew by
weight among the others until no target is above its limit.

Every row draws a key by a hash of its id, its size and, among equal rows, its number. A
source's rows are cut into ranges of the key, sorted within each range, and their sizes
are summed up: inside the ranges in parallel, ahead of them over one total per range. Whole
epochs of a source are taken as long as its target holds them; of the last epoch the rows
in front are taken, up to exactly the target rounded to whole words, so the row at the cut
gives its first words only.

Bounds: a range holds at most about ``RANGE_ROWS`` rows, whatever a source's share of the table; a source has
``LEAST_RANGES`` of them as soon as they hold a thousand rows each.
Rows with the same id and size are numbered per part of the written table, so that a group
of equal rows spreads over all ranges. Only three sums per round of sharing reach the driver.

Edge cases: a null or empty text has size 0 and is taken 0 times, a source of such texts has
the target 0; a null source is a source of its own; null ids draw keys as well; equal rows
are counted and taken one by one, and the result is the same in every run, as equal rows can
stand for each other; an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, written
from ledgerloom.operators.dimensional import dense_key

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
LIMIT = 2
RANGE_ROWS = 50_000
LEAST_RANGES = 64
SPACE = 1 << 32


def _whole(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def weighted(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size, source_rows) with the weight of each source by its place in code-point order."""
    named = dense_key(sizes.where("source is not null"), "source", "place", "sources")
    last = sizes.where("source is null").withColumn("place", F.lit(named.count() + 1))
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.get(cycle, ((F.col("place") - 1) % len(weights)).cast("int")).cast("long").alias("weight")
    return named.unionByName(last).select("place", "source", "source_size", "source_rows", weight)


def targets(sources: DataFrame, share_percent: int = SHARE_PERCENT, limit: int = LIMIT) -> DataFrame:
    """``sources`` with ``target``, the words that the mix shall take of each.

    All comparisons are in whole numbers. In each round those above their limit leave with it and
    the rest share what is left; shares only grow, so nobody comes back, and the loop ends
    with the first round in which nobody leaves.
    """
    size, weight = F.col("source_size").cast("decimal(20,0)"), F.col("weight").cast("decimal(10,0)")
    above, out = F.lit(False), -1
    while True:
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("source_size")).otherwise(0)).alias("held"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(above.cast("long")).alias("out"),
        ).first()
        # a source's share is its weight times part / whole
        part = share_percent * (row["all"] or 0) - 100 * limit * (row["held"] or 0)
        whole = 100 * max(row["open"] or 0, 1)
        share = weight * _whole(part)
        if (row["out"] or 0) == out:
            break
        above, out = share > size * _whole(limit * whole), row["out"] or 0
    target = F.when(above, (size * limit).cast("double")).otherwise(share.cast("double") / F.lit(float(whole)))
    return sources.withColumn("target", target)


def _numbered(rows: DataFrame) -> DataFrame:
    """``rid, number``: the place of a row among those of its source with the same id and size; first rows may lack.

    Rows of a group are counted per part of the written table, so a group of any size is numbered in parallel.
    """
    same = ["place", "who", "size"]
    repeated = written(rows.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    if repeated.isEmpty():
        return None
    repeats = rows.join(repeated, same).select("rid", *same, F.shiftright("rid", 33).alias("part"))
    ahead = Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = repeats.groupBy(*same, "part").agg(F.count("*").alias("n"))
    per_part = per_part.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy(*same, "part").orderBy("rid")) - 1
    counted = repeats.withColumn("inside", inside).join(per_part, [*same, "part"])
    return counted.select("rid", (F.col("ahead") + F.col("inside")).alias("number"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, limit: int = LIMIT
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every row.

    ``taken`` is the number of words that the mix takes of the document, repeats counted: whole
    epochs of its source first, then the document again, whole, in part or not.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    slim = docs.select("doc_id", "source", size.alias("size"))
    rows = written(slim.withColumn("rid", F.monotonically_increasing_id()), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    sources = written(weighted(written(sizes, "sources"), weights), "weighted")
    sources = targets(sources, share_percent, limit)

    who = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = rows.withColumnRenamed("source", "named").join(sources, F.col("named").eqNullSafe(F.col("source")))
    placed = placed.drop("named").withColumn("who", who)
    numbers = _numbered(placed)
    if numbers is None:
        numbered = placed.withColumn("number", F.lit(0).cast("long"))
    else:
        numbered = placed.join(numbers, "rid", "left").fillna(0, ["number"])
    draw = F.md5(F.concat_ws(":", "who", "size", "number"))
    first = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    ranges = F.expr(f"least(1 + source_rows div 1000, {LEAST_RANGES} + source_rows div {RANGE_ROWS})")
    keyed = numbered.withColumn("draw", draw).withColumn("range", F.floor(first * ranges / F.lit(SPACE)))

    ahead = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("place", "range").agg(F.sum("size").alias("total"))
    totals = totals.withColumn("ahead", F.coalesce(F.sum("total").over(ahead), F.lit(0))).drop("total")
    inside = Window.partitionBy("place", "range").orderBy("draw", "who", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["place", "range"])

    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0)
    left = budget - epochs * F.col("source_size") - F.col("ahead") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return summed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
