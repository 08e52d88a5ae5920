"""Running sums, ranks and previous values that survive a hot group.

A plain window sorts each group in one task. Here every group is cut into
slices, and a window runs per (group, slice). What the earlier slices add up to
travels as one extra *carry* row that sorts before the rows of its slice, so
there is no join back and null keys need no special care. The rows are read
twice: for the carries and for the result.

``slices`` lists functions from fine to coarse. Each maps its order value to a
slice value and must never step backwards as the order value grows, such as the
hour of a timestamp. One task sorts the rows of one slice of a group, so the
finest slice decides how much a task holds. ``quantile_slices`` draws bounds for any column. One function is enough while a group
has few slices, as hours of a few years; with more, the carries are computed the
same way over the coarser ones, at the price of another pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Slice = Callable[[Column], Column]

_SLICE = "_slice"
_KIND = "_kind"  # 0 = carry row, 1 = row of the input


def time_slices(*units: str) -> list[Slice]:
    """Slices of a date or timestamp, for example ``time_slices("HOUR", "MONTH")``."""
    return [lambda value, unit=unit: F.date_trunc(unit, value) for unit in units]


def width_slices(*widths: int) -> list[Slice]:
    """Slices of a whole number, given their widths from narrow to wide."""
    return [lambda value, width=width: F.floor(value / width) for width in widths]


def quantile_slices(df: DataFrame, column: str, rows: int = 1_000_000, most: int = 512) -> list[Slice]:
    """Slices of any column that can be sorted, also text, of about ``rows`` rows of ``df`` each.

    Their bounds are values drawn once, those of the rows with the smallest hashes, so the draw is
    repeatable. A value that many rows share gets a slice of its own; nulls are in the lowest one.
    """
    wanted = min(most, df.count() // rows + 1)
    if wanted == 1:
        return []
    draw = df.where(F.col(column).isNotNull()).select(column, F.xxhash64(*df.columns).alias("_draw"))
    drawn = draw.orderBy("_draw", column).limit(32 * wanted)
    values = [r[0] for r in drawn.orderBy(column).collect()]
    bounds = list(dict.fromkeys(values[i * len(values) // wanted] for i in range(1, wanted))) if values else []
    if not bounds:
        return []
    # The value after a bound starts a slice too, so that a bound shared by many rows stands alone.
    at_most = F.array(*[F.lit(b) for b in bounds])

    def place(value: Column) -> Column:
        below = F.size(F.filter(at_most, lambda b: b <= value))
        above = F.size(F.filter(at_most, lambda b: b < value))
        return F.when(value.isNull(), 0).otherwise(below + above)

    return [place]


def _sorted_by(columns: Sequence[str], descending: bool) -> list[Column]:
    if descending:
        return [F.col(c).desc_nulls_last() for c in columns]
    return [F.col(c).asc_nulls_first() for c in columns]


def _add_carries(rows: DataFrame, carries: DataFrame) -> DataFrame:
    """Rows and carry rows together; columns that carries lack are null."""
    return rows.withColumn(_KIND, F.lit(1)).unionByName(
        carries.withColumn(_KIND, F.lit(0)), allowMissingColumns=True
    )


def _take_rows(df: DataFrame, *helpers: str) -> DataFrame:
    return df.filter(F.col(_KIND) == 1).drop(_KIND, _SLICE, *helpers)


def _running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    slices: Sequence[Slice],
    descending: bool,
    last: int,
) -> DataFrame:
    """Add running sums; ``last`` is 0 to include the row itself, -1 not to.

    ``sums`` maps a new column to the column it adds up.
    """
    ordering = _sorted_by(order, descending)
    if not slices:
        frame = Window.partitionBy(*group).orderBy(*ordering)
        frame = frame.rowsBetween(Window.unboundedPreceding, last)
        return df.withColumns({new: F.sum(old).over(frame) for new, old in sums.items()})

    rows = df.withColumn(_SLICE, slices[0](F.col(order[0])))
    totals = rows.groupBy(*group, _SLICE).agg(*[F.sum(old).alias(old) for old in sums.values()])
    totals = totals.withColumnRenamed(_SLICE, "_at")
    before = {f"_before_{old}": old for old in sums.values()}
    carries = _running(totals, group, ["_at"], before, slices[1:], descending, -1).select(
        *group,
        F.col("_at").alias(_SLICE),
        *[F.col(new).alias(old) for new, old in before.items()],
    )
    frame = Window.partitionBy(*group, _SLICE).orderBy(_KIND, *ordering)
    frame = frame.rowsBetween(Window.unboundedPreceding, last)
    both = _add_carries(rows, carries)
    return _take_rows(
        both.withColumns({new: F.sum(old).over(frame) for new, old in sums.items()})
    )


def running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    slices: Sequence[Slice] = (),
) -> DataFrame:
    """Sum of ``value`` over the rows of the group up to and including this one.

    ``order`` must order the rows of a group totally. Row frames are used, so
    rows equal in the first order column still get sums of their own.
    """
    return _running(df, group, order, {name: value}, slices, False, 0)


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    tie_slice: Slice | None = None,
    descending: bool = True,
) -> DataFrame:
    """Add ``row_number``, ``rank`` and ``dense_rank`` within each group.

    Rows equal in ``order`` share a rank; ``ties`` orders them for the row number.
    ``tie_slice`` cuts the rows of one rank by their first tie column, so that a
    task sorts the rows of one (group, order, slice); what comes before them is
    counted first.
    """
    ordering, tie_order = _sorted_by(order, descending), _sorted_by(ties, False)
    if tie_slice is None:
        rank_frame = Window.partitionBy(*group).orderBy(*ordering)
        row_frame = Window.partitionBy(*group).orderBy(*ordering, *tie_order)
        return df.withColumns(
            {
                "row_number": F.row_number().over(row_frame),
                "rank": F.rank().over(rank_frame),
                "dense_rank": F.dense_rank().over(rank_frame),
            }
        )

    rows = df.withColumn(_SLICE, tie_slice(F.col(ties[0])))
    counts = rows.groupBy(*group, *order, _SLICE).agg(F.count("*").alias("_rows"))
    by_value = Window.partitionBy(*group).orderBy(*ordering)
    by_slice = Window.partitionBy(*group).orderBy(*ordering, *_sorted_by([_SLICE], False))
    before = F.sum("_rows").over(by_slice.rowsBetween(Window.unboundedPreceding, -1))
    carries = counts.select(
        *group,
        *order,
        _SLICE,
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.dense_rank().over(by_value).alias("_dense"),
    )
    same = Window.partitionBy(*group, *order)
    carries = carries.withColumn("_rank", F.min("_before").over(same) + 1)
    # The carry row comes first and counts as one row.
    row_frame = Window.partitionBy(*group, *order, _SLICE).orderBy(_KIND, *tie_order)
    carried = {"rank": "_rank", "dense_rank": "_dense"}
    both = _add_carries(rows, carries).withColumns(
        {
            "row_number": F.row_number().over(row_frame) - 1 + F.first("_before").over(row_frame),
            **{name: F.first(c).over(row_frame) for name, c in carried.items()},
        }
    )
    return _take_rows(both, "_before", *carried.values())


def previous_values(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    slices: Sequence[Slice] = (),
    prefix: str = "previous_",
) -> DataFrame:
    """Add the values the previous row of the group holds; null on its first row."""
    packed = df.withColumn("_held", F.struct(*columns))
    found = _previous(packed, group, order, slices)
    return found.withColumns({prefix + c: F.col("_previous")[c] for c in columns}).drop(
        "_held", "_previous"
    )


def _previous(
    df: DataFrame, group: Sequence[str], order: Sequence[str], slices: Sequence[Slice]
) -> DataFrame:
    ordering = _sorted_by(order, False)
    if not slices:
        frame = Window.partitionBy(*group).orderBy(*ordering)
        return df.withColumn("_previous", F.lag("_held").over(frame))

    rows = df.withColumn(_SLICE, slices[0](F.col(order[0])))
    # Each task keeps the last row of a slice before anything is shuffled.
    latest = Window.partitionBy(*group, _SLICE).orderBy(
        *[F.col(c).desc_nulls_last() for c in order]
    )
    lasts = rows.withColumn("_n", F.row_number().over(latest)).filter("_n = 1")
    lasts = lasts.select(*group, F.col(_SLICE).alias("_at"), "_held")
    carries = _previous(lasts, group, ["_at"], slices[1:]).select(
        *group, F.col("_at").alias(_SLICE), F.col("_previous").alias("_held")
    )
    frame = Window.partitionBy(*group, _SLICE).orderBy(_KIND, *ordering)
    both = _add_carries(rows, carries).withColumn("_previous", F.lag("_held").over(frame))
    return _take_rows(both)


def changed(current: Column, previous: Column) -> Column:
    """True where a value differs from its previous one; never null."""
    return F.coalesce(current != previous, F.lit(False))
