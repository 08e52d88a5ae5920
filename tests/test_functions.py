from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.functions import dates, text


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_strip_removes_every_kind_of_white_space(spark):
    values = ["  a b ", "\ta\n", " a　", "\x1fa", " \t ", "", None]
    assert apply(spark, text.strip_text, values) == ["a b", "a", "a", "a", "", "", None]


def test_capitalize_lowers_all_but_the_first_character(spark):
    values = ["united STATES", "ñandú", "", None, "x"]
    assert apply(spark, text.capitalize_first, values) == ["United states", "Ñandú", "", None, "X"]


def test_numbers_are_plain_decimals_only(spark):
    values = ["45.00", " 7 ", "1e3", "-1", ".5", "2.", "+3", "1d", "nan", "inf", "two", "", "1,5", "1e400", "-1e400", None]
    expected = [45.0, 7.0, 1000.0, -1.0, 0.5, 2.0, 3.0] + [None] * 9
    assert apply(spark, text.to_number, values) == expected


def test_decimal_comma_and_truncation(spark):
    assert apply(spark, lambda c: text.to_number(text.decimal_point(c)), ["45,00"]) == [45.0]
    assert apply(spark, text.to_whole, [1.9, 0.5, -1.9, 1e30, None], "double") == [1, 0, -1, None, None]


MIXED = (
    [
        ("2026-08-01", date(2026, 8, 1), date(2026, 1, 8)),
        ("2026/08/02", date(2026, 8, 2), date(2026, 2, 8)),
        ("2026-08-25", date(2026, 8, 25), date(2026, 8, 25)),
        ("02-08-2026", date(2026, 8, 2), date(2026, 8, 2)),
        ("12/25/2026", date(2026, 12, 25), date(2026, 12, 25)),
        ("1.9.2026", date(2026, 9, 1), date(2026, 9, 1)),
        ("20260802", date(2026, 8, 2), date(2026, 8, 2)),
        ("2026-08-25 10:30:00", date(2026, 8, 25), date(2026, 8, 25)),
        ("2 Aug 2026", date(2026, 8, 2), date(2026, 8, 2)),
        ("2 august 2026", date(2026, 8, 2), date(2026, 8, 2)),
        ("August 12, 2026", date(2026, 8, 12), date(2026, 8, 12)),
        ("31-04-2026", None, None),
        ("2026-02-30", None, None),
        ("not_a_date", None, None),
        ("2026", date(2026, 1, 1), date(2026, 1, 1)),
        ("1st August 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("August 1st, 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("the 1st of August 2026", None, None),
        ("1st of August 2026 10:00 am", date(2026, 8, 1), date(2026, 8, 1)),
        ("Aug-1-26", date(2026, 8, 1), date(2026, 8, 1)),
        ("2026-Aug-01", date(2026, 8, 1), date(2026, 8, 1)),
        ("2026 01 Aug", date(2026, 8, 1), date(2026, 8, 1)),
        ("98-Feb-01", date(1998, 2, 1), date(1998, 2, 1)),
        ("Aug 2026 1", date(2026, 8, 1), date(2026, 8, 1)),
        ("8/2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("13/2026", None, None),
        ("20260801T1000", date(2026, 8, 1), date(2026, 8, 1)),
        ("20260801 100000", date(2026, 8, 1), date(2026, 8, 1)),
        ("2026-08-01 10", date(2026, 8, 1), date(2026, 1, 8)),
        ("2026-08-01 25", None, None),
        ("1 8 26 10", None, None),
        ("2026-08-01 10:00 EST", date(2026, 8, 1), date(2026, 1, 8)),
        ("1 Aug 2026 10:00:00 -0500", date(2026, 8, 1), date(2026, 8, 1)),
        ("Sat Aug  1 10:00:00 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("Sat Aug  1 10:00:00 UTC 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("10:00 1 Aug 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("\t2026-08-01\n", date(2026, 8, 1), date(2026, 1, 8)),
        ("1\tAug\n2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("August", None, None),
        ("32 Aug 2026", None, None),
        ("2026-08-01-01", None, None),
        ("-2026-08-01", None, None),
        ("2026-08-01 later", None, None),
        ("2 Augenblick 2026", None, None),
        ("02/08/26", date(2026, 8, 2), date(2026, 8, 2)),
        ("02/08/98", date(1998, 8, 2), date(1998, 8, 2)),
        ("1-Aug-26", date(2026, 8, 1), date(2026, 8, 1)),
        ("2 Sept 2026", date(2026, 9, 2), date(2026, 9, 2)),
        (" 2026-08-01 ", date(2026, 8, 1), date(2026, 1, 8)),
        ("2026-08-01 10:00 PM", date(2026, 8, 1), date(2026, 1, 8)),
        ("2026-08-01T10:00:00Z", date(2026, 8, 1), date(2026, 1, 8)),
        ("2026-08-01T10:00:00.5+02:00", date(2026, 8, 1), date(2026, 1, 8)),
        ("Saturday, 1 August 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("2026-08", date(2026, 8, 1), date(2026, 8, 1)),
        ("Aug 2026", date(2026, 8, 1), date(2026, 8, 1)),
        ("2026-13", None, None),
        ("10:30", None, None),
        ("", None, None),
        (None, None, None),
    ]
)


@pytest.fixture(scope="module")
def mixed_dates(spark):
    """All notations read at once, plain and with year-first ones day-first."""
    written = [w for w, _, _ in MIXED]
    plain = apply(spark, dates.parse_mixed_date, written)
    swapped = apply(spark, lambda c: dates.parse_mixed_date(c, True), written)
    return dict(zip(written, zip(plain, swapped, strict=True), strict=True))


@pytest.mark.parametrize(("written", "plain", "swapped"), MIXED)
def test_mixed_dates(mixed_dates, written, plain, swapped):
    assert mixed_dates[written] == (plain, swapped)


def test_iso_dates_and_timestamps_are_strict(spark):
    values = ["2026-10-01", "2026-02-30", "2026-1-1", "2026-10-01 00:00:00", "01/10/2026", "2026-10-01\n", None]
    assert apply(spark, dates.iso_date, values) == [date(2026, 10, 1)] + [None] * 6
    stamps = ["2026-10-01 09:15:00", "2026-10-01 09:15:00\n", "2026-10-01", "not_a_timestamp", "2026-10-01 25:00:00", None]
    assert apply(spark, dates.iso_timestamp, stamps) == [datetime(2026, 10, 1, 9, 15)] + [None] * 5


def test_strict_reading_fails_on_a_bad_text(spark):
    with pytest.raises(PySparkException):
        apply(spark, lambda c: F.to_date(c, "yyyy-MM-dd"), ["2026-02-30"])


def test_calendar_attributes(spark):
    df = spark.sql("SELECT date'2026-08-01' AS d")
    named = {name: c.alias(name) for name, c in dates.calendar_attributes(F.col("d")).items()}
    row = df.select(dates.date_key(F.col("d")).alias("key"), *named.values()).first()
    assert tuple(row) == (20260801, 1, 8, "August", 3, 2026, 5, "Saturday", True)


def test_common_dates_are_read_as_by_their_tokens(spark):
    from ledgerloom.functions import dates

    days, months = ["1", "02", "13", "31", "32", "45", "00"], ["2", "08", "13", "40", "feb", "June", "sept", "AUGUST", "febr"]
    texts = [a + s + b + t + y for a in days for b in months for y in ("2026", "26", "01", "1900") for s, t in ("//", "-.", "  ", "- ")]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4).localCheckpoint()
    read = lambda: [r[0] for r in df.select(dates.parse_mixed_date(F.col("t"))).collect()]
    shape, found = dates._DAY_MONTH_YEAR, read()
    assert df.filter(F.lower("t").rlike(shape)).count() > len(texts) // 3
    try:
        dates._DAY_MONTH_YEAR = r"^never\z"
        assert read() == found
    finally:
        dates._DAY_MONTH_YEAR = shape
    assert sum(d is None for d in found) not in (0, len(found))


def test_whole_numbers_are_cast_only_in_range(spark):
    numbers = [1.9, -1.9, 0.0, 2.0**63, -(2.0**63), 1e30, -1e30, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    plain = [r[0] for r in df.select(F.col("n").try_cast("bigint")).collect()]
    assert [r[0] for r in df.select(text.to_whole(F.col("n"))).collect()] == plain
    assert "CASE WHEN" in text.to_whole(F.col("n"))._jc.toString()
