"""Column functions that parse dates and derive calendar attributes.

Text is checked by shape before it is parsed. A parser that meets text of
another shape throws inside Spark, which costs many times the check.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
# What is parsed ends with its last digit: "$" would let a line break follow.
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
_ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"

# White space that may stand around a date or between its parts.
_BLANKS = " \t\n\r\x0b\x0c"

# English month names, in full or cut short.
_MONTH_NAMES = (
    "(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?"
    "|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)"
)
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

# Day, month and year, the most common order. A number over 31 in front may be a year; else the classes of
# the tokens below would come to the same readings.
_DAY_MONTH_YEAR = rf"^([0-2]?\d|3[01])[-/. ](\d{{1,2}}|{_MONTH_NAMES})[-/. ](\d{{4}}|\d{{2}})\z"

# What does not change the date. A zone is a short word or an offset behind a time of day.
_WEEKDAY = r"^(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?[., ]+"
_ZONE = rf"( ?(z|(?!{_MONTH_NAMES}\b)[a-z]{{3,5}}\b|[+-]\d{{2}}(:?\d{{2}})?))?"
_TIME_OF_DAY = rf"(^|[ ,]+|(?<=\d)t)\d{{1,2}}:\d{{2}}(:\d{{2}}([.,]\d+)?)?( ?[ap]m\b)?{_ZONE}(?=[ ,]|\z)"
_HOUR = r"(?<=^\d{4}[-/.]\d{2}[-/.]\d{2})[ t]([01]?\d|2[0-3])\z"
_COMPACT_TIME = r"(?<=^\d{8})[ t]?\d{2}(\d{2}(\d{2})?)?\z"
_ORDINAL = r"(?<=\d)(st|nd|rd|th)\b( of\b)?"

# Token classes in a date whose parts are separated by dashes: M month name, C whole date, Y year, y number
# that can only be a year, n day, month or year of two digits.
_CLASSES = {rf"\b{_MONTH_NAMES}\b": "M", r"\b\d{8}\b": "C", r"\b\d{4}\b": "Y", r"\b(3[2-9]|[4-9]\d)\b": "y", r"\b\d{1,2}\b": "n"}
# Places of year, month and day by the classes of the tokens; readings in the order of their preference.
# A date without a day or month is the first one.
_READINGS = {
    "Y-n-n": [(0, 1, 2)],
    "n-n-Y": [(2, 1, 0), (2, 0, 1)],
    "n-n-n": [(2, 1, 0), (2, 0, 1)],
    "n-n-y": [(2, 1, 0), (2, 0, 1)],
    "n-M-Y": [(2, 1, 0)],
    "n-M-n": [(2, 1, 0)],
    "n-M-y": [(2, 1, 0)],
    "M-n-Y": [(2, 0, 1)],
    "M-n-n": [(2, 0, 1)],
    "M-n-y": [(2, 0, 1)],
    "M-Y-n": [(1, 0, 2)],
    "Y-M-n": [(0, 1, 2)],
    "Y-n-M": [(0, 2, 1)],
    "y-M-n": [(0, 1, 2)],
    "Y-n": [(0, 1, None)],
    "n-Y": [(1, 0, None)],
    "Y-M": [(0, 1, None)],
    "M-Y": [(1, 0, None)],
    "Y": [(0, None, None)],
}
# A two-digit year from this on belongs to the 1900s.
_CENTURY_FROM = 76


def looks_iso(text: Column) -> Column:
    return text.rlike(ISO_DATE_SHAPE)


def iso_date(text: Column) -> Column:
    """Strict ``yyyy-MM-dd``; anything else, and impossible days, become null."""
    return F.when(text.rlike(_ISO_DATE), text.try_cast("date"))


def iso_timestamp(text: Column) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss``; anything else becomes null."""
    return F.when(text.rlike(_ISO_TIMESTAMP), text.try_cast("timestamp"))


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def _year(text: Column) -> Column:
    century = F.when(text >= str(_CENTURY_FROM), "19").otherwise("20")
    return F.when(F.length(text) == 2, F.concat(century, text)).otherwise(text)


def _month(name: Column) -> Column:
    """Number of a month, given by number or name."""
    number = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.substring(name, 1, 3))
    return F.when(number > 0, number.cast("string")).otherwise(name)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bare(day: Column) -> Column:
    """Lower-case text without weekday, time of day, zone and ordinal endings."""
    for pattern in (_WEEKDAY, _TIME_OF_DAY, _HOUR, _COMPACT_TIME, _ORDINAL):
        day = F.regexp_replace(day, pattern, "")
    return F.btrim(day, F.lit(_BLANKS + ","))


def parse_mixed_date(text: Column, iso_day_first: bool = False) -> Column:
    """Parse dates written in several notations; unreadable ones become null.

    What does not change the date is taken away: white space around it, a weekday, a time of day with
    or without a zone, ordinal endings as in ``1st of August``. The rest is cut at dashes, slashes, points, commas and
    spaces into tokens, which are month names, years of four digits, numbers over 31, that can only be years, or
    numbers up to 31; the classes of the tokens decide which is year, month and day.

    Year-last notations are day-first (``02-08-2026`` is the second of August)
    and fall back to month-first when the day-first reading is impossible.
    Year-first notations are year-month-day. ``iso_day_first=True`` reads them
    as year-day-month first, for files that were written that way round.
    A month name settles which token is the month: ``2 Aug 2026``, ``August 2nd, 2026``, ``2026-Aug-02``.
    ``20260802`` is read too; ``2026-08``, ``8/2026`` and ``Aug 2026`` are the first of the
    month, ``2026`` is the first of the year. Two-digit years from 76 on are 19xx.
    """
    def read(written: Column) -> Column:
        shape = written
        for pattern, name in _CLASSES.items():
            shape = F.regexp_replace(shape, pattern, name)

        def resolve(found: Column) -> Column:
            def at(place: int | None) -> Column:
                return F.lit("1") if place is None else F.get(found["tokens"], place)

            result = F.when(found["shape"] == "C", _date(*[F.substring(written, *cut) for cut in ((1, 4), (5, 2), (7, 2))]))
            for kind, readings in _READINGS.items():
                tried = readings
                if iso_day_first and kind == "Y-n-n":
                    tried = [(0, 2, 1), *readings]
                dates = [_date(_year(at(y)), _month(at(m)) if "M" in kind else at(m), at(d)) for y, m, d in tried]
                result = result.when(found["shape"] == kind, F.coalesce(*dates))
            return result

        return _let(F.struct(F.split(written, "-").alias("tokens"), shape.alias("shape")), resolve)

    def read_plain(tokens: Column) -> Column:
        first, second, year = (F.get(tokens, i) for i in range(3))
        return F.coalesce(_date(_year(year), _month(second), first), _date(_year(year), first, second))

    def parse(day: Column) -> Column:
        # Only letters, colons and blanks tell of more than numbers and separators.
        bare = F.when(day.rlike("[a-z: ]"), _bare(day)).otherwise(day)
        iso = day.try_cast("date")
        if iso_day_first:
            iso = F.coalesce(_date(F.substring(day, 1, 4), F.substring(day, 9, 2), F.substring(day, 6, 2)), iso)
        other = _let(F.regexp_replace(bare, r"[-/.,\s]+", "-"), read)
        plain = _let(F.split(day, "[-/. ]"), read_plain)
        return F.when(day.rlike(_ISO_DATE), iso).when(day.rlike(_DAY_MONTH_YEAR), plain).otherwise(other)

    return _let(F.lower(F.btrim(text, F.lit(_BLANKS))), parse)


def date_key(day: Column) -> Column:
    """The date as the integer ``yyyymmdd``."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Date-dimension attributes, weeks starting on Monday = 0."""
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "day_of_week_num": F.weekday(day),
        "day_of_week_name": F.date_format(day, "EEEE"),
        "is_weekend": F.weekday(day) >= 5,
    }
