"""Column functions that clean text and turn it into numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A plain decimal number, optionally with an exponent and space around. Words such as "nan",
# "inf" and suffixed literals such as "1d" are not numbers in a sales file.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip_text(text: Column) -> Column:
    """Remove white space of every kind from both ends; inner space stays."""
    return F.btrim(text.cast("string"), F.lit(_WHITE_SPACE))


def capitalize_first(text: Column) -> Column:
    """First character upper case, everything after it lower case."""
    return F.concat(
        F.upper(F.substring(text, 1, 1)),
        F.lower(F.substring(text, F.lit(2), F.length(text))),
    )


def decimal_point(text: Column) -> Column:
    """Write decimal commas as decimal points."""
    return F.replace(text.cast("string"), F.lit(","), F.lit("."))


def to_number(text: Column) -> Column:
    """Parse a number as DOUBLE; what is no number, or too large for one, becomes null."""
    return finite(F.when(text.rlike(_NUMBER), text.try_cast("double")))


def finite(number: Column) -> Column:
    """Null in place of infinity."""
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def to_whole(number: Column) -> Column:
    """Cut the fraction off (1.9 becomes 1); null when out of range.

    The range is looked at first: a cast that fails throws inside Spark.
    """
    return F.when(number.between(-(2.0**63), 2.0**63), number.try_cast("bigint"))
