"""CSV in and out. Everything is read as text; types are a later, checked step."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

logger = logging.getLogger(__name__)

# The words that count as a missing value in a CSV field.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_BROKEN = "_broken_record"


def na_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace the missing-value words by null in text columns."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) for c in columns or df.columns}
    )


def read_csv(spark: SparkSession, path: str, on_empty: str = "raise") -> DataFrame:
    """Read a CSV file or folder with a header line, every column as STRING.

    A missing path raises ``FileNotFoundError`` and a file without any content
    ``ValueError``. A header without rows raises, warns or passes, as
    ``on_empty`` says.

    Nothing is altered silently: ``ValueError`` is raised for lines that are not UTF-8, with the
    name of their file, for a header that names a column twice, for headers that differ, and for rows that have more
    fields than the header; a row with fewer fields is filled up with nulls.

    Files are shared by tasks, however large. Only a file with a line whose quotes do not pair up may hold
    line breaks inside quotes, and is read by one task; a pass over the lines tells which.
    """
    if on_empty not in ("raise", "warn", "pass"):
        raise ValueError(f"on_empty must be raise, warn or pass, not {on_empty!r}")
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input not found: {path}") from error
        raise
    sources = _sources(lines, path)

    def reader(multiline: bool) -> DataFrameReader:
        options = {"header": True, "escape": '"', "multiLine": multiline, "enforceSchema": False}
        return spark.read.options(**options)

    first = reader(sources[0][0]).csv(sources[0][1])
    if not first.columns:
        raise ValueError(f"Input holds no readable data: {path}")
    _require_distinct(reader(sources[0][0]).option("header", False).csv(sources[0][1]).first(), path)
    rows = sum(_checked_rows(reader(multiline), first.schema, files, path) for multiline, files in sources)
    if on_empty != "pass" and not rows:
        if on_empty == "raise":
            raise ValueError(f"Input is empty: {path}")
        logger.warning("Input is empty: %s", path)
    frames = [first, *[reader(multiline).schema(first.schema).csv(files) for multiline, files in sources[1:]]]
    return na_to_null(reduce(DataFrame.unionByName, frames))


def _sources(lines: DataFrame, path: str) -> list[tuple[bool, str | list[str]]]:
    """Whether to read line breaks inside quotes, and the files: all of them alike, or two lists.

    Raises for bytes that are no UTF-8. The text source hands out the bytes of each line as they are.
    """
    unpaired = F.regexp_count("value", F.lit('"')) % 2 == 1
    files = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count_if(~F.is_valid_utf8("value")).alias("broken"), F.count_if(unpaired).alias("unpaired")
    )
    special = files.where("broken > 0 or unpaired > 0").collect()  # no more than the files that the driver has listed
    broken = sorted((_plain_name(r["file"]), r["broken"]) for r in special if r["broken"])
    if broken:
        name, count = broken[0]
        raise ValueError(f"{count} lines of {name} are not UTF-8 (files with such lines: {len(broken)})")
    quoted = {_plain_name(r["file"]) for r in special}
    names = [_plain_name(f) for f in lines.inputFiles()]
    plain = [f for f in names if f not in quoted]
    if not quoted or not plain:
        return [(bool(quoted), path)]
    return sorted([(False, plain), (True, [f for f in names if f in quoted])], key=lambda s: names.index(s[1][0]))


def _plain_name(uri: str) -> str:
    """A file's URI as a path; Spark writes local ones with one slash or three."""
    return unquote(uri).replace("file:///", "file:/", 1)


def _require_distinct(header: Row | None, path: str) -> None:
    """Spark would number the columns and then find that the header differs."""
    names = Counter(name.lower() for name in header or () if name is not None)
    repeated = [name for name, n in names.items() if n > 1]
    if repeated:
        raise ValueError(f"The header names columns more than once: {', '.join(repeated)}: {path}")


def _checked_rows(reader: DataFrameReader, schema: T.StructType, files: str | list[str], path: str) -> int:
    """Row count; raises if a header differs from the first one or a row has too many fields."""
    whole = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    # All columns are parsed, as pruned ones are not compared with the header.
    df = reader.options(columnNameOfCorruptRecord=_BROKEN, columnPruning=False).schema(whole).csv(files)
    # Commas outside quotes; a record of another length than the header counts as broken.
    bare = F.regexp_replace(_BROKEN, '"[^"]*"', "")
    too_many = F.regexp_count(bare, F.lit(",")) >= len(schema)
    first = F.coalesce(F.length(F.col(f"`{schema[0].name}`")), F.lit(0)) >= 0
    try:
        rows, long = df.agg(F.count("*"), F.count_if(first & F.coalesce(too_many, F.lit(False)))).first()
    except (PySparkException, Py4JJavaError) as error:
        if "CSV header does not conform" in str(error) or "Number of column in CSV header" in str(error):
            raise ValueError(f"Files differ in their headers: {path}") from error
        raise
    if long:
        raise ValueError(f"{long} rows have more fields than the {len(schema)} of the header: {path}")
    return rows


def write_csv(df: DataFrame, path: str) -> None:
    """Write a folder of CSV part files with header lines, replacing it."""
    df.write.mode("overwrite").option("header", True).csv(path)
