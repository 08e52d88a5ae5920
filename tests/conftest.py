from __future__ import annotations

import csv
import io

import pytest

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "ledgerloom-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Make a table of text columns from CSV text; empty fields are null."""

    def make(text: str):
        rows = list(csv.reader(io.StringIO(text)))
        schema = ", ".join(f"{c} string" for c in rows[0])
        return spark.createDataFrame([[v or None for v in r] for r in rows[1:]], schema)

    return make


@pytest.fixture
def rows():
    """The rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted([tuple(r) for r in chosen.collect()], key=repr)

    return collect
