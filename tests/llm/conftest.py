from __future__ import annotations

import pytest

from ledgerloom.llm.common import configure

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark, tmp_path):
    """A ``documents`` table from (id, text) or (id, text, lang), with extra columns whose names clash with inner ones."""
    configure(spark)

    def make(rows, stored=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        docs = spark.createDataFrame(full, SCHEMA)
        for name in ("rid", "label", "value", "key", "keys", "block", "n", "h", "mark", "deal", "found", "_row_key", "_stays", "score"):
            docs = docs.selectExpr("*", f"cast(null as string) as {name}")
        if stored:
            docs.write.mode("overwrite").parquet(str(tmp_path / "documents"))
            docs = spark.read.parquet(str(tmp_path / "documents"))
        return docs

    return make


@pytest.fixture(scope="session")
def sf(spark):
    import os

    configure(spark)
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("needs the test tables")
    return folder
