import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality_rules as q
from ledgerloom.llm.queries import ORACLES, QUERIES


def expected(text):
    """The base measures in plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    base = (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )
    return (*base, base[0] < 10 or 100 * base[4] > 20 * base[0])


def texts():
    r = random.Random(5)
    some = [" ".join(r.choice("ab") for _ in range(r.randint(0, 30))) for _ in range(60)]
    some += ["\n".join(r.choice(["a b", "x", " ", "#é|\v<"]) for _ in range(r.randint(0, 12))) for _ in range(40)]
    return [None, "", " \n\t ", "a b c d e a b c d e", "ÀÉ " * 40, "w" * 100_000, "Ab, c 😀 d\x0be"] + some + some[:5]


def test_measures_against_plain_python(documents):
    docs = documents(list(enumerate(texts())))
    found = {r["doc_id"]: r for r in q.judge(docs, q.RULES).collect()}
    for i, text in enumerate(texts()):
        assert tuple(found[i][c] for c in (*q.BASE, "base_failed")) == expected(text), text
        assert not (found[i]["kept"] and found[i]["base_failed"])


def test_order_never_changes_the_verdict(documents):
    docs = documents(list(enumerate(texts())))
    profiles = q.profile(docs, sample_rows=50)
    verdicts = [
        sorted(tuple(r) for r in q.judge(docs, rules).collect())
        for rules in (q.cascade(profiles), q.RULES, q.RULES[::-1])
    ]
    assert verdicts[0] == verdicts[1] == verdicts[2]
    kept = {r["doc_id"] for r in q.keep(docs, q.cascade(profiles)).collect()}
    assert kept == {v[0] for v in verdicts[0] if v[-1]}
    assert q.keep(docs, q.RULES).columns == docs.columns


def test_lines_that_repeat_reject_a_text_from_three_on(documents):
    lines = [f"line{i} says this{i}" for i in range(9)]
    two = [*lines, lines[0], "apart from them", lines[1]]
    three = [*two, "and once more", lines[2]]
    half = [x for i, line in enumerate(lines[:4]) for x in (line, f"between {i} {i}", line)]
    rows = [(i, "\n".join(x)) for i, x in enumerate((two, two[3:], three, three[4:], half))]
    kept = {r["doc_id"]: (r["n_dup_lines"], r["kept"]) for r in q.judge(documents(rows), q.RULES).collect()}
    assert kept == {0: (2, True), 1: (0, True), 2: (3, True), 3: (0, True), 4: (4, False)}


def test_most_rejections_per_second_first():
    cheap, dear, idle = q.Rule("cheap", None), q.Rule("dear", None), q.Rule("idle", None)
    order = q.cascade([q.Profile(dear, 0.5, 10.0), q.Profile(idle, 0.0, 0.1), q.Profile(cheap, 0.2, 0.1)])
    assert [r.name for r in order] == ["cheap", "dear", "idle"]


def test_later_rules_are_not_computed(documents):
    stop = q.Rule("stop", lambda m: m("n_words") >= 0)
    fail = q.Rule("fail", lambda m: F.raise_error(F.concat(F.lit("asked "), m("n_words").cast("string"))).cast("boolean"))
    assert q.keep(documents([(1, "a")]), [stop, fail]).count() == 0
    with pytest.raises(Exception, match="asked"):
        q.keep(documents([(1, "a")]), [fail, stop]).collect()


def test_empty_table(documents):
    docs = documents([])
    assert q.judge(docs, q.cascade(q.profile(docs))).count() == 0


def test_no_python_in_the_plan(documents):
    plan = q.judge(documents([(1, "a b")]), q.RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_against_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cursor = connection.execute(ORACLES["op1_quality_rules"])
    columns = [c[0] for c in cursor.description]
    result = QUERIES["op1_quality_rules"](spark, sf)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in result.select(*columns).collect())
