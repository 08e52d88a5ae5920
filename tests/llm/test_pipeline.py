import collections

import corpus_pipeline
import __spark_entry__ as entry
from ledgerloom.llm import language, minhash, packing, pii, queries
from ledgerloom.llm.common import table
from tests.llm.test_minhash import sets_of
from tests.llm.test_quality_rules import expected as measures

SHORT = {1, 2, 3, 4, 5, 6, 7, 8, 9, 10}


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == sorted(SHORT)
    assert {"pipeline", *queries.QUERIES} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())


def good(text):
    """All quality rules in plain Python."""
    n, chars, symbols, dup, covered, failed = measures(text)
    lines = sum(bool(x.strip(packing.WHITE)) for x in (text or "").split("\n"))
    capitals = sum(c.isupper() for c in text or "")
    return not (failed or 100 * symbols > 10 * n or 100 * dup > 50 * lines or chars > 30 * n or 100 * capitals > 50 * chars)


def test_stages_against_plain_python(spark, sf):
    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = {n: f for n, f in corpus_pipeline.STAGES}

    kept = stage[names[0]](spark, docs, sf)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = {r["doc_id"] for r in kept.collect()}
    assert left == {i for i, t in rows.items() if good(t)}

    told = stage[names[1]](spark, kept, sf)
    assert told.columns == docs.columns
    model = language.fit(kept)
    plain = {i for i in left for n, s in [language.predict(model, [rows[i]])] if n[0] != "und" and s[0] >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    left = {r["doc_id"] for r in told.collect()}
    assert left == plain

    single = stage[names[2]](spark, told, sf)
    assert single.columns == docs.columns
    groups = {}
    sets = {i: sets_of(rows[i], 5) for i in left}
    for i in sorted(left):
        same = {g for g, members in groups.items() if any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in members)}
        joined = [i, *(j for g in same for j in groups.pop(g))]
        groups[min(joined)] = joined
    left = {r["doc_id"] for r in single.collect()}
    assert left == set(groups)

    clean = stage[names[3]](spark, single, sf)
    assert clean.columns == docs.columns
    field = pii.fit()
    masked = {r["doc_id"]: r for r in clean.collect()}
    assert masked.keys() == left
    for i, r in masked.items():
        _, (spans,) = pii.spans_of(field, [rows[i]])
        assert r["text"] == pii.masked(rows[i], spans) and r["n_chars"] == len(r["text"])

    packed = stage[names[4]](spark, clean, sf).collect()
    words = collections.Counter()
    for r in packed:
        words[r["doc_id"]] += len(r["text"].encode().split())
        assert r["bin_words"] <= r["capacity"]
    assert words == {i: len(r["text"].encode().split()) for i, r in masked.items()}

    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


def test_empty_and_odd_tables(spark, documents, tmp_path):
    good_text = " ".join(f"{a}o{b}en" for a in "bdfgklmnprst" for b in "bdgklmnrst")
    for rows in ([], [(1, None), (2, ""), (None, "x")], [(1, good_text, "en"), (1, good_text, "en"), (2, good_text + " end", "en"), (None, None)]):
        docs = documents(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert {r["doc_id"] for r in docs.collect()} == ({1} if len(rows) == 4 else set())


def test_near_duplicates_take_five_words():
    assert minhash.PERCENT == 80 and minhash.keep_one.__defaults__ == (5,)
