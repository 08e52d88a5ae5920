"""The registered queries of the operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import alignment, html, language, minhash, mixing, neighbours, packing, pii, prefix_trie, quality_rules, segmentation, sharding, suffix_tree
from ledgerloom.llm.common import configure, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Register a query under its function's name."""

    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        configure(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rules = quality_rules.cascade(quality_rules.profile(docs))
    return quality_rules.judge(docs, rules)


ORACLES["op1_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT rid, i, ws[i:i+4] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n >= 2),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines, length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_capitals
  FROM docs LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 10 * n_words
            OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines) OR word_chars > 30 * n_words
            OR 100 * n_capitals > 50 * word_chars) AS kept
FROM measured
"""


@query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(table(spark, folder, "pages"))


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"), pii.fit())


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query
def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.component_ids(table(spark, folder, "documents"), words=2)


@query
def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"), shards=40)


@query
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.score(table(spark, folder, "documents"))


def _model_file() -> str:
    """A public SentencePiece model; its place can be given in the environment."""
    return _tokenizer_file("LEDGERLOOM_SENTENCEPIECE_MODEL", "piece_bpe_32k.model")


def _tokenizer_file(variable: str, name: str) -> str:
    if path := os.environ.get(variable):
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_sampled_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return segmentation.segment(docs, _model_file(), k=4)


ORACLES["op5_minhash_dedup"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM docs),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id
       AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION SELECT r.a, l.b FROM reached r JOIN edges l ON r.b = l.a),
named AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN named USING (doc_id)
"""

# Pages of the test tables hold their article in an element of that name, its blocks in p and h1.
ORACLES["op8_html_extraction"] = r"""
WITH parts AS (
  SELECT page_id, url, string_split_regex(
           regexp_extract(html, '<article>(.*?)(</article>|$)', 1, 's'), '</?(p|h1)>') AS blocks
  FROM pages),
plain AS (
  SELECT page_id, url, list_transform(blocks, lambda b: replace(replace(regexp_replace(regexp_replace(
           regexp_replace(b, '<[^>]*(>|$)', ' ', 'g'), '&quot;?', '"', 'g'), '\s+', ' ', 'g'),
           '&amp;', '&'), '&amp', '&')) AS blocks
  FROM parts),
joined AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda b: trim(b)),
           lambda b: b <> ''), chr(10) || chr(10)) AS text
  FROM plain)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
"""


@query
def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


ORACLES["op12_source_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
         CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS HUGEINT) AS w
  FROM docs GROUP BY source),
-- a source is held at its limit if filling all in proportion up to that point takes no more than there is
held AS (
  SELECT a.source, a.s, a.w,
         200 * sum(CASE WHEN b.w * a.s < b.s * a.w THEN b.w * a.s ELSE b.s * a.w END)
           < 150 * any_value(a.w) * sum(b.s) AS is_held
  FROM sources a, sources b GROUP BY a.source, a.s, a.w),
shares AS (
  SELECT 150 * sum(s) - 200 * coalesce(sum(s) FILTER (is_held), 0) AS part,
         100 * coalesce(sum(w) FILTER (NOT is_held), 0) AS whole
  FROM held),
targets AS (
  SELECT source, CAST(s AS BIGINT) AS source_size,
         CASE WHEN is_held THEN CAST(2 * s AS DOUBLE)
              ELSE CAST(w * part AS DOUBLE) / CAST(whole AS DOUBLE) END AS target
  FROM held, shares),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source, doc_id, size) - 1 AS number FROM docs),
keyed AS (
  SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size || ':' || number) AS draw FROM numbered),
summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed),
joined AS (
  SELECT doc_id, source, size, source_size, target, before, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM summed JOIN targets USING (source)
  UNION ALL
  SELECT doc_id, d.source, size, source_size, target, before, CAST(floor(target + 0.5) AS BIGINT),
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END
  FROM summed d JOIN targets t ON d.source IS NULL AND t.source IS NULL)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM joined
"""


@query
def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    both = alignment.load(_tokenizer_file("LEDGERLOOM_BYTE_BPE", "byte_bpe_50k.json"), _model_file())
    return alignment.score(table(spark, folder, "documents"), both)


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, folder, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_heads(turns))


ORACLES["op11_prefix_trie"] = r"""
WITH given AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT c, [role, text] AS t, row_number() OVER (
           PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) - 1 AS pos
  FROM given),
ids AS (  -- crc32 of the digits, bit by bit
  SELECT c, xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
           lambda crc, x: list_reduce(list_concat([xor(crc, x)], range(8)),
             lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns)),
own AS (SELECT ids.c, coalesce(list(t ORDER BY pos) FILTER (pos >= h), []) AS ts FROM ids JOIN turns USING (c) GROUP BY ids.c),
heads AS (
  SELECT ids.c, coalesce(list(t ORDER BY pos) FILTER (t IS NOT NULL), []) AS ts
  FROM ids LEFT JOIN turns ON turns.c = ids.c - ids.c % 20 AND pos < h GROUP BY ids.c),
convs AS (SELECT c, list_concat(heads.ts, own.ts) AS ts FROM heads JOIN own USING (c)),
paths AS (SELECT c, d, ts[1:d] AS path, d = len(ts) AS is_end FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM convs)),
nodes AS (
  SELECT d, path, min(c) AS c, count(*) AS n, list_filter(list(CASE WHEN is_end THEN c END ORDER BY c), lambda x: x IS NOT NULL) AS ends
  FROM paths GROUP BY d, path),
placed AS (  -- every conversation of a node, with the conversation that names it
  SELECT p.c AS member, n.d, n.c FROM paths p JOIN nodes n ON n.d = p.d AND n.path = p.path),
parents AS (
  SELECT n.*, p.c AS parent FROM nodes n LEFT JOIN placed p ON p.member = n.c AND p.d = n.d - 1),
children AS (SELECT parent AS c, d - 1 AS d, count(*) AS k FROM parents WHERE d > 0 GROUP BY ALL),
weighed AS (
  SELECT p.*, coalesce(k, 0) AS k,
         (n - 1) * CASE WHEN p.d = 0 THEN 0 ELSE len(regexp_extract_all(path[p.d][2], '[^\x20\x09-\x0D]+')) END AS saved
  FROM parents p LEFT JOIN children ON children.c = p.c AND children.d = p.d),
sums AS (
  SELECT a.c, a.d, sum(w.saved) AS saved, count(*) FILTER (w.k = 0) AS leaves
  FROM weighed w JOIN placed a ON a.member = w.c AND a.d <= w.d GROUP BY a.c, a.d)
SELECT CAST(w.c AS BIGINT) AS conv_id, CAST(w.d AS BIGINT) AS depth, CAST(parent AS BIGINT) AS parent_conv_id,
       CAST(n AS BIGINT) AS n_convs, CAST(k AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(array_to_string(ends, ',')) AS ends_sha256
FROM weighed w JOIN sums ON sums.c = w.c AND sums.d = w.d
"""
