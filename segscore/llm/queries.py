"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from segscore.llm.exact import exact_dedup
from segscore.llm.langid import language_id
from segscore.llm.lexical import ranked_search
from segscore.llm.mixing import mix_sources
from segscore.llm.negatives import hard_negatives
from segscore.llm.packing import pack
from segscore.llm.pitman_yor import score_corpus
from segscore.llm.quality import quality
from segscore.llm.secret_scan import RULES, joined_spans, of_kind, scan_secrets
from segscore.llm.simhash import simhash_dedup
from segscore.llm.substring_dedup import repeated_spans
from segscore.llm.topk import top_k
from segscore.llm.toxicity import toxicity
from segscore.sources.tables import read_table

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    Q[f.__name__] = f
    return f


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_dedup(docs, shingle=4, radius=4).select("doc_id", "fingerprint", "component_id")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs, read_table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL["op4_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY len DESC, doc_id)
"""


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL["op5_mixing"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap,
             (SELECT sum(size) FROM d)::DOUBLE * 1.5::DOUBLE AS budget FROM s),
r AS (SELECT *, cap / weight AS ratio,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS below,
             sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS free FROM w),
l AS (SELECT min(ratio) AS place, arg_min((budget - below) / free, ratio) AS level FROM r WHERE weight * ((budget - below) / free) <= cap),
t AS (SELECT source, source_size, CASE WHEN l.place IS NULL THEN cap ELSE least(weight * l.level, cap) END AS target FROM r, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
o AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS part,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('42:' || d.doc_id), d.doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + d.size / 2.0::DOUBLE AS middle
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN middle < part THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs).withColumn("spans_text", joined_spans(F.col("spans")))
    number = [F.size(F.filter("spans", of_kind(r.kind))).cast("long").alias(f"n_{r.kind}") for r in RULES]
    return found.select("doc_id", *number, F.sha2("spans_text", 256).alias("base_sha256"), F.col("spans_text").alias("spans"))


def _spans_sql(i: int) -> str:
    rule = RULES[i]
    pattern = rule.pattern.replace("'", "''")
    return f"""
m{i} AS (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS hit, regexp_extract_all(t, '{pattern}', {rule.group}) AS part,
               string_split_regex(t, '{pattern}') AS gap FROM docs),
p{i} AS (SELECT doc_id, unnest(range(1, len(hit) + 1)) AS i, hit, part, gap FROM m{i}),
k{i} AS (SELECT doc_id, {i} AS kind, length(hit[i]) AS len,
               length(array_to_string(gap[1:i], '')) + length(array_to_string(hit[1:i - 1], '')) AS place
        FROM p{i} WHERE length(part[i]) >= {rule.least})"""


SQL["op6_secrets"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {_spans_sql(0)}, {_spans_sql(1)}, {_spans_sql(2)},
a AS (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2),
g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || place || ':' || (place + len), ',' ORDER BY place, kind) AS spans
      FROM a GROUP BY doc_id)
SELECT docs.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN g USING (doc_id)
"""


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, corpus_pipeline.tokenizer_path())


@query
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


SQL["op9_topk"] = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, read_table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "p_insult", "p_severe", "score", "predicted")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search(docs, read_table(spark, sf_dir, "benchmark"), k=20)


_TERMS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL["op11_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS_SQL} AS words FROM documents),
n AS (SELECT row, doc_id, len(words)::BIGINT AS n FROM d WHERE len(words) > 0),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS_SQL} AS words FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item, item_id, term, count(*)::BIGINT AS times FROM (SELECT item, item_id, unnest(words) AS term FROM i) GROUP BY ALL),
t AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(words) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, a GROUP BY term),
s AS (SELECT item, item_id, row, n.doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
      FROM q JOIN t USING (term) JOIN w USING (term) JOIN n USING (row), a GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s
      WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


@query
def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(v.select("vec_id", "embedding", moved.alias("label")))


SQL["op13_hard_negatives"] = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE place <= 5 AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
