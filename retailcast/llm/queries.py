"""Registered queries of this subpackage: each runs its operator over a whole table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.llm import (decontam, dsir, hilbert_pq, license_dice, line_dedup, ngram_join, onebit, pivot_topk,
                            secret_ledger, sp_codec, surrogates, toxicity, wrappers)
from retailcast.session import ensure_checkpoint_dir, shared_path

#: The SentencePiece model; a parameter of the installation, never part of the repository.
SP_MODEL = os.environ.get("SP_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: The key of the surrogates; a deployment sets its own.
SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "local-development-key")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = shared_path(spark, f"tables/ledger-{uuid.uuid4().hex}")
    return secret_ledger.secret_report(secret_ledger.secrets(docs, ledger))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.encode(table(spark, sf_dir, "documents"), sp_codec.model_bytes(SP_MODEL))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_dice.license_scan(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, least = dsir.resample(docs, table(spark, sf_dir, "labels"))
    key = F.col(dsir.KEY)
    return scored.select("doc_id", F.col(dsir.LOG_WEIGHT).alias("log_weight"), key.alias("gumbel_key"), (key >= least).alias("kept"))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return onebit.hard_negatives(table(spark, sf_dir, "embeddings"), label)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_pq.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_secret_scan, op3_toxicity, op4_sentencepiece, op5_decontamination,
    op6_pivot_topk, op7_license_scan, op8_quality_classifier, op9_pii_surrogates, op10_line_dedup,
    op11_hard_negatives, op12_html_extraction, op13_vector_codes)}

#: Rows of ``embeddings`` whose vectors are usable.
_USABLE = """embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _vector_codes_sql(rounds: int = hilbert_pq.ROUNDS) -> str:
    """The rounds of assigning and averaging as a chain of subqueries."""
    def assigned(c: str, columns: str) -> str:
        return f"""SELECT {columns} FROM (
  SELECT t.rid, t.p, t.e, min(struct_pack(d := CAST(list_sum(list_transform(range(1, len(t.e) + 1), lambda i: (t.e[i] - c.e[i]) * (t.e[i] - c.e[i]))) AS BIGINT), k := c.k)) AS m
  FROM t JOIN {c} c ON t.p = c.p GROUP BY t.rid, t.p, t.e)"""
    parts = [f"""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE {_USABLE})""",
             "t AS (SELECT rid, p, e[len(e) // 4 * p + 1 : len(e) // 4 * (p + 1)] AS e FROM v, range(4) r(p))",
             "c0 AS (SELECT p, rid - 1 AS k, e FROM t WHERE rid <= 256)"]
    for r in range(rounds):
        parts += [f"a{r} AS ({assigned(f'c{r}', 'rid, p, e, m.k AS k')})",
                  f"""u{r} AS (SELECT p, k, list(x ORDER BY i) AS e FROM (
  SELECT p, k, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (SELECT p, k, unnest(e) AS x, unnest(range(len(e))) AS i FROM a{r}) GROUP BY p, k, i) GROUP BY p, k)""",
                  f"c{r + 1} AS (SELECT c.p, c.k, coalesce(u.e, c.e) AS e FROM c{r} c LEFT JOIN u{r} u ON c.p = u.p AND c.k = u.k)"]
    last = f"c{rounds}"
    return "WITH " + ",\n".join([*parts, f"z AS ({assigned(last, 'rid, p, m.k AS k, m.d AS d')})",
                                 "g AS (SELECT rid, string_agg(printf('%02x', CAST(k AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY rid)",
                                 f"h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, i)) AS s FROM (SELECT p, k, unnest(e) AS x, unnest(range(len(e))) AS i FROM {last}))"]) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT s FROM h) AS codebooks_sha256
FROM g JOIN v USING (rid)"""


ORACLE_SQL = {
    "op11_hard_negatives": f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.e) = len(c.e)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
    "op13_vector_codes": _vector_codes_sql(),
    "op6_pivot_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op10_line_dedup": """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
}
