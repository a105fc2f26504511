"""The registered queries over the driver's tables, one for each operator, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from strandloom.llm import bpe, chunk_store, langid, lattice, licenses, matroska, mixing, near_dup, pii, toxicity

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark, sf_dir):
    return bpe.round_trip(_documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op2_source_mix(spark, sf_dir):
    return mixing.mix_report(_documents(spark, sf_dir))


def op3_toxicity(spark, sf_dir):
    return toxicity.score_report(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_license_scan(spark, sf_dir):
    return licenses.scan(_documents(spark, sf_dir))


def op5_language(spark, sf_dir):
    return langid.report(_documents(spark, sf_dir))


def op6_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(_documents(spark, sf_dir), width=4, percent=80)


def op7_lattice(spark, sf_dir):
    return lattice.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.95)


def op8_pii(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return pii.report(docs, pii.fit(docs))


def op9_matroska(spark, sf_dir):
    return matroska.media_digest(_documents(spark, sf_dir))


def op10_chunk_store(spark, sf_dir):
    return chunk_store.store_round_trip(_documents(spark, sf_dir), JSON).drop("root")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_source_mix, op3_toxicity, op4_license_scan, op5_language, op6_near_dup, op7_lattice, op8_pii, op9_matroska, op10_chunk_store, pipeline)}

MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(list_extract([5, 2, 1], 1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)) AS DOUBLE) AS weight, CAST(source_size * 3 AS DOUBLE) AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio, sum(source_size) OVER () AS total,
  coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
  sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight FROM w),
l AS (SELECT *, (total - capped) / left_weight AS level FROM r),
f AS (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, level LIMIT 1),
t AS (SELECT source, source_size, least(weight * (SELECT level FROM f), cap) AS target FROM l),
c AS (SELECT source, size, CAST(ceil(count(*) / {mixing.BIN}.0) AS BIGINT) AS bins FROM d GROUP BY source, size),
b AS (SELECT d.doc_id, d.source, d.size, floor(CAST(('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0 * c.bins) AS bin
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.size = c.size),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, bin, doc_id) AS i FROM b),
x AS (SELECT n.doc_id, n.size, t.source_size, t.target, n.i, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  CAST(('0x' || substr(md5('{mixing.SEED}' || CASE WHEN n.source IS NULL THEN 'n' ELSE 's' || n.source END), 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(floor(i * rate + u) - floor((i - 1) * rate + u) AS BIGINT) AS copies,
  CAST(floor(i * rate + u) - floor((i - 1) * rate + u) AS BIGINT) * size AS taken FROM x"""

ORACLES = {"op2_source_mix": MIX_SQL, "op4_license_scan": licenses.scan_sql()}
