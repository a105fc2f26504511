"""A corpus pipeline of five stages: drop toxic documents, keep one of each near-duplicate group, mask personal data, mix
the sources to target weights, and encode to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandloom.llm import bpe, mixing, near_dup, pii, toxicity
from strandloom.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under a half; the model is fitted on this stage's own documents and the labels table.

    Null and empty texts are scored as texts without offending words, and repeated rows alike; without labelled rows of both
    kinds every text scores the share of toxic labels; an empty table stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, out="_toxicity").where("_toxicity < 0.5").select(*docs.columns)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by a similarity of 0.8 or more on five-word shingles."""
    return near_dup.keep_one(docs, width=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a kind's name in place of each span of personal data; no row goes, null texts stay null, an empty table stays empty."""
    return pii.mask(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks; documents without words are drawn at their source's rate, too.

    Null sources are one source; rows alike in all columns are drawn together; a source without words takes nothing.
    """
    return mixing.mix(docs)


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each mixed copy: doc_id, source, lang, token_ids. Null and empty texts have no ids; an empty table gives no rows."""
    slim = docs.select("doc_id", "source", "lang", "text")
    return bpe.encode(slim, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_copies),
    ("personal_data", mask_personal_data),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_ids),
]

#: SQL can't express the fitted models of the first and third stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
