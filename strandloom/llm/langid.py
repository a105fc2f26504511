"""Language identification of code-switched text by a linear-chain conditional random field.

Every word gets a distribution over languages by forward-backward over affix, n-gram and lexicon (whole word) features
with learned transitions; a document's language is the one with the most probability mass over its words, and the score
is that language's share. Words are labelled for fitting with their document's language.

Fitted on the driver on at most SAMPLE rows a language (none longer than LONGEST characters, the MOST_LABELS most
frequent languages), chosen by a hash of the id outside the held-out fold; prediction reads every whole text.

Defined results: null text, or text without letters, is `und` with score 0; rows with null lang are predicted but never
learned from; without any labelled row all texts are `und`; ties go to the first language by name; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import crf
from strandloom.llm.common import bounded, crc_of_id, hash_share, row_blocks

SAMPLE, LONGEST, MOST_LABELS, HELD, FOLDS = 300, 8_000, 64, 2, 4


def fit(docs: DataFrame, sample: int = SAMPLE, held: int = HELD, folds: int = FOLDS) -> crf.ChainModel | None:
    usable = docs.where(F.col("lang").isNotNull()).where(F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(folds)) != held, F.lit(False)))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LABELS).collect()
    if not sizes:
        return None
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["n"])))])
    near = usable.where(hash_share("doc_id", 47) < share[F.col("lang")]).where(F.length("text").between(1, LONGEST)).select("doc_id", "lang", "text")
    found = sorted({(r["doc_id"], r["lang"], r["text"]) for r in near.limit(2 * sample * len(sizes)).collect()})
    labels = sorted({r[1] for r in found})
    if not labels:
        return None
    words = crf.words_of([r[2] for r in found])
    gold = np.array([labels.index(r[1]) for r in found], dtype=np.int64)[words.piece]
    return crf.fit(labels, words, gold, epochs=4)


def predict_texts(model: crf.ChainModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    if model is None:
        return ["und"] * len(texts), np.zeros(len(texts))
    mass = np.zeros((len(texts), len(model.labels)))
    for held, words, marg in model.tag(texts):
        if len(marg):
            np.add.at(mass, np.array([h[0] for h in held])[words.piece], marg)
    total, best = mass.sum(1), mass.argmax(1)
    langs, scores = [], np.zeros(len(texts))
    for k, text in enumerate(texts):
        if not text or not total[k] or not any(c.isalpha() for c in text):
            langs.append("und")
        else:
            langs.append(model.labels[best[k]])
            scores[k] = mass[k, best[k]] / total[k]
    return langs, scores


def predict(df: DataFrame, model: crf.ChainModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row. No shuffle."""
    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            langs, scores = predict_texts(shared.value, block.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return slim.transform(bounded).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(FOLDS)) == HELD, F.lit(False))
    return predict(docs, fit(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
