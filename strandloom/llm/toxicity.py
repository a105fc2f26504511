"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are known for documents only, so words get theirs first: a word of a toxic document is labelled toxic if, over
the sample, words like it occur in toxic documents far more than in clean ones (a smoothed log odds ratio on document
counts, over the word or its longest frequent beginning). The field then learns affix, n-gram and word weights
with transitions and generalises to unseen forms. A document's score comes from its words' forward-backward marginals
(the highest, and the sum of those worth counting) by a logistic regression on the sample.

The model is fitted on the driver on at most `sample` labelled rows (SAMPLE of each class, none longer than LONGEST
characters), chosen by a hash of the id from the folds other than the held-out one; scoring reads every whole text.

Defined results: null and empty texts have the score of a text without toxic words; documents without a label are
scored alike; a label row with null id or label is ignored; an id labelled twice counts as toxic if any row says so;
without both classes in the sample every score is the share of the toxic class; repeated rows repeat.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import crf
from strandloom.llm.common import bounded, crc_of_id, give_back, hash_share, row_blocks

SAMPLE, LONGEST, HELD, FOLDS = 900, 10_000, 0, 5


@dataclass
class ToxicityModel:
    chain: crf.ChainModel | None
    logistic: np.ndarray
    prior: float

    def features(self, texts: list[str | None], spans: bool = False):
        """Per text: the highest marginal's logit and the log of the summed marginals; with spans also [start, end, score] by characters."""
        top, total, found = np.zeros(len(texts)), np.zeros(len(texts)), [[] for _ in texts]
        for held, words, marg in self.chain.tag(texts):
            p = marg[:, 1]
            text_of = np.array([h[0] for h in held])[words.piece] if len(p) else np.zeros(0, np.int64)
            np.maximum.at(top, text_of, p)
            np.add.at(total, text_of, np.where(p >= 0.2, p, 0))
            if spans:
                last, of, opened = None, -1, np.zeros(0, np.int64)
                for i in np.flatnonzero(p >= 0.5).tolist():
                    k, first, piece = held[words.piece[i]]
                    if of != words.piece[i]:  # characters before each byte of the piece
                        of = words.piece[i]
                        raw = np.frombuffer(crf.lowered(piece).encode("utf-8", "surrogatepass"), np.uint8)
                        opened = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    a, b = (first + int(opened[x - words.offsets[of]]) for x in (words.starts[i], words.ends[i]))
                    if last == (k, i - 1):
                        found[k][-1] = (found[k][-1][0], b, max(found[k][-1][2], float(p[i])))
                    else:
                        found[k].append((a, b, float(p[i])))
                    last = (k, i)
        clipped = np.clip(top, 1e-4, 1 - 1e-4)
        return np.stack([np.log(clipped / (1 - clipped)), np.log1p(total)], 1), found

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.scores_and_spans(texts, spans=False)[0]

    def scores_and_spans(self, texts: list[str | None], spans: bool = True) -> tuple[np.ndarray, list]:
        if self.chain is None:
            return np.full(len(texts), self.prior), [[] for _ in texts]
        x, found = self.features(texts, spans)
        return 1 / (1 + np.exp(-np.clip(x @ self.logistic[:-1] + self.logistic[-1], -30, 30))), found


def _stems(word: bytes) -> list[bytes]:
    """The word and its beginnings of at least five bytes."""
    return [word[:n] for n in range(len(word), 4, -1)] or [word]


def token_labels(words: crf.Words, toxic: np.ndarray, least: float = 2.5) -> np.ndarray:
    """1 for words of toxic documents that mark them, else 0. toxic: by piece."""
    raw, spelled = words.data.tobytes(), []
    known: dict[bytes, bytes] = {}  # one object for each different word
    counts: list[Counter] = [Counter(), Counter()]
    bounds = np.searchsorted(words.piece, np.arange(len(toxic) + 1)).tolist()
    for p, (w0, w1) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        own = [known.setdefault(w, w) for w in (raw[a:b] for a, b in zip(words.starts[w0:w1].tolist(), words.ends[w0:w1].tolist(), strict=True))]
        spelled += own
        counts[int(toxic[p])].update({s for w in set(own) for s in _stems(w)})
    n = [max(1, int((toxic == c).sum())) for c in (0, 1)]
    odds: dict[bytes, float] = {}

    def marks(w: bytes) -> bool:
        if w not in odds:
            found = [np.log((counts[1][s] + 0.5) / (n[1] + 1)) - np.log((counts[0][s] + 0.5) / (n[0] + 1)) for s in _stems(w) if counts[1][s] >= 3]
            odds[w] = max(found, default=0.0)
        return odds[w] >= least

    gold = np.zeros(len(spelled), np.int64)
    for p in np.flatnonzero(toxic).tolist():
        gold[bounds[p] : bounds[p + 1]] = [marks(w) for w in spelled[bounds[p] : bounds[p + 1]]]
    return gold


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, held: int = HELD, folds: int = FOLDS) -> ToxicityModel:
    """Fit on labelled rows outside the held-out fold."""
    usable = labels.where("doc_id is not null and toxic is not null").where(F.pmod(crc_of_id("doc_id"), F.lit(folds)) != held)
    per_id = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {int(r["toxic"] > 0): r["n"] for r in per_id.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") > 0, sample / max(1, sizes.get(1, 0))).otherwise(sample / max(1, sizes.get(0, 0)))
    chosen = per_id.withColumn("_share", hash_share("doc_id", 31)).where(F.col("_share") < share).select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    rows = chosen.limit(3 * sample).collect()  # about 2 * sample by the shares
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    if not sizes.get(0) or not sizes.get(1) or not rows:
        return ToxicityModel(None, np.zeros(3), prior)
    few = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in rows], "doc_id long, _toxic int"))
    near = docs.select("doc_id", "text").where(F.length("text") <= LONGEST).join(few, "doc_id").select("doc_id", "text", "_toxic")
    found = sorted({(r["doc_id"], r["text"], r["_toxic"]) for r in near.limit(4 * sample).collect()})
    texts, toxic = [r[1] for r in found], np.array([r[2] for r in found], dtype=np.int64)
    if len(set(toxic.tolist())) < 2:
        return ToxicityModel(None, np.zeros(3), prior)
    words = crf.words_of(texts)
    gold = token_labels(words, toxic)
    model = ToxicityModel(crf.fit(["clean", "toxic"], words, gold, weight=np.where(gold == 1, 3.0, 1.0)), np.zeros(3), prior)
    features, _ = model.features(texts)
    weights = np.where(toxic == 1, prior / toxic.mean(), (1 - prior) / (1 - toxic.mean()))
    model.logistic = _weighted(features, toxic, weights)
    give_back()
    return model


def _weighted(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logistic weights for the corpus's share of toxic rows, from a sample with another: fit, then move the bias."""
    w = crf.fit_logistic(x, y)
    drawn, true = y.mean(), float((weights * y).sum() / weights.sum())
    w[-1] += np.log(true / (1 - true)) - np.log(drawn / (1 - drawn)) if 0 < true < 1 and 0 < drawn < 1 else 0
    return w


def score(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """df with one more column, the score of each whole text. No shuffle."""
    if out in df.columns:
        raise ValueError(f"column {out} exists already")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{out}` double"
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, text):
            got = shared.value.scores(block.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(got, pa.float64())], [*block.schema.names, out])

    return df.transform(bounded).mapInArrow(run, fields)


def tag_spans(df: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and an array of (start, end, score): runs of words whose marginal is a half or more, in characters."""
    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            texts = block.column("text").to_pylist()
            found = [[] for _ in texts] if shared.value.chain is None else shared.value.features(texts, spans=True)[1]
            rows = [[{"start": a, "end": b, "score": s} for a, b, s in x] for x in found]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(rows, span)], ["doc_id", "spans"])

    return slim.transform(bounded).mapInArrow(run, f"doc_id {kind}, spans array<struct<start: int, end: int, score: double>>")


def score_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans for every document; spans are start:end of its offending runs of words, comma-joined."""
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            got, found = shared.value.scores_and_spans(block.column("text").to_pylist())
            shown = [",".join(f"{a}:{b}" for a, b, _ in x) for x in found]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(got, pa.float64()), pa.array(shown, pa.string())], ["doc_id", "score", "spans"])

    scored = slim.transform(bounded).mapInArrow(run, f"doc_id {kind}, score double, spans string")
    held = F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(FOLDS)) == HELD, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
