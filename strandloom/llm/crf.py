"""A linear-chain conditional random field over the words of a text, with hashed features, in array operations.

A word is a run of lower-cased ASCII letters and non-ASCII characters. Its features are the byte n-grams of the word with
one boundary on either side (so prefixes, suffixes and inner n-grams alike) and the word itself; each is hashed into
one of a fixed number of weights for each label. Labels of neighbouring words share learned transition weights.
Chains are runs of at most CHAIN words of one text, so the forward and backward passes step over thousands of chains
together; every word of every text is in exactly one chain. Very long texts are taken in pieces cut at white space.

Fitting minimises the negative log likelihood by AdaGrad over batches of chains, on the driver, over a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

from strandloom.llm.common import ragged

BUCKETS_BITS, ORDERS, CHAIN, PIECE = 18, (2, 3, 4), 64, 1 << 19
#: Bytes of words that are hashed at once.
HASHED = 1 << 18
_IS_WORD = np.zeros(256, bool)
_IS_WORD[97:123] = _IS_WORD[128:] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def lowered(text: str) -> str:
    """Lower case, one character for each character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def pieces_of(texts: list[str | None], limit: int = PIECE) -> Iterator[tuple[int, int, str]]:
    """(index, first character, piece) of each text; a piece has at most limit characters and ends at white space if it can."""
    for k, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = len(text) if len(text) - at <= limit else max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit))
            end = end if end > at else min(at + limit, len(text))
            yield k, at, text[at:end]
            at = end


@dataclass
class Words:
    """The words of some pieces: the piece of each, byte range in the joined buffer, and features on demand."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    offsets: np.ndarray  # of the pieces in the buffer


def words_of(pieces: list[str]) -> Words:
    raw = [lowered(p).encode("utf-8", "surrogatepass") for p in pieces]
    offsets = 1 + np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n\n\n\n\n", np.uint8).copy()
    inside = _IS_WORD[data]
    data[~inside] = 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    return Words(data, starts, ends, np.searchsorted(offsets, starts, side="right") - 1, offsets)


def _buckets(hashes: np.ndarray, order: int) -> np.ndarray:
    return (hashes * np.uint32(2654435761 + 2 * order * 40503) >> np.uint32(32 - BUCKETS_BITS)).astype(np.int32)


def gram_buckets(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order, the weight index of the n-gram that starts at each byte."""
    hashes = data.astype(np.uint32)
    for order in range(2, max(ORDERS) + 1):
        hashes = hashes[:-1] * np.uint32(0x01000193) + data[order - 1 :]
        if order in ORDERS:
            yield order, _buckets(hashes, order)


def word_buckets(words: Words) -> np.ndarray:
    """The weight index of each word, some words at a time, as the sums take eight bytes several times for each byte of text."""
    out, w0 = np.empty(len(words.starts), np.int32), 0
    while w0 < len(out):
        first = int(words.starts[w0])
        w1 = max(w0 + 1, int(np.searchsorted(words.ends, first + HASHED, side="right")))
        out[w0:w1] = _word_buckets(words.data[first : words.ends[w1 - 1]], words.starts[w0:w1] - first, words.ends[w0:w1] - first)
        w0 = w1
    return out


def _word_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        n = len(data)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _STEP)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _STEP_BACK)]))
        own = (sums[ends] - sums[starts]) * back[starts]
        own ^= own >> np.uint64(31)
        own *= np.uint64(0xBF58476D1CE4E5B9)
    return (own >> np.uint64(64 - BUCKETS_BITS)).astype(np.int32)


def chains_of(piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each chain, longest first."""
    if not len(piece):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    firsts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
    counts = np.diff(np.concatenate([firsts, [len(piece)]]))
    parts = -(-counts // CHAIN)
    starts = np.repeat(firsts, parts) + CHAIN * (ragged(np.zeros(len(parts), np.int64), parts))
    lengths = np.minimum(np.repeat(firsts + counts, parts) - starts, CHAIN)
    order = np.argsort(-lengths, kind="stable")
    return starts[order], lengths[order]


def marginals(scores: np.ndarray, trans: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pairs: bool = False):
    """Each word's label probabilities by forward and backward passes; with pairs also the expected transitions."""
    n, k = scores.shape
    emitted = np.exp(scores - scores.max(1, keepdims=True)) if n else scores
    step = np.exp(trans)
    alpha, beta = np.empty((n, k)), np.empty((n, k))
    if not n:
        return alpha, np.zeros((k, k))
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(int(lengths[0]))]  # chains longer than t
    for t, m in enumerate(active):
        at = starts[:m] + t
        now = emitted[at] if t == 0 else (alpha[at - 1] @ step) * emitted[at]
        alpha[at] = now / now.sum(1, keepdims=True)
    expected = np.zeros((k, k))
    for t in range(len(active) - 1, -1, -1):
        m, longer = active[t], active[t + 1] if t + 1 < len(active) else 0
        at = starts[:m] + t
        now = np.ones((m, k))
        if longer:
            ahead = emitted[at[:longer] + 1] * beta[at[:longer] + 1]
            now[:longer] = ahead @ step.T
            if pairs:
                both = alpha[at[:longer]][:, :, None] * step * ahead[:, None, :]
                expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
        beta[at] = now / now.sum(1, keepdims=True)
    found = alpha * beta
    return found / found.sum(1, keepdims=True), expected


@dataclass
class ChainModel:
    labels: list[str]
    weights: list[np.ndarray] = field(default_factory=list)
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def scores(self, words: Words) -> np.ndarray:
        out = np.repeat(self.bias[None, :], len(words.starts), 0)
        if not len(words.starts):
            return out
        for order, buckets in gram_buckets(words.data):
            first, last = words.starts - 1, np.maximum(words.ends + 2 - order, words.starts - 1)
            for k, w in enumerate(self.weights):
                sums = np.empty(len(buckets) + 1)
                sums[0] = 0
                np.cumsum(w[buckets], dtype=np.float64, out=sums[1:])
                out[:, k] += sums[last] - sums[first]
        own = word_buckets(words)
        for k, w in enumerate(self.weights):
            out[:, k] += w[own]
        return out

    def tag(self, texts: list[str | None]) -> Iterator[tuple[list[tuple[int, int, str]], Words, np.ndarray]]:
        """For some pieces at a time: the pieces, their words and each word's label probabilities."""
        held, size = [], 0
        for piece in pieces_of(texts):
            if held and size + len(piece[2]) > PIECE:
                yield self._tagged(held)
                held, size = [], 0
            held.append(piece)
            size += len(piece[2])
        if held:
            yield self._tagged(held)

    def _tagged(self, held):
        words = words_of([p[2] for p in held])
        return held, words, marginals(self.scores(words), self.trans, *chains_of(words.piece))[0]


def fit(labels: list[str], words: Words, gold: np.ndarray, epochs: int = 6, batch: int = 40_000, rate: float = 0.15, weight: np.ndarray | None = None, seed: int = 1) -> ChainModel:
    """Learn weights and transitions from words with gold labels. weight: of each word's emission gradient."""
    k, size = len(labels), 1 << BUCKETS_BITS
    model = ChainModel(labels, [np.zeros(size, np.float32) for _ in labels], np.zeros(k), np.zeros((k, k)))
    starts, lengths = chains_of(words.piece)
    by_start = np.argsort(starts)
    starts, lengths = starts[by_start], lengths[by_start]
    if not len(starts):
        return model
    own_buckets = word_buckets(words)

    def features(w0: int, w1: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Weight index and word, counted from w0, of each feature of the words from w0 to w1; made anew for each batch, as those of all words take many times their text."""
        first, found = int(words.starts[w0]) - 1, []
        for order, buckets in gram_buckets(words.data[first : words.ends[w1 - 1] + 1]):
            counts = np.maximum(words.ends[w0:w1] - words.starts[w0:w1] + 3 - order, 0)
            found.append((buckets[ragged(words.starts[w0:w1] - 1 - first, counts)], np.repeat(np.arange(w1 - w0), counts)))
        return [*found, (own_buckets[w0:w1], np.arange(w1 - w0))]

    cuts = [0, *[i for i in range(1, len(starts)) if starts[i] // batch != starts[i - 1] // batch], len(starts)]
    squares, bias_sq, trans_sq = [np.full(size, 1e-2, np.float32) for _ in labels], np.full(k, 1e-2), np.full((k, k), 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for b in rng.permutation(len(cuts) - 1):
            own, lens = starts[cuts[b] : cuts[b + 1]], lengths[cuts[b] : cuts[b + 1]]
            w0, w1 = int(own[0]), int(own[-1] + lens[-1])
            parts = features(w0, w1)
            scores = np.repeat(model.bias[None, :], w1 - w0, 0)
            for at, word in parts:
                for j, w in enumerate(model.weights):
                    scores[:, j] += np.bincount(word, weights=w[at], minlength=w1 - w0)
            order = np.argsort(-lens, kind="stable")
            found, pairs = marginals(scores, model.trans, own[order] - w0, lens[order], pairs=True)
            truth = np.zeros_like(found)
            truth[np.arange(w1 - w0), gold[w0:w1]] = 1
            slope = truth - found
            if weight is not None:
                slope *= weight[w0:w1, None]
            first = np.zeros(w1 - w0, bool)
            first[own - w0] = True
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[w0 : w1 - 1][~first[1:]], gold[w0 + 1 : w1][~first[1:]]), 1)
            scale = 1 / max(1, w1 - w0) * 1000
            for j in range(k):
                total = sum(np.bincount(at, weights=slope[word, j], minlength=size) for at, word in parts).astype(np.float32) * np.float32(scale)
                squares[j] += total * total
                model.weights[j] += np.float32(rate) * total / np.sqrt(squares[j])
            for value, square, move in ((model.bias, bias_sq, slope.sum(0) * scale), (model.trans, trans_sq, (seen - pairs) * scale)):
                square += move * move
                value += rate * move / np.sqrt(square)
    return model


def fit_logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a penalised logistic regression, bias last, by Newton's method."""
    x = np.concatenate([features, np.ones((len(features), 1))], 1)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curve, slope)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w
