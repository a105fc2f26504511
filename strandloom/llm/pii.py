"""Personal data: fixed base patterns, and a semi-Markov conditional random field that adds spans they miss.

Base spans are the leftmost non-overlapping matches of each kind's pattern, with its check (octets, Luhn, digit counts).
They are found by scans that stay linear on any text. The model works on regions around digits, `@` and `+`: tokens are
runs of digits, runs of letters and single other characters, and a segment of up to LONGEST tokens is scored as a whole
(shape, lengths, checks, neighbours). Dynamic programming over segments, with transitions between kinds, chooses
boundaries and kinds together; a segment is added if its marginal is at least SURE and no base span meets it.

Fitted on the driver with some features left out at random, so that no single cue decides: on regions of at most SAMPLE
documents with triggers (by a hash of the id, no longer than FIT_CHARS), with base spans as truth, and on TAUGHT made
examples of what the base patterns drop, such as telephone numbers without a country code, cards with points, and
addresses with brackets around their signs, among dates, amounts, serial numbers and failed cards that are none.
Detection reads whole texts, long regions in windows that overlap by REACH characters.

Defined results: null and empty texts have no spans; positions count code points, the end is exclusive; base spans of
different kinds may overlap, those of one kind don't, and no added span meets another span; texts of any length are read
whole, in linear time; repeated rows repeat; an empty table gives no rows. n_email and the like count base spans; `spans`
holds base and added ones. Only doc_id and text are read; mask keeps every other column, whatever its name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import bounded, hash_share, row_blocks

KINDS = ("email", "ip", "card", "phone")
SAMPLE, FIT_CHARS, FIT_REGIONS, TAUGHT, LONGEST, REACH, SURE = 400, 20_000, 700, 700, 24, 64, 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@+]+")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and _LOCAL_END.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        at += 1
        if found:
            yield start, found.end()
            done = at = found.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then in the order of KINDS."""
    if not _TRIGGER.search(text):
        return []
    found = [(a, b, "email") for a, b in emails(text)]
    found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Stretches without white space around triggers, at most REACH characters beyond them; neighbours one space apart are one."""
    held: tuple[int, int] | None = None
    for m in _TRIGGER.finditer(text):
        if held and m.end() <= held[1]:
            continue
        a, b = m.start(), m.end()
        low, high = max(0, a - REACH), min(len(text), b + REACH)
        while a > low and not text[a - 1].isspace():
            a -= 1
        while b < high and not text[b].isspace():
            b += 1
        if held and a <= held[1] + 1:
            held = (held[0], max(b, held[1]))
        else:
            if held:
                yield held
            held = (a, b)
    if held:
        yield held


@lru_cache(maxsize=100_000)
def _shape_features(span: str) -> tuple[str, ...]:
    digits = "".join(c for c in span if c.isascii() and c.isdigit())
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[A-Za-z]+", "a", span))
    groups = ",".join(str(len(g)) for g in re.findall("[0-9]+", span)[:6])
    out = [f"shape {shape[:40]}", f"groups {groups}", f"digits {min(len(digits), 20)}", f"dots {min(span.count('.'), 4)}", f"ats {min(span.count('@'), 2)}", f"first {shape[:1]}", f"last {shape[-1:]}", f"letters {'a' in shape}", f"length {min(len(span) // 4, 8)}"]
    if digits and len(digits) >= 12 and luhn(digits):
        out.append("luhn")
    if re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", span):
        out.append(f"octets {all(int(p) <= 255 for p in span.split('.'))}")
    if "@" in span:
        out.append(f"dot after at {'.' in span.rsplit('@', 1)[1]}")
    return tuple(out)


def _context(text: str, a: int, b: int) -> list[str]:
    side = lambda c: "9" if c.isdigit() else "a" if c.isalpha() else c if c else "^"
    return [f"left {side(text[a - 1 : a])}", f"right {side(text[b : b + 1])}"]


class Lattice:
    """Tokens of a region and its candidate segments (first token, last token + 1, features)."""

    def __init__(self, text: str, start: int, end: int):
        self.bounds = [start]
        for m in _TOKEN.finditer(text, start, end):
            self.bounds.append(m.end())
        n = len(self.bounds) - 1
        digits, ats = [0], [0]
        for i in range(n):
            token = text[self.bounds[i] : self.bounds[i + 1]]
            digits.append(digits[-1] + (len(token) if token.isascii() and token.isdigit() else 0))
            ats.append(ats[-1] + (token == "@"))
        self.segments: list[tuple[int, int, list[str]]] = []
        solid = [text[self.bounds[i]].isascii() and (text[self.bounds[i]].isalnum() or text[self.bounds[i]] in "+(") for i in range(n)]
        for i in range(n):
            if not solid[i]:
                continue
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                d, at = digits[j] - digits[i], ats[j] - ats[i]
                if at > 1 or d > 20:
                    break
                tail = text[self.bounds[j] - 1]
                if (at or d >= 7 or d >= 4 and text.count(".", self.bounds[i], self.bounds[j]) == 3) and tail.isascii() and tail.isalnum():
                    self.segments.append((i, j, [*_shape_features(text[self.bounds[i] : self.bounds[j]]), *_context(text, self.bounds[i], self.bounds[j])]))
        self.n = n


class SegmentModel:
    """Feature weights for each kind and transitions between kinds; 0 stands for no entity (single tokens, score 0)."""

    def __init__(self):
        self.weights: dict[str, np.ndarray] = {}
        self.trans = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
        self.bias = np.full(len(KINDS), -2.0)

    def segment_scores(self, features: list[str]) -> np.ndarray:
        out = self.bias.copy()
        for f in features:
            w = self.weights.get(f)
            if w is not None:
                out += w
        return out

    def marginals(self, lattice: Lattice, features: list[list[str]] | None = None):
        """For each segment its kinds' probabilities; also expected transitions. By forward and backward sums over segments."""
        k, n = len(KINDS) + 1, lattice.n
        scores = [self.segment_scores(f) for f in features or [s[2] for s in lattice.segments]]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for s, (i, j, _) in enumerate(lattice.segments):
            ending[j].append(s)
            starting[i].append(s)
        step = np.exp(self.trans)
        grown = [np.exp(np.clip(x, -30, 30)) for x in scores]
        alpha = np.zeros((n + 1, k))
        alpha[0, 0] = 1
        scale = np.ones(n + 1)
        for j in range(1, n + 1):
            alpha[j, 0] = (alpha[j - 1] @ step)[0]
            for s in ending[j]:
                i = lattice.segments[s][0]
                alpha[j, 1:] += (alpha[i] @ step)[1:] * grown[s] / np.prod(scale[i + 1 : j])
            scale[j] = alpha[j].sum() or 1.0
            alpha[j] /= scale[j]
        # the true sums are alpha[j] * prod(scale[1..j]); those of beta are beta[i] * prod(scale[i+1..n])
        beta = np.zeros((n + 1, k))
        beta[n] = 1
        for i in range(n - 1, -1, -1):
            ahead = np.zeros(k)
            ahead[0] = beta[i + 1, 0] / scale[i + 1]
            for s in starting[i]:
                j = lattice.segments[s][1]
                ahead[1:] += grown[s] * beta[j, 1:] / np.prod(scale[i + 1 : j + 1])
            beta[i] = step @ ahead
        total = float(alpha[n] @ beta[n])
        found, pairs = np.zeros((len(scores), k - 1)), np.zeros((k, k))
        for i in range(n):
            before = alpha[i]
            pairs[:, 0] += before * step[:, 0] * beta[i + 1, 0] / scale[i + 1] / total
            for s in starting[i]:
                j = lattice.segments[s][1]
                own = before[:, None] * step[:, 1:] * grown[s] * beta[j, 1:] / np.prod(scale[i + 1 : j + 1]) / total
                pairs[:, 1:] += own
                found[s] = own.sum(0)
        return found, pairs

    def best(self, lattice: Lattice) -> list[tuple[int, int, int, float]]:
        """The best joint choice: (start, end, kind) of each chosen segment with its marginal."""
        if not lattice.segments:
            return []
        k, n = len(KINDS) + 1, lattice.n
        scores = np.array([self.segment_scores(s[2]) for s in lattice.segments])
        begins = np.array([s[0] for s in lattice.segments])
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for s, (_, j, _) in enumerate(lattice.segments):
            ending[j].append(s)
        value, segment = np.full((n + 1, k), -math.inf), np.full((n + 1, k), -1)
        ahead, before = np.empty((n + 1, k)), np.empty((n + 1, k), np.int64)  # the best way on from a place, by the next kind
        value[0, 0] = 0
        for j in range(n + 1):
            if j:
                value[j, 0] = ahead[j - 1, 0]
                if ending[j]:
                    own = np.array(ending[j])
                    ways = ahead[begins[own], 1:] + scores[own]
                    pick = ways.argmax(0)
                    value[j, 1:], segment[j, 1:] = ways[pick, np.arange(k - 1)], own[pick]
            ways = value[j][:, None] + self.trans
            ahead[j], before[j] = ways.max(0), ways.argmax(0)
        at, c, chosen = n, int(value[n].argmax()), []
        while at:
            if c:
                chosen.append((int(segment[at, c]), c - 1))
                i = int(begins[segment[at, c]])
            else:
                i = at - 1
            at, c = i, int(before[i, c])
        if not chosen:
            return []
        found, _ = self.marginals(lattice)
        return [(lattice.bounds[lattice.segments[s][0]], lattice.bounds[lattice.segments[s][1]], c, float(found[s, c])) for s, c in reversed(chosen)]


def taught(rng: np.random.Generator) -> tuple[str, tuple[int, int, str] | None]:
    """One made text and the span in it that the base patterns drop, or none."""
    digits = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))
    pick = lambda *x: x[rng.integers(len(x))]
    area, mid, last = str(rng.integers(2, 10)) + digits(2), str(rng.integers(2, 10)) + digits(2), digits(4)
    kind = pick("phone", "phone", "card", "email", "ip", "none", "none", "none")
    if kind == "phone":
        span = pick(f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area}.{mid}.{last}", f"({area}){mid}-{last}", f"({area}) {mid} {last}")
    elif kind == "card":
        number = pick("4", "5") + digits(14)
        number += next(c for c in "0123456789" if luhn(number + c))
        span = pick(".", "--", "/").join(number[k : k + 4] for k in (0, 4, 8, 12))
    elif kind == "email":
        host = pick("org", "com", "net", "io")
        span = pick(f"{word()}@{word()}[.]{host}", f"{word()}[@]{word()}.{host}", f"{word()}.{word()}(@){word()}.{host}", f"{word()}@{word()}(.){host}")
    elif kind == "ip":
        span = pick("[.]", "(.)").join(str(n) for n in rng.integers(0, 256, 4))
    else:
        card = digits(16)
        card = card if not luhn(card) else card[:-1] + str((int(card[-1]) + 1) % 10)
        span = pick(f"20{digits(2)}-0{1 + int(digits(1)) % 9}-1{digits(1)}", f"1{digits(1)}/0{digits(1)}/20{digits(2)}", f"20{digits(2)}-01-{digits(2)} 1{digits(1)}:{digits(2)}:{digits(2)}", f"{digits(3)},{digits(3)},{digits(3)}", f"{digits(7)}.{digits(2)}", f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", card, " ".join(card[k : k + 4] for k in (0, 4, 8, 12)), digits(10), digits(8), f"{digits(2)}.{digits(6)}, -{digits(3)}.{digits(6)}", f"1.{digits(1)}.{digits(2)}.{digits(1)}.{digits(4)}", f"{word()}@{word()}", f"no-{digits(8)}", digits(5) + word() + digits(6) + word())
    left = pick("", f"{word()} ", f"{word()} {digits(2)} ", f"{word()}: ", f"{word()} (", "\n")
    text = left + span + pick("", ".", ",", f" {word()}", f" {word()} {digits(2)}", ")", "\n")
    return text, None if kind == "none" else (len(left), len(left) + len(span), kind)


def windows(a: int, b: int, size: int = 6 * REACH, step: int = 5 * REACH) -> Iterator[tuple[int, int]]:
    """[a, b) in windows that overlap by REACH characters."""
    while b - a > size:
        yield a, a + size
        a += step
    if a < b:
        yield a, b


def fit_segments(texts: list[str], epochs: int = 4, rate: float = 0.2, drop: float = 0.25, seed: int = 3, made: int = TAUGHT) -> SegmentModel | None:
    """Learn from regions of the texts, with their base spans as truth, and from made texts."""
    rng, cases, extra = np.random.default_rng(seed), [], []

    def case(text: str, spans: list[tuple[int, int, str]], a: int, b: int) -> list[tuple[Lattice, dict[int, int]]]:
        lattice = Lattice(text, a, b)
        at, index = {x: i for i, x in enumerate(lattice.bounds)}, {(i, j): s for s, (i, j, _) in enumerate(lattice.segments)}
        truth, done = {}, 0
        for x, y, kind in spans:
            s = index.get((at.get(x), at.get(y)))
            if s is not None and x >= done:
                truth[s], done = KINDS.index(kind), y
        return [(lattice, truth)] if lattice.segments else []

    for text in texts:
        if len(cases) < 4 * FIT_REGIONS:
            base = base_spans(text)
            cases += [c for a, b in regions(text) for x, y in windows(a, b) for c in case(text, base, x, y)]
    for _ in range(made):
        text, span = taught(rng)
        extra += [c for a, b in regions(text) for c in case(text, [span] if span else base_spans(text), a, b)]
    cases = [cases[i] for i in sorted(rng.permutation(len(cases))[:FIT_REGIONS])] + extra
    if not any(t for _, t in cases):
        return None
    model, squares = SegmentModel(), {}
    bias_sq, trans_sq = np.full(len(KINDS), 1e-2), np.full_like(model.trans, 1e-2)
    for _ in range(epochs):
        for c in rng.permutation(len(cases)):
            lattice, truth = cases[c]
            kept = [[f for f in s[2] if rng.random() >= drop] for s in lattice.segments]
            found, pairs = model.marginals(lattice, kept)
            slope = -found
            for s, kind in truth.items():
                slope[s, kind] += 1
            seen, last, i = np.zeros_like(pairs), 0, 0
            starts = {lattice.segments[s][0]: (lattice.segments[s][1], kind + 1) for s, kind in truth.items()}
            while i < lattice.n:
                j, kind = starts.get(i, (i + 1, 0))
                seen[last, kind] += 1
                last, i = kind, j
            for s in np.flatnonzero(np.abs(slope).max(1) > 1e-3):
                for f in kept[s]:
                    if f not in model.weights:
                        model.weights[f], squares[f] = np.zeros(len(KINDS)), np.full(len(KINDS), 1e-2)
                    squares[f] += slope[s] ** 2
                    model.weights[f] += rate * slope[s] / np.sqrt(squares[f])
            for value, square, move in ((model.bias, bias_sq, slope.sum(0)), (model.trans, trans_sq, seen - pairs)):
                square += move * move
                value += rate * move / np.sqrt(square)
    return model


def added_spans(text: str, base: list[tuple[int, int, str]], model: SegmentModel | None) -> list[tuple[int, int, str]]:
    """Segments that the model is sure of and that no base span meets. Regions that base spans cover whole are not searched."""
    out: list[tuple[int, int, str]] = []
    if model is None:
        return out
    spans, k = sorted((a, b) for a, b, _ in base), 0
    for a, b in regions(text):
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        free, at = [], a
        for x, y in spans[k:]:
            if x >= b:
                break
            free.append((at, x))
            at = max(at, y)
        free.append((at, b))
        found = []
        for p, q in (w for x, y in free for w in windows(x, y)):
            if sum(c.isdigit() for c in text[p:q]) < 4 and "@" not in text[p:q]:
                continue  # no segment holds fewer
            lattice = Lattice(text, p, q)
            if lattice.segments:
                found += [(-sure, i, j, c) for i, j, c, sure in model.best(lattice) if sure >= SURE]
        own: list[tuple[int, int, str]] = []
        for _, i, j, c in sorted(found):  # windows overlap, so the surer of two that meet stays
            if all(j <= x or y <= i for x, y, _ in own):
                own.append((i, j, KINDS[c]))
        out += sorted(own)
    return out


def find(text: str | None, model: SegmentModel | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans."""
    base = base_spans(text or "")
    extra = added_spans(text, base, model) if text and _TRIGGER.search(text) else []
    return base, sorted([*base, *extra], key=lambda s: (s[0], KINDS.index(s[2]))) if extra else base


def fit(docs: DataFrame, sample: int = SAMPLE) -> SegmentModel | None:
    """Fit on about `sample` documents with triggers, by a hash of the id over all of them, at every size of the corpus."""
    usable = docs.where(F.length("text") <= FIT_CHARS).where(F.col("text").rlike(r"@|\+[0-9]|[0-9]{5}"))
    n = usable.count()
    drawn = usable.where(hash_share("doc_id", 61) < 2 * sample / max(1, n)).select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in drawn.collect()})
    return fit_segments([r[-1] for r in rows])


def _digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def report(docs: DataFrame, model: SegmentModel | None) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            rows = []
            for key, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist(), strict=True):
                base, spans = find(text, shared.value)
                rows.append((key, *(sum(s[2] == k for s in base) for k in KINDS), hashlib.sha256(_digest(base).encode()).hexdigest(), _digest(spans)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.transform(bounded).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask_text(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """Each stretch that spans cover becomes the name of its first span's kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    merged: list[list] = []
    for a, b, kind in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: SegmentModel | None, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with masked texts, and the length column set anew where a text has changed. All other columns and rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, n_at = docs.columns.index(text), docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, text):
            columns, old = list(block.columns), block.column(text).to_pylist()
            new = [mask_text(t, find(t, shared.value)[1]) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if n_at is not None:
                counts = [len(t) if t != was else n for t, was, n in zip(new, old, columns[n_at].to_pylist(), strict=True)]
                columns[n_at] = pa.array(counts, columns[n_at].type)
            yield pa.RecordBatch.from_arrays(columns, block.schema.names)

    return docs.transform(bounded).mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
