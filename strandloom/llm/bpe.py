"""Byte-level BPE: text to token ids and back, with the tokenizers library over Arrow batches.

A byte-level vocabulary writes each byte as one printable character, so any text has ids and every id has bytes.
Splitting never crosses a single space that a visible character follows; the encoder therefore cuts texts there,
encodes each different piece once per worker and assembles a document's ids from the pieces with array gathers.

Defined results: a null text counts as empty and has no ids; an id outside the table is an error on decoding;
a character split over several ids is whole again after decoding their bytes together, and a half of one decodes to
U+FFFD in the text column while the bytes column keeps it. A tokenizers file's added tokens in a text are taken as the
library takes them, and decode to their own spelling; ranks with a pattern have none. Texts of any length are encoded
whole. An empty table gives none; repeated rows repeat; an added column whose name exists already is an error.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import BLOCK_BYTES, bounded, give_back, ragged, row_blocks

#: Pieces that one worker remembers; beyond that it starts afresh.
CACHED_PIECES = 600_000
#: Text that one worker encodes at a time: a piece is looked up once for each block that holds it.
ENCODED_BYTES = 4 << 20
#: Pieces remembered where ids go on with the texts: more are encoded again, but a worker stays small beside those that the stages before have left.
SLIM_PIECES = 200_000
_CUT = re.compile(r"(?= \S)")
_WORD = r"^[\x00\x01]?[A-Za-zÀ-ÖØ-öø-ɏ]+$"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = [b for r in (range(33, 127), range(161, 173), range(174, 256)) for b in r]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def split_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes the token: what merging by lower ranks leaves of it."""
    parts, top = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], top), i) for i in range(len(parts) - 1))
        if rank >= top:
            raise ValueError(f"rank {top} can't be reached by merges")
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str):
    """A tokenizers.Tokenizer that merges by these ranks inside each match of the pattern."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_alphabet()
    spell = lambda raw: "".join(chars[b] for b in raw)
    merges = [split_of(t, ranks) for t, _ in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
    model = models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=[(spell(a), spell(b)) for a, b in merges], ignore_merges=True)
    made = Tokenizer(model)
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


def bytes_of_ids(tokenizer) -> list[bytes | None]:
    """Each id's bytes, those of its spelling for an added token; None for gaps."""
    back = {c: b for b, c in enumerate(byte_alphabet())}
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    table: list[bytes | None] = [None] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        if all(c in back for c in token):
            table[i] = bytes(back[c] for c in token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        table += [None] * (i + 1 - len(table))
        table[i] = token.content.encode()
    return table


class _Index(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


def _strings(array: pa.Array) -> list[str]:
    """The strings of an array without nulls."""
    return array.to_numpy(zero_copy_only=False).tolist()


def _numbered(array: pa.Array) -> tuple[list[str], np.ndarray]:
    """The different strings of an array and for each place the number of its own."""
    coded = array.dictionary_encode()
    return _strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)


class PieceEncoder:
    """Encodes blocks of texts; a piece is a text's head, or a space or line end with what follows it up to the next.

    Lines of printable characters without double, leading or trailing spaces are cut at every space and line end; other
    texts where a space meets a visible character. In the index a piece after a space stands without it, a head after "\\0" and one after a line end after "\\1".

    Pieces are remembered up to a bound; when it is met, the half that was asked for most often stays.
    """

    def __init__(self, tokenizer, cached: int = CACHED_PIECES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.cached = tokenizer, cached
        self.bytes = bytes_of_ids(tokenizer)
        chars = byte_alphabet()
        self.spelling = {b: chars[b] for b in range(256)}
        self.merger = Tokenizer(tokenizer.model)  # the merges alone, of words in the alphabet's spelling, parted by line ends of that spelling
        self.merger.pre_tokenizer = pre_tokenizers.Split(chars[10], "isolated")
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.index, self.used = _Index(), 0
        self.starts, self.counts, self.hits, self.flat = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 16, np.int32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _shrink(self) -> None:
        n = len(self.index)
        kept = np.sort(np.argsort(-self.hits[:n], kind="stable")[: self.cached // 2])
        keys = list(self.index)
        self.index = _Index()
        self.index.update((keys[k], i) for i, k in enumerate(kept.tolist()))
        counts = self.counts[kept]
        ids = self.flat[ragged(self.starts[kept], counts)]
        self.used = len(ids)
        self.flat[: self.used] = ids
        self.counts[: len(kept)], self.hits[: len(kept)], self.starts[: len(kept)] = counts, self.hits[kept] // 2, np.cumsum(counts) - counts
        self.hits[len(kept) :] = 0

    def _learn(self) -> None:
        """Ids of the pieces that the index has just numbered.

        A word of Latin letters is one match of the split and a run of signs at its end another, so the different words go
        to the merges directly, all in one call that tells whose each id is; other pieces go through the whole tokenizer.
        """
        fresh, self.index.fresh = self.index.fresh, []
        n, known, get = len(fresh), len(self.index) - len(fresh), self.index.get
        shown = pa.array(fresh, pa.large_string())
        stems = pc.utf8_rtrim(shown, _SIGNS)
        plain = pc.match_substring_regex(stems, _WORD).to_numpy(zero_copy_only=False)
        signed = plain & pc.not_equal(pc.binary_length(stems), pc.binary_length(shown)).to_numpy(zero_copy_only=False)
        words, of_word = _numbered(stems.filter(pa.array(plain)))
        tails, of_tail = _numbered(pa.array([fresh[i][len(w) :] for i, w in zip(np.flatnonzero(signed).tolist(), _strings(stems.filter(pa.array(signed))), strict=True)], pa.large_string()))
        rest = np.flatnonzero(~plain).tolist()
        texts = [fresh[i][1:] if fresh[i][:1] == "\0" else "\n" + fresh[i][1:] if fresh[i][:1] == "\1" else " " + fresh[i] for i in rest]
        # Each piece is a head, a word and a tail: their places in the pool of ids, which begins with those learnt before.
        at = np.fromiter((get(w, known) for w in words), np.int64, len(words))
        new = at >= known
        unknown = [words[k] for k in np.flatnonzero(new).tolist()]
        merged, n_unknown = self._merged(unknown)
        others = self.whole([*texts, *tails, "\n"])
        n_others = np.fromiter(map(len, others), np.int64, len(others))
        pool = np.concatenate([self.flat[: self.used], merged, np.fromiter(chain.from_iterable(others), np.int32, int(n_others.sum()))])
        begins = self.used + np.cumsum(np.concatenate([n_unknown, n_others]))
        begins -= np.concatenate([n_unknown, n_others])
        at_others, at_words, n_words = begins[len(unknown) :], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at_words[new], n_words[new] = begins[: len(unknown)], n_unknown
        at_words[~new], n_words[~new] = self.starts[at[~new]], self.counts[at[~new]]
        after_line = new & np.array([w[0] == "\1" for w in words], bool)
        starts, counts = np.zeros((n, 3), np.int64), np.zeros((n, 3), np.int64)
        starts[plain, 0], counts[plain, 0] = at_others[-1], after_line[of_word] * n_others[-1]
        starts[plain, 1], counts[plain, 1] = at_words[of_word], n_words[of_word]
        starts[rest, 1], counts[rest, 1] = at_others[: len(rest)], n_others[: len(rest)]
        starts[signed, 2], counts[signed, 2] = at_others[len(rest) + of_tail], n_others[len(rest) + of_tail]
        self._file(pool[ragged(starts.ravel(), counts.ravel())], counts.sum(axis=1))

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, one word's after another's, and how many each has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        shown = "\n".join([" " + w if w[0] not in "\0\1" else w[1:] for w in words]).encode().decode("latin-1").translate(self.spelling)
        made = np.array(self.merger.encode_batch_fast([shown], add_special_tokens=False)[0].ids, np.int32)
        parted = np.flatnonzero(made == self.merger.token_to_id(self.spelling[10]))  # no word holds a line end
        return np.delete(made, parted), np.diff(parted - np.arange(len(parted)), prepend=0, append=len(made) - len(parted))

    def _file(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Store the ids of the last pieces of the index."""
        need, n = self.used + len(ids), len(self.index)
        first = n - len(sizes)
        while len(self.starts) < n:
            self.starts, self.counts, self.hits = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.starts, self.counts, self.hits))
        while len(self.flat) < need:
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
        self.flat[self.used : need] = ids
        self.counts[first:n] = sizes
        self.starts[first:n] = self.used + np.cumsum(sizes) - sizes
        self.used = need

    def block(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's first position among them (one more entry at the end).

        The words of texts without odd white space are split and numbered as one Arrow array, so that the index is asked
        once for each different word of the block.
        """
        if len(self.index) > self.cached:
            self._shrink()
        even: list[str] = []  # words parted by single spaces
        odd: list[str] = []
        place = np.zeros((len(texts), 2), np.int64)  # a text's first piece and their number; places of odd ones are moved behind the others' below
        of_even: list[int] = []
        of_odd: list[int] = []
        apart: dict[int, np.ndarray] = {}
        for k, text in enumerate(texts):
            if not text:
                continue
            if any(a in text for a in self.added):
                apart[k] = np.array(self.whole([text])[0], dtype=np.int32)
                continue
            lines = text.split("\n")
            if "  " not in text and all(x.isprintable() and x and x[0] != " " and x[-1] != " " for x in lines):
                even.append("\0" + " \1".join(lines))
                of_even.append(k)
            elif "\0" in text or "\1" in text:
                apart[k] = np.array(self.whole([text])[0], dtype=np.int32)
            else:
                pieces = [p[1:] if p[0] == " " and len(p) > 1 and not p[1].isspace() else "\0" + p for p in _CUT.split(text) if p]
                place[k] = len(odd), len(pieces)
                of_odd.append(k)
                odd.extend(pieces)
        split = pc.split_pattern(pa.array(even, pa.large_string()), " ")
        words, of_word = _numbered(split.flatten())
        place[of_even, 1] = counts = split.value_lengths().to_numpy(zero_copy_only=False)
        place[of_even, 0] = np.cumsum(counts, dtype=np.int64) - counts
        place[of_odd, 0] += len(of_word)
        get = self.index.__getitem__
        at = np.fromiter(map(get, words), np.int64, len(words))[of_word]
        if odd:
            at = np.concatenate([at, np.fromiter(map(get, odd), np.int64, len(odd))])[ragged(place[:, 0], place[:, 1])]
        if self.index.fresh:
            self._learn()
        self.hits[: len(self.index)] += np.bincount(at, minlength=len(self.index))
        counts = self.counts[at]
        ids = self.flat[ragged(self.starts[at], counts)]
        bounds = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(place[:, 1])])]
        if apart:
            parts = [apart.get(k, ids[bounds[k] : bounds[k + 1]]) for k in range(len(texts))]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, bounds.astype(np.int64)


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, pattern: str | None = None, cached: int = CACHED_PIECES) -> PieceEncoder:
    """The worker's encoder for a vocabulary file: a tokenizers JSON, or ranks together with a split pattern. It remembers up to cached pieces from now on."""
    if (path, pattern) not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if pattern is None:
            made = Tokenizer.from_file(path)
        else:
            made = tokenizer_from_ranks(read_ranks(path), pattern)
        _ENCODERS[path, pattern] = PieceEncoder(made, cached)
    _ENCODERS[path, pattern].cached = cached
    return _ENCODERS[path, pattern]


def char_spans(raw: list[bytes]) -> list[tuple[int, int]]:
    """Character offsets of each token's bytes; a token that holds part of a character spans the whole of it."""
    whole = np.frombuffer(b"".join(raw), np.uint8)
    opened = np.concatenate([[0], np.cumsum((whole & 0xC0) != 0x80)])
    ends = np.cumsum([len(b) for b in raw])
    starts = ends - [len(b) for b in raw]
    begins = [int(opened[min(s + 1, len(whole))]) - 1 if s < len(whole) else int(opened[-1]) for s in starts]
    return list(zip(begins, (int(opened[e]) for e in ends), strict=True))


def encode(df: DataFrame, path: str, pattern: str | None = None, text: str = "text", out: str = "token_ids", offsets: bool = False) -> DataFrame:
    """Add the ids of each text, and with offsets also token_starts and token_ends in characters. Other columns stay."""
    clash = {out, *(("token_starts", "token_ends") if offsets else ())} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already; name another output")
    extra = f", `{out}` array<int>" + (", token_starts array<int>, token_ends array<int>" if offsets else "")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + extra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern, SLIM_PIECES)
        for block in row_blocks(batches, text, BLOCK_BYTES):
            ids, bounds = enc.block(block.column(text).to_pylist())
            columns = [*block.columns, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
            names = [*block.schema.names, out]
            if offsets:
                spans = [char_spans([enc.bytes[i] for i in ids[a:b].tolist()]) if b > a else [] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                columns += [pa.array([[x[k] for x in s] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                names += ["token_starts", "token_ends"]
            yield pa.RecordBatch.from_arrays(columns, names)
            del block, ids, bounds, columns
            give_back()

    return df.transform(bounded).mapInArrow(run, fields)


def decode(df: DataFrame, path: str, pattern: str | None = None, ids: str = "token_ids") -> DataFrame:
    """Add decoded_bytes and decoded_text for a column of ids; null ids stay null."""
    clash = {"decoded_bytes", "decoded_text"} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", decoded_bytes binary, decoded_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path, pattern).bytes
        for batch in batches:
            raw = [None if x is None else b"".join(map(table.__getitem__, x)) for x in batch.column(ids).to_pylist()]
            shown = [None if x is None else x.decode("utf-8", "replace") for x in raw]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary()), pa.array(shown, pa.string())], [*batch.schema.names, "decoded_bytes", "decoded_text"])

    return df.transform(bounded).mapInArrow(run, fields)


def round_trip(df: DataFrame, path: str, pattern: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode, and give per document its id count and the digests of the ids' text and of the decoded bytes.

    One row for each input row, repeated rows and null ids included; no shuffle, one pass over the text.
    """
    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        table, shown = enc.bytes, [str(i) for i in range(len(enc.bytes))]
        for block in row_blocks(batches, "text", ENCODED_BYTES):
            ids, bounds = enc.block(block.column("text").to_pylist())
            counts, spelled, decoded = np.diff(bounds), [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = ids[a:b].tolist()
                spelled.append(hashlib.sha256(" ".join(map(shown.__getitem__, own)).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(table.__getitem__, own))).hexdigest())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spelled, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return slim.transform(bounded).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
