"""A content-addressed store for token-id streams.

Each document's ids (with an end id) are cut where a rolling hash of the last ids meets a mask, so equal stretches
make equal chunks wherever they stand. A chunk is filed under the digest of its ids and stored once; a document is a
recipe of digests with a Merkle root over them, and documents stand in ascending id order in range-partitioned files.

Store layout under one folder: `chunks/kind=1` (key: the digest, n, body: zstd of the ids), `chunks/kind=0` (equal recipes
once, with the number of copies; key: a digest of their id and root, so that a task that runs again, over rows in another
order, makes the same keys), `recipes` (doc_id, n_tokens, digests, root, part, before) sorted by doc_id, part counting the files and
before the ids earlier in the file. Texts are encoded once and chunks go through one shuffle, where each digest meets.

Reading back decodes every stored chunk, checks it against its digest and takes its crc32; a document's crc32 comes
from its chunks' by the rule for joined streams, so no stream has to be shuffled whole. Only slim rows are.

Defined results: null text is the end id alone; rows with a null doc_id come first; repeated rows each have a recipe,
in no fixed order among themselves; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.llm.bpe import _ENCODERS, ENCODED_BYTES, encoder
from strandloom.llm.common import bounded, row_blocks, shuffle_width, work_dir

WINDOW, MASK, LEAST, MOST, DIGEST = 8, (1 << 9) - 1, 64, 4096, 16
#: Digests a task remembers, to store a chunk once for each task at most before the shuffle.
SEEN = 200_000


_BASE = 0x5851F42D4C957F2D
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The rolling hash's base, up to its n-th power, and its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))])) for base in (_BASE, pow(_BASE, -1, 1 << 64))]
    return [p[:n] for p in _POWERS]


def marks_of(ids: np.ndarray) -> np.ndarray:
    """Positions after which the hash of the last WINDOW ids has its mask bits zero."""
    n = len(ids)
    with np.errstate(over="ignore"):
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        up, down = _powers(n)
        sums = np.cumsum(mixed * down)
        sums[WINDOW:] -= sums[:-WINDOW].copy()
        sums *= up
    return np.flatnonzero((sums >> np.uint64(40)) & np.uint64(MASK) == 0) + 1


def cut_points(marks: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the stream from start to end: at marks, within LEAST and MOST."""
    ends, last = [], start
    for m in [*marks, end]:
        while m - last > MOST:
            last += MOST
            ends.append(last)
        if m - last >= LEAST or m == end and m > last:
            ends.append(m)
            last = m
    return ends


def packed(ids: np.ndarray) -> bytes:
    """Ids as 16-bit numbers where they fit, else as 32-bit ones."""
    return ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()


def unpacked(raw: bytes, n: int) -> bytes:
    """The ids as little-endian 32-bit numbers."""
    return np.frombuffer(raw, "<u2").astype("<u4").tobytes() if len(raw) == 2 * n else raw


def merkle_root(digests: list[bytes]) -> bytes:
    """Pairwise hashes up to one; an odd last digest moves up as it is. No digest: the hash of nothing."""
    level = digests or [hashlib.blake2b(b"", digest_size=DIGEST).digest()]
    while len(level) > 1:
        level = [hashlib.blake2b(b"\1" + level[i] + level[i + 1], digest_size=DIGEST).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _times(matrix: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


_ZEROS: list[list[int]] = []
_TABLES: dict[int, np.ndarray] = {}


def _shift_tables(k: int) -> np.ndarray:
    """For each of a crc's four bytes, what 2**k zero bytes after it make of that byte."""
    if not _ZEROS:
        step = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
        for _ in range(3):
            step = [_times(step, column) for column in step]
        _ZEROS.append(step)  # one zero byte
    while len(_ZEROS) <= k:
        _ZEROS.append([_times(_ZEROS[-1], column) for column in _ZEROS[-1]])
    if k not in _TABLES:
        _TABLES[k] = np.array([[_times(_ZEROS[k], v << 8 * byte) for v in range(256)] for byte in range(4)], np.uint32)
    return _TABLES[k]


def crcs_joined(crcs: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """crc32 of byte strings set end to end, counts of them for each result, from their crc32 and sizes."""
    ends = np.cumsum(sizes)
    last = np.cumsum(counts)
    after = np.repeat(np.concatenate([[0], ends])[last], counts) - ends  # bytes behind each string in its own result
    moved = crcs.astype(np.uint32)
    k = 0
    while (after >> k).any():
        at = np.flatnonzero(after >> k & 1)
        t, v = _shift_tables(k), moved[at]
        moved[at] = t[0][v & 255] ^ t[1][v >> 8 & 255] ^ t[2][v >> 16 & 255] ^ t[3][v >> 24]
        k += 1
    sums = np.concatenate([[0], np.bitwise_xor.accumulate(moved)]).astype(np.uint32)
    return sums[last] ^ sums[last - counts]


def write_store(df: DataFrame, folder: str, vocabulary: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode the texts of df with a tokenizers file and write their store."""
    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, press, seen = encoder(vocabulary), zstandard.ZstdCompressor(level=1), set()
        names, kinds = ["kind", "key", "doc_id", "n", "body", "root"], (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        for block in row_blocks(batches, "text", ENCODED_BYTES):
            ids, bounds = enc.block(block.column("text").to_pylist())
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")  # each document's end id
            bounds = bounds + np.arange(len(bounds))
            marks = marks_of(ids)  # a mark within LEAST of a document's start, where the window reaches back, is no cut
            own, rows = np.searchsorted(marks, bounds, side="right"), []
            marks = marks.tolist()
            for i, (key, a, b) in enumerate(zip(block.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                last, digests = a, []
                for end in cut_points(marks[own[i] : own[i + 1]], a, b):
                    digest = hashlib.blake2b(ids[last:end].tobytes(), digest_size=DIGEST).digest()
                    digests.append(digest)
                    if digest not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(digest)
                        rows.append((1, digest, None, end - last, press.compress(packed(ids[last:end])), None))
                    last = end
                root = merkle_root(digests)
                rows.append((0, hashlib.blake2b(repr(key).encode() + root, digest_size=DIGEST).digest(), key, b - a, b"".join(digests), root))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    spark = df.sparkSession
    fields = "kind int, key binary, doc_id long, n long, body binary, root binary"
    first = [F.first(c).alias(c) for c in ("doc_id", "n", "body", "root")]
    once = slim.transform(bounded).mapInArrow(run, fields).groupBy("kind", "key").agg(*first, F.count("*").alias("copies"))
    once.write.partitionBy("kind").option("compression", "uncompressed").parquet(f"{folder}/chunks")
    read = spark.read.schema(fields + ", copies long").parquet(f"{folder}/chunks").where("kind = 0")
    recipes = read.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", F.col("n").alias("n_tokens"), F.col("body").alias("digests"), "root")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _ENCODERS.clear()  # the texts are encoded; a reused worker has no use for its pieces
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            sums = before + np.cumsum(n)
            if len(n):
                before = int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part), pa.int32()), pa.array(sums - n, pa.int64())], [*batch.schema.names, "part", "before"])

    ordered = recipes.repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id")
    ordered.transform(bounded).mapInArrow(count, "doc_id long, n_tokens long, digests binary, root binary, part int, before long").write.parquet(f"{folder}/recipes")


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Per document from the store's files: doc_id, start, n_tokens, ids_crc32, root. A chunk or recipe that fails its digest, root or count is an error."""
    chunks = spark.read.schema("kind int, key binary, n long, body binary").parquet(f"{folder}/chunks").where("kind = 1").select(F.col("key").alias("digest"), "n", F.col("body").alias("payload"))
    recipes = spark.read.schema("doc_id long, n_tokens long, digests binary, root binary, part int, before long").parquet(f"{folder}/recipes")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for batch in batches:
            sums = []
            for digest, n, payload in zip(*(batch.column(c).to_pylist() for c in ("digest", "n", "payload")), strict=True):
                raw = unpacked(press.decompress(payload), n)
                if hashlib.blake2b(raw, digest_size=DIGEST).digest() != digest:
                    raise ValueError(f"chunk {digest.hex()} differs from its digest")
                sums.append(zlib.crc32(raw))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("n"), pa.array(sums, pa.int64())], ["digest", "n", "crc"])

    sums = chunks.transform(bounded).mapInArrow(checked, "digest binary, n long, crc long")
    steps = F.sequence(F.lit(0), F.expr(f"cast(length(digests) / {DIGEST} as int) - 1"))
    row = recipes.select("part", "before", F.posexplode(steps).alias("k", "at"), "digests").select("part", "before", "k", F.expr(f"substring(digests, at * {DIGEST} + 1, {DIGEST})").alias("digest"))
    parts = row.join(sums, "digest").groupBy("part", "before").agg(F.array_sort(F.collect_list(F.struct("k", "n", "crc", "digest"))).alias("pieces"))
    totals = recipes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    shifts = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("shift"))  # one row a file
    whole = recipes.select("part", "before", "doc_id", "n_tokens", "root").join(parts, ["part", "before"], "left").join(shifts, "part")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("pieces")
            flat, counts = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            n, last = flat.field("n").to_numpy(), np.cumsum(counts)
            digests, ends = flat.field("digest").to_pylist(), np.concatenate([[0], np.cumsum(n)])
            if (ends[last] - ends[last - counts] != batch.column("n_tokens").to_numpy()).any():
                raise ValueError("a recipe differs from its count")
            for i, root in enumerate(batch.column("root").to_pylist()):
                if merkle_root(digests[last[i] - counts[i] : last[i]]) != root:
                    raise ValueError("a recipe differs from its root")
            sums = crcs_joined(flat.field("crc").to_numpy(), 4 * n, counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums.astype(np.int64)), batch.column("root")], ["doc_id", "start", "n_tokens", "ids_crc32", "root"])

    placed = whole.select("doc_id", (F.col("before") + F.col("shift")).alias("start"), "n_tokens", "root", "pieces")
    return placed.transform(bounded).mapInArrow(folded, "doc_id long, start long, n_tokens long, ids_crc32 long, root binary")


def store_round_trip(df: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write a store into the shared folder and read it back."""
    folder = f"{work_dir(df.sparkSession)}/strandloom/store-{uuid.uuid4().hex}"
    write_store(df, folder, vocabulary, end_id)
    return read_store(df.sparkSession, folder)
