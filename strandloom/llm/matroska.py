"""Matroska: variable-length EBML elements, clusters, lacing and cues, parsed into packet tables.

The parser walks elements of known and unknown size, reads SimpleBlocks and BlockGroups with any of the four lacings
(none, Xiph, fixed, EBML) and gives for each frame its track, timestamp and byte range. The writer stores bytes as one
mono 8-bit PCM track: frames of 64 samples, fixed-size lacing, clusters with cues. It writes no clock or random ids,
so equal payloads make equal files.

Defined results: null or empty text is one frame of zero bytes; text of any length is written in clusters that a
16-bit block timestamp can span; damaged files raise ValueError in parse() and give no packets but an error text in
packets(); extra columns of the input stay out of the results.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import bounded, row_blocks

# Fixed values of the container format: element identifiers.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
SCALE, DURATION, MUXER, WRITER = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK, NUMBER, UID, KIND, LACING, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE, GROUP, BLOCK, REFERENCE, SPACING = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB, 0x23E383
POINT, CUE_TIME, POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
MASTERS = {EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES, TRACK, AUDIO, GROUP, POINT, POSITIONS}
TOP = {EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES}

FRAME, LACED, PER_CLUSTER, HERTZ = 64, 8, 2048, 8000


def _id(n: int) -> bytes:
    return n.to_bytes((n.bit_length() + 7) // 8, "big")


def _size(n: int) -> bytes:
    width = 1
    while n >= (1 << 7 * width) - 1:
        width += 1
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(kind: int, body: bytes) -> bytes:
    return _id(kind) + _size(len(body)) + body


def _uint(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


_HEAD = element(EBML, _uint(0x4286, 1) + _uint(0x42F7, 1) + _uint(0x42F2, 4) + _uint(0x42F3, 8) + element(0x4282, b"matroska") + _uint(0x4287, 4) + _uint(0x4285, 2))
_TRACKS = element(TRACKS, element(TRACK, _uint(NUMBER, 1) + _uint(UID, 1) + _uint(KIND, 2) + _uint(LACING, 1) + element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, element(RATE, struct.pack(">d", HERTZ)) + _uint(CHANNELS, 1) + _uint(DEPTH, 8))))


def write(payload: bytes) -> bytes:
    """A file of one PCM track; payload must be a positive multiple of FRAME bytes."""
    if not payload or len(payload) % FRAME:
        raise ValueError("the payload has no whole frames")
    frames, ms = len(payload) // FRAME, FRAME * 1000 // HERTZ
    info = element(INFO, _uint(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", frames * ms)) + element(MUXER, b"strandloom") + element(WRITER, b"strandloom"))
    parts, at, cues = [info, _TRACKS], len(info) + len(_TRACKS), []
    for first in range(0, frames, PER_CLUSTER):
        last = min(first + PER_CLUSTER, frames)
        blocks = [_uint(TIMESTAMP, first * ms)]
        for f in range(first, last, LACED):
            n = min(LACED, last - f)
            head = b"\x81" + struct.pack(">h", (f - first) * ms) + (bytes((0x84, n - 1)) if n > 1 else b"\x80")
            blocks.append(element(SIMPLE, head + payload[f * FRAME : (f + n) * FRAME]))
        parts.append(element(CLUSTER, b"".join(blocks)))
        cues.append(element(POINT, _uint(CUE_TIME, first * ms) + element(POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER, at))))
        at += len(parts[-1])
    return _HEAD + element(SEGMENT, b"".join(parts) + element(CUES, b"".join(cues)))


def _vint(data: bytes, at: int, keep: bool = False) -> tuple[int, int, bool]:
    """Value, position after it, and whether all value bits are set (unknown size)."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length number at byte {at}")
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise ValueError(f"the file ends inside a number at byte {at}")
    raw = int.from_bytes(data[at : at + width], "big")
    value = raw & (1 << 7 * width) - 1
    return raw if keep else value, at + width, value == (1 << 7 * width) - 1


def _frames(data: bytes, at: int, end: int) -> tuple[int, int, int, list[tuple[int, int]]]:
    """Track, relative timestamp, flags and the frames' byte ranges of one block."""
    track, at, _ = _vint(data, at)
    if at + 3 > end:
        raise ValueError("a block is too short")
    (relative,), flags = struct.unpack(">h", data[at : at + 2]), data[at + 2]
    at, lacing = at + 3, flags >> 1 & 3
    if not lacing:
        return track, relative, flags, [(at, end)]
    if at >= end:
        raise ValueError("a laced block is too short")
    count, at, sizes = data[at] + 1, at + 1, []
    if lacing == 1:
        for _ in range(count - 1):
            n = 0
            while data[at] == 255:
                n, at = n + 255, at + 1
            sizes.append(n + data[at])
            at += 1
    elif lacing == 3:
        for k in range(count - 1):
            start = at
            n, at, _ = _vint(data, at)
            sizes.append(n if not k else sizes[-1] + n - ((1 << 7 * (at - start) - 1) - 1))
    else:
        if (end - at) % count:
            raise ValueError("fixed lacing doesn't divide the block")
        sizes = [(end - at) // count] * (count - 1)
    ranges = []
    for n in sizes:
        ranges.append((at, at + n))
        at += n
    if at > end or any(n < 0 for n in sizes):
        raise ValueError("laced frames exceed their block")
    return track, relative, flags, [*ranges, (at, end)]


def parse(data: bytes) -> dict:
    """packets [(track, timestamp in ns, start, end, keyframe)], tracks {number: codec}, cues [(time, track, position)], scale, duration."""
    out: dict = {"packets": [], "tracks": {}, "cues": [], "scale": 1_000_000, "duration": 0.0}
    stack: list[tuple[int, int]] = []  # kind, end
    at, cluster, track, cue = 0, 0, [0, ""], [0, 0, 0]
    sound, spacing, group, refers = {}, {}, 0, False  # of the track being read: its samples; by track: frame times; packets before the group
    uint = lambda a, b: int.from_bytes(data[a:b], "big")
    while at < len(data) or stack:
        while stack and at >= stack[-1][1]:
            kind, _ = stack.pop()
            if kind == TRACK:
                out["tracks"][track[0]] = track[1]
                spacing[track[0]] = {**sound}
            elif kind == GROUP and refers:  # frames that refer to others are no key frames
                out["packets"][group:] = [(*p[:4], False) for p in out["packets"][group:]]
            elif kind == POSITIONS:
                out["cues"].append(tuple(cue))
        if at >= len(data):
            break
        kind, body, _ = _vint(data, at, keep=True)
        n, body, unknown = _vint(data, body)
        while stack and kind in TOP and stack[-1][0] in TOP - {SEGMENT}:
            stack.pop()  # an element of unknown size ends where its next sibling starts
        end = (stack[-1][1] if stack else len(data)) if unknown else body + n
        if end > (stack[-1][1] if stack else len(data)):
            raise ValueError(f"element {kind:X} at byte {at} ends outside its parent")
        if unknown and kind not in MASTERS:
            raise ValueError(f"element {kind:X} may not have an unknown size")
        if kind in MASTERS:
            stack.append((kind, end))
            if kind == TRACK:
                track, sound = [0, ""], {}
            elif kind == GROUP:
                group, refers = len(out["packets"]), False
            at = body
            continue
        if kind == TIMESTAMP:
            cluster = uint(body, end)
        elif kind in (SIMPLE, BLOCK):
            number, relative, flags, ranges = _frames(data, body, end)
            base, scale = cluster + relative, out["scale"]
            known, first = spacing.get(number, {}), ranges[0][1] - ranges[0][0]
            if SPACING in known:
                spread = known[SPACING]
            elif out["tracks"].get(number, "").startswith("A_PCM") and known.get(RATE):  # as long as its samples take
                spread = round(first * 8 * 1_000_000_000 / (known.get(DEPTH) or 8) / (known.get(CHANNELS) or 1) / known[RATE])
            else:
                spread = 0
            key = bool(flags & 0x80) or kind == BLOCK
            out["packets"] += [(number, base * scale + k * spread, a, b, key) for k, (a, b) in enumerate(ranges)]
        elif kind == REFERENCE:
            refers = True
        elif kind in (SPACING, CHANNELS, DEPTH):
            sound[kind] = uint(body, end)
        elif kind == RATE and end - body in (4, 8):
            sound[kind] = struct.unpack(">d" if end - body == 8 else ">f", data[body:end])[0]
        elif kind == NUMBER:
            track[0] = uint(body, end)
        elif kind == CODEC:
            track[1] = data[body:end].decode("ascii", "replace")
        elif kind == SCALE:
            out["scale"] = uint(body, end)
        elif kind == DURATION:
            out["duration"] = struct.unpack(">d" if end - body == 8 else ">f", data[body:end])[0] if end - body in (4, 8) else 0.0
        elif kind == CUE_TIME:
            cue[0] = uint(body, end)
        elif kind == CUE_TRACK:
            cue[1] = uint(body, end)
        elif kind == CUE_CLUSTER:
            cue[2] = uint(body, end)
        at = end
    return out


def packets(df: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """A row for each frame: key, track, codec, timestamp_ns, byte_start, byte_end, keyframe; a damaged file has one row with its error."""
    slim = df.select(F.col(key).alias("key"), F.col(media).cast("binary").alias("media"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "media"):
            rows = []
            for k, data in zip(block.column("key").to_pylist(), block.column("media").to_pylist(), strict=True):
                if data is None:
                    continue
                try:
                    found = parse(data)
                    rows += [(k, t, found["tracks"].get(t, ""), ns, a, b, key_frame, None) for t, ns, a, b, key_frame in found["packets"]]
                except (ValueError, IndexError, struct.error) as error:
                    rows.append((k, None, None, None, None, None, None, str(error)))
            names = ["key", "track", "codec", "timestamp_ns", "byte_start", "byte_end", "keyframe", "error"]
            kinds = [block.schema.field("key").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return slim.transform(bounded).mapInArrow(run, f"key {kind}, track long, codec string, timestamp_ns long, byte_start long, byte_end long, keyframe boolean, error string")


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % FRAME or (0 if raw else FRAME)), len(raw)


def store_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the Matroska file of each text."""
    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            media = [write(payload_of(t)[0]) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(media, pa.binary())], ["doc_id", "media"])

    return slim.transform(bounded).mapInArrow(run, "doc_id long, media binary")


def media_digest(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store each text, parse the stored bytes, rebuild the payload from the packets' byte ranges and describe both. One pass, no shuffle."""
    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_blocks(batches, "text"):
            rows = []
            for key, value in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist(), strict=True):
                padded, n = payload_of(value)
                media = write(padded)
                found = parse(media)
                back = b"".join([media[a:b] for _, _, a, b, _ in found["packets"]])
                last = found["packets"][-1]
                feature = f"tracks={len(found['tracks'])};packets={len(found['packets'])};cues={len(found['cues'])};last_ns={last[1]};ms={found['duration']:.0f};low={min(back)};high={max(back)};mean={sum(back) / len(back):.6f}"
                rows.append((key, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return slim.transform(bounded).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
