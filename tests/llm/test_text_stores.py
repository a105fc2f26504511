"""BPE, chunk store, Matroska, mixing and licenses against plain versions, with nulls, empty and odd rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from strandloom.llm import bpe, chunk_store, licenses, matroska, mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, extra string"


def odd_texts():
    rng = random.Random(5)
    pieces = ["word", " ", "  ", "\n", "\t", " \n ", "don't", "é", "中文", "🙂", " ", "\u0085", " ", "\x1c", "123", "!?", "<|endoftext|>", "\x00", "I'll ", "a" * 40, "é", "‍", "Ⅷ", "ﬃ", "١٢"]
    texts = ["", None, " ", "a", " a", "a ", "  a  b ", "a\n  b", "\n \nb", "x" * 5000, "word " * 3000]
    return texts + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(300)]


def frame(spark, texts, sources=("a",)):
    rows = [(i, t, "en", sources[i % len(sources)], 0, 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id", None, None, None, None, None), *rows[:2]], SCHEMA)


def test_round_trip_is_tiktokens(spark):
    texts = odd_texts()
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.round_trip(frame(spark, texts), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        text = "no id" if r.doc_id is None else texts[r.doc_id] or ""
        ids = plain.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()), repr(text)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_every_code_point_splits_alike():
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.PieceEncoder(bpe.tokenizer_from_ranks(ranks, P.PATTERN))
    points = [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}" for c in points]
    differ = []
    for k in range(0, len(texts), 5000):
        ids, bounds = own.block(texts[k : k + 5000])
        for j, t in enumerate(texts[k : k + 5000]):
            if ids[bounds[j] : bounds[j + 1]].tolist() != plain.encode_ordinary(t):
                differ.append(hex(points[k + j]))
    assert not differ, differ[:50]


def test_encode_and_decode_keep_columns_and_offsets(spark):
    df = frame(spark, ["né 🙂 x", None, ""])
    path = P.path("byte_bpe_50k.json")
    out = bpe.decode(bpe.encode(df, path, offsets=True), path).where("doc_id = 0").first()
    assert out.decoded_text == "né 🙂 x" and out.extra == "x"
    assert out.token_starts[0] == 0 and out.token_ends[-1] == len("né 🙂 x")
    assert all(0 <= a < b <= 6 for a, b in zip(out.token_starts, out.token_ends, strict=True))
    with pytest.raises(ValueError):
        bpe.encode(df, path, out="extra")
    half = spark.createDataFrame([([bpe.encoder(path).block(["🙂"])[0].tolist()[0]],)], "token_ids array<int>")
    assert bpe.decode(half, path).first().decoded_text == "�"


def test_small_cache_gives_the_same_ids():
    path = P.path("byte_bpe_50k.json")
    made = Tokenizer.from_file(path)
    tight, texts = bpe.PieceEncoder(made, cached=10), [t or "" for t in odd_texts()]
    for k in range(0, len(texts), 20):
        ids, bounds = tight.block(texts[k : k + 20])
        for j, t in enumerate(texts[k : k + 20]):
            assert ids[bounds[j] : bounds[j + 1]].tolist() == made.encode(t, add_special_tokens=False).ids


def test_store_gives_back_every_stream(spark):
    texts = [*odd_texts(), "same words here " * 900, "same words here " * 900]
    path = P.path("byte_bpe_50k.json")
    made = Tokenizer.from_file(path)
    df = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(3)
    rows = {r.doc_id: r for r in chunk_store.store_round_trip(df, path).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = [*made.encode(t or "", add_special_tokens=False).ids, 0]
        r = rows[i * 3]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert chunk_store.store_round_trip(df.limit(0), path).count() == 0


def test_pieces_of_words_and_signs_are_the_librarys():
    made = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    parts = ["word", "Straße", "ɏʰ", "it's", "'tis", "x'", "a1", "中文", "0", "é"], ["", ".", ",", "###", "!?", "'", "'s", "_", "…", ".5", "\n", "\n.", " ", "\0", "\1"]
    texts = [f"{a}{s} {b}{t}\n{a}{t}" for a in parts[0] for b in parts[0][:5] for s in parts[1] for t in parts[1]]
    for texts in (texts, texts[::-1]):
        for size in (1, 97):
            own = bpe.PieceEncoder(made, cached=2000)
            for k in range(0, len(texts) if size > 1 else 300, size):
                ids, bounds = own.block(texts[k : k + size])
                assert np.split(ids, bounds[1:-1])[0].tolist() == made.encode(texts[k]).ids
                assert ids.tolist() == [i for t in texts[k : k + size] for i in made.encode(t, add_special_tokens=False).ids]


def test_special_tokens_and_repeated_rows_are_stored_as_the_library_gives_them(spark):
    path = P.path("byte_bpe_50k.json")
    made = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "a  <|endoftext|>  b\n<|endoftext|>", "<|endoftext|>", "<|endoftext", "x y " * 400]
    assert made.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (None, texts[4]), (None, None)], "doc_id long, text string").repartition(3)
    rows = chunk_store.store_round_trip(df, path).collect()
    assert len(rows) == 8 and len({(r.start) for r in rows}) == 8
    for r in rows:
        if r.doc_id is not None:
            ids = [*made.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    decoded = bpe.decode(bpe.encode(df.where("doc_id = 0"), path), path).first()
    assert decoded.decoded_text == texts[0]
    with pytest.raises(ValueError):
        bpe.decode(df.selectExpr("array(1) as token_ids", "text as decoded_text"), path)


def test_store_keeps_equal_chunks_once_and_finds_damage(spark, tmp_path):
    folder, text = f"file://{tmp_path}/store", "".join(chr(97 + i * i % 26) + " " * (i % 3 == 0) for i in range(9000))
    df = spark.createDataFrame([(i, text) for i in range(6)], "doc_id long, text string").repartition(3)
    chunk_store.write_store(df, folder, P.path("byte_bpe_50k.json"))
    chunks = spark.read.parquet(f"{folder}/chunks").where("kind = 1")
    assert chunks.count() == chunks.select("key").distinct().count() > 1
    bad = chunks.selectExpr("unhex(concat('00', substring(hex(key), 3))) as key", "doc_id", "n", "body", "root", "copies", "kind")
    rows = bad.collect()
    spark.createDataFrame(rows, bad.schema).write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/chunks")
    with pytest.raises(Exception, match="differs"):
        chunk_store.read_store(spark, folder).collect()


def test_chunks_cut_alike_wherever_they_stand():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50000, 20000)
    cuts = lambda x: chunk_store.cut_points(chunk_store.marks_of(x).tolist(), 0, len(x))
    ends = cuts(ids)
    mask = np.uint64(chunk_store.MASK)
    mixed = [int(i) * 0x9E3779B97F4A7C15 % 2**64 for i in ids]
    mixed = [x ^ x >> 29 for x in mixed]
    rolled = [sum(mixed[i - k] * pow(0x5851F42D4C957F2D, k, 2**64) for k in range(chunk_store.WINDOW)) % 2**64 for i in range(chunk_store.WINDOW, 3000)]
    marked = set(chunk_store.marks_of(ids).tolist())
    assert all((np.uint64(h >> 40) & mask == 0) == (i + 1 in marked) for i, h in enumerate(rolled, chunk_store.WINDOW))
    two = np.concatenate([ids[:7000], [0], ids[:9000]])
    split = chunk_store.marks_of(two).tolist()
    assert [e - 7001 for e in chunk_store.cut_points([m for m in split if m > 7001], 7001, len(two))] == cuts(ids[:9000])
    assert ends[-1] == len(ids) and all(b - a <= chunk_store.MOST for a, b in zip([0, *ends], ends, strict=False))
    moved = {e - 333 for e in cuts(np.concatenate([rng.integers(0, 50000, 333), ids]))}
    assert len(moved & set(ends)) > 0.8 * len(ends)
    parts = [b"abc", b"", b"defgh" * 999, b"i", b"x"]
    joined = chunk_store.crcs_joined(np.array([zlib.crc32(p) for p in parts]), np.array([len(p) for p in parts]), np.array([3, 0, 2]))
    assert joined.tolist() == [zlib.crc32(b"".join(parts[:3])), 0, zlib.crc32(b"ix")]
    assert chunk_store.merkle_root([]) != chunk_store.merkle_root([b"a" * 16])


def test_matroska_gives_back_payloads(spark):
    texts = [*odd_texts(), "z" * 700_000]
    rows = matroska.media_digest(frame(spark, texts)).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        raw = ("no id" if r.doc_id is None else texts[r.doc_id] or "").encode()
        padded = raw + b"\0" * (max(1, -(-len(raw) // 64)) * 64 - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest())
        assert r.tail_crc32 == zlib.crc32(padded[-64:]) and r.media_bytes > r.payload_bytes
    media = matroska.store_texts(frame(spark, ["hello", None]))
    table = matroska.packets(media).where("key = 0").collect()
    assert [(p.track, p.codec, p.timestamp_ns, p.byte_end - p.byte_start, p.error) for p in table] == [(1, "A_PCM/INT/LIT", 0, 64, None)] * 2
    broken = spark.createDataFrame([(1, b"\x1a\x45\xdf\xa3\xff\x00"), (2, None)], "doc_id long, media binary")
    assert [r.error is not None for r in matroska.packets(broken).collect()] == [True]


def test_matroska_key_frames_rates_and_cues():
    m = matroska
    audio = m.element(m.AUDIO, m.element(m.RATE, m.struct.pack(">d", 48000.0)) + m._uint(m.CHANNELS, 2) + m._uint(m.DEPTH, 16))
    tracks = m.element(m.TRACKS, m.element(m.TRACK, m._uint(m.NUMBER, 1) + m.element(m.CODEC, b"A_PCM/INT/LIT") + audio) + m.element(m.TRACK, m._uint(m.NUMBER, 2) + m.element(m.CODEC, b"V_X") + m._uint(m.SPACING, 40_000_000)))
    laced = m.element(m.SIMPLE, b"\x81\x00\x00\x84\x01" + b"a" * 384)  # two frames of 192 bytes, 48 samples of 4 bytes: 1 ms each
    plain = m.element(m.GROUP, m.element(m.BLOCK, b"\x82\x00\x05\x00xy"))
    refers = m.element(m.GROUP, m.element(m.BLOCK, b"\x82\x00\x07\x04\x01xy") + m.element(m.REFERENCE, b"\xfe"))
    data = m._HEAD + m.element(m.SEGMENT, tracks + m.element(m.CLUSTER, m._uint(m.TIMESTAMP, 0) + laced + plain + refers))
    got = [(t, ns, key) for t, ns, _, _, key in m.parse(data)["packets"]]
    assert got == [(1, 0, True), (1, 1_000_000, True), (2, 5_000_000, True), (2, 7_000_000, False), (2, 47_000_000, False)]
    payload = bytes(64 * 5000)
    media = m.write(payload)
    found = m.parse(media)
    segment = media.index(m._id(m.SEGMENT)) + 4
    start = segment + 1 + (8 - media[segment].bit_length())
    assert len(found["cues"]) == 3 and all(media[start + at :][:4] == m._id(m.CLUSTER) for _, _, at in found["cues"])
    assert [p[1] for p in found["packets"][:3]] == [0, 8_000_000, 16_000_000]


def test_matroska_reads_every_lacing_and_unknown_sizes():
    e, frames = matroska.element, [b"a" * 300, b"b" * 10, b"c" * 7]
    body = b"".join(frames)
    xiph = b"\x81\x00\x05\x02\x02" + b"\xff\x2d\x0a" + body
    ebml = b"\x81\x00\x06\x06\x02" + b"\x41\x2c" + (10 - 300 + 8191 | 0x4000).to_bytes(2, "big") + body
    plain = b"\x81\x00\x07\x80" + b"solo"
    cluster = b"\x1f\x43\xb6\x75\x01\xff\xff\xff\xff\xff\xff\xff" + e(0xE7, b"\x0a") + e(0xA3, xiph) + e(0xA0, e(0xA1, ebml)) + e(0xEC, b"void") + e(0xA3, plain)
    data = e(0x1A45DFA3, b"") + b"\x18\x53\x80\x67\x01\xff\xff\xff\xff\xff\xff\xff" + cluster + cluster
    got = matroska.parse(data)["packets"]
    assert [data[a:b] for _, _, a, b, _ in got] == [*frames, *frames, b"solo"] * 2
    assert [p[1] for p in got[:7]] == [15_000_000] * 3 + [16_000_000] * 3 + [17_000_000]


def test_mix_takes_what_targets_ask(spark):
    rng = random.Random(2)
    rows = [(i, "w " * min(400, int(rng.expovariate(0.02))), rng.choice(["hot"] * 6 + ["b", "c", None])) for i in range(4000)]
    df = spark.createDataFrame([*rows, (None, None, "void"), (1, "", "hot")], "doc_id long, text string, source string")
    out = mixing.mix_report(df).collect()
    assert len(out) == len(rows) + 2
    total, by = sum(r.size for r in out), {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        x = by.setdefault((r.target, r.source_size), [r.source_size, 0])
        x[1] += r.taken
    assert abs(sum(t for t, _ in by) - total) < 1e-6 * total
    assert all(target <= 3 * size and abs(taken - target) <= max(800, 0.03 * target) for (target, _), (size, taken) in by.items())
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixing.mix_report(df.repartition(7)).collect()), key=repr)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mix(df.limit(0)).count() == 0
    drawn = {}
    for r in out:
        drawn[r.doc_id] = drawn.get(r.doc_id, 0) + r.copies
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: n for k, n in drawn.items() if n}


def test_mix_of_repeated_rows_and_clashing_names(spark):
    """Rows alike in all columns come as often as all of them were drawn; names of inner columns may be taken."""
    fields = "doc_id long, text string, source string, size string, copies long, _row string, _key string, rows long, m map<string,int>"
    rows = [(i, f"w{i} " * (5 + i % 3), "ab"[i % 2], "s", i, "r", None, 1, {"k": i}) for i in range(300)]
    rows += [(7, "same text", "a", None, None, None, "k", None, None)] * 90 + [(None, "same text", None, None, None, None, "k", None, {})] * 40
    rows += [(8, "one id", "a", None, None, None, None, None, {"k": k}) for k in range(30)]
    df = spark.createDataFrame(rows, fields)
    report, mixed = mixing.mix_report(df).collect(), mixing.mix(df)
    assert mixed.columns == df.columns and mixed.schema == df.schema
    drawn, got = {}, {}
    for r in report:
        drawn[r.doc_id] = drawn.get(r.doc_id, 0) + r.copies
    out = mixed.collect()
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: n for k, n in drawn.items() if n} and len(out) == sum(drawn.values())
    given = {repr(r) for r in df.collect()}
    assert {repr(r) for r in out} <= given


def test_mix_levels_like_repeated_sharing(spark):
    counts = spark.createDataFrame([("a", 10, 1), ("b", 1000, 5), ("c", 3, 100), (None, 0, 4), ("d", 7, 9)], "source string, size long, rows long")
    got = {r.source: r for r in mixing.source_targets(counts).collect()}
    sizes = {s: got[s].source_size for s in ("a", "b", "c", "d", None)}
    weights, left, target = dict(zip(sizes, (5, 2, 1, 5, 2), strict=True)), sum(sizes.values()), {}
    while True:
        share = {s: left * w / sum(weights.values()) for s, w in weights.items()}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            del weights[s]
    assert all(abs(got[s].target - t) < 1e-6 for s, t in target.items())


def test_licenses(spark):
    texts = ["x. Licensed under the Apache License, Version 2.0.\nRest", "Permission is hereby granted", None, "", "no words.\nThis work is licensed under the\nGNU General Public License, version 3.", "All rights reserved. Released under the MIT License."]
    mit = [k for k, v in licenses.SENTENCES.items() if v in ("mitgrant", "mitnotice", "mitwarranty")]
    texts.append(". ".join(mit) + ".")
    got = {r.doc_id: (r.licenses, r.n_known) for r in licenses.scan(frame(spark, texts)).collect()}
    assert [got[i] for i in range(7)] == [("Apache-2.0", 1), ("", 0), ("", 0), ("", 0), ("GPL-3.0-only", 0), ("MIT,all-rights-reserved", 2), ("MIT", 3)]


def test_every_license_sentence_has_a_key_word():
    import re

    assert all(re.search(licenses.KEYWORDS, s) for s in licenses.SENTENCES)
    assert {w for p, _ in licenses.RULES for w in re.findall("[a-z0-9]+", p)} == set(licenses.SENTENCES.values())


def test_licenses_whose_phrases_are_broken(spark):
    warranty = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    texts = ["This work is in the public\ndomain.", "All rights\nreserved.", "All  Rights\tReserved.", "This is free and unencumbered software released into the public\ndomain.", warranty]
    got = {r.doc_id: (r.licenses, r.sentence_ids) for r in licenses.scan(frame(spark, texts)).collect()}
    assert [got[i] for i in range(5)] == [("public-domain", ""), ("all-rights-reserved", ""), ("all-rights-reserved", "reserved"), ("Unlicense", ""), ("", "mitwarranty")]


def test_every_license_sentence_has_a_stem_inside_a_word():
    import re

    assert re.fullmatch("[a-z|]+", licenses.GATE.removeprefix("(?i)"))
    assert all(re.search(licenses.GATE, s) for s in licenses.SENTENCES)


def test_queries_are_registered():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted([*(f"op{n}" for n in range(1, 11)), "pipeline"])
    assert set(queries.ORACLES) <= set(queries.QUERIES)
