"""Toxicity, language and personal data: models against held-out labels and brute force, with odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strandloom.llm import crf, langid, pii, toxicity

SCHEMA = "doc_id long, text string, lang string, score double, extra string"


def corpus(n=700, seed=1):
    rng = random.Random(seed)
    plain = {"aa": ["thon", "shar", "ingly", "the", "whor", "neath"], "bb": ["eaux", "mentre", "laire", "queil", "les", "oipour"]}
    docs, labels = [], []
    for i in range(n):
        lang = "aa" if i % 3 else "bb"
        words = [rng.choice(plain[lang]) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(5, 60))]
        toxic = i % 7 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), "grubbl" + rng.choice(["", "ig", "ed", "on", "ish", "ers"]))
        docs.append((i, " ".join(words).capitalize() + ".", lang, 0.5, "x"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_chain_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(0)
    scores, trans = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    found, pairs = crf.marginals(scores, trans, np.array([0]), np.array([4]), pairs=True)
    ways = np.array(np.meshgrid(*[range(3)] * 4, indexing="ij")).reshape(4, -1)
    weight = np.exp(sum(scores[t, ways[t]] for t in range(4)) + sum(trans[ways[t], ways[t + 1]] for t in range(3)))
    truth = np.array([[weight[ways[t] == k].sum() for k in range(3)] for t in range(4)]) / weight.sum()
    assert np.allclose(found, truth)
    both = np.array([[sum(weight[(ways[t] == a) & (ways[t + 1] == b)].sum() for t in range(3)) for b in range(3)] for a in range(3)]) / weight.sum()
    assert np.allclose(pairs, both)


def test_chains_cover_each_word_once_and_long_texts_are_cut_between_words():
    words = crf.words_of(["abc def " * 100, "", "x"])
    starts, lengths = crf.chains_of(words.piece)
    assert sorted(i for s, n in zip(starts, lengths, strict=True) for i in range(s, s + n)) == list(range(201))
    text = "word " * 1000 + "y" * 700
    pieces = list(crf.pieces_of([None, text, ""], limit=512))
    assert "".join(p for _, _, p in pieces) == text and all(len(p) <= 512 for _, _, p in pieces) and {k for k, _, _ in pieces} == {1}
    assert crf.lowered("İA") == "İa" or len(crf.lowered("İA")) == 2


def test_toxicity_finds_held_out_documents_and_spans(spark):
    docs, labels = corpus()
    df = spark.createDataFrame([*docs, (None, None, None, None, None), (9001, "", "aa", None, None), docs[0]], SCHEMA)
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    rows = toxicity.score_report(df, lab).collect()
    assert len(rows) == len(docs) + 3 and all(0 <= r.score <= 1 for r in rows)
    toxic = dict(labels)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert np.mean([r.predicted == toxic.get(r.doc_id, 0) for r in held]) > 0.97
    assert [r.predicted for r in rows if r.doc_id in (None, 9001)] == [0, 0]
    model = toxicity.fit(df, lab)
    spans = {r.doc_id: [docs[r.doc_id][1][s["start"] : s["end"]] for s in r.spans] for r in toxicity.tag_spans(df.where("doc_id < 700"), model).collect()}
    assert np.mean([any("grubbl" in s.lower() for s in spans[i]) == bool(t) for i, t in labels]) > 0.97
    none = toxicity.score_report(df, lab.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_report(df.limit(0), lab).count() == 0
    with pytest.raises(ValueError):
        toxicity.score(df, model)


def test_language_by_held_out_rows(spark):
    docs, _ = corpus()
    df = spark.createDataFrame([*docs, (None, "thon shar", None, None, None), (9002, "123 !?", "aa", None, None), (9003, None, None, None, None), (9004, "", "bb", None, None)], SCHEMA)
    rows = langid.report(df).collect()
    held = [r for r in rows if r.held_out and r.doc_id < 700]
    assert np.mean([r.lang_pred == docs[r.doc_id][2] for r in held]) > 0.98
    odd = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id is None or r.doc_id > 9000}
    assert odd[9002] == odd[9003] == odd[9004] == ("und", 0.0) and odd[None][0] == "aa"
    assert {r.lang_pred for r in langid.report(df.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_are_the_patterns():
    rng = random.Random(4)
    parts = ["4111 1111 1111 1111", "+1 (212) 555-0100", "10.0.0.255", "256.1.1.1", "a.b@c.d-e.com", "@", "..", "x@y", " ", "\n", "7", "-", "+", "é", "(", "1.2.3.4.5.6.7.8", "a@b.c@d.e"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert pii.base_spans(text) == brute(text), repr(text)


def test_base_spans_are_linear_on_hostile_texts():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000, "a@b." * 75_000):
        pii.base_spans(text)


def test_segment_marginals_sum_over_all_segmentations():
    text = "ab 12345678 c@d.ef"
    lattice = pii.Lattice(text, 0, len(text))
    model = pii.SegmentModel()
    rng = np.random.default_rng(3)
    model.trans = rng.normal(size=(5, 5))
    for s in lattice.segments:
        for f in s[2]:
            model.weights.setdefault(f, rng.normal(size=4))
    starts = {}
    for s, (i, j, f) in enumerate(lattice.segments):
        starts.setdefault(i, []).append((s, j, model.segment_scores(f)))
    totals = np.zeros((len(lattice.segments), 4))
    whole = 0.0

    def walk(at, last, weight, used):
        nonlocal whole
        if at == lattice.n:
            whole += weight
            for s, c in used:
                totals[s, c] += weight
            return
        walk(at + 1, 0, weight * np.exp(model.trans[last, 0]), used)
        for s, j, score in starts.get(at, ()):
            for c in range(4):
                walk(j, c + 1, weight * np.exp(model.trans[last, c + 1] + score[c]), [*used, (s, c)])

    walk(0, 0, 1.0, [])
    assert np.allclose(model.marginals(lattice)[0], totals / whole, atol=1e-8)
    ways = []

    def best(at, last, score, used):
        if at == lattice.n:
            ways.append((score, used))
            return
        best(at + 1, 0, score + model.trans[last, 0], used)
        for s, j, own in starts.get(at, ()):
            for c in range(4):
                best(j, c + 1, score + model.trans[last, c + 1] + own[c], [*used, (s, c)])

    best(0, 0, 0.0, [])
    at = lambda s: tuple(lattice.bounds[i] for i in lattice.segments[s][:2])
    assert [x[:3] for x in model.best(lattice)] == [(*at(s), c) for s, c in max(ways, key=lambda w: w[0])[1]]


def test_pii_report_and_mask(spark):
    rng = random.Random(6)
    texts = [f"word mail me.{i}@site{i}.org or +1 (212) 555-{1000 + i} from 10.1.2.{i % 256} end" if i % 2 else f"plain text {i} without" for i in range(200)]
    rows = [(i, t, "aa", 0.1, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, None, None, None, None), (500, "", None, None, None), rows[1]], SCHEMA)
    model = pii.fit(df)
    out = {r.doc_id: r for r in pii.report(df, model).collect()}
    assert (out[1].n_email, out[1].n_ip, out[1].n_card, out[1].n_phone) == (1, 1, 0, 1) and out[None].spans == "" and out[2].spans == ""
    for i, t in enumerate(texts):
        assert set(",".join(f"{k}:{a}:{b}" for a, b, k in brute(t)).split(",")) <= set(out[i].spans.split(","))
    masked = pii.mask(df.withColumn("n_chars", df.doc_id), model)
    assert masked.columns == [*df.columns, "n_chars"]
    row = masked.where("doc_id = 1").first()
    assert row.text == "word mail [EMAIL] or [PHONE] from [IP] end" and row.n_chars == len(row.text)
    assert masked.where("doc_id = 2").first().text == texts[2] and masked.count() == 203
    assert pii.report(df.limit(0), pii.fit(df.limit(0))).count() == 0
    del rng


def test_model_adds_spans_that_patterns_miss():
    rng = random.Random(8)
    texts = [f"call +1 (212) 555-{rng.randint(1000, 9999)} now {rng.randint(10, 99)} items" for _ in range(300)]
    model = pii.fit_segments(texts)
    base, spans = pii.find("call (212) 555-1234 now or +1 (212) 555-9876 then", model)
    assert set(base) <= set(spans) and len(base) == 1 and (5, 19, "phone") in spans
    assert all(not (a < y and x < b) for a, b, _ in set(spans) - set(base) for x, y, _ in base)
    fresh, found, planted, wrong, decoys = np.random.default_rng(99), 0, 0, 0, 0
    for _ in range(800):
        text, span = pii.taught(fresh)
        base, spans = pii.find(text, model)
        if span:
            planted += 1
            found += span in spans
        else:
            decoys += 1
            wrong += spans != base
    print("planted", planted, "found", found, "decoys", decoys, "wrongly marked", wrong)
    assert found >= 0.9 * planted and wrong <= 0.02 * decoys


def test_added_spans_in_long_regions_are_found_wherever_they_lie():
    model = pii.fit_segments([])
    for n in range(60, 420, 7):
        text = "-".join("ab1" for _ in range(n)) + " (212) 555-1234 end " + "x1" * n
        start = text.index("(212)")
        assert (start, start + 14, "phone") in pii.find(text, model)[1], n
    assert pii.find("", model) == ([], []) and pii.find(None, model) == ([], [])
    long = "word " * 200_000 + "(212) 555-1234 " + "1 " * 5_000
    assert (1_000_000, 1_000_014, "phone") in pii.find(long, model)[1] or pii.find(long, model)[0] == []


def test_base_digest_is_that_of_the_patterns(spark):
    rng = random.Random(12)
    parts = ["4111 1111 1111 1111", "+1 (212) 555-0100", "10.0.0.255", "a.b@c.d-e.com", " ", "\n", "7", "é", "x"]
    texts = [None, "", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(200)], "w " * 100_000 + "q@r.st"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(df, pii.fit(df)).collect():
        base = brute(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in base) for k in pii.KINDS)


def test_toxicity_report_has_the_spans_of_the_tagger(spark):
    docs, labels = corpus(400)
    df = spark.createDataFrame([*docs, (8000, "é " * 70_000 + "grubblish", "aa", None, None)], SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.score_report(df, lab).collect()}
    tagged = {r.doc_id: ",".join(f"{s['start']}:{s['end']}" for s in r.spans) for r in toxicity.tag_spans(df, toxicity.fit(df, lab)).collect()}
    assert {k: r.spans for k, r in rows.items()} == tagged and sum(bool(r.spans) for r in rows.values()) >= 50
    assert rows[8000].spans == "140000:140009"
