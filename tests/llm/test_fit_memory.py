"""Fitting on the driver stays small: the driver holds its session and all models beside it."""

import tracemalloc

import numpy as np

from strandloom.llm import crf, toxicity


def test_a_fit_takes_a_few_times_its_text():
    rng = np.random.default_rng(3)
    known = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(3000)]
    texts = [" ".join(known[i] for i in rng.integers(0, 3000, 3000)) for _ in range(100)]
    toxic = np.arange(100) % 2
    words = crf.words_of(texts)
    tracemalloc.start()
    try:
        gold = toxicity.token_labels(words, toxic)
        crf.fit(["clean", "toxic"], words, gold, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30 * len(words.data)


def test_words_hash_alike_in_pieces(monkeypatch):
    words = crf.words_of(["one two three", "x" * 50 + " one", "", "three two"])
    whole = crf.word_buckets(words)
    for limit in (1, 7, 20):
        monkeypatch.setattr(crf, "HASHED", limit)
        assert crf.word_buckets(words).tolist() == whole.tolist()
    assert whole[0] == whole[4] and whole[1] == whole[6] and whole[2] == whole[5]
