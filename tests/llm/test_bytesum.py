import random
import tracemalloc

import numpy as np

from rentlake.llm import bytesum


def test_tables_that_a_worker_keeps_are_small_for_any_text():
    data = np.frombuffer(b"some words of a text " * 200_000, dtype=np.uint8)
    bytesum._powers.cache_clear()
    bytesum.powers(1)
    tracemalloc.start()
    try:
        hashes, first = bytesum.word_hashes(data, np.array([0, len(data)]))
        kept = tracemalloc.get_traced_memory()[0] - hashes.nbytes - first.nbytes
    finally:
        tracemalloc.stop()
        bytesum._powers.cache_clear()
    assert len(hashes) == 1_000_000
    assert kept < 8 << 20


def test_words_have_the_same_hash_in_every_segment():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdé", k=rng.randrange(1, 9))) for _ in range(2000)]
    words[700] = "x" * (bytesum.SEGMENT + 100)  # longer than a segment
    texts = [" ".join(words * 30), "", words[5], " ".join(reversed(words))]
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    hashes, first = bytesum.word_hashes(data, offsets)

    def alone(word):
        raw = np.frombuffer(word.encode(), dtype=np.uint8)
        return bytesum.word_hashes(raw, np.array([0, len(raw)]))[0][0]

    number = {w: alone(w) for w in set(words)}
    assert first.tolist() == [0, 60_000, 60_000, 60_001, 62_001]
    assert hashes.tolist() == [number[w] for t in texts for w in t.split()]
