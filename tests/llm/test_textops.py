import random
import tracemalloc

import numpy as np

from lineweave.llm import textops as T


def test_blocks_hash_like_the_whole(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join("é" * rng.randrange(1, 9) + str(rng.randrange(99)) for _ in range(rng.randrange(60))).encode() for _ in range(40)] + [b"", b"   ", b"x" * 900]
    whole = T.hash_words(texts)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(T, "HASH_BYTES", size)
        parts = T.hash_words(texts)
        assert (parts.h == whole.h).all() and (parts.start == whole.start).all() and (parts.first == whole.first).all()
    same = T.hash_words([b"a b", b"b  a"]).h
    assert same[0] == same[3] and same[1] == same[2] and same[0] != same[1]


def test_a_text_of_20_mb_takes_ten_bytes_a_byte():
    text = np.random.default_rng(1).integers(97, 123, 20_000_000, np.uint8)
    text[::7] = 0x20
    data = text.tobytes()
    tracemalloc.start()
    words = T.hash_words([data])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words.h) > 2_000_000 and peak < 14 * len(data)
