import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing, stretches

WORDS = public_tokenizers.path("word_bpe_49k.json")


def made(calls):
    """Ids of a stretch: as many as its first byte modulo 4, from its checksum on."""

    def make(words):
        calls.append(list(words))
        return [np.arange(zlib.crc32(w) % 1000, zlib.crc32(w) % 1000 + w[0] % 4, dtype="<u4").tobytes() for w in words]

    return make


def looked_up(known, words):
    data = np.frombuffer(b"".join(words), np.uint8)
    at = stretches.bounds(np.array([len(w) for w in words], np.int64))
    ids, counts = known.ids(data, at[:-1], at[1:])
    cuts = stretches.bounds(counts)
    return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]


def test_ids_are_those_made_whatever_is_remembered(monkeypatch):
    monkeypatch.setattr(stretches, "TOGETHER", 37)
    rng, calls = random.Random(3), []
    known = stretches.Known(made(calls), "<u4", size=20)  # forgets all the time
    for _ in range(60):
        words = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 63, 64, 65, 200]))) for _ in range(rng.randint(0, 100))]
        words += words[: len(words) // 2]
        assert looked_up(known, words) == made([])(words)
    assert known.entries <= 20 + 37 and max(map(len, calls)) <= 37


def test_equal_first_hashes_are_told_apart(monkeypatch):
    real = stretches.hashes
    monkeypatch.setattr(stretches, "hashes", lambda *a: (np.zeros_like(real(*a)[0]), real(*a)[1]))
    words = [b"%d" % i for i in range(300)]
    assert looked_up(stretches.Known(made([]), "<u4"), words) == made([])(words)


def test_a_stretch_is_made_once():
    calls = []
    known = stretches.Known(made(calls), "<u4")
    looked_up(known, [b"one", b"two", b"one"])
    looked_up(known, [b"two", b"three"])
    assert sorted(w for c in calls for w in c) == [b"one", b"three", b"two"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAzZ'.,<|>0 \n\té日🎉"), max_size=30), max_size=5))
def test_words_of_several_texts_are_the_tokenizers(texts):
    t = packing.tokenizer(WORDS)
    got = [np.frombuffer(x, "<u2").tolist() for x in t.encode([x.encode() for x in texts])]
    assert got == [t.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
