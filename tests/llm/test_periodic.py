import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import SCHEMA, clashing, empty_documents, odd_documents

from tidemark.llm import periodic
from tidemark.llm.periodic import LEAST_EXPONENT, LEAST_WORDS, detect, find_runs


def plain_runs(w):
    """All runs, by trying each period at each place."""
    out = set()
    for q in range(1, len(w) // LEAST_EXPONENT + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(LEAST_WORDS, LEAST_EXPONENT * q):
                stretch = w[i : i + length]
                if not any(all(stretch[x] == stretch[x + r] for x in range(length - r)) for r in range(1, q)):
                    out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def texts_of_all_kinds():
    rng = random.Random(11)
    yield []
    yield ["a"]
    yield ["a"] * 300
    yield ["a"] * 5
    yield ["a"] * 6
    yield ["a", "b"] * 4
    yield ["a", "b"] * 3 + ["a"]
    yield (["a"] * 6 + ["b"]) * 5
    yield (["a", "b"] * 5 + ["c"]) * 7
    yield ["x"] + ["a", "b", "c"] * 30 + ["a", "x"]
    fib = [["a"], ["a", "b"]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    for letters in (1, 2, 3, 5):
        for n in (7, 20, 60, 200):
            yield [rng.choice("abcde"[:letters]) for _ in range(n)]
    for _ in range(60):
        w = []
        for _ in range(rng.randint(1, 6)):
            root = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
            w += (root * rng.randint(1, 9))[: rng.randint(1, 50)]
        yield w


def test_runs_against_all_periods():
    texts = list(texts_of_all_kinds())
    names = {}
    number = np.array([names.setdefault(x, len(names)) for w in texts for x in w], np.int64)
    bounds = np.cumsum([0] + [len(w) for w in texts])
    found = list(zip(*(x.tolist() for x in find_runs(number, bounds))))
    want = [(int(b) + s, n, q) for b, w in zip(bounds, texts) for s, n, q in plain_runs(w)]
    assert found == want and len(want) > 100
    for w in texts:
        own = np.array([names[x] for x in w], np.int64)
        assert list(zip(*(x.tolist() for x in find_runs(own, np.array([0, len(w)]))))) == plain_runs(w)


def test_small_chunks_and_hash_collisions(monkeypatch):
    texts = list(texts_of_all_kinds())[:30]
    data = np.frombuffer(" ".join(x for w in texts for x in w).encode(), np.uint8)
    starts = np.arange(0, len(data), 2)
    monkeypatch.setattr(periodic, "word_hashes", lambda d, s, e: np.zeros(len(s), np.uint64))
    number = periodic.number_words(data, starts, starts + 1)
    assert len(np.unique(number)) == len({x for w in texts for x in w})
    bounds = np.cumsum([0] + [len(w) for w in texts])
    whole = find_runs(number, bounds)
    monkeypatch.setattr(periodic, "CHUNK", 1)
    assert all((a == b).all() for a, b in zip(whole, find_runs(number, bounds)))


def expected(doc_id, text):
    """The contract of the registered query, word by word."""
    w = (text or "").replace(" ", "").encode().split()
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digests = (hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(b" ".join(plain_collapse(w, runs))).hexdigest())
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


@pytest.fixture
def query(spark, monkeypatch):
    def run(docs):
        monkeypatch.setattr(periodic, "table", lambda *_: docs)
        return periodic.op11(spark, "")

    return run


def test_query_against_the_contract(spark, query):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        w = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 90))]
        rows.append((i, (rng.choice([" ", "\t\n", "\x0b "])).join(w) + rng.choice(["", " ", "\n\n"]), "en", "a", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in query(docs).collect())
    assert got == sorted(expected(i, t) for i, t, *_ in rows)
    assert sum(r[1] > 0 for r in got) >= 10


def test_odd_rows(spark, query):
    def in_order(rows):
        return sorted(rows, key=repr)

    rows = [(r["doc_id"], r["text"]) for r in odd_documents(spark).collect()]
    short = [r for r in rows if len(r[1] or "") < 10_000]
    got = [tuple(r) for r in query(odd_documents(spark)).collect()]
    want = [expected(*r) for r in short]
    assert len(got) == len(rows) and in_order(r for r in got if r[0] != 4) == in_order(want)
    assert query(empty_documents(spark)).collect() == []
    again = query(clashing(odd_documents(spark), "runs", "collapsed", "n_words", "best", "listed", "h"))
    assert in_order(tuple(r) for r in again.collect()) == in_order(got)


def test_operator_keeps_columns_and_long_texts(spark):
    long = " ".join(["the", "same", "three"] * 50_000)
    docs = spark.createDataFrame([(1, long, "mine"), (2, "a b", "yours"), (None, None, None)], "doc_id long, text string, runs string")
    got = {r["doc_id"]: r for r in detect(docs.withColumn("other", docs.runs)).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 150_000, 3)] and got[1]["collapsed"] == "the same three"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == "a b" and got[2]["other"] == "yours"
    assert got[None]["n_words"] == 0 and got[None]["collapsed"] == ""
