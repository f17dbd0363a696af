import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, empty_documents, odd_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat, packing, pieces

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ids(model, text):
    return np.frombuffer(model.encode([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeinrstho  \n\tXé日🎉0 "), max_size=120))
def test_pieces_are_the_librarys(library, text):
    model = pieces.model(PIECES)
    assert ids(model, text) == library.encode(text)
    assert model.decode(model.encode([text])[0]) == text


def test_long_stretch_is_searched_in_a_bounded_window(library):
    text = "".join(random.Random(1).choice("aeinrst") for _ in range(20_000))
    model = pieces.model(PIECES)
    assert ids(model, text) == library.encode(text)
    given_out = []
    for i, piece in enumerate(model.search("▁" + text)):
        given_out.append(piece)
        if i == 100:
            break  # pieces come out long before the end is seen
    assert "".join(given_out) == ("▁" + text)[: len("".join(given_out))]


def test_unigram_search_takes_the_best_sum():
    model = pieces.PieceModel(PIECES)
    model.bpe, model.ids, model.longest = False, {"a": 1, "b": 2, "ab": 3, "abc": 4, "c": 5, "bc": 6}, 3
    model.score = {"a": -1.0, "b": -1.0, "ab": -1.5, "abc": -9.0, "c": -1.0, "bc": -0.5}
    assert list(model.search("abc" * 20)) == ["a", "bc"] * 20


def test_pieces_odd_rows(spark):
    docs = clashing(odd_documents(spark), "ids")
    coded = pieces.encode(docs, PIECES)
    assert coded.columns == [*odd_documents(spark).columns, "ids"]
    rows = pieces.decode(clashing(coded, "decoded"), PIECES).collect()
    assert len(rows) == 9 and all(r["decoded"] == (r["text"] or "") for r in rows)
    report = pieces.piece_report(odd_documents(spark), PIECES).collect()
    assert all(r["round_trip"] for r in report) and {r["n_ids"] for r in report if r["doc_id"] in (1, 2)} == {0}
    assert pieces.encode(empty_documents(spark), PIECES).count() == 0


def check_packing(rows, texts, width):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        want, at = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want))
            assert r["ids_crc32"] == zlib.crc32(want[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(want)
    for pieces_ in by_sequence.values():
        at = 0
        for r in sorted(pieces_, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == width or at < width and at & (at - 1) == 0
    return by_sequence


def test_packing_keeps_every_id_once(spark):
    rng = random.Random(6)
    extra = [(100 + i, prose(rng, rng.randint(1, 300)), "en", rng.choice("xxxyz"), 0) for i in range(150)]
    docs = odd_documents(spark, extra).where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack(docs.repartition(5), WORDS, width=256, segment_tokens=20_000).collect()
    assert len(check_packing(rows, texts, 256)) > 100
    # Several segments, and little that is not a full sequence.
    assert len({r["sequence_id"] >> 24 for r in rows}) > 3


def test_windows_hold_the_mixture(spark):
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, prose(rng, 100), "ab"[i % 4 == 0]) for i in range(200)], "doc_id long, text string, source string")
    rows = packing.pack(docs, WORDS, width=256).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    total, b = sum(r["length"] for r in rows), sum(r["length"] for r in rows if source[r["doc_id"]] == "b")
    share, full = b / total, {}
    for r in rows:
        full.setdefault(r["sequence_id"], [0, 0])[source[r["doc_id"]] == "b"] += r["length"]
    for a_ids, b_ids in full.values():
        if a_ids + b_ids == 256:
            assert abs(b_ids - 256 * share) <= 1


def test_allot_carries_deficits():
    shares = np.array([1000, 333, 7, 1])
    got = packing.allot(shares, np.array([0.5, 0.25, 0.0, 0.0]), 64)
    assert (got.sum(axis=1) == 64).all() and (got >= 0).all() and (got.sum(axis=0) <= shares).all()
    ideal = np.arange(1, len(got) + 1)[:, None] * shares[None, :] * 64 / shares.sum()
    assert np.abs(got.cumsum(axis=0) - ideal).max() < 2


def test_repeated_rows_and_null_ids_are_packed_as_often_as_they_come(spark):
    rows = packing.pack(odd_documents(spark), WORDS).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 6) == 8
    assert any(r["doc_id"] is None for r in rows)
    assert packing.pack(empty_documents(spark), WORDS).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abXYÉé'’-—*.,!|<>19 \n\t\x1csʼΣ"), max_size=60))
def test_words_tokenize_as_whole_texts_do(text):
    tokenizer = packing.tokenizer(WORDS)
    assert np.frombuffer(tokenizer.encode([text.encode()])[0], "<u2").tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi \\b <#> </turn>\n### user"), (1, 2, "assistant", "hello\\"), (1, 3, "user", None),
    (2, 0, "user", "only a question"), (3, 5, "assistant", "\\n\\\\ 🎉é"), (3, 5, "assistant", "\\n\\\\ 🎉é"), (3, None, None, ""),
    (None, 1, "odd\nrole<#\\", "</turn>\n"), (4, 0, "assistant", ""),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_reads_back(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("n_turns", chat.F.lit(1))
    examples = chat.expand(turns)
    got = {r["conv_id"]: r for r in chat.digest(examples).collect()}
    groups = {}
    for c, turn, role, text in TURNS:
        groups.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, rows in groups.items():
        rows.sort()
        replies = "".join(t for _, _, role, t in rows if role == "assistant")
        assert got[c]["n_turns"] == len(rows)
        assert got[c]["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, _, role, t in rows))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(replies), sha(replies))
    rows = examples.where("conv_id = 1").collect()
    assert [r["target"] for r in sorted(rows, key=lambda r: len(r["formatted"]))] == [2, None]
    assert all(r["formatted"].count(chat.END) == r["formatted"].count(chat.HEAD) for r in rows)
    one = next(r for r in rows if r["target"] == 2)
    assert one["formatted"][one["loss_start"] : one["loss_start"] + one["loss_length"]] == "hello\\b"


def test_chat_of_nothing(spark):
    assert chat.expand(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_very_long_text(spark):
    turns = spark.createDataFrame([(1, 0, "user", "#<\\" * 200_000), (1, 1, "assistant", "x" * 300_000)], "conv_id long, turn long, role string, text string")
    row = chat.digest(chat.expand(turns)).first()
    assert row["loss_chars"] == 300_000 and row["turns_sha256"] == sha("user\n" + "#<\\" * 200_000 + "\nassistant\n" + "x" * 300_000 + "\n")
