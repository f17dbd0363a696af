import os
import random

import pytest
from helpers import clashing, empty_documents, odd_documents, prose

from tidemark.llm import language, quality

TONGUES = {"aa": "aeioulnrst", "bb": "bcdfghkmpz", "cc": "qwxyvjuoei"}


def corpus(spark, n=120):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(5, 60), TONGUES[k]), k, "s", None) for i, k in ((i, sorted(TONGUES)[i % 3]) for i in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_language_held_out(spark):
    docs = corpus(spark)
    model = language.fit_documents(docs)
    rows = language.predict(docs.withColumn("held_out", language.held_out()), model).where("held_out").collect()
    assert len(rows) > 15
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in rows)


def test_language_odd_rows(spark):
    model = language.fit_documents(corpus(spark))
    docs = clashing(odd_documents(spark), "lang_pred", "Score")
    got = language.predict(docs, model)
    assert got.columns == [*odd_documents(spark).columns, "lang_pred", "score", "lang_rejected"]
    rows = got.collect()
    assert len(rows) == 9
    for r in rows:
        if r["doc_id"] in (1, 2, 3, 7):
            assert (r["lang_pred"], r["score"], r["lang_rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in TONGUES
    assert language.predict(empty_documents(spark), model).count() == 0


def test_language_unlearned_is_rejected(spark):
    docs = corpus(spark, 1200)
    model = language.fit_documents(docs)
    rng = random.Random(12)
    strange = [prose(rng, 40, "абвгдежзик") for _ in range(20)] + [prose(rng, 40, "abcdefghijklmnopqrstuvwxyz") for _ in range(20)]
    got = language.predict(spark.createDataFrame([(t,) for t in strange], "text string"), model).collect()
    assert all(r["lang_rejected"] for r in got)
    held = language.predict(docs.where(language.held_out()), model).collect()
    assert sum(r["lang_rejected"] for r in held) <= 0.01 * len(held)


def test_language_against_plain_sums(spark):
    """Scores again, subword by subword in plain Python."""
    import math

    model = language.fit_documents(corpus(spark))
    texts = ["aeiou", "Nobody KNOWS; 12 what", "größer ÉTÉ x", "a", "ab", "é", "qwx yvj uoei " * 30]
    want = []
    for text in texts:
        raw = text.encode()
        low = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in raw]
        low = [b + 32 if i and raw[i - 1] == 0xC3 and 0x80 <= raw[i] <= 0x9E else b for i, b in enumerate(low)]
        total, n = [0.0] * len(model.logits), 0
        for size in (2, 3, 4):
            for i in range(len(low) - size + 1):
                part = low[i : i + size]
                if any(b != 32 for b in part):
                    key = sum(b << 8 * k for k, b in enumerate(part))
                    bucket = ((key + size) * 0x9E3779B97F4A7C15 % 2**64) >> 49
                    total, n = [t + float(row[bucket]) for t, row in zip(total, model.logits)], n + 1
        e = [math.exp((t / max(n, 1) + b) / model.temperature) for t, b in zip(total, model.bias)]
        p = [x / sum(e) for x in e][: len(model.languages)]
        want.append((model.languages[p.index(max(p))], max(p), max(p) < model.reject_below))
    got = language.predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), model).orderBy("i").collect()
    for r, (lang, score, rejected) in zip(got, want):
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-5 and r["lang_rejected"] == rejected


def test_language_sample_is_bounded(spark):
    """One row that makes up nearly all of the table is learned once; rare tags beyond the limit are not."""
    rng = random.Random(3)
    rows = [(i, prose(rng, 20, TONGUES[k]), k) for i, k in enumerate(["aa", "bb"] * 60)]
    rows += [(999, prose(rng, 20, TONGUES["aa"]), "aa")] * 20_000
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, sample = language.draw_sample(labelled, 10, 20)
    assert languages == ["aa", "bb"]
    counts = {(r["lang"], r["training"]): r["count"] for r in sample.groupBy("lang", "training").count().collect()}
    assert counts == {("aa", True): 10, ("aa", False): 20, ("bb", True): 10, ("bb", False): 20}
    assert sample.count() == sample.distinct().count()


def test_language_rare_tags_are_not_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    docs = corpus(spark).where("lang <> 'cc' or doc_id < 30")
    model = language.fit_documents(docs)
    assert model.languages == ("aa", "bb")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_language_rejects_what_it_has_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.fit_documents(docs)
    assert 0.05 < model.temperature < 20 and 0.2 < model.reject_below < 0.999
    rng = random.Random(1)
    strange = [
        "De kinderen spelen vandaag in het park achter onze school, omdat het weer eindelijk mooi is geworden. Morgen gaan wij met de trein naar zee.",
        "Oggi i ragazzi giocano nel parco dietro la nostra scuola perché finalmente il tempo è diventato bello. Domani andremo al mare con il treno.",
        "Barna leker i dag i parken bak skolen vår fordi været endelig er blitt fint. I morgen skal vi ta toget til sjøen og ta med oss brød og ost.",
        *[prose(rng, 40, "bcdfghjklmnpqrstvwxz") for _ in range(10)],
        *[prose(rng, 40, "abcdefghijklmnopqrstuvwxyz") for _ in range(10)],
    ]
    got = language.predict(spark.createDataFrame([(t,) for t in strange], "text string"), model).collect()
    assert all(r["lang_rejected"] and r["score"] < 0.5 for r in got)
    held = language.predict(docs.where(language.held_out()).where("lang is not null"), model).where("lang_pred <> 'und'").collect()
    right = [r for r in held if r["lang_pred"] == r["lang"]]
    assert len(right) >= 0.995 * len(held) and sum(r["lang_rejected"] for r in right) <= 0.005 * len(right)


def test_language_nothing_to_learn(spark):
    model = language.fit_documents(empty_documents(spark))
    assert {r["lang_pred"] for r in language.predict(odd_documents(spark), model).collect()} == {"und"}


def test_language_score_does_not_depend_on_neighbours(spark):
    docs = corpus(spark, 40)
    model = language.fit_documents(docs)
    together = {r["doc_id"]: r["score"] for r in language.predict(docs, model).collect()}
    alone = {r["doc_id"]: r["score"] for r in language.predict(docs.where("doc_id % 7 = 3"), model).collect()}
    assert all(together[i] == s for i, s in alone.items())


def quality_corpus(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(200):
        text, good = prose(rng, rng.randint(20, 60)), i % 4 != 0
        rows.append((i, text.capitalize() + "." if good else text.upper().replace(" ", "!! ") if i % 8 else text.replace(" ", "%%% "), "en", "s", None))
        labels.append((i, int(good)))
    labels += [(500, None), (None, 1), (3, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_held_out(spark):
    docs, labels = quality_corpus(spark)
    model = quality.fit_documents(docs, labels)
    rows = quality.predict(docs.withColumn("held_out", language.held_out(parts=5, rest=0)), model).where("held_out").collect()
    assert len(rows) > 20
    assert all(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in rows)


def test_quality_bounded_by_parameter(spark):
    docs, labels = quality_corpus(spark)
    assert len(quality.fit(docs, labels, most=50).points) == 50


def test_quality_odd_rows(spark):
    model = quality.fit_documents(*quality_corpus(spark))
    rows = quality.predict(clashing(odd_documents(spark), "predicted", "score"), model).collect()
    assert len(rows) == 9
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[1] == by_id[2] == model.prior
    assert quality.predict(empty_documents(spark), model).count() == 0
    blank = quality.fit(empty_documents(spark), spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.predict(odd_documents(spark), blank).collect()} == {0.5}
