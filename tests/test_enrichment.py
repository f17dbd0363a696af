"""Sources, normalisation, scoring, labels and the daily summary."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SAMPLE_POSTS
from tidemark.functions.dates import event_day, utc_instant
from tidemark.functions.numbers import round_half_even, round_half_up
from tidemark.functions.text import tokens, words
from tidemark.operators.enrich import column_scorer, enrich, sentiment_label
from tidemark.operators.lexicon import (
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    lexicon_counts,
    lexicon_score,
    lexicon_table_scores,
    merge_lexicons,
    prefix_token_hits,
    token_trace,
)
from tidemark.operators.normalize import normalize
from tidemark.operators.summary import daily_summary, scorer_agreement
from tidemark.schema import ENRICHED, NORMALIZED, conform
from tidemark.sources import cap_posts, read_posts


def raw(spark, *posts):
    lines = [(p if isinstance(p, str) else json.dumps(p),) for p in posts]
    return spark.createDataFrame(lines, "value string").select(F.try_parse_json("value").alias("post"))


@pytest.mark.parametrize("fmt", ["json", "jsonl", "search"])
def test_every_format_reads_the_same_posts(spark, sample_dir, fmt):
    got = read_posts(spark, f"{sample_dir}/{fmt}", fmt)
    assert [f.name for f in got.schema][:8] == NORMALIZED.fieldNames()
    rows = {r["id"]: r for r in got.collect()}
    assert set(rows) == {p["id"] for p in SAMPLE_POSTS}
    assert rows["1850000000000000001"]["like_count"] == 48210
    assert all(r["quality_flags"] == [] for r in rows.values())


def test_unknown_format_is_refused(spark, sample_dir):
    with pytest.raises(ValueError):
        read_posts(spark, sample_dir, "xml")


def test_absent_keys_get_defaults_and_nulls_stay(spark):
    cases = [
        {"source": "pager", "created_at": "2031-07-04"},
        {"id": None, "text": "hum", "source": None, "public_metrics": None},
        {"id": 77, "created_at": None},
        {"id": False, "text": "", "public_metrics": {}},
    ]
    rows = normalize(raw(spark, *cases)).collect()
    assert [r["id"] for r in rows] == ["", "None", "77", "False"]
    assert [r["created_at"] for r in rows] == ["2031-07-04", "", None, ""]
    assert [r["text"] for r in rows] == ["", "hum", "", ""]
    assert [r["source"] for r in rows] == ["pager", None, "unknown", "unknown"]
    assert all(r["like_count"] == 0 for r in rows)


def test_counts_truncate_and_bad_ones_are_flagged(spark):
    counts = [3.9, "7", None, "many", -2.5, 12]
    rows = normalize(
        raw(spark, *[{"id": str(i), "public_metrics": {"like_count": c}} for i, c in enumerate(counts)])
    ).orderBy("id").collect()
    assert [r["like_count"] for r in rows] == [3, 7, 0, 0, -2, 12]
    assert [r["quality_flags"] for r in rows] == [[], [], ["bad_like_count"], ["bad_like_count"], [], []]


def test_strict_fails_on_flags_and_bad_lines_are_kept_otherwise(spark):
    frame = raw(spark, "not json", {"id": "a", "text": None})
    flags = sorted(r["quality_flags"][0] for r in normalize(frame).collect())
    assert flags == ["bad_json", "null_text"]
    with pytest.raises(Exception, match="strict"):
        normalize(frame, strict=True).collect()


def test_cap_reports_what_it_left_out(sample):
    got = cap_posts(sample, 2).collect()
    assert [(r["id"][-1], r["requested"], r["available"]) for r in got] == [("2", 2, 5), ("1", 2, 5)]
    assert cap_posts(sample, 1000).count() == 5


def test_array_files_of_any_shape(spark, tmp_path):
    """Large and broken files, absent and null fields, the same way in every format."""
    big = [{"id": str(i), "text": "word " * 40, "source": None} for i in range(30_000)] + [{"text": None}]
    (tmp_path / "json").mkdir()
    (tmp_path / "search").mkdir()
    (tmp_path / "json" / "big.json").write_text(json.dumps(big))
    (tmp_path / "json" / "broken.json").write_text('[{"id": "x"')
    (tmp_path / "json" / "none.json").write_text("[]")
    (tmp_path / "json" / "one.json").write_text('{"id": "alone", "text": "one post"}')
    (tmp_path / "search" / "big.json").write_text(json.dumps({"data": big}))
    for fmt, others in (("json", 1), ("search", 0)):
        rows = read_posts(spark, str(tmp_path / fmt), fmt)
        kinds = {(r["source"], r["bad"]): r["count"] for r in rows.groupBy("source", F.array_contains("quality_flags", "bad_json").alias("bad")).count().collect()}
        assert kinds[(None, False)] == 30_000
        assert kinds[("unknown", False)] == 1 + others
        assert rows.filter("id = '' and array_contains(quality_flags, 'null_text')").count() == 1
    assert read_posts(spark, str(tmp_path / "json"), "json").filter("array_contains(quality_flags, 'bad_json')").count() >= 1
    with pytest.raises(Exception, match="strict"):
        read_posts(spark, str(tmp_path / "json"), "json", strict=True).collect()


def test_golden_scores_and_labels(sample):
    rows = enrich(sample).orderBy("id").collect()
    assert [r["engagement_total"] for r in rows] == [56860, 15335, 9843, 72390, 7308]
    assert [r["sentiment_score"] for r in rows] == [1.0, -0.3333, 0.0, 0.6667, 0.0]
    assert [r["sentiment_label"] for r in rows] == ["positive", "negative", "neutral", "positive", "neutral"]
    assert {(r["scorer"], r["scorer_version"]) for r in rows} == {("lexicon", "28-words")}
    assert set(enrich(sample).columns) == set(ENRICHED.fieldNames())


def test_golden_daily_summary(sample):
    rows = [tuple(r) for r in daily_summary(enrich(sample)).collect()]
    assert rows == [
        ("2026-01-15", 3, 82038, 0.2222, 1, 1, 1),
        ("2026-01-16", 2, 79698, 0.3333, 1, 1, 0),
    ]


def test_published_second_scorer_summary(spark, sample):
    """The published compound values through the same labels, sums and averages."""
    published = {"1": 0.9233, "2": -0.5574, "3": 0.0, "4": 0.807, "5": 0.0}
    table = F.create_map(*[F.lit(x) for kv in published.items() for x in kv])
    scored = sample.withColumn("text", F.substring("id", -1, 1))
    rows = daily_summary(enrich(scored, column_scorer("published", "1", lambda t: F.try_element_at(table, t)))).collect()
    assert [(r["avg_sentiment"], r["positive"], r["neutral"], r["negative"]) for r in rows] == [
        (0.122, 1, 1, 1),
        (0.4035, 1, 1, 0),
    ]


# Texts with their words, lookup forms and hits counted by hand: (text, words, tokens, plus, minus).
COUNTED = [
    ("", [], [], 0, 0),
    (" \t ", [], [], 0, 0),
    ("?! ' ..", ["?!", "'", ".."], ["", "", ""], 0, 0),
    ("Love it, LOVE it!", ["Love", "it,", "LOVE", "it!"], ["love", "it", "love", "it"], 2, 0),
    ("a sad, 'sad' day", ["a", "sad,", "'sad'", "day"], ["a", "sad", "sad", "day"], 0, 2),
    ("wonderful\nbut broken", ["wonderful", "but", "broken"], ["wonderful", "but", "broken"], 1, 1),
    ("happy\u2003angry\u00a0best", ["happy", "angry", "best"], ["happy", "angry", "best"], 2, 1),
    ("success\x1dwrong", ["success", "wrong"], ["success", "wrong"], 1, 1),
    ("\ufeffawesome", ["\ufeffawesome"], ["\ufeffawesome"], 0, 0),
    ("losers unhappy great-ish", ["losers", "unhappy", "great-ish"], ["losers", "unhappy", "great-ish"], 0, 0),
    ("ÇA VA? überall", ["ÇA", "VA?", "überall"], ["ça", "va", "überall"], 0, 0),
    ("win " * 7 + "lose", ["win"] * 7 + ["lose"], ["win"] * 7 + ["lose"], 7, 1),
]
# Hits by prefix, counted by hand for the texts where they differ from whole words.
BY_PREFIX = {9: (1, 1)}


def counted(spark):
    return spark.createDataFrame([(i, row[0]) for i, row in enumerate(COUNTED)], "id int, text string")


def test_words_tokens_and_scores(spark):
    rows = counted(spark).select(
        "id", words(F.col("text")).alias("w"), tokens(F.col("text")).alias("t"), F.round(lexicon_score(F.col("text")) * 3).alias("thirds")
    ).orderBy("id").collect()
    for (_, said, forms, plus, minus), row in zip(COUNTED, rows):
        assert (row["w"], row["t"]) == (said, forms)
        assert row["thirds"] == max(-3, min(3, plus - minus))


def lexicon_table(spark):
    return spark.createDataFrame(
        [(w, 1) for w in POSITIVE_WORDS] + [(w, -1) for w in NEGATIVE_WORDS], "token string, polarity int"
    )


def test_lexicon_table_counts_even_with_copies(spark):
    copies = counted(spark).unionByName(counted(spark)).unionByName(counted(spark))
    got = {r["id"]: (r["n_tokens"], r["positives"], r["negatives"]) for r in lexicon_counts(copies, lexicon_table(spark), "id").collect()}
    scores = {r["id"]: r["raw_score"] for r in lexicon_table_scores(copies, lexicon_table(spark), "id").collect()}
    for i, (_, said, _, plus, minus) in enumerate(COUNTED):
        assert got[i] == (len(said), plus, minus)
        assert scores[i] == [-1.0, -0.6667, -0.3333, 0.0, 0.3333, 0.6667, 1.0][max(-3, min(3, plus - minus)) + 3]


def test_a_token_with_both_signs_is_one_token(spark):
    both = spark.createDataFrame([("odd", 1), ("odd", -1), ("odd", 1), ("fine", 1)], "token string, polarity int")
    text = spark.createDataFrame([(1, "odd fine day")], "id int, text string")
    assert tuple(lexicon_counts(text, both, "id").first()) == (1, 3, 2, 1)
    assert [r["polarity"] for r in token_trace(text, both, "id").orderBy("position").collect()] == [0, 1, None]


def test_one_key_with_two_texts_fails(spark):
    mixed = spark.createDataFrame([(1, "one"), (1, "other")], "id int, text string")
    with pytest.raises(Exception, match="different texts"):
        lexicon_counts(mixed, lexicon_table(spark), "id").collect()


def test_trace_shows_every_word(spark):
    df = spark.createDataFrame([("a", "A 'Great' delay, then")], "id string, text string")
    rows = token_trace(df, lexicon_table(spark), "id").orderBy("position").collect()
    assert [(r["raw"], r["token"], r["polarity"]) for r in rows] == [
        ("A", "a", None), ("'Great'", "great", 1), ("delay,", "delay", -1), ("then", "then", None)
    ]


def test_prefix_matching_both_ways(spark):
    texts = counted(spark)
    by_table = {r["id"]: (r["positives"], r["negatives"]) for r in prefix_token_hits(texts.unionByName(texts), lexicon_table(spark), "id").collect()}
    scores = {r["id"]: r["s"] for r in texts.select("id", F.round(lexicon_score(F.col("text"), prefix=True) * 3).alias("s")).collect()}
    for i, (_, _, _, plus, minus) in enumerate(COUNTED):
        p, n = BY_PREFIX.get(i, (plus, minus))
        assert by_table[i] == (p, n)
        assert scores[i] == max(-3, min(3, p - n))


def test_lexicons_unite_without_repeats(spark):
    table = lexicon_table(spark)
    assert merge_lexicons(table, table).count() == 28


def test_rounding_is_exact(spark):
    rng = random.Random(1)
    values = [7 / 64, -7 / 64, 5 / 32, -0.0, 4e14 + 0.5, -9e12]
    for _ in range(9000):
        tie = (2 * rng.randrange(-30_000, 30_000) + 1) / 20_000  # halfway between two results of four places
        values += [tie, math.nextafter(tie, -10), math.nextafter(tie, 10), rng.gauss(0, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", round_half_even(F.col("x")).alias("r4"), round_half_even(F.col("x"), 3).alias("r3")).collect()
    assert [r for r in rows if r["r4"] != round(r["x"], 4) or r["r3"] != round(r["x"], 3)] == []
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double").select(round_half_even(F.col("x"))).collect()
    assert math.isnan(odd[0][0]) and math.isinf(odd[1][0])
    ups = spark.createDataFrame([(2.5,), (-2.5,), (0.4,)], "x double").select(round_half_up(F.col("x"))).collect()
    assert [r[0] for r in ups] == [3, -2, 0]


def test_label_cuts_are_inclusive(spark):
    """The cuts themselves; their neighbours are neutral."""
    above, below = 0.05, -0.05
    probes = [above, below, math.nextafter(above, -1), math.nextafter(below, 1), 0.7, -0.2]
    rows = spark.createDataFrame([(c,) for c in probes], "s double").select(sentiment_label(F.col("s"))).collect()
    assert [r[0] for r in rows] == ["positive", "negative", "neutral", "neutral", "positive", "negative"]


def test_label_uses_the_rounded_score(spark, sample):
    scorer = column_scorer("flat", "1", lambda t: F.lit(0.04996))
    assert {r[0] for r in enrich(sample, scorer).select("sentiment_label").collect()} == {"positive"}


def test_timestamps_of_both_spellings(spark):
    values = ["2026-01-15T14:02:00.000Z", "2026-01-15 14:02:00+00:00", "2026-01-15T14:02:00+02:00",
              "2026-01-15 00:30:00-0130", "2026-01-15", "", None, "soon"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    rows = df.select(utc_instant(F.col("c")).cast("string").alias("t"), event_day(F.col("c")).alias("d"), "i").orderBy("i").collect()
    assert [r["t"] for r in rows] == ["2026-01-15 14:02:00", "2026-01-15 14:02:00", "2026-01-15 12:02:00",
                                      "2026-01-15 02:00:00", "2026-01-15 00:00:00", None, None, None]
    assert [r["d"] for r in rows] == ["2026-01-15"] * 5 + ["", "", "soon"]


def test_model_scorer_runs_in_arrow_batches(spark, sample):
    import pandas as pd

    @F.pandas_udf("double")
    def shout(text: pd.Series) -> pd.Series:
        return text.str.count("!").astype(float)

    rows = enrich(sample, column_scorer("shout", "0.1", shout)).orderBy("id").collect()
    assert rows[0]["sentiment_score"] == 1.0 and rows[1]["sentiment_score"] == 0.0
    assert rows[0]["scorer"] == "shout"


def test_agreement_matrix(spark, sample):
    a = enrich(sample)
    b = enrich(sample, column_scorer("flat", "1", lambda t: F.lit(0.0)))
    rows = {r["label_a"]: r for r in scorer_agreement(a, b, "id").collect()}
    assert rows["positive"]["disagreements"] == 2 and rows["positive"]["gap_sum_e4"] == 16667
    assert rows["neutral"]["neutral"] == 2


def test_conform_refuses_unknown_and_missing_columns(spark, sample):
    full = enrich(sample)
    assert conform(full, ENRICHED).schema.fieldNames() == ENRICHED.fieldNames()
    with pytest.raises(ValueError, match="unknown"):
        conform(full.withColumn("extra", F.lit(1)), ENRICHED)
    with pytest.raises(ValueError, match="missing"):
        conform(full.drop("scorer"), ENRICHED)
