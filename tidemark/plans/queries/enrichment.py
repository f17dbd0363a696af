"""Normalising, scoring, labels, daily summaries, token queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import round_half_even
from tidemark.functions.text import clean_word, words
from tidemark.operators import lexicon as lex
from tidemark.operators.enrich import (
    Scorer,
    column_scorer,
    engagement_total,
    enrich,
    label_scored,
    sentiment_label,
)
from tidemark.operators.normalize import normalize
from tidemark.operators.parity import field_diff, multiset_diff
from tidemark.operators.summary import (
    agreement_matrix,
    daily_summary,
    mean_score,
    score_units,
    summary_totals,
)
from tidemark.plans import views as v
from tidemark.plans.registry import query
from tidemark.session import local_table, scratch_path
from tidemark.sources.posts import cap_posts, read_posts

POSTS_A_FILE = 50_000  # fixed value: posts in one packed file of lines
FREQUENT = column_scorer("lexicon", "frequent", lambda t: lex.lexicon_score(t, v.PLUS, v.MINUS))


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whole posts with text, as the lake stores them. Each document is scored once, before posts join to it.

    A sorted join, whatever the tables' sizes: the posts of a document come out next to each other, so
    that their text, written with each of them, packs into little more than one.
    """
    scored = FREQUENT.apply(v.texts(spark, sf)).select("doc_id", "text", "raw_score")
    posts = v.facts(spark, sf).join(scored.hint("merge"), "doc_id").select(*v.POST_COLUMNS, "raw_score")
    return label_scored(posts, FREQUENT)


def scored_posts(spark: SparkSession, sf: str, scorer: Scorer = FREQUENT) -> DataFrame:
    """Labelled posts without text. Each document is scored once, before posts join to it."""
    scores = scorer.apply(v.texts(spark, sf)).select("doc_id", "raw_score")
    return label_scored(v.facts(spark, sf).join(scores, "doc_id"), scorer)


@query(
    "daily_summary",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
SELECT event_day, count(*) AS post_count, CAST(sum(engagement_total) AS BIGINT) AS total_engagement,
       CAST(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) AS BIGINT) AS sentiment_sum_e4,
       count(*) FILTER (sentiment_label = 'positive') AS positive,
       count(*) FILTER (sentiment_label = 'neutral') AS neutral,
       count(*) FILTER (sentiment_label = 'negative') AS negative
FROM scored GROUP BY event_day ORDER BY event_day"""),
)
def q_daily_summary(spark, sf):
    return summary_totals(scored_posts(spark, sf)).orderBy("event_day")


@query(
    "daily_average_sentiment",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
SELECT event_day, count(*) AS post_count,
       CAST(round(sum(CAST(round(sentiment_score * 10000) AS BIGINT)) / 10000.0 / count(*), 4) AS DOUBLE) AS avg_sentiment
FROM scored GROUP BY event_day"""),
)
def q_daily_average(spark, sf):
    return daily_summary(scored_posts(spark, sf)).select("event_day", "post_count", "avg_sentiment")


@query(
    "enriched_posts",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
SELECT id, created_at, d.text, like_count, retweet_count, reply_count, quote_count, s.source, engagement_total,
       sentiment_score, sentiment_label, event_day, 'lexicon' AS scorer, 'frequent' AS scorer_version,
       CAST(created_ts AS DATE) AS event_date
FROM scored s JOIN documents d USING (doc_id)"""),
)
def q_enriched_posts(spark, sf):
    scored = FREQUENT.apply(v.texts(spark, sf))
    joined = v.facts(spark, sf).join(scored.select("doc_id", "text", "raw_score"), "doc_id")
    return label_scored(joined.select(*v.POST_COLUMNS, "raw_score"), FREQUENT)


# Raw posts whose shape depends on the event type: absent keys, stored nulls, odd counts.
_RAW_SHAPE = """
  CASE source
    WHEN 'error' THEN to_json(named_struct('id', doc_key, 'created_at', created_at, 'text', text,
      'public_metrics', named_struct('like_count', like_count, 'retweet_count', retweet_count)))
    WHEN 'signup' THEN to_json(named_struct('id', doc_key, 'created_at', cast(null as string), 'text', text,
      'public_metrics', cast(null as string), 'source', cast(null as string)), map('ignoreNullFields', 'false'))
    WHEN 'click' THEN to_json(named_struct('id', doc_key, 'text', text,
      'public_metrics', named_struct('like_count', cast(like_count as string), 'reply_count', like_count + 0.75D), 'source', source))
    ELSE to_json(named_struct('id', doc_key, 'created_at', created_at, 'text', text, 'source', source,
      'public_metrics', named_struct('like_count', like_count, 'retweet_count', retweet_count,
                                     'reply_count', reply_count, 'quote_count', quote_count)))
  END
"""


@query(
    "normalized_posts",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT id,
       CASE source WHEN 'signup' THEN NULL WHEN 'click' THEN '' ELSE created_at END AS created_at,
       status AS text,
       CASE source WHEN 'signup' THEN 0 ELSE like_count END AS like_count,
       CASE WHEN source IN ('signup', 'click') THEN 0 ELSE retweet_count END AS retweet_count,
       CASE WHEN source IN ('signup', 'error') THEN 0 WHEN source = 'click' THEN like_count ELSE reply_count END AS reply_count,
       CAST(0 AS BIGINT) AS quote_count,
       CASE source WHEN 'signup' THEN NULL WHEN 'error' THEN 'unknown' ELSE source END AS source
FROM facts"""),
)
def q_normalized_posts(spark, sf):
    shaped = v.event_posts(spark, sf).withColumn("doc_key", F.col("id").cast("bigint"))
    raw = shaped.select(F.parse_json(F.expr(_RAW_SHAPE)).alias("post"))
    return normalize(raw).drop("quality_flags")


@query(
    "landed_posts",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT source, count(*) AS post_count, CAST(sum(like_count) AS BIGINT) AS likes, count(DISTINCT text) AS texts
FROM (SELECT f.source, f.like_count, d.text FROM facts f JOIN documents d USING (doc_id)) GROUP BY source"""),
)
def q_landed_posts(spark, sf):
    """Posts written out as JSON lines and read back through the text source.

    A file cannot be split once it is packed, so it holds a bounded number of posts. Texts are told
    apart by their SHA-256, so that they need not be shuffled to be counted.
    """
    posts = v.posts(spark, sf)
    metrics = F.struct("like_count", "retweet_count", "reply_count", "quote_count").alias("public_metrics")
    path = scratch_path(spark, "landed")
    posts.select(F.to_json(F.struct("id", "created_at", "text", "source", metrics)).alias("value")).write.option(
        "maxRecordsPerFile", POSTS_A_FILE
    ).text(path, compression="gzip")
    read = read_posts(spark, path)
    return read.groupBy("source").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("like_count").alias("likes"),
        F.count_distinct(F.sha2("text", 256)).alias("texts"),
    )


@query(
    "capped_posts",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT id, created_at, CAST(500 AS BIGINT) AS requested, (SELECT count(*) FROM facts) AS available
FROM facts ORDER BY created_at, id LIMIT 500"""),
)
def q_capped_posts(spark, sf):
    return cap_posts(v.facts(spark, sf).select("id", "created_at"), requested=500)


@query(
    "engagement_totals",
    v.with_ctes(v.SQL_FACTS, body="""
SELECT id, like_count, retweet_count, reply_count, quote_count,
       like_count + retweet_count + reply_count + quote_count AS engagement_total FROM facts"""),
)
def q_engagement_totals(spark, sf):
    counts = v.facts(spark, sf).select("id", "like_count", "retweet_count", "reply_count", "quote_count")
    return counts.withColumn("engagement_total", engagement_total())


@query(
    "label_counts",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
SELECT source, sentiment_label, count(*) AS post_count, CAST(sum(engagement_total) AS BIGINT) AS engagement
FROM scored GROUP BY ALL"""),
)
def q_label_counts(spark, sf):
    return scored_posts(spark, sf).groupBy("source", "sentiment_label").agg(
        F.count(F.lit(1)).alias("post_count"), F.sum("engagement_total").alias("engagement")
    )


@query(
    "lexicon_scores",
    v.with_ctes(v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, body="""
SELECT doc_id, CAST(round(thirds / 3.0 * 10000) AS BIGINT) AS score_e4 FROM net"""),
)
def q_lexicon_scores(spark, sf):
    score = lex.lexicon_score(F.col("text"), v.PLUS, v.MINUS)
    return v.texts(spark, sf).select("doc_id", score_units(round_half_even(score)).alias("score_e4"))


@query(
    "built_in_lexicon_scores",
    v.with_ctes(v.SQL_WORDS, body=f"""
SELECT d.doc_id, coalesce(h.positives, 0) AS positives, coalesce(h.negatives, 0) AS negatives,
       CAST(round(greatest(-3, least(3, coalesce(h.positives, 0) - coalesce(h.negatives, 0))) / 3.0 * 10000) AS BIGINT) AS score_e4
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (token IN ({v.sql_list(lex.POSITIVE_WORDS)})) AS positives,
         count(*) FILTER (token IN ({v.sql_list(lex.NEGATIVE_WORDS)})) AS negatives
  FROM words GROUP BY doc_id) h USING (doc_id)"""),
)
def q_built_in_scores(spark, sf):
    counted = v.texts(spark, sf).select(
        "doc_id",
        lex.count_hits(F.col("text"), lex.POSITIVE_WORDS).alias("positives"),
        lex.count_hits(F.col("text"), lex.NEGATIVE_WORDS).alias("negatives"),
    )
    score = lex.net_score(F.col("positives") - F.col("negatives"))
    return counted.withColumn("score_e4", score_units(round_half_even(score)))


@query(
    "token_hit_counts",
    v.with_ctes(v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, body="""
SELECT doc_id, n_tokens, positives, negatives FROM net"""),
)
def q_token_hit_counts(spark, sf):
    return lex.lexicon_counts(v.texts(spark, sf), v.lexicon(spark), "doc_id")


@query(
    "token_trace",
    v.with_ctes(v.SQL_WORDS, v.SQL_LEXICON, body="""
SELECT doc_id, CAST(position AS BIGINT) AS position, raw, token, CAST(polarity AS BIGINT) AS polarity
FROM words LEFT JOIN lexicon USING (token)"""),
)
def q_token_trace(spark, sf):
    trace = lex.token_trace(v.texts(spark, sf), v.lexicon(spark), "doc_id")
    return trace.select(
        "doc_id", F.col("position").cast("bigint").alias("position"), "raw", "token",
        F.col("polarity").cast("bigint").alias("polarity"),
    )


@query(
    "token_frequencies",
    v.with_ctes(v.SQL_WORDS, body="""
SELECT token, count(*) AS uses, count(DISTINCT doc_id) AS documents FROM words GROUP BY token"""),
)
def q_token_frequencies(spark, sf):
    """Two plain counts: uses per (token, document) first, so a frequent token is small by then."""
    per_doc = lex.word_rows(v.texts(spark, sf), "doc_id").groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("token").agg(F.sum("n").alias("uses"), F.count(F.lit(1)).alias("documents"))


@query(
    "lexicon_word_usage",
    v.with_ctes(v.SQL_WORDS, v.SQL_LEXICON, body="""
SELECT token, CAST(polarity AS BIGINT) AS polarity, count(*) AS uses FROM words JOIN lexicon USING (token) GROUP BY ALL"""),
)
def q_lexicon_word_usage(spark, sf):
    hits = lex.token_trace(v.texts(spark, sf), v.lexicon(spark), "doc_id").filter(F.col("polarity").isNotNull())
    return hits.groupBy("token", F.col("polarity").cast("bigint").alias("polarity")).agg(F.count(F.lit(1)).alias("uses"))


@query(
    "lexicon_union",
    v.with_ctes(v.SQL_WORDS, body=f"""
SELECT list_word AS token, coalesce(count(w.token), 0) AS uses
FROM (SELECT unnest([{v.sql_list(v.PLUS)}]) AS list_word UNION SELECT unnest([{v.sql_list(v.FREQUENT_POSITIVE + v.MINUS)}])) l
LEFT JOIN words w ON w.token = l.list_word GROUP BY list_word"""),
)
def q_lexicon_union(spark, sf):
    def one(items):
        return local_table(spark, [(w,) for w in items], "token string")

    merged = lex.merge_lexicons(one(v.PLUS), one(v.FREQUENT_POSITIVE + v.MINUS))
    uses = lex.word_rows(v.texts(spark, sf), "doc_id").groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    return merged.join(uses, "token", "left").select("token", F.coalesce("uses", F.lit(0)).alias("uses"))


@query(
    "prefix_lexicon_scores",
    v.with_ctes(v.SQL_WORDS, body=f"""
SELECT d.doc_id, coalesce(h.positives, 0) AS positives, coalesce(h.negatives, 0) AS negatives
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER ({" OR ".join(f"starts_with(token, '{w}')" for w in v.PLUS)}) AS positives,
         count(*) FILTER ({" OR ".join(f"starts_with(token, '{w}')" for w in v.MINUS)}) AS negatives
  FROM words GROUP BY doc_id) h USING (doc_id)"""),
)
def q_prefix_scores(spark, sf):
    return v.texts(spark, sf).select(
        "doc_id",
        lex.count_prefix_hits(F.col("text"), v.PLUS).alias("positives"),
        lex.count_prefix_hits(F.col("text"), v.MINUS).alias("negatives"),
    )


@query(
    "prefix_join_hits",
    v.with_ctes(v.SQL_WORDS, v.SQL_LEXICON, body="""
SELECT d.doc_id, count(DISTINCT position) FILTER (polarity = 1) AS positives,
       count(DISTINCT position) FILTER (polarity = -1) AS negatives
FROM documents d LEFT JOIN (SELECT doc_id, position, polarity FROM words w JOIN lexicon l ON starts_with(w.token, l.token)) h
  ON h.doc_id = d.doc_id GROUP BY d.doc_id"""),
)
def q_prefix_join_hits(spark, sf):
    return lex.prefix_token_hits(v.texts(spark, sf), v.lexicon(spark), "doc_id")


@query(
    "turn_word_counts",
    f"""
WITH raw_words AS (
  SELECT conv_id, role, unnest({v.sql_words()}) AS raw FROM conversations)
SELECT role, count(*) AS n_words, count(DISTINCT lower(trim(raw, '{v.SQL_EDGE}'))) AS vocabulary,
       count(*) FILTER (trim(raw, '{v.SQL_EDGE}') = '') AS bare_punctuation
FROM raw_words GROUP BY role""",
)
def q_turn_word_counts(spark, sf):
    """Tokenising another text table: words, distinct lookup forms, words that strip to nothing."""
    rows = v.table(spark, sf, "conversations").select("role", F.explode(words(F.col("text"))).alias("raw"))
    token = rows.select("role", clean_word(F.col("raw")).alias("token"))
    per_token = token.groupBy("role", "token").agg(F.count(F.lit(1)).alias("n"))
    return per_token.groupBy("role").agg(
        F.sum("n").alias("n_words"),
        F.count(F.lit(1)).alias("vocabulary"),
        F.coalesce(F.sum(F.when(F.col("token") == "", F.col("n"))), F.lit(0)).alias("bare_punctuation"),
    )


@query(
    "scorer_agreement",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, body=f"""
, built AS (
  SELECT doc_id, greatest(-3, least(3, count(*) FILTER (token IN ({v.sql_list(lex.POSITIVE_WORDS)}))
         - count(*) FILTER (token IN ({v.sql_list(lex.NEGATIVE_WORDS)})))) AS thirds FROM words GROUP BY doc_id),
pairs AS (
  SELECT CASE WHEN a.thirds > 0 THEN 'positive' WHEN a.thirds < 0 THEN 'negative' ELSE 'neutral' END AS label_a,
         CASE WHEN b.thirds > 0 THEN 'positive' WHEN b.thirds < 0 THEN 'negative' ELSE 'neutral' END AS label_b,
         abs(CAST(round(a.thirds / 3.0, 4) * 10000 AS BIGINT) - CAST(round(coalesce(b.thirds, 0) / 3.0, 4) * 10000 AS BIGINT)) AS gap
  FROM facts f JOIN net a USING (doc_id) LEFT JOIN built b USING (doc_id))
SELECT label_a, count(*) FILTER (label_b = 'negative') AS negative, count(*) FILTER (label_b = 'neutral') AS neutral,
       count(*) FILTER (label_b = 'positive') AS positive, count(*) FILTER (label_a <> label_b) AS disagreements,
       CAST(sum(gap) AS BIGINT) AS gap_sum_e4, CAST(round(sum(gap) / 10000.0 / count(*), 4) AS DOUBLE) AS mean_gap
FROM pairs GROUP BY label_a"""),
)
def q_scorer_agreement(spark, sf):
    """Both scorers read a text once; the posts then take the pair of scores."""
    scores = v.texts(spark, sf).select(
        "doc_id",
        round_half_even(lex.lexicon_score(F.col("text"), v.PLUS, v.MINUS)).alias("a"),
        round_half_even(lex.lexicon_score(F.col("text"))).alias("b"),
    )
    pairs = v.facts(spark, sf).select("doc_id").join(scores, "doc_id")
    return agreement_matrix(pairs.withColumns({"label_a": sentiment_label(F.col("a")), "label_b": sentiment_label(F.col("b"))}))


@F.pandas_udf(T.DoubleType())
def _shout_share(text: pd.Series) -> pd.Series:
    """Share of characters that are exclamation marks: a stand-in for a user's model."""
    return (text.str.count("!") / text.str.len().clip(lower=1)).astype("float64")


@query(
    "model_scores",
    """
SELECT doc_id, length(text) - length(replace(text, '!', '')) AS shouts,
       CAST(round((length(text) - length(replace(text, '!', ''))) / greatest(length(text), 1), 4) AS DOUBLE) AS sentiment_score,
       CASE WHEN round((length(text) - length(replace(text, '!', ''))) / greatest(length(text), 1), 4) >= 0.05
            THEN 'positive' ELSE 'neutral' END AS sentiment_label,
       'shout-share' AS scorer, '1' AS scorer_version
FROM documents""",
)
def q_model_scores(spark, sf):
    """A model in an Arrow-batched UDF, plugged in where the word list goes."""
    scorer = column_scorer("shout-share", "1", _shout_share)
    scored = scorer.apply(v.texts(spark, sf).select("doc_id", "text"))
    zero = F.lit(0).cast("bigint")
    empty = {c: zero for c in ("like_count", "retweet_count", "reply_count", "quote_count")}
    labelled = label_scored(scored.withColumns({**empty, "created_at": F.lit("")}), scorer)
    shouts = (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).cast("bigint")
    return labelled.select("doc_id", shouts.alias("shouts"), "sentiment_score", "sentiment_label", "scorer", "scorer_version")


@query(
    "language_mean_score",
    v.with_ctes(v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, body="""
SELECT lang, count(*) AS texts, CAST(sum(CAST(round(thirds / 3.0 * 10000) AS BIGINT)) AS BIGINT) AS score_sum_e4,
       CAST(round(sum(CAST(round(thirds / 3.0 * 10000) AS BIGINT)) / 10000.0 / count(*), 4) AS DOUBLE) AS mean_score
FROM net GROUP BY lang"""),
)
def q_language_mean_score(spark, sf):
    score = round_half_even(lex.lexicon_score(F.col("text"), v.PLUS, v.MINUS))
    totals = v.texts(spark, sf).select("lang", score_units(score).alias("e4")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("e4").alias("score_sum_e4")
    )
    return totals.withColumn("mean_score", mean_score(F.col("score_sum_e4"), F.col("texts")))


_FIELDS = ["post_count", "total_engagement", "positive", "neutral", "negative"]


@query(
    "summary_parity",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
, a AS (SELECT event_day, count(*) AS post_count, sum(engagement_total) AS total_engagement,
               count(*) FILTER (sentiment_label = 'positive') AS positive, count(*) FILTER (sentiment_label = 'neutral') AS neutral,
               count(*) FILTER (sentiment_label = 'negative') AS negative FROM scored GROUP BY 1),
b AS (SELECT event_day, count(*) AS post_count, sum(engagement_total) AS total_engagement,
               count(*) FILTER (sentiment_label = 'positive') AS positive, count(*) FILTER (sentiment_label = 'neutral') AS neutral,
               count(*) FILTER (sentiment_label = 'negative') AS negative FROM scored WHERE source <> 'error' GROUP BY 1)
SELECT event_day, 'both' AS side, field FROM (
  SELECT a.event_day, unnest(['post_count', 'total_engagement', 'positive', 'neutral', 'negative']) AS field,
         unnest([a.post_count <> b.post_count, a.total_engagement <> b.total_engagement, a.positive <> b.positive,
                 a.neutral <> b.neutral, a.negative <> b.negative]) AS differs
  FROM a JOIN b USING (event_day)) WHERE differs
UNION ALL SELECT event_day, 'left_only', NULL FROM a WHERE event_day NOT IN (SELECT event_day FROM b)"""),
)
def q_summary_parity(spark, sf):
    """Field by field: the summary of all posts against the one without error posts."""
    scored = scored_posts(spark, sf)
    return field_diff(
        summary_totals(scored), summary_totals(scored.filter(F.col("source") != "error")), "event_day", _FIELDS
    )


@query(
    "summary_multiset_parity",
    v.with_ctes(v.SQL_FACTS, body="""
, a AS (SELECT substr(created_at, 1, 10) AS event_day, source, count(*) AS post_count FROM facts GROUP BY 1, 2),
b AS (SELECT substr(created_at, 1, 10) AS event_day, source, count(*) AS post_count FROM facts WHERE like_count > 100 GROUP BY 1, 2)
SELECT *, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'right_only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""),
)
def q_summary_multiset_parity(spark, sf):
    facts = v.facts(spark, sf)

    def counts(df):
        day = F.substring("created_at", 1, 10).alias("event_day")
        return df.groupBy(day, "source").agg(F.count(F.lit(1)).alias("post_count"))

    return multiset_diff(counts(facts), counts(facts.filter(F.col("like_count") > 100)))


@query(
    "posts_by_created",
    v.with_ctes(v.SQL_FACTS, body="SELECT id, created_at, source FROM facts ORDER BY created_at, id"),
)
def q_posts_by_created(spark, sf):
    return v.facts(spark, sf).select("id", "created_at", "source").orderBy("created_at", "id")


@query(
    "first_posts",
    v.with_ctes(v.SQL_FACTS, body="SELECT id, created_at, source FROM facts ORDER BY created_at, id LIMIT 50"),
)
def q_first_posts(spark, sf):
    return v.facts(spark, sf).select("id", "created_at", "source").orderBy("created_at", "id").limit(50)


# All stored columns but the score, whose digits the two engines spell differently.
_STORED = [*v.POST_COLUMNS, "engagement_total", "sentiment_label", "event_day"]
_STORED_SQL = "to_json({" + ", ".join(f"'{c}': {c}" for c in _STORED) + "})"
_TEXT_POSTS = """
full_posts AS (SELECT s.* EXCLUDE (doc_id), d.text FROM scored s JOIN documents d USING (doc_id))
"""


def _stored_json(spark: SparkSession, sf: str) -> DataFrame:
    return stored_rows(spark, sf).select("id", "event_day", F.to_json(F.struct(*_STORED)).alias("row_json"))


@query(
    "payload_bytes",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, _TEXT_POSTS, body=f"""
SELECT event_day, count(*) AS post_count, CAST(sum(strlen({_STORED_SQL}::VARCHAR)) AS BIGINT) AS payload_bytes FROM full_posts GROUP BY 1"""),
)
def q_payload_bytes(spark, sf):
    """Serialised size of whole rows per day, as Spark spells JSON."""
    return _stored_json(spark, sf).groupBy("event_day").agg(
        F.count(F.lit(1)).alias("post_count"), F.sum(F.octet_length("row_json")).alias("payload_bytes")
    )


@query(
    "row_json",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, _TEXT_POSTS, body=f"SELECT id, md5({_STORED_SQL}::VARCHAR) AS row_md5 FROM full_posts"),
)
def q_row_json(spark, sf):
    return _stored_json(spark, sf).select("id", F.md5("row_json").alias("row_md5"))
