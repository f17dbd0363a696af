"""The valence scorer over whole texts, with a small lexicon of words the given texts use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import valence as val
from tidemark.operators.lexicon import NEGATIVE_WORDS, POSITIVE_WORDS
from tidemark.operators.summary import score_units
from tidemark.plans import views as v
from tidemark.plans.registry import query
from tidemark.session import local_table

# Valences of words in the given texts, and of the built-in word lists.
VALENCES = {
    **{w: 2.0 for w in POSITIVE_WORDS},
    **{w: -2.0 for w in NEGATIVE_WORDS},
    "the": 0.7, "and": 1.1, "with": 1.9, "der": 0.4, "que": 2.3, "les": 1.3,
    "is": -0.9, "und": -1.4, "la": -0.6, "no": -1.2, "for": -2.1, "it": -0.3,
    "kind": 1.6,
}
RULES = val.ValenceRules(
    capital=0.733,
    negation=-0.74,
    boosters={"in": 0.293, "to": -0.293, "of": 0.4, "de": -0.25, "was by": 0.2, "to be": -0.2},
    negators=["not", "never", "on", "nicht", "un"],
    idioms={"of the": 1.5, "the of": -1.7, "by the": 0.9, "in der": -1.1, "that and the": 2.2, "and the": -0.5},
    contrast="that",
)
EMOJI = {"é": "accent", "ß": "sharp ess", "ñ": "tilde", "ü": "umlaut"}


def valence_lexicon(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(VALENCES.items()), "token string, valence double")


def _map(table) -> str:
    pairs = ", ".join("('" + k.replace("'", "''") + f"', {x!r}::DOUBLE)" for k, x in table.items())
    return f"(SELECT * FROM (VALUES {pairs}) t(k, x))"


_PUNCT = val.PUNCTUATION.replace("'", "''")
_NEG = v.sql_list(RULES.negators)
_N, _C = f"({RULES.negation})", RULES.capital


def _negates(word: str) -> str:
    return f"(coalesce({word} IN ({_NEG}), false) OR coalesce(contains({word}, 'n''t'), false))"


def _boost_step(source: str, k: int) -> str:
    """Booster at distance k for a word that is not itself in the lexicon."""
    return f"""
  SELECT {source}.*, {source}.v AS v_in, {source}.v + coalesce(
    CASE WHEN b{k} IS NOT NULL AND NOT in{k} THEN
      ((CASE WHEN {source}.v < 0 THEN -bo.x ELSE bo.x END)
       + CASE WHEN up{k} AND mixed THEN (CASE WHEN {source}.v > 0 THEN {_C} ELSE -{_C} END) ELSE 0 END) * {val.DECAY[k]} END, 0) AS w
  FROM {source} LEFT JOIN booster bo ON bo.k = b{k}"""


SQL_HITS = f"""
vlex AS {_map(VALENCES)}, booster AS {_map(RULES.boosters)}, idiom AS {_map(RULES.idioms)},
vdocs AS (
  SELECT doc_id, text, list_transform({v.sql_words()}, lambda w:
    CASE WHEN length(trim(w, '{_PUNCT}')) <= 2 THEN w ELSE trim(w, '{_PUNCT}') END) AS ws FROM documents),
vtok AS (
  SELECT doc_id, generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS raw FROM vdocs),
vlow AS (SELECT *, lower(raw) AS low, upper(raw) = raw AND lower(raw) <> raw AS up FROM vtok),
vctx AS (
  SELECT *, lag(low, 1) OVER s AS b1, lag(low, 2) OVER s AS b2, lag(low, 3) OVER s AS b3,
         lag(up, 1) OVER s AS up1, lag(up, 2) OVER s AS up2, lag(up, 3) OVER s AS up3,
         lead(low, 1) OVER s AS a1, lead(low, 2) OVER s AS a2,
         (count(*) FILTER (up) OVER d) BETWEEN 1 AND (count(*) OVER d) - 1 AS mixed
  FROM vlow WINDOW s AS (PARTITION BY doc_id ORDER BY pos), d AS (PARTITION BY doc_id)),
h0 AS (
  SELECT c.*, l.x AS lex, coalesce(b1 IN (SELECT k FROM vlex), false) AS in1, coalesce(b2 IN (SELECT k FROM vlex), false) AS in2,
         coalesce(b3 IN (SELECT k FROM vlex), false) AS in3, coalesce(a1 IN (SELECT k FROM vlex), false) AS ina
  FROM vctx c JOIN vlex l ON l.k = c.low),
h1 AS (
  SELECT *, CASE WHEN coalesce(b1 = 'no' OR b2 = 'no' OR (b3 = 'no' AND b1 IN ('or', 'nor')), false) THEN lex * {_N}
                 WHEN low = 'no' AND ina THEN 0.0 ELSE lex END AS v0 FROM h0),
h2 AS (SELECT *, v0 + CASE WHEN up AND mixed THEN (CASE WHEN v0 > 0 THEN {_C} ELSE -{_C} END) ELSE 0 END AS v FROM h1),
h3 AS ({_boost_step('h2', 1)}),
h4 AS (SELECT * EXCLUDE (v, w, v_in), CASE WHEN b1 IS NOT NULL AND NOT in1 AND {_negates('b1')} THEN w * {_N} ELSE w END AS v FROM h3),
h5 AS ({_boost_step('h4', 2)}),
h6 AS (SELECT * EXCLUDE (v, w, v_in), CASE WHEN b2 IS NULL OR in2 THEN w
         WHEN b2 = 'never' AND b1 IN ('so', 'this') THEN w * 1.25 WHEN b2 = 'without' AND b1 = 'doubt' THEN w
         WHEN {_negates('b2')} THEN w * {_N} ELSE w END AS v FROM h5),
h7 AS ({_boost_step('h6', 3)}),
h8 AS (SELECT * EXCLUDE (v, w, v_in), CASE WHEN b3 IS NULL OR in3 THEN w
         WHEN (b3 = 'never' AND b2 IN ('so', 'this')) OR b1 IN ('so', 'this') THEN w * 1.25
         WHEN b3 = 'without' AND (b2 = 'doubt' OR b1 = 'doubt') THEN w
         WHEN {_negates('b3')} THEN w * {_N} ELSE w END AS v FROM h7),
h9 AS (
  SELECT h8.* EXCLUDE (v), CASE WHEN b3 IS NULL OR in3 THEN v ELSE
      coalesce((SELECT x FROM idiom WHERE k = low || ' ' || a1 || ' ' || a2), (SELECT x FROM idiom WHERE k = low || ' ' || a1),
               (SELECT x FROM idiom WHERE k = b1 || ' ' || low), (SELECT x FROM idiom WHERE k = b2 || ' ' || b1 || ' ' || low),
               (SELECT x FROM idiom WHERE k = b2 || ' ' || b1), (SELECT x FROM idiom WHERE k = b3 || ' ' || b2 || ' ' || b1),
               (SELECT x FROM idiom WHERE k = b3 || ' ' || b2), v)
      + coalesce((SELECT x FROM booster WHERE k = b3 || ' ' || b2 || ' ' || b1), 0)
      + coalesce((SELECT x FROM booster WHERE k = b3 || ' ' || b2), 0)
      + coalesce((SELECT x FROM booster WHERE k = b2 || ' ' || b1), 0) END AS v
  FROM h8),
hits AS (
  SELECT doc_id, pos, CASE WHEN low IN (SELECT k FROM booster) OR (low = 'kind' AND a1 = 'of') THEN 0.0
         WHEN b1 = 'least' AND NOT in1 AND coalesce(b2, '') NOT IN ('at', 'very') THEN v * {_N} ELSE v END AS valence
  FROM h9)
"""
SQL_VALENCE = SQL_HITS + f""",
folded AS (
  SELECT d.doc_id, d.text, len(d.ws) AS n, list_position(list_transform(d.ws, lambda w: lower(w)), '{RULES.contrast}') - 1 AS bi,
         coalesce(h.places, []) AS places, coalesce(h.vals, []::DOUBLE[]) AS vals
  FROM vdocs d LEFT JOIN (
    SELECT doc_id, list(pos ORDER BY pos) AS places, list(valence ORDER BY pos) AS vals FROM hits WHERE valence <> 0 GROUP BY doc_id) h USING (doc_id)),
turned AS (
  SELECT doc_id, text, n, CASE WHEN bi IS NULL OR bi < 0 OR len(vals) = 0 THEN vals ELSE
    list_reduce(list_transform(range(len(vals)), lambda k: {{'i': k, 'a': []::DOUBLE[]}}),
      lambda acc, x: {{'i': x.i, 'a': list_transform(acc.a, lambda y, k:
        CASE WHEN k = list_position(acc.a, acc.a[x.i + 1])
             THEN y * (CASE WHEN places[k] < bi THEN 0.5 WHEN places[k] > bi THEN 1.5 ELSE 1.0 END) ELSE y END)}},
      {{'i': -1::BIGINT, 'a': vals}}).a END AS vals
  FROM folded),
sums AS (
  SELECT doc_id, n, coalesce(list_sum(vals), 0) AS s,
         coalesce(list_sum(list_transform(list_filter(vals, lambda x: x > 0), lambda x: x + 1)), 0) AS up,
         coalesce(list_sum(list_transform(list_filter(vals, lambda x: x < 0), lambda x: x - 1)), 0) AS down,
         n - len(vals) AS flat,
         least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE +
         CASE WHEN length(text) - length(replace(text, '?', '')) <= 1 THEN 0.0
              WHEN length(text) - length(replace(text, '?', '')) <= 3 THEN (length(text) - length(replace(text, '?', ''))) * 0.18 ELSE 0.96 END AS e
  FROM turned),
final AS (
  SELECT doc_id, n, s + e * sign(s) AS s, up + CASE WHEN up > abs(down) THEN e ELSE 0 END AS up,
         down - CASE WHEN up < abs(down) THEN e ELSE 0 END AS down, flat FROM sums)
"""


@query(
    "valence_scores",
    v.with_ctes(SQL_VALENCE, body="""
SELECT doc_id, CASE WHEN n = 0 THEN 0 ELSE CAST(round(s / sqrt(s * s + 15) * 10000) AS BIGINT) END AS compound_e4,
       CASE WHEN n = 0 THEN 0 ELSE CAST(round(abs(down) / (up + abs(down) + flat) * 1000) AS BIGINT) END AS neg_e3,
       CASE WHEN n = 0 THEN 0 ELSE CAST(round(flat / (up + abs(down) + flat) * 1000) AS BIGINT) END AS neu_e3,
       CASE WHEN n = 0 THEN 0 ELSE CAST(round(up / (up + abs(down) + flat) * 1000) AS BIGINT) END AS pos_e3
FROM final"""),
)
def q_valence_scores(spark, sf):
    scores = val.valence_scores(v.texts(spark, sf), valence_lexicon(spark), RULES, "doc_id")
    e3 = lambda c: F.rint(F.col(c) * 1000).cast("bigint").alias(f"{c}_e3")
    return scores.select("doc_id", score_units(F.col("compound")).alias("compound_e4"), e3("neg"), e3("neu"), e3("pos"))


@query(
    "word_valences",
    v.with_ctes(SQL_HITS, body="""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(round(valence * 1000000) AS BIGINT) AS valence_e6 FROM hits"""),
)
def q_word_valences(spark, sf):
    """Every lexicon word with its valence after all rules but the contrast word."""
    rows = val.word_valences(v.texts(spark, sf), valence_lexicon(spark), RULES, "doc_id")
    return rows.select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.rint(F.col("valence") * 1000000).cast("bigint").alias("valence_e6")
    )


# Words of the given texts, and what stands in their place so that every rule about neighbours applies.
SHAPES = {" of ": " isn't ", " in ": " never so ", " to ": " without doubt ", " de ": " kind of ", " and ": " at least ", " y ": " least ", " is ": " never this x "}


def _shaped_sql() -> str:
    out = "text"
    for a, b in SHAPES.items():
        out = f"replace({out}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return f"shaped AS (SELECT doc_id, {out} AS text FROM documents)"


@query(
    "word_valences_shaped",
    v.with_ctes(_shaped_sql(), SQL_HITS.replace("FROM documents", "FROM shaped"), body="""
SELECT doc_id, CAST(pos AS BIGINT) AS pos, low AS token, coalesce(b1, '') AS before_1, coalesce(b2, '') AS before_2, CAST(round(valence * 1000000) AS BIGINT) AS valence_e6
FROM (SELECT hits.*, t.low, t.b1, t.b2 FROM hits JOIN vctx t USING (doc_id, pos))"""),
)
def q_word_valences_shaped(spark, sf):
    """The rules on texts in which negations, lifts, doubts, ``kind of`` and ``least`` stand before lexicon words."""
    texts = v.texts(spark, sf)
    for a, b in SHAPES.items():
        texts = texts.withColumn("text", F.replace("text", F.lit(a), F.lit(b)))
    rows = val.word_valences(texts, valence_lexicon(spark), RULES, "doc_id")
    # A text's words meet its hits once, not once for each hit.
    hits = rows.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "valence")).alias("hits"))
    found = hits.join(texts.select("doc_id", val.valence_words(F.col("text")).alias("ws")), "doc_id")

    def told(h):
        said = lambda k: F.coalesce(F.lower(F.get("ws", h["pos"] - k)), F.lit(""))
        valence = F.rint(h["valence"] * 1000000).cast("bigint")
        return F.struct(h["pos"].cast("bigint").alias("pos"), said(0).alias("token"), said(1).alias("before_1"), said(2).alias("before_2"), valence.alias("valence_e6"))

    return found.select("doc_id", F.explode(F.transform("hits", told)).alias("w")).select("doc_id", "w.*")


@query(
    "valence_labels",
    v.with_ctes(v.SQL_FACTS, SQL_VALENCE, body="""
, labelled AS (
  SELECT doc_id, CASE WHEN n = 0 THEN 0.0 ELSE round(s / sqrt(s * s + 15), 4) END AS c FROM final)
SELECT source, CASE WHEN c >= 0.05 THEN 'positive' WHEN c <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       count(*) AS post_count, 'valence' AS scorer
FROM facts JOIN labelled USING (doc_id) GROUP BY ALL"""),
)
def q_valence_labels(spark, sf):
    """The valence scorer plugged in where the word list goes."""
    from tidemark.plans.queries.enrichment import scored_posts

    scorer = val.valence_scorer("query", valence_lexicon(spark), RULES)
    return scored_posts(spark, sf, scorer).groupBy("source", "sentiment_label", "scorer").agg(
        F.count(F.lit(1)).alias("post_count")
    )


@query(
    "valence_sums",
    v.with_ctes(v.SQL_WORDS, body=f"""
, vlex AS {_map({k: round(x * 10) for k, x in VALENCES.items()})}
SELECT d.doc_id, count(x) AS hits, CAST(coalesce(sum(x), 0) AS BIGINT) AS valence_e1
FROM documents d LEFT JOIN (SELECT doc_id, x FROM words JOIN vlex ON k = token) h ON h.doc_id = d.doc_id GROUP BY d.doc_id"""),
)
def q_valence_sums(spark, sf):
    """Plain join of words to the valence table, without rules."""
    from tidemark.operators.lexicon import word_rows

    hits = word_rows(v.texts(spark, sf), "doc_id").join(valence_lexicon(spark), "token")
    sums = hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("hits"), F.sum(F.rint(F.col("valence") * 10).cast("bigint")).alias("valence_e1")
    )
    every = v.table(spark, sf, "documents").select("doc_id").join(sums, "doc_id", "left")
    return every.select("doc_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("hits", "valence_e1")])


@query(
    "neighbour_tokens",
    v.with_ctes(v.SQL_WORDS, body="""
, near AS (SELECT token, lag(token, 1) OVER w AS before_1, lag(token, 2) OVER w AS before_2, lag(token, 3) OVER w AS before_3,
                   lead(token, 1) OVER w AS after_1, lead(token, 2) OVER w AS after_2
           FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY position))
SELECT token, count(before_1) AS with_1_before, count(before_2) AS with_2_before, count(before_3) AS with_3_before,
       count(after_1) AS with_1_after, count(after_2) AS with_2_after, count(*) FILTER (before_1 = 'of') AS after_of,
       count(*) FILTER (before_2 = 'of') AS two_after_of, count(*) FILTER (before_3 = 'of') AS three_after_of
FROM near GROUP BY token"""),
)
def q_neighbour_tokens(spark, sf):
    """Words with their neighbours, taken from shifted arrays inside the row: no window, no sort."""
    from tidemark.functions.text import tokens

    base = v.texts(spark, sf).select("doc_id", tokens(F.col("text")).alias("t"))
    none = F.lit(None).cast("string")
    later = lambda n: F.slice("t", n + 1, F.greatest(F.size("t") - n, F.lit(0)))
    zipped = F.arrays_zip(
        F.col("t"), *[F.concat(F.array_repeat(none, n), "t").alias(f"before_{n}") for n in (1, 2, 3)], *[later(n).alias(f"after_{n}") for n in (1, 2)]
    )
    # The shifted arrays run past the last word; those places hold no word.
    near = base.select(F.explode(zipped).alias("w")).select("w.*").filter(F.col("t").isNotNull())
    return near.groupBy(F.col("t").alias("token")).agg(
        *[F.count(f"before_{n}").alias(f"with_{n}_before") for n in (1, 2, 3)],
        *[F.count(f"after_{n}").alias(f"with_{n}_after") for n in (1, 2)],
        *[F.count_if(F.col(f"before_{n}") == "of").alias(name) for n, name in ((1, "after_of"), (2, "two_after_of"), (3, "three_after_of"))],
    )


@query(
    "valence_tokens",
    v.with_ctes(SQL_HITS.split("h0 AS")[0].rstrip().rstrip(","), body="""
SELECT doc_id, len(ws) AS n_words, len(list_filter(ws, lambda w: upper(w) = w AND lower(w) <> w)) AS n_upper,
       CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS n_chars FROM vdocs"""),
)
def q_valence_tokens(spark, sf):
    """Words with punctuation stripped, how many are upper case, and their characters."""
    ws = v.texts(spark, sf).select("doc_id", val.valence_words(F.col("text")).alias("ws"))
    return ws.select(
        "doc_id",
        F.size("ws").cast("bigint").alias("n_words"),
        F.size(F.filter("ws", val.is_upper)).cast("bigint").alias("n_upper"),
        F.aggregate("ws", F.lit(0).cast("bigint"), lambda a, w: a + F.length(w)).alias("n_chars"),
    )


@query(
    "emoji_words",
    """
WITH marked AS (
  SELECT doc_id, text, """
    + "replace(" * len(EMOJI) + "text" + "".join(f", '{c}', '@@{d}')" for c, d in EMOJI.items())
    + """ AS m FROM documents)
SELECT doc_id, CAST(length(text) AS BIGINT) AS before_chars,
       CAST(length(replace(regexp_replace(m, '([^ ])@@', '\\1 ', 'g'), '@@', '')) AS BIGINT) AS after_chars,
       md5(replace(regexp_replace(m, '([^ ])@@', '\\1 ', 'g'), '@@', '')) AS digest
FROM marked""",
)
def q_emoji_words(spark, sf):
    """Single characters replaced by words; accented letters stand in for emoji here."""
    table = local_table(spark, list(EMOJI.items()), "char string, description string")
    texts = v.texts(spark, sf).select("doc_id", "text", F.length("text").cast("bigint").alias("before_chars"))
    out = val.emoji_to_words(texts, table, "doc_id")
    return out.select("doc_id", "before_chars", F.length("text").cast("bigint").alias("after_chars"), F.md5("text").alias("digest"))


@query(
    "punctuation_emphasis",
    """
SELECT conv_id, turn, CAST(round((least(length(text) - length(replace(text, '!', '')), 4) * 0.292 +
  CASE WHEN length(text) - length(replace(text, '?', '')) <= 1 THEN 0
       WHEN length(text) - length(replace(text, '?', '')) <= 3 THEN (length(text) - length(replace(text, '?', ''))) * 0.18 ELSE 0.96 END) * 1000) AS BIGINT) AS emphasis_e3
FROM (SELECT conv_id, turn, replace(replace(text, '.', '!'), ',', '?') AS text FROM conversations)""",
)
def q_punctuation_emphasis(spark, sf):
    """The texts hold few such marks, so full stops and commas stand in for them."""
    turns = v.table(spark, sf, "conversations")
    marked = F.translate("text", ".,", "!?")
    return turns.select("conv_id", "turn", F.rint(val.punctuation_emphasis(marked) * 1000).cast("bigint").alias("emphasis_e3"))


@query(
    "compound_scores",
    """
SELECT event_id, CAST(round((value - 50) / sqrt((value - 50) * (value - 50) + 15) * 10000) AS BIGINT) AS compound_e4 FROM events""",
)
def q_compound_scores(spark, sf):
    total = F.col("value") - 50
    return v.table(spark, sf, "events").select("event_id", F.rint(val.compound(total) * 10000).cast("bigint").alias("compound_e4"))
