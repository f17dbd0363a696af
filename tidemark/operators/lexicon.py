"""The word-list scorer.

Two forms give the same counts. A short literal list is matched inside the row with array
functions, with no shuffle. A lexicon *table* is joined: words are exploded, joined to the table
(Spark broadcasts it if its bytes stay below the session's threshold, and shuffles otherwise), and
partially aggregated before the one shuffle per text. Texts themselves are never part of the join,
so a text without hits costs nothing there and no key is shared by all texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_half_even
from tidemark.functions.text import any_of, clean_word, tokens, words

# The built-in word lists.
POSITIVE_WORDS = [
    "good", "great", "love", "excellent", "amazing", "happy", "win", "best",
    "awesome", "incredible", "excited", "success", "wonderful", "huge",
]
NEGATIVE_WORDS = [
    "bad", "terrible", "hate", "awful", "sad", "lose", "worst", "broken",
    "fail", "disaster", "angry", "wrong", "problem", "delay",
]
# Fixed value: net hits are divided by this and clamped to [-1, 1].
NET_SCALE = 3.0


def net_score(net: Column) -> Column:
    """Clamped score of positive minus negative hits; a text without words has net 0."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), net / F.lit(NET_SCALE)))


def count_hits(text: Column, vocabulary: Sequence[str]) -> Column:
    """How many words of ``text`` are in ``vocabulary``."""
    listed = list(vocabulary)
    return F.size(F.filter(tokens(text), lambda t: t.isin(listed))).cast("bigint")


def count_prefix_hits(text: Column, vocabulary: Sequence[str]) -> Column:
    """How many words equal or begin with a vocabulary word, so ``delayed`` matches ``delay``."""
    pattern = "^" + any_of(list(vocabulary))
    return F.size(F.filter(tokens(text), lambda t: t.rlike(pattern))).cast("bigint")


def lexicon_score(
    text: Column,
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    prefix: bool = False,
) -> Column:
    """The score as one expression. Both lists are counted in a single pass over the words."""
    if prefix:
        net = count_prefix_hits(text, positive) - count_prefix_hits(text, negative)
        return net_score(net)
    plus, minus = list(positive), list(negative)
    net = F.aggregate(
        tokens(text),
        F.lit(0),
        lambda acc, t: acc + F.when(t.isin(plus), 1).otherwise(0) - F.when(t.isin(minus), 1).otherwise(0),
    )
    return net_score(net)


def word_rows(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, position, raw, token)``, one row per word. Narrow: no shuffle."""
    return texts.select(key, F.posexplode(words(F.col(text))).alias("position", "raw")).withColumn(
        "token", clean_word(F.col("raw"))
    )


def signs(lexicon: DataFrame, token: str = "token") -> DataFrame:
    """One row per token: whether it is listed as positive and as negative."""
    return lexicon.groupBy(F.col("token").alias(token)).agg(
        F.bool_or(F.col("polarity") > 0).alias("plus"), F.bool_or(F.col("polarity") < 0).alias("minus")
    )


def _one_text_per_key(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Copies per key and the number of words; fails if a key comes with different texts."""
    found = texts.groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(F.size(words(F.col(text)))).cast("bigint").alias("n_tokens"),
        F.min(F.xxhash64(text)).alias("low"),
        F.max(F.xxhash64(text)).alias("high"),
    )
    same = F.when(F.col("low") == F.col("high"), F.col("n_tokens")).otherwise(
        F.raise_error(F.lit(f"a {key} comes with different texts")).cast("bigint")
    )
    return found.select(key, "copies", same.alias("n_tokens"))


def token_trace(texts: DataFrame, lexicon: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Every word with its cleaned form and the ``polarity`` it hits, null for none.

    ``lexicon`` has ``token`` and ``polarity`` (+1 or -1); a token listed with both signs shows 0.
    """
    return word_rows(texts, key, text).join(signs(lexicon), "token", "left").withColumn(
        "polarity", F.when(F.col("plus") & F.col("minus"), 0).when(F.col("plus"), 1).when(F.col("minus"), -1)
    ).drop("plus", "minus")


def lexicon_counts(texts: DataFrame, lexicon: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Per text: ``n_tokens, positives, negatives`` against a lexicon table of any size.

    A text without words or hits still gets a row. Rows that repeat a ``key`` (an append-written lake
    holds many) count once: hits are divided by the copies, so copies need not be removed by a
    shuffle of texts first. A key with different texts fails. A token listed with both signs is one
    token that counts on both sides.
    """
    hits = word_rows(texts, key, text).join(signs(lexicon), "token")
    hits = hits.groupBy(key).agg(F.count_if("plus").alias("positives"), F.count_if("minus").alias("negatives"))
    each = lambda c: F.coalesce(F.col(c) / F.col("copies"), F.lit(0)).cast("bigint").alias(c)
    every = _one_text_per_key(texts, key, text)
    return every.join(hits, key, "left").select(key, "n_tokens", each("positives"), each("negatives"))


def lexicon_table_scores(texts: DataFrame, lexicon: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, raw_score)`` from a lexicon table."""
    counts = lexicon_counts(texts, lexicon, key, text)
    return counts.select(
        key, round_half_even(net_score(F.col("positives") - F.col("negatives"))).alias("raw_score")
    )


def merge_lexicons(first: DataFrame, second: DataFrame) -> DataFrame:
    """Set union of two lexicon tables."""
    return first.unionByName(second).distinct()


def prefix_token_hits(texts: DataFrame, lexicon: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Prefix matching against a lexicon table: cut each word at every lexicon length and join.

    An equi-join, so a long list never turns into a nested loop over words and list. A word that
    matches several entries counts once per polarity sign. Every text gets a row.
    """
    lengths = lexicon.agg(F.collect_set(F.length("token"))).scalar()  # as many as word lengths
    # Equal words of a text are one row with a count, so each word meets the list once.
    said = texts.groupBy(key).agg(F.flatten(F.collect_list(tokens(F.col(text)))).alias("said"), F.count(F.lit(1)).alias("copies"))
    said = said.select(key, "copies", F.explode("said").alias("token")).groupBy(key, "copies", "token").agg(F.count(F.lit(1)).alias("n"))
    cuts = said.withColumn("cut", F.explode(lengths)).filter(F.col("cut") <= F.length("token")).withColumn("stem", F.expr("substring(token, 1, cut)"))
    hit = cuts.join(signs(lexicon, "stem"), "stem").groupBy(key, "copies", "token", "n").agg(F.bool_or("plus").alias("plus"), F.bool_or("minus").alias("minus"))
    total = lambda side: F.sum(F.when(F.col(side), F.col("n")).otherwise(0) / F.col("copies")).cast("bigint")
    hits = hit.groupBy(key).agg(total("plus").alias("positives"), total("minus").alias("negatives"))
    return texts.select(key).distinct().join(hits, key, "left").select(
        key, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("positives", "negatives")]
    )
