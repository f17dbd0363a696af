r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as context, then that turn,
of which alone the text is trainable. A conversation that does not end in an assistant turn gets
one more example without a target, so that no turn is lost.

A turn is written ``### role\ntext</turn>\n``. Inside texts and roles ``\``, ``#`` and ``<`` become
``\b``, ``\h`` and ``\l``, in roles a line end becomes ``\n``; so no control string can arise from
a text, and undoing the replacements (``\b`` last) gives it back exactly.

Turns are ordered by turn, then role and text (nulls first), so repeated rows stay, in a defined
order. Null text or role is empty; rows of null conversation form one conversation. Further columns
are ignored. One conversation is handled by one task: the longest example *is* the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import register, table

HEAD, BREAK, END = "### ", "\n", "</turn>\n"
ASSISTANT = "assistant"


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


MARKS = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]


def escape(text: Column) -> Column:
    return _swap(text, MARKS)


def escape_role(role: Column) -> Column:
    return _swap(role, [*MARKS, ("\n", "\\n")])


def unescape(text: Column) -> Column:
    return _swap(text, [(new, old) for old, new in [("\n", "\\n"), *reversed(MARKS)]])


def expand(turns: DataFrame) -> DataFrame:
    """Examples of ``turns`` (conv_id, turn, role, text).

    Returns conv_id, target (number of the trainable turn from 0, null if none), last (whether the
    example holds the whole conversation), formatted, and loss_start and loss_length in code points
    (null without a target).
    """
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    whole = whole.select(
        "conv_id",
        F.transform("t", lambda t: F.concat(F.lit(HEAD), escape_role(t["role"]), F.lit(BREAK))).alias("heads"),
        F.transform("t", lambda t: escape(t["text"])).alias("bodies"),
        F.transform("t", lambda t: t["role"] == ASSISTANT).alias("replies"),
    )
    n = F.size("bodies")
    targets = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("replies", i) | (i == n - 1))
    one = whole.select("conv_id", "heads", "bodies", "replies", F.explode(targets).alias("at"))
    prefix = lambda count: F.concat_ws(
        "", F.zip_with(F.slice("heads", 1, count), F.slice("bodies", 1, count), lambda h, b: F.concat(h, b, F.lit(END)))
    )
    trains = F.get("replies", F.col("at"))
    one = one.select("conv_id", "at", trains.alias("trains"), prefix(F.col("at")).alias("context"), F.get("heads", F.col("at")).alias("head"), F.get("bodies", F.col("at")).alias("body"), (F.col("at") == n - 1).alias("last"))
    return one.select(
        "conv_id",
        F.when(F.col("trains"), F.col("at")).alias("target"),
        "last",
        F.concat("context", "head", "body", F.lit(END)).alias("formatted"),
        F.when(F.col("trains"), F.length("context") + F.length("head")).alias("loss_start"),
        F.when(F.col("trains"), F.length("body")).alias("loss_length"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted example, as an array of (role, text)."""
    pieces = F.split(formatted, END)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, BREAK)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(HEAD) + 1), cut - 1 - len(HEAD))).alias("role"),
            unescape(F.substring(piece, cut + 1, F.length(piece))).alias("text"),
        )

    return F.transform(turns, turn)


def digest(examples: DataFrame) -> DataFrame:
    """What the formatted examples of a conversation say, read back from them."""
    loss = unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    told = F.transform(parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = examples.select(
        "conv_id",
        F.length("formatted").cast("long").alias("n"),
        F.when(F.col("loss_start").isNotNull(), F.struct("target", loss.alias("text"))).alias("loss"),
        F.when(F.col("last"), F.struct(F.size(told).cast("long").alias("n"), F.sha2(F.concat_ws("", told), 256).alias("sha"))).alias("turns"),
    )
    got = rows.groupBy("conv_id").agg(F.max("turns").alias("turns"), F.sort_array(F.collect_list("loss")).alias("loss"), F.sum("n").alias("formatted_chars"))
    under = F.concat_ws("", F.transform("loss", lambda x: x["text"]))
    return got.select(
        "conv_id",
        F.col("turns.n").alias("n_turns"),
        F.col("turns.sha").alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"),
        F.sha2(under, 256).alias("loss_sha256"),
        "formatted_chars",
    )


PROBE = r"\### Assistant: </turn> ok"

OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), n AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(13 + length(role) + length(regexp_replace(role, '[^\\#<' || chr(10) || ']', '', 'g'))
        + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) OVER (w ROWS UNBOUNDED PRECEDING) AS so_far
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (role = 'assistant' OR i = n) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""


@register("op10_chat_format", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PROBE).alias("text")
    )
    return digest(expand(turns.unionByName(probe)))
