"""Raw nested posts to the declared flat schema.

The input is a ``VARIANT`` column, or a struct of ``VARIANT`` fields, because the rules tell an absent
key from a stored null: a default fills in only for the former.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schema import COUNT_COLUMNS

POST_FIELDS = ("id", "created_at", "text", "source", "public_metrics")

# (path below the post, type) -> the value there
Getter = Callable[[str, str], Column]


def _getter(raw: DataFrame, column: str) -> Getter:
    post = F.col(column)
    if not isinstance(raw.schema[column].dataType, StructType):
        return lambda path, kind: F.try_variant_get(post, f"$.{path}", kind)

    def field(path: str, kind: str) -> Column:
        name, _, rest = path.partition(".")
        return F.try_variant_get(post.getField(name), f"$.{rest}" if rest else "$", kind)

    return field


def _text_or(get: Getter, path: str, default: str) -> Column:
    """The string at ``path``; ``default`` when the key is absent, null when it is null."""
    return F.when(get(path, "variant").isNull(), F.lit(default)).otherwise(get(path, "string"))


def _id_text(get: Getter) -> Column:
    part, text = get("id", "variant"), get("id", "string")
    return (
        F.when(part.isNull(), F.lit(""))
        .when(F.is_variant_null(part), F.lit("None"))
        .when(F.schema_of_variant(part) == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def _count(get: Getter, name: str) -> Column:
    """A count as bigint, truncated; digits in a string are accepted, anything else is null."""
    path = f"public_metrics.{name}"
    return F.coalesce(get(path, "bigint"), get(path, "double").try_cast("bigint"))


def normalize(raw: DataFrame, column: str = "post", keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Eight flat columns plus ``quality_flags``, then any ``keep`` columns of ``raw``.

    Flags: ``bad_json`` (the line held no JSON), ``null_text``, and ``bad_<count>`` for a stored
    count that is null or not a number, which becomes 0. ``strict`` fails on any flag instead.
    """
    get = _getter(raw, column)
    counts = {name: _count(get, name) for name in COUNT_COLUMNS}
    flags = [
        F.when(F.col(column).isNull(), F.lit("bad_json")),
        F.when(F.is_variant_null(get("text", "variant")), F.lit("null_text")),
    ]
    for name, value in counts.items():
        present = get(f"public_metrics.{name}", "variant").isNotNull()
        flags.append(F.when(present & value.isNull(), F.lit(f"bad_{name}")))
    quality = F.array_compact(F.array(*flags))
    if strict:
        quality = F.when(F.size(quality) == 0, quality).otherwise(
            F.raise_error(F.concat(F.lit("post failed strict checks: "), F.array_join(quality, ",")))
            .cast("array<string>")
        )
    return raw.select(
        _id_text(get).alias("id"),
        _text_or(get, "created_at", "").alias("created_at"),
        _text_or(get, "text", "").alias("text"),
        *[F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in counts.items()],
        _text_or(get, "source", "unknown").alias("source"),
        quality.alias("quality_flags"),
        *[F.col(c) for c in keep],
    )
