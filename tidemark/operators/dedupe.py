"""One row per key, without sending all copies of a key to one task or sorting whole rows.

The winning order value of a key is aggregated first, on the map side too and without the other
columns; then the rows that carry it are kept. A ``row_number`` window would gather and sort every
copy, and a ``max_by`` of the whole row sorts rows twice.

Ordered by one whole number, the stamp of a row is a single decimal: the number, then 63 bits of the
row's hash, which settle ties. It fits the buffer of a hash aggregate. Keys are joined as text and a
flag for null, by plain equality, so both shuffles are by the same columns and what follows needs none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDE = "decimal(38,0)"


def _stamp(df: DataFrame, order: list[Column]) -> Column:
    """A value that sorts rows by ``order`` (nulls first) and differs for different rows."""
    row = F.xxhash64(*df.columns)
    kinds = [f.dataType for f in df.select(*[c.alias(f"o{i}") for i, c in enumerate(order)]).schema]
    if len(order) == 1 and isinstance(kinds[0], T.IntegralType):
        lowest = F.lit(str(-(2**63) - 1)).cast("decimal(20,0)")
        number = F.coalesce(order[0].cast("decimal(20,0)"), lowest)
        return (number * F.lit("1" + "0" * 19).cast("decimal(20,0)")).cast(_WIDE) + F.shiftrightunsigned(row, 1).cast("decimal(19,0)")
    return F.struct(*[c.alias(f"order_{i}") for i, c in enumerate(order)], row.alias("row"))


def _pick(df: DataFrame, keys: list[str], order: list[Column], best, reached, copies: str | None) -> DataFrame:
    # ``reached`` compares by order, as an equality would become a join key and shuffle the winners again.
    coded = {f"_key_{i}": F.coalesce(F.col(k).cast("string"), F.lit("")) for i, k in enumerate(keys)}
    coded |= {f"_null_{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    rows = df.withColumns(coded | {"_stamp": _stamp(df, order)})
    counted = [F.count(F.lit(1)).alias("_copies")] if copies else []
    won = rows.groupBy(*coded).agg(best("_stamp").alias("_won"), *counted)
    kept = rows.join(won, list(coded)).where(reached(F.col("_stamp"), F.col("_won")))
    # Identical rows are one; the join has brought a key's rows together already.
    extra = [F.col("_copies").alias(copies)] if copies else []
    return kept.select(*df.columns, *coded, *extra).distinct().drop(*coded)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], copies: str | None = None) -> DataFrame:
    """The row with the smallest ``order`` per key.

    ``copies`` names an extra column with the number of rows the key had.
    """
    return _pick(df, keys, order, F.min, Column.__le__, copies)


def last_per_key(df: DataFrame, keys: list[str], order: list[Column], copies: str | None = None) -> DataFrame:
    """The row with the largest ``order`` per key."""
    return _pick(df, keys, order, F.max, Column.__ge__, copies)
