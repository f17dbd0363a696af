"""A stated query set against all vectors, tile by tile.

The queries are cut into blocks of ``QUERY_BLOCK`` and the vectors dealt out evenly to lanes of at
most ``LANE`` rows; each (block, lane) meets in one task, which gives back its own best per query,
and a last window over those keeps the best of all. Nothing is broadcast and no task holds more
than one tile; the number of tiles, not their size, grows with the table.

Vectors that are null, of another length than most, or hold null or non-finite components take no
part. A query id that occurs twice is asked once, with the smaller of its vectors; a candidate that
occurs twice is found twice. A query never meets rows of its own id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK, LANE = 8192, 65536
#: Lanes are smaller on small tables, so that every core has some, but never below this.
SMALL_LANE = 2048


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    size = common.first()
    return rows.where(F.size("embedding") == (size["n"] if size else 0))


def matrix(rows: pa.Table, key: str = "vec_id") -> tuple[np.ndarray, np.ndarray]:
    ids = rows.column(key).to_numpy()
    flat = rows.column("embedding").combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return ids, flat.to_numpy(zero_copy_only=False).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))


def search(vectors: DataFrame, every: int, k: int, score_type: str, best: Callable, radius: int | None = None) -> DataFrame:
    """The ``k`` best candidates of each row whose id is divisible by ``every``.

    ``best(query_ids, queries, ids, vectors)`` returns arrays (row of the query, id, score) that hold
    at least the tile's ``k`` best of each query.

    With a ``radius``, candidates lie at a distance, a fourth array, and those beyond the radius count only
    for queries that have fewer than ``k`` within it in the whole table: the ``k`` at the least distance
    (ties to the smaller id), ranked by score. Of a query with fewer than ``k`` in a tile, ``best`` returns the
    tile's ``k`` at the least distance. So answers do not depend on how the table is cut into tiles.
    """
    asked = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # Under a name of its own: Spark takes the two sides of a cogroup for one column if they share it.
    asked = asked.withColumnRenamed("vec_id", "query_id")
    count, n_asked = vectors.count(), asked.count()
    blocks = max(1, -(-n_asked // QUERY_BLOCK))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, -(-count // LANE), min(2 * cores, count // SMALL_LANE))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    dealt = vectors.withColumn("lane", (F.monotonically_increasing_id() % lanes).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def tile(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        query_ids, q = matrix(queries, "query_id")
        ids, x = matrix(rows)
        names, kinds = ["query_id", "vec_id", "score"], [pa.int64(), pa.int64(), pa.int64() if score_type == "long" else pa.float64()]
        if radius is not None:
            names, kinds = [*names, "far"], [*kinds, pa.int64()]
        if not len(q) or not len(x):
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names)
        at, who, score, *far = best(query_ids, q, ids, x)
        order = np.lexsort((who, -score, at))
        at, who, score, *far = (v[order] for v in (at, who, score, *far))
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        keep = rank < k
        return pa.Table.from_arrays([pa.array(v[keep], t) for v, t in zip((query_ids[at], who, score, *far), kinds)], names)

    keys = ["block", "lane"]
    schema = f"query_id long, vec_id long, score {score_type}" + (", far long" if radius is not None else "")
    found = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(tile, schema)
    by = Window.partitionBy("query_id")
    if radius is not None:
        enough = F.col("inside") >= k
        first = F.when(enough, (F.col("far") > radius).cast("long")).otherwise(F.col("far"))
        chosen = by.orderBy(first, F.when(enough, -F.col("score")), "vec_id")
        found = found.withColumn("inside", F.count_if(F.col("far") <= radius).over(by)).withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= k)
    order = by.orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
