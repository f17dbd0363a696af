"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into equal segments, at several resolutions; each segment is kept as its mean and
deviation. For two segments of ``n`` components the squared distance is at least
``n * ((mean - mean')**2 + (dev - dev')**2)``, and with the vectors' lengths that is an upper bound
of the inner product. A tile is searched in blocks: the bounds are computed coarse to fine, each
only for what the one before left over, and survivors get their exact product. What a query must
beat is the k-th best product so far; candidates that can only tie are kept, for the smaller id.

Components are whole numbers, floor(1024 * x), so products are exact. See ``tiles`` for what takes
part and how repeated ids count. Fewer candidates than ``k`` are all returned; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.registry import register, table
from tidemark.llm.tiles import search, usable

LEVELS = (2, 8, 16)
ROWS, QUERIES = 1024, 256


def whole(x: np.ndarray) -> np.ndarray:
    return np.floor(1024.0 * x)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that a dot product bounds the inner product."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    root = np.sqrt([len(p) for p in parts])
    mean = np.stack([x[:, p].mean(axis=1) for p in parts], axis=1)
    dev = np.stack([x[:, p].std(axis=1) for p in parts], axis=1)
    return np.concatenate([mean * root, dev * root], axis=1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers, as doubles where these are exact, else as integers."""
    most = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * q.shape[1]
    if most < 2**53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def best_products(k: int, counted: dict | None = None):
    """The tile search for ``tiles.search``; ``counted`` collects how many pairs each step looks at."""

    def best(query_ids, q, ids, x):
        q, x = whole(q), whole(x)
        stats_x = [statistics(x, s) for s in LEVELS]
        out = []
        for begin in range(0, len(q), QUERIES):
            part, own = q[begin : begin + QUERIES], query_ids[begin : begin + QUERIES]
            stats_q = [statistics(part, s) for s in LEVELS]
            top = np.full((len(part), k), np.iinfo(np.int64).min)
            for at in range(0, len(x), ROWS):
                block, block_ids = x[at : at + ROWS], ids[at : at + ROWS]
                beat = top[:, 0].astype(np.float64)
                live_q, live_x = np.arange(len(part)), np.arange(len(block))
                open_pairs = own[:, None] != block_ids[None, :]
                for sq, sx in zip(stats_q, stats_x):
                    # The bound of what is still open; a hair above, for the rounding of roots.
                    bound = sq[live_q] @ sx[at : at + ROWS][live_x].T
                    open_pairs = open_pairs & (bound + 1e-9 * np.abs(bound) + 1e-3 >= beat[live_q, None])
                    if counted is not None:
                        counted[sq.shape[1] // 2] = counted.get(sq.shape[1] // 2, 0) + bound.size
                    some_q, some_x = open_pairs.any(axis=1), open_pairs.any(axis=0)
                    live_q, live_x, open_pairs = live_q[some_q], live_x[some_x], open_pairs[some_q][:, some_x]
                    if not open_pairs.size:
                        break
                if not open_pairs.size:
                    continue
                score = products(part[live_q], block[live_x])
                open_pairs &= score >= top[live_q, 0][:, None]
                i, j = np.nonzero(open_pairs)
                if counted is not None:
                    counted["exact"] = counted.get("exact", 0) + score.size
                if not len(i):
                    continue
                out.append((begin + live_q[i], block_ids[live_x[j]], score[i, j]))
                lifted = np.concatenate([top[live_q], np.where(open_pairs, score, np.iinfo(np.int64).min)], axis=1)
                top[live_q] = np.sort(np.partition(lifted, -k, axis=1)[:, -k:], axis=1)
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*out))

    return best


def top_products(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    return search(usable(vectors), every, k, "long", best_products(k))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@register("op2_exact_topk", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))
