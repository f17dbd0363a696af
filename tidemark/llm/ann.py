"""Approximate nearest neighbours by multi-index hashing.

*Codes*: unit vectors are turned by rotations learned on a bounded sample (each turns the sample as
close as possible to the corners of a cube, by alternating signs and a Procrustes step), and the
signs of all rotations together are the code. *Index*: the code is cut into 16-bit substrings, and
every substring indexes its rows by value. *Search*: codes within Hamming radius ``r`` of ``m``
substrings agree with the query in at least one of them up to ``r // m`` bits (and all but the
first ``r % m + 1`` up to one bit less), so probing those buckets finds every code within the
radius. Those are ranked by cosine in double precision on the original vectors.

The radius is learned too: the ``reach`` quantile of the Hamming distances between sample vectors
and their true nearest in the sample. Neighbours in the whole table are nearer than in a sample, so
recall there is at least about ``reach``. A query with fewer than ``k`` codes of the whole table within
the radius has its ``k`` nearest codes instead. Every row is indexed; no bucket is capped.

Zero vectors take no part; see ``tiles`` for the rest. Ties go to the smaller id; fewer candidates
than ``k`` are all returned; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import register, table
from tidemark.llm.tiles import search, usable

SAMPLE = 4096
_ONES = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


@dataclass(frozen=True)
class Codes:
    rotations: np.ndarray  # (components, bits)
    center: np.ndarray
    radius: int

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """Substrings of the codes, (rows, substrings) of 16 bits."""
        bits = (unit - self.center) @ self.rotations > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def normalized(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[a ^ b].sum(axis=-1, dtype=np.int64)


def fit(sample: np.ndarray, bits: int = 128, k: int = 5, reach: float = 0.98, rounds: int = 25, seed: int = 5) -> Codes:
    """Rotations and radius from the rows of ``sample`` (in a defined order)."""
    if not len(sample):
        return Codes(np.zeros((0, 0)), np.zeros(0), 0)
    rng = np.random.default_rng(seed)
    x = normalized(sample)
    center = x.mean(axis=0)
    turned, size = x - center, x.shape[1]
    banks = []
    for _ in range(-(-bits // size)):
        r, _ = np.linalg.qr(rng.normal(size=(size, size)))
        for _ in range(rounds):
            u, _, v = np.linalg.svd(turned.T @ np.where(turned @ r > 0, 1.0, -1.0))
            r = u @ v
        banks.append(r)
    rotations = np.concatenate(banks, axis=1)
    rotations = rotations[:, : max(16, min(bits, rotations.shape[1]) // 16 * 16)]
    if rotations.shape[1] % 16:  # fewer than 16 components: fill up with zero bits
        rotations = np.pad(rotations, ((0, 0), (0, -rotations.shape[1] % 16)))
    codes = Codes(rotations, center, rotations.shape[1])
    code = codes.encode(x)
    asked = np.arange(min(len(x), 512))
    like = x[asked] @ x.T
    like[asked, asked] = -2
    near = np.argsort(-like, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    far = hamming(code[asked][:, None, :], code[near])
    return Codes(rotations, center, int(np.ceil(np.quantile(far, reach))) if far.size else rotations.shape[1])


class Index:
    """Substring indexes over the codes of one tile."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.buckets = codes, []
        for j in range(codes.shape[1]):
            values, rows = np.unique(codes[:, j], return_inverse=True)
            self.buckets.append((values, rows))

    @staticmethod
    def masks(radius: int) -> np.ndarray:
        """All 16-bit values of at most ``radius`` ones."""
        return np.array([sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(16), n)], np.uint16)

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) of all codes within ``radius``."""
        parts = self.codes.shape[1]
        hit = np.zeros((len(queries), len(self.codes)), bool)
        for j, (values, rows) in enumerate(self.buckets):
            reach = radius // parts - (j > radius % parts)
            if reach < 0:
                continue
            if reach <= 2 and len(values) > 256:  # few neighbours: look their buckets up
                probes = queries[:, j, None] ^ self.masks(reach)[None, :]
                at = np.minimum(np.searchsorted(values, probes), len(values) - 1)
                q, p = np.nonzero(values[at] == probes)
                bucket = np.zeros((len(queries), len(values)), bool)
                bucket[q, at[q, p]] = True
            else:  # more neighbours than buckets: compare the buckets' values
                bucket = _ONES[queries[:, j, None] ^ values[None, :]] <= reach
            hit |= bucket[:, rows]
        q, x = np.nonzero(hit)
        near = hamming(queries[q], self.codes[x]) <= radius
        return q[near], x[near]


def best_cosines(codes: Codes, k: int):
    def best(query_ids, q, ids, x):
        q, x = normalized(q), normalized(x)
        code_q, index = codes.encode(q), Index(codes.encode(x))
        out = []
        step = max(1, min(256, (1 << 22) // len(x)))
        for begin in range(0, len(q), step):
            part = slice(begin, begin + step)
            a, b = index.within(code_q[part], codes.radius)
            own = query_ids[part][a] == ids[b]
            a, b = a[~own], b[~own]
            far = hamming(code_q[part][a], index.codes[b])
            for i in np.flatnonzero(np.bincount(a, minlength=len(code_q[part])) < k):
                distance = hamming(code_q[begin + i][None, :], index.codes)
                others = np.flatnonzero(ids != query_ids[begin + i])
                add = others[np.lexsort((ids[others], distance[others]))][:k]
                a, b, far = np.r_[a[a != i], np.full(len(add), i)], np.r_[b[a != i], add], np.r_[far[a != i], distance[add]]
            score = np.concatenate([np.zeros(0)] + [np.einsum("ij,ij->i", q[begin + a[c : c + 65536]], x[b[c : c + 65536]]) for c in range(0, len(a), 65536)])
            order = np.lexsort((ids[b], -score, a))
            a, b, score, far = a[order], b[order], score[order], far[order]
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, np.int64)
            keep = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)])) < k
            out.append((begin + a[keep], ids[b[keep]], score[keep], far[keep]))
        return tuple(np.concatenate(c) for c in zip(*out))

    return best


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, **options) -> DataFrame:
    rows = usable(vectors).where("exists(embedding, x -> x <> 0)")
    # Ids are drawn first: what each task offers for the sample is ids, not vectors.
    drawn = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    sample = rows.join(F.broadcast(drawn), "vec_id").groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy("vec_id").toPandas()["embedding"]
    codes = fit(np.stack(sample.to_numpy()) if len(sample) else np.zeros((0, 0)), k=k, **options)
    return search(rows, every, k, "double", best_cosines(codes, k), codes.radius)


@register("op8_multi_index_hashing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
