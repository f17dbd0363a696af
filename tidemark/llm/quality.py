"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A document is its counts of hashed runs of 1 to 4 *shapes* (small letter, capital, digit, blank,
line end, or the mark itself) and of words repeated at once, damped, weighted by inverse document frequency and projected on the
leading singular vectors of the labelled sample. Every document meets every labelled vector in
blocked cosine products; the ``neighbours`` nearest vote, each with its similarity to a power.

Labelled vectors are broadcast. Their number is bounded by ``most`` (by hash of the id), whatever
the size of the label table, so the broadcast is at most ``most * rank`` floats.

Null and empty texts, and texts without any known shape, get the share of label 1 in the sample.
Labels with null id or quality are left out; an id labelled twice counts with its mean. Without any
label every score is 0.5. Empty tables give no rows, repeated rows a row each; other columns pass
through, one named like an added column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from tidemark.llm.arrays import U64, column, map_rows, slices, utf8, word_hashes, words
from tidemark.llm.language import held_out
from tidemark.llm.registry import register, table

BUCKETS = 1 << 11
GRAMS = (1, 2, 3, 4)
THRESHOLD = 0.3
#: A repeated word counts as so many runs; a word has about twenty.
REPEAT_WEIGHT = 20
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")
_SHAPE[0x80:] = ord("a")


def shapes(data: np.ndarray) -> np.ndarray:
    out = _SHAPE[data]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)
    out[:-1][capital] = ord("A")
    out[1:][capital] = ord("A")
    return out


def bags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of shape runs per text, (texts, BUCKETS)."""
    n_texts, out = len(offsets) - 1, np.zeros((len(offsets) - 1) * BUCKETS, np.int64)
    value = shapes(data).astype(U64)
    row = np.repeat(np.arange(n_texts) * BUCKETS, np.diff(offsets))
    starts, ends, first = words(data, offsets)
    word = word_hashes(data, starts, ends)
    for back in (1, 2):  # stuttering: a word said again right away or after one other
        again = np.flatnonzero(word[back:] == word[:-back]) + back
        again = again[row[starts[again]] == row[starts[again - back]]]
        out += REPEAT_WEIGHT * np.bincount(row[starts[again]] + back - 1, minlength=len(out))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    key = np.zeros(len(data), U64)
    for n in GRAMS:
        key[: len(key) - n + 1] |= value[n - 1 :] << U64(8 * (n - 1))
        bucket = (((key + U64(n)) * U64(0x9E3779B97F4A7C15)) >> U64(64 - 11)).astype(np.int64)
        bucket = np.maximum(bucket, 2)  # 0 and 1 count repeated words
        inside = room >= n
        out += np.bincount(row[inside] + bucket[inside], minlength=len(out))
    return out.reshape(n_texts, BUCKETS)


def damped(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-12)


@dataclass(frozen=True)
class QualityModel:
    basis: np.ndarray  # (BUCKETS, rank): inverse document frequency times singular vectors
    points: np.ndarray  # (labelled, rank), unit length
    votes: np.ndarray
    prior: float
    neighbours: int
    power: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(damped(counts) @ self.basis)

    def scores(self, counts: np.ndarray, leave_out: np.ndarray | None = None) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.points):
            return out
        x = self.project(counts)
        k = min(self.neighbours, len(self.points) - (leave_out is not None))
        for begin in range(0, len(x), 256):
            like = x[begin : begin + 256] @ self.points.T
            if leave_out is not None:
                like[np.arange(len(like)), leave_out[begin : begin + 256]] = -2
            near = np.argpartition(like, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(like, near, axis=1), 0).astype(np.float64) ** self.power
            total = weight.sum(axis=1)
            some = total > 0
            out[begin : begin + 256][some] = (weight * self.votes[near]).sum(axis=1)[some] / total[some]
        return np.clip(out, 0, 1)


def _counted(batch: pa.RecordBatch):
    texts, quality = column(batch, "text"), column(batch, "quality")
    for begin, end in slices(texts):
        data, offsets = utf8(texts.slice(begin, end - begin))
        rows = [damped(r[None])[0].tobytes() for r in bags(data, offsets)]
        yield pa.RecordBatch.from_arrays([quality.slice(begin, end - begin), pa.array(rows, pa.binary())], ["quality", "bag"])


def fit(docs: DataFrame, labels: DataFrame, most: int = 3000, rank: int = 32, neighbours: int = 25, power: float = 8.0, seed: int = 3) -> QualityModel:
    """Learn from documents joined to ``labels`` (doc_id, quality) by id; at most ``most`` of them."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = (
        docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
        .mapInArrow(map_rows(_counted), "quality double, bag binary").collect()
    )
    rows = sorted((r["bag"], r["quality"]) for r in rows)
    if not rows:
        return QualityModel(np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0), 0.5, neighbours, power)
    x = np.frombuffer(b"".join(b for b, _ in rows), np.float32).reshape(len(rows), BUCKETS)
    votes = np.array([q for _, q in rows])
    idf = (1 + np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0)))).astype(np.float32)
    weighted = x * idf
    rng = np.random.default_rng(seed)
    # Leading right singular vectors by subspace iteration.
    span = rng.normal(size=(BUCKETS, min(rank + 8, len(x)))).astype(np.float32)
    for _ in range(6):
        span, _ = np.linalg.qr(weighted.T @ (weighted @ span))
    _, _, right = np.linalg.svd(weighted @ span, full_matrices=False)
    basis = idf[:, None] * (span @ right.T)[:, :rank]
    return QualityModel(basis.astype(np.float32), unit(x @ basis), votes, float(votes.mean()), neighbours, power)


def predict(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score", predicted: str = "predicted", threshold: float = THRESHOLD) -> DataFrame:
    """Append the score and whether it reaches ``threshold``."""
    docs = docs.drop(score, predicted)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def vote(batch: pa.RecordBatch):
        texts = column(batch, text)
        for begin, end in slices(texts):
            data, offsets = utf8(texts.slice(begin, end - begin))
            got = np.concatenate([held.value.scores(bags(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in _rows(end - begin)])
            yield pa.RecordBatch.from_arrays(
                [*batch.slice(begin, end - begin).columns, pa.array(got), pa.array((got >= threshold).astype(np.int32))],
                [*batch.schema.names, score, predicted],
            )

    schema = StructType(list(docs.schema)).add(score, DoubleType()).add(predicted, IntegerType())
    return docs.mapInArrow(map_rows(vote), schema)


def _rows(n: int, step: int = 512):
    """Many short texts are cut once more: each takes a row of ``BUCKETS`` counts."""
    return [(i, min(i + step, n)) for i in range(0, n, step)]


def fit_documents(docs: DataFrame, labels: DataFrame) -> QualityModel:
    return fit(docs, labels.where(~held_out(parts=5, rest=0)).select("doc_id", "quality"))


@register("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_documents(docs, table(spark, sf_dir, "labels"))
    got = predict(docs.select("doc_id", "text", held_out(parts=5, rest=0).alias("held_out")), model)
    return got.select("doc_id", "held_out", "score", "predicted")
