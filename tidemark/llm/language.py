"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are the runs of 2 to 4 bytes of the lower-cased text in which everything but letters is a
blank; they are hashed to ``BUCKETS`` embeddings, averaged and passed to a softmax. Both layers are
trained by stochastic gradient descent in numpy. As both are linear up to the softmax, they are
multiplied once and a document costs one table lookup per subword and language.

The sample is bounded: of each of the ``MOST_LANGUAGES`` most frequent languages at most ``per_language
+ held_back`` labelled documents, distinct by id and text, those with the smallest hashes of both.
Rarer languages are not learned. The first ``per_language`` (or four fifths, of fewer) train; the rest is
scored in the executors, which send back one row of logits a document.

*Rejection.* The softmax has one class more, for text of no learned language. It is trained on the same
documents with a share of their subwords replaced by random ones, so that subwords which no learned
language uses speak for it. Targets are smoothed, so logits stay finite. The temperature is set so that
the mean score of the held-back documents is the share of them that is right (by the rule of
succession), and the bound is the score below which only ``reject_share`` of those rightly labelled
fall. Nothing else moves the bound.

Null texts and texts without a letter get ``und``, score 0. Empty input gives no rows; repeated
rows get a row each; other columns pass through ``predict`` untouched, one named like a column it
adds is replaced. With nothing to learn from, every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from tidemark.llm.arrays import U64, column, map_rows, segment_sums, slices, utf8
from tidemark.llm.registry import register, table
from tidemark.session import settle

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
UNKNOWN = "und"
#: Languages that are learned, the most frequent ones.
MOST_LANGUAGES = 200
#: The share of subwords drawn anew in a document that stands for no language, from and to.
REPLACED = (0.3, 1.0)
_LOWER = np.full(256, 0x20, np.uint8)
_LOWER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LOWER[0x80:] = np.arange(0x80, 256)


def letters(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes, with a blank for each ASCII byte that is no letter."""
    low = _LOWER[data]
    # Capitals of Latin-1: 0xC3 followed by 0x80 to 0x9E; small ones are 0x20 further on.
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)
    low[1:][capital] += 0x20
    return low


def subwords(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the ``n`` bytes at each place; ``BUCKETS`` where they pass the text's end or are blank."""
    value = letters(data).astype(np.uint64)
    key = np.zeros(len(value), U64)
    blank = np.ones(len(value), bool)
    for i in range(n):
        whole = max(len(key) - i, 0)
        key[:whole] |= value[i:] << U64(8 * i)
        blank[:whole] &= value[i:] == 0x20
    bucket = (((key + U64(n)) * U64(0x9E3779B97F4A7C15)) >> U64(64 - 15)).astype(np.int64)
    bucket[blank] = BUCKETS
    ends = offsets[1:][offsets[1:] > offsets[:-1]]
    for i in range(1, n):
        at = ends - i
        bucket[at[at >= 0]] = BUCKETS
    return bucket


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logits: np.ndarray  # (languages + 1, BUCKETS + 1): the last row is no language, the last column zero
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probabilities of the languages, one row per text; they add up to less than one."""
        return _softmax(self.raw(texts) / self.temperature)[:, : len(self.languages)]

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Mean logits of each text's subwords; the bias alone where there is none."""
        data, offsets = utf8(texts)
        total = np.zeros((len(texts), len(self.logits)))
        count = np.zeros(len(texts))
        for n in GRAMS if len(data) else ():
            bucket = subwords(data, offsets, n)
            count += segment_sums((bucket < BUCKETS).astype(np.int64), offsets)
            for k, row in enumerate(self.logits):
                total[:, k] += segment_sums(row[bucket], offsets)
        return total / np.maximum(count, 1)[:, None] + self.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    if x.shape[-1] == 0:
        return x
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = (data | 0x20) - np.uint8(97) < 26
    found = segment_sums(plain.astype(np.int64), offsets) > 0
    for i in np.flatnonzero(~found & (offsets[1:] > offsets[:-1])):
        found[i] = any(c.isalpha() for c in texts[int(i)].as_py() or "")
    return found


def held_out(key: str = "doc_id", parts: int = 4, rest: int = 2):
    """True where crc32 of the id as text leaves ``rest``; a null id never is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == rest, F.lit(False))


def _bags(batch: pa.RecordBatch):
    """Each document's buckets and their shares of its subwords."""
    texts, langs = column(batch, "text"), column(batch, "lang")
    for begin, end in slices(texts):
        data, offsets = utf8(texts.slice(begin, end - begin))
        if not len(data):
            continue
        grams = [subwords(data, offsets, n) for n in GRAMS]
        keep, shares = [], []
        for i in range(end - begin):
            got = np.concatenate([g[offsets[i] : offsets[i + 1]] for g in grams])
            count = np.bincount(got, minlength=BUCKETS + 1)[:BUCKETS]
            used = np.flatnonzero(count)
            keep.append(used.astype(np.uint16).tobytes())
            shares.append((count[used] / max(count.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [langs.slice(begin, end - begin).cast(pa.string()), pa.array(keep, pa.binary()), pa.array(shares, pa.binary())],
            ["lang", "buckets", "shares"],
        )


def draw_sample(labelled: DataFrame, per_language: int, held_back: int) -> tuple[list[str], DataFrame]:
    """The languages to learn and the sample (text, lang, training), of bounded size whatever repeats."""
    labelled = labelled.where("text is not null and lang is not null").withColumn("at", F.xxhash64("doc_id", "text"))
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("at").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return [], labelled.select("text", "lang", F.lit(True).alias("training"))
    most, span = per_language + held_back, 1 << 30
    # About twice as many as wanted pass the bound on the hash; the window keeps the first of them.
    bound = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(span, 2 * most * span // r["n"] + 1))])
    near = labelled.where(F.pmod("at", F.lit(span)) < bound[F.col("lang")]).dropDuplicates(["doc_id", "lang", "at"])
    order = Window.partitionBy("lang").orderBy(F.pmod("at", F.lit(span)), "at", "doc_id")
    first = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    cut = F.least(F.lit(per_language), F.ceil(F.count("*").over(Window.partitionBy("lang")) * 0.8))
    chosen = first.select("text", "lang", (F.col("rank") <= cut).alias("training"))
    return sorted(r["lang"] for r in counts), settle(chosen, "language-sample")


def _train(docs: list, languages: int, size: int, epochs: int, rate: float, smooth: float, rng) -> tuple[np.ndarray, np.ndarray]:
    """Logits of all buckets and biases, by gradient descent on (buckets, shares, language) one at a time."""
    classes = languages + 1
    embed = rng.normal(0, 0.1, (BUCKETS, size)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (size, classes)).astype(np.float32), np.zeros(classes, np.float32)
    steps, step = max(1, 2 * epochs * len(docs)), 0
    for _ in range(epochs):
        for i in rng.permutation(2 * len(docs)):
            bucket, share, y = docs[i // 2]
            if i % 2:
                # The same document with some or all of its subwords drawn anew: no language.
                kept = rng.random(len(bucket)) > rng.uniform(*REPLACED)
                bucket = np.where(kept, bucket, rng.integers(0, BUCKETS, len(bucket)))
                y = languages
            now = rate * (1 - step / steps)
            step += 1
            hidden = share @ embed[bucket]
            p = _softmax(hidden @ out + bias) - np.float32(smooth / classes)
            p[y] -= 1 - smooth
            toward = out @ p
            out -= now * np.outer(hidden, p)
            bias -= now * 0.05 * p
            # Shares are small: the embedding layer takes a rate scaled to the subwords of a text.
            embed[bucket] -= (now * 200.0) * share[:, None] * toward
    logits = np.zeros((classes, BUCKETS + 1), np.float32)
    logits[:, :BUCKETS] = (embed @ out).T
    return logits, bias.astype(np.float64)


def _temperature(raw: np.ndarray, languages: int, wanted: float) -> float:
    """The temperature at which the mean best score of ``raw`` is ``wanted``; a mean score falls as it rises."""
    low, high = 1e-3, 1e3
    for _ in range(60):
        middle = float(np.sqrt(low * high))
        mean = _softmax(raw / middle)[:, :languages].max(axis=1).mean()
        low, high = (middle, high) if mean > wanted else (low, middle)
    return float(np.sqrt(low * high))


def _lowest(scores: np.ndarray, share: float) -> float:
    """The score below which a new one falls with probability ``share``, from ranks among n + 1; below the
    lowest of a small sample it goes straight down to 0."""
    ranked = np.r_[0.0, np.sort(scores)]
    return float(np.interp(share * len(ranked), np.arange(len(ranked)), ranked))


def fit(labelled: DataFrame, per_language: int = 400, held_back: int = 1500, size: int = 16, epochs: int = 8, rate: float = 0.5, smooth: float = 0.05, reject_share: float = 0.002, seed: int = 7) -> LanguageModel:
    """Learn from ``labelled`` (doc_id, text, lang); the sample's size does not follow the input."""
    languages, sample = draw_sample(labelled, per_language, held_back)
    if not languages:
        return LanguageModel((), np.zeros((1, BUCKETS + 1), np.float32), np.zeros(1), 1.0, 0.0)
    where = {lang: i for i, lang in enumerate(languages)}
    rows = sample.where("training").select("text", "lang").mapInArrow(map_rows(_bags), "lang string, buckets binary, shares binary").toLocalIterator()
    docs = sorted((r["buckets"], r["shares"], where[r["lang"]]) for r in rows if len(r["buckets"]))
    docs = [(np.frombuffer(b, np.uint16), np.frombuffer(s, np.float32), y) for b, s, y in docs]
    logits, bias = _train(docs, len(languages), size, epochs, rate, smooth, np.random.default_rng(seed))
    plain = LanguageModel(tuple(languages), logits, bias, 1.0, 0.0)
    held = sample.sparkSession.sparkContext.broadcast(plain)

    def judge(batch: pa.RecordBatch):
        texts, langs = column(batch, "text"), column(batch, "lang")
        for begin, end in slices(texts):
            part = texts.slice(begin, end - begin)
            data, offsets = utf8(part)
            known = np.flatnonzero(has_letter(part, data, offsets))
            raw = held.value.raw(part)[known]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(raw.ravel()), raw.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([langs.slice(begin, end - begin).take(pa.array(known)).cast(pa.string()), lists], ["lang", "raw"])

    told = sample.where("not training").select("text", "lang").mapInArrow(map_rows(judge), "lang string, raw array<double>").collect()
    if not told:
        return plain
    raw, truth = np.array([r["raw"] for r in told]), np.array([where[r["lang"]] for r in told])
    right = raw[:, : len(languages)].argmax(axis=1) == truth
    heat = _temperature(raw, len(languages), (right.sum() + 1) / (len(right) + 2))
    best = _softmax(raw / heat)[:, : len(languages)].max(axis=1)
    return LanguageModel(tuple(languages), logits, bias, heat, _lowest(best[right], reject_share))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", pred: str = "lang_pred", score: str = "score", rejected: str = "lang_rejected") -> DataFrame:
    """Append the predicted language, its probability and whether it is rejected.

    Rejected are texts without a language and those scored below the model's bound.
    """
    docs = docs.drop(pred, score, rejected)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def label(batch: pa.RecordBatch):
        m, texts = held.value, column(batch, text)
        for begin, end in slices(texts):
            part = texts.slice(begin, end - begin)
            data, offsets = utf8(part)
            known = has_letter(part, data, offsets) if m.languages else np.zeros(end - begin, bool)
            p = m.scores(part)
            best = p.argmax(axis=1) if m.languages else np.zeros(end - begin, np.int64)
            top = np.where(known, p.max(axis=1) if m.languages else 0.0, 0.0)
            name = [m.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [*batch.slice(begin, end - begin).columns, pa.array(name, pa.string()), pa.array(top), pa.array(~known | (top < m.reject_below))],
                [*batch.schema.names, pred, score, rejected],
            )

    schema = StructType(list(docs.schema)).add(pred, StringType()).add(score, DoubleType()).add(rejected, BooleanType())
    return docs.mapInArrow(map_rows(label), schema)


def fit_documents(docs: DataFrame) -> LanguageModel:
    return fit(docs.where(~held_out()).where("doc_id is not null").select("doc_id", "text", "lang"))


@register("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_documents(docs)
    got = predict(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return got.select("doc_id", "held_out", "lang_pred", "score", "lang_rejected")
