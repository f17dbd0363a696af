"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set: runs of ``SHINGLE`` words (a shorter text is one run), each with its count
times its inverse document frequency. Two texts are linked if their weighted Jaccard similarity,
the sum of smaller weights over the sum of larger ones, reaches ``SIMILARITY``; classes are the
connected components. Texts are compared word by word, unchanged.

*Frequencies* count all documents, for every shingle: ``1 + ln((1 + N) / (1 + df))``. Documents are
dealt by a hash of id and text to buckets of about ``BUCKET_BYTES``, once; copies of one text spread
over them. A bucket sends its distinct shingles, sorted and cut into hash ranges, each with a byte for
its count (more where that does not suffice), to be summed by range. Back come the places of those that
stand in more than one document, with their counts, and the bucket, which has kept its texts, works
its shingles out again. So a shingle meets others once per bucket, however many texts hold it, and no
task holds more than a few ranges.

*Sketches*: improved consistent weighted sampling (Ioffe 2010) draws ``BANDS * ROWS`` samples; two
texts agree in each with a probability equal to their similarity. *Bands* of ``ROWS`` samples put
texts into buckets: a pair at 0.8 misses all of them once in 3,000 times, one at 0.9 never in
practice. Within a bucket nobody is paired with everybody: a text is compared with the bucket's
fullest text (the one with most bucket mates overall, near the middle of its class) and with
``RANDOM_FIRSTS`` texts drawn anew in each bucket; finer buckets, with samples of the bands before as
well, do the same. So candidates grow with the texts, whatever the size of a bucket, and a pair that
misses the firsts of one bucket has those of its other buckets. Pairs whose sketches agree in less
than ``LEAST_AGREEMENT`` are not fetched (a pair at 0.8 falls there once in 1,000).

*Verification* is exact, on whole texts: first each text with its best candidate, then all
candidates that the links so far do not connect.

*What the buckets missed* is found by a prefix filter. With a text's shingles ordered from rare to
frequent, two texts at ``least`` or more share one of those that come before the first text's weight
passes ``1 - least`` of its whole. The first shingle they share, in that order, leaves room for enough
common weight behind it, and their whole weights differ by a factor of ``least`` at most. Texts of
different components for which a shared shingle meets both are compared, again the most alike of each
two components first. A shingle of one component alone is
dropped before anything is paired, so a family of linked copies costs no pairs. Only pairs whose
sketches agree in less than ``LEAST_SURE`` are not fetched (a pair at 0.8 falls there once in 10
million times).

Exact copies are one text from the start, so a hot group of copies costs one row. Null texts and
texts without words are classes of their own. Empty tables give no rows; repeated rows are copies;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrays import BASE_A, BASE_B, U64, column, map_rows, mix, range_hashes, slices, utf8, word_hashes, words
from tidemark.llm.components import components
from tidemark.llm.registry import register, table
from tidemark.session import settle

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
#: Shingles in less than this share of the documents all weigh the same: none, each has its own count.
SHARE = 0
BUCKET_BYTES = 4 << 20
LEAST_AGREEMENT = 0.55
LEAST_SURE = 0.4
#: Bits for each text to fetch (one in sixteen of the others is fetched in vain), and all of them: 8 MB.
BITS_EACH, MOST_BITS = 16, 1 << 26
#: Texts of each bucket, drawn at random, that its members are compared with beside the fullest.
RANDOM_FIRSTS = 2


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles (sorted), their counts, and where each text's begin (n + 1)."""
    data, offsets = utf8(texts)
    starts, ends, bounds = words(data, offsets)
    w = word_hashes(data, starts, ends)
    sizes = np.diff(bounds)
    grams = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    of = np.concatenate([[0], np.cumsum(grams)])
    begin = np.arange(of[-1]) + np.repeat(bounds[:-1] - of[:-1], grams)
    h = mix(range_hashes(w, begin, begin + np.repeat(np.minimum(sizes, SHINGLE), grams), BASE_B))
    for a, b in zip(of[:-1].tolist(), of[1:].tolist()):
        h[a:b].sort()
    new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
    new[of[:-1][grams > 0]] = True
    at = np.flatnonzero(new)
    return h[at], np.diff(np.r_[at, len(h)]), np.searchsorted(at, of)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and how often each stands there; ``h`` is sorted in place."""
    h.sort()
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[first], np.diff(np.r_[first, len(h)])


def pack_counts(n: np.ndarray) -> bytes:
    """Counts of one and more, a byte each, those of 255 and more in full behind."""
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype("<i8").tobytes()


def unpack_counts(packed: bytes | pa.Buffer, size: int) -> np.ndarray:
    out = np.frombuffer(packed, np.uint8, size).astype(np.int64)
    out[out == 255] = np.frombuffer(packed, "<i8", offset=size)
    return out


_SENT = "bucket int, range int, shingles binary, n binary"
_ANSWER = "bucket int, range int, at binary, n binary, shingles binary"


def _in_ranges(h: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins among sorted shingles (ranges + 1 values)."""
    return np.searchsorted((h >> U64(32)) * U64(ranges) >> U64(32), np.arange(ranges + 1, dtype=U64))


def _distinct_of(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts of a bucket, sorted, and how many of the texts hold each."""
    parts = []
    for chunk in texts.chunks:
        for begin, end in slices(chunk):
            parts.append(shingles(chunk.slice(begin, end - begin))[0])
    return _distinct(np.concatenate([np.zeros(0, U64), *parts]))


def _by_range(ranges: int):
    def run(rows: pa.Table) -> pa.Table:
        h, n = _distinct_of(rows.column("text"))
        at = _in_ranges(h, ranges)
        full = np.flatnonzero(at[:-1] < at[1:])
        parts = [slice(at[r], at[r + 1]) for r in full]
        return pa.table(
            {
                "bucket": pa.array([rows.column("bucket")[0].as_py()] * len(full), pa.int32()), "range": pa.array(full, pa.int32()),
                "shingles": pa.array([h[x].tobytes() for x in parts], pa.binary()), "n": pa.array([pack_counts(n[x]) for x in parts], pa.binary()),
            }
        )

    return run


def _places(among: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``h`` stand in ``among`` (sorted), and where there."""
    at = np.searchsorted(among, h)
    here = np.flatnonzero(among[np.minimum(at, len(among) - 1)] == h) if len(among) else np.zeros(0, np.int64)
    return here, at[here]


def summed(parts: list[tuple[np.ndarray, pa.Buffer]]) -> tuple[np.ndarray, np.ndarray]:
    """The values, sorted, whose counts add up to more than one, and these sums.

    A part has distinct sorted values and their packed counts. Most values stand once: counts are unpacked
    for a part at a time, and summed for those alone that repeat, so scratch is about one more copy of the values.
    """
    h = np.concatenate([np.zeros(0, U64), *(own for own, _ in parts)])
    h.sort()
    again = h[1:][h[1:] == h[:-1]]
    del h
    often = (own[np.frombuffer(n, np.uint8, len(own)) > 1] for own, n in parts if len(own))
    h = _distinct(np.concatenate([again, *often]))[0]
    sums = np.zeros(len(h), np.int64)
    for own, n in parts:
        here, at = _places(h, own)
        sums[at] += unpack_counts(n, len(own))[here]
    return h, sums


def _repeated(full: bool):
    """For each bucket, which of its shingles of a range stand in more than one document, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            # Views of the batch: what a range holds is there once.
            for bucket, r, h, n in zip(*batch.columns):
                held.setdefault(r.as_py(), []).append((bucket.as_py(), np.frombuffer(h.as_buffer(), U64), n.as_buffer()))
        while held:
            r, parts = held.popitem()
            h, n = summed([x[1:] for x in parts])
            out = []
            for bucket, own, _ in parts:
                here, at = _places(h, own)
                if len(here):
                    out.append((bucket, r, here.astype("<u4").tobytes(), pack_counts(n[at]), own[here].tobytes() if full else None))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["bucket", "range", "at", "n", "shingles"])

    return run


def _ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def frequencies(dealt: DataFrame, full: bool = False) -> DataFrame:
    """(bucket, range, at, n): places, among a bucket's distinct shingles of a hash range, of those that
    stand in more than one document, and in how many. ``full`` adds the shingles themselves."""
    ranges = _ranges(dealt)
    sent = dealt.groupBy("bucket").applyInArrow(_by_range(ranges), _SENT)
    # One range for each task; by a hash of it, some tasks would hold several.
    return sent.repartitionById(ranges, "range").mapInArrow(_repeated(full), _ANSWER)


def idf(n: np.ndarray, total: int) -> np.ndarray:
    return 1 + np.log((1 + total) / (1 + n.astype(np.float64)))


@dataclass(frozen=True)
class Weights:
    """All inverse document frequencies in one place, for small tables: one for shingles of a single document."""

    common: float
    shingle: np.ndarray  # sorted
    idf: np.ndarray


def fit_weights(docs: DataFrame) -> Weights:
    rows = frequencies(_dealt(_keyed(docs)), full=True).select("shingles", "n").collect()
    total = docs.count()
    h = np.concatenate([np.zeros(0, U64), *(np.frombuffer(r["shingles"], U64) for r in rows)])
    n = np.concatenate([np.zeros(0, np.int64), *(unpack_counts(r["n"], len(r["shingles"]) // 8) for r in rows)])
    h, first = np.unique(h, return_index=True)
    return Weights(float(idf(np.ones(1), total)[0]), h, idf(n[first], total))


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2: where 1 - (1 + x) * exp(-x) is p."""
    p = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 60.0)
    for _ in range(60):
        x = (low + high) / 2
        under = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(under, x, low), np.where(under, high, x)
    return x


_GAMMA = _gamma_quantiles()
_R, _LOG_C = _GAMMA.astype(np.float32), np.log(_GAMMA).astype(np.float32)
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=U64) * U64(BASE_A))


def samples(h: np.ndarray, weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Consistent weighted samples, (texts, BANDS * ROWS); texts without shingles have zeros."""
    out = np.zeros((len(offsets) - 1, len(_SEEDS)), U64)
    full = np.flatnonzero(offsets[:-1] < offsets[1:])
    if not len(full):
        return out
    first, sizes = offsets[:-1][full], np.diff(offsets)[full]
    log_w = np.log(weight).astype(np.float32)
    for k, seed in enumerate(_SEEDS):
        z = (h ^ seed) * U64(0xD6E8FEB86659FD93)
        z ^= z >> U64(32)
        z *= U64(0xD6E8FEB86659FD93)
        r = _R[(z >> U64(48)).astype(np.int64)]
        beta = ((z & U64(0xFFFF)).astype(np.float32) + np.float32(0.5)) / np.float32(65536)
        t = np.floor(log_w / r + beta)
        a = _LOG_C[((z >> U64(32)) & U64(0xFFFF)).astype(np.int64)] - r * (t - beta) - r
        least = np.minimum.reduceat(a, first)
        at = np.flatnonzero(a == np.repeat(least, sizes))
        at = at[np.searchsorted(at, first)]
        out[full, k] = mix(h[at] ^ (t[at].astype(np.int64).view(U64) * U64(BASE_B)) ^ seed)
    return out


_SKETCHED = (
    "digest binary, doc_id long, copies long, bands array<long>, finer array<long>, samples binary, df binary, weight double, prefix array<long>, rest array<double>"
)
_LONGS = pa.list_(pa.int64())
_SKETCH_SCHEMA = pa.schema(
    [("digest", pa.binary()), ("doc_id", pa.int64()), ("copies", pa.int64()), ("bands", _LONGS), ("finer", _LONGS), ("samples", pa.binary()), ("df", pa.binary())]
    + [("weight", pa.float64()), ("prefix", _LONGS), ("rest", pa.list_(pa.float64()))]
)


def prefix(h: np.ndarray, weight: np.ndarray, df: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of a text, of which each text as near as ``least`` has one among its own rarest,
    and for each the weight from it on."""
    order = np.lexsort((h, df))
    whole = weight.sum()
    before = np.cumsum(weight[order]) - weight[order]
    first = (before <= (1 - least + 1e-6) * whole) & (df[order] > 1)
    return h[order[first]], whole - before[first]


def sketches(dealt: DataFrame, chosen: DataFrame, total: int, least: float = SIMILARITY) -> DataFrame:
    """digest, doc_id, copies, bands and finer bands (64-bit keys), and the samples in 32 bits each.

    One row for each text with words, from the document that ``chosen`` (bucket, digest, doc_id,
    copies) names. Also ``df``, the document frequencies of the text's distinct shingles, in the order
    of ``shingles``, and the text's ``prefix``.
    """
    ranges = _ranges(dealt)

    def run(told: pa.Table, rows: pa.Table) -> pa.Table:
        known, _ = _distinct_of(rows.column("text"))
        begin_of, often = _in_ranges(known, ranges), np.ones(len(known), np.int64)
        copies_of = {}
        for r, at, n, digest, copies in zip(*(told.column(c).to_pylist() for c in ("range", "at", "n", "digest", "copies"))):
            if digest is not None:
                copies_of[digest] = copies
            else:
                place = np.frombuffer(at, "<u4")
                often[begin_of[r] + place] = unpack_counts(n, len(place))
        # Of rows alike in id and text one is enough.
        speaks = [copies_of.pop(d, None) for d in rows.column("digest").to_pylist()]
        mine = np.array([c is not None for c in speaks], bool)
        rows = rows.filter(pa.array(mine)).append_column("copies", pa.array([c for c in speaks if c is not None], pa.int64()))
        out = [pa.RecordBatch.from_pylist([], _SKETCH_SCHEMA)]
        for batch in rows.combine_chunks().to_batches():
            texts = column(batch, "text")
            for begin, end in slices(texts):
                h, tf, offsets = shingles(texts.slice(begin, end - begin))
                df = often[np.searchsorted(known, h)] if len(known) else np.ones(len(h), np.int64)
                weight = tf * idf(df, total)
                got = samples(h, weight, offsets)
                by_band = got.reshape(len(got), BANDS, ROWS)
                bands = np.zeros((len(got), BANDS), U64)
                for k in range(ROWS):
                    bands = mix(bands ^ by_band[:, :, k])
                finer = mix(bands ^ mix(np.roll(by_band[:, :, 0], 1, axis=1) ^ mix(np.roll(by_band[:, :, 0], 2, axis=1))))
                full = np.flatnonzero(np.diff(offsets) > 0)
                part = batch.slice(begin, end - begin).take(pa.array(full))
                lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x[full].view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
                spans = [slice(offsets[i], offsets[i + 1]) for i in full]
                rare = [prefix(h[x], weight[x], df[x], least) for x in spans]
                small = (got[full] & U64(0xFFFFFFFF)).astype("<u4")
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            column(part, "digest"), column(part, "doc_id"), column(part, "copies"), lists(bands), lists(finer),
                            pa.array([x.tobytes() for x in small], pa.binary()), pa.array([pack_counts(df[x]) for x in spans], pa.binary()),
                            pa.array([weight[x].sum() for x in spans], pa.float64()), pa.array([r[0].view(np.int64) for r in rare], _LONGS), pa.array([r[1] for r in rare], pa.list_(pa.float64())),
                        ],
                        schema=_SKETCH_SCHEMA,
                    )
                )
        return pa.Table.from_batches(out)

    answers = frequencies(dealt).select("bucket", "range", "at", "n", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("copies"))
    nothing = F.lit(None).cast("binary")
    told = answers.union(chosen.select("bucket", F.lit(None).cast("int"), nothing, nothing, "digest", "copies"))
    return told.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(run, _SKETCHED)


def candidates(distinct: DataFrame) -> DataFrame:
    """(a, b, agreement): texts and first texts of their buckets, once per pair."""
    bucketed = distinct.select("digest", "copies", F.posexplode("bands").alias("band", "key")).unionByName(
        distinct.select("digest", "copies", F.posexplode("finer").alias("band", "key")).withColumn("band", F.col("band") + BANDS)
    )
    sizes = bucketed.groupBy("band", "key").agg(F.sum("copies").alias("n"), F.count("*").alias("texts")).where("texts > 1").drop("texts")
    bucketed = bucketed.join(sizes, ["band", "key"])
    # The text most others are near has the fullest buckets; it is drawn first wherever it is.
    fullness = bucketed.groupBy("digest").agg(F.sum("n").alias("fullness"))
    bucketed = bucketed.join(fullness, "digest").select("digest", "band", "key", "fullness")
    draws = [F.struct(-F.col("fullness"), F.xxhash64("digest"), "digest")] + [F.struct(F.lit(0).cast("long"), F.xxhash64("digest", "band", F.lit(i)), "digest") for i in range(RANDOM_FIRSTS)]
    firsts = bucketed.groupBy("band", "key").agg(F.array(*[F.min(d).getField("digest") for d in draws]).alias("firsts"))
    bucketed = bucketed.join(firsts, ["band", "key"]).select("digest", F.explode("firsts").alias("b"))
    pairs = bucketed.where("digest <> b").select(F.greatest("digest", "b").alias("a"), F.least("digest", "b").alias("b")).distinct()
    return agreeing(pairs, distinct, LEAST_AGREEMENT)


def agreeing(pairs: DataFrame, distinct: DataFrame, least: float) -> DataFrame:
    """(a, b, agreement) of the pairs whose sketches agree in ``least`` of the samples."""
    side = lambda name: distinct.select(F.col("digest").alias(name), F.col("samples").alias(f"samples_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def agree(batch: pa.RecordBatch):
        a, b = (np.frombuffer(b"".join(column(batch, c).to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in ("samples_a", "samples_b"))
        yield pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b"), pa.array((a == b).mean(axis=1))], ["a", "b", "agreement"])

    return both.select("a", "b", "samples_a", "samples_b").mapInArrow(map_rows(agree), "a binary, b binary, agreement double").where(F.col("agreement") >= least)


def missed(distinct: DataFrame, roots: DataFrame, least: float = SIMILARITY, files: int | None = None) -> DataFrame:
    """(a, b, agreement): texts of different components that may be as near as ``least`` by the weights
    that their shared rare shingles leave."""
    near = distinct.select("digest", "weight", F.explode(F.arrays_zip("prefix", "rest")).alias("p"))
    # Texts whose weights differ by ``least`` at most are in the same level or in neighbouring ones.
    level = F.floor(F.log("weight") / F.log(F.lit(1 / least))).cast("int")
    rare = _rooted(near.select("digest", "weight", level.alias("level"), F.col("p.prefix").alias("shingle"), F.col("p.rest").alias("rest")), roots, "digest")
    # Members of a shingle by component: one alone has no pairs to add.
    mixed = rare.groupBy("shingle").agg(F.min("root_digest").alias("low"), F.max("root_digest").alias("high")).where("low <> high").select("shingle")
    rare = settle(rare.join(mixed, "shingle"), "dedup-rare", files)
    # The largest component of a shingle is only one side of its pairs.
    main = rare.groupBy("shingle", "root_digest").agg(F.count("*").alias("n")).groupBy("shingle").agg(F.max(F.struct("n", "root_digest")).getField("root_digest").alias("main"))
    small = rare.join(main, "shingle").where("root_digest <> main").select(
        "shingle", F.explode(F.array(*[F.col("level") + i for i in (-1, 0, 1)])).alias("level"),
        F.col("digest").alias("x"), F.col("root_digest").alias("root_x"), F.col("weight").alias("weight_x"), F.col("rest").alias("rest_x"),
    )
    sure = 1 - 1e-6  # for rounding
    enough = F.least("rest", "rest_x") >= (F.col("weight") + F.col("weight_x")) * (least / (1 + least) * sure)
    alike = F.least("weight", "weight_x") >= F.greatest("weight", "weight_x") * (least * sure)
    met = rare.join(small, ["shingle", "level"]).where((F.col("root_digest") != F.col("root_x")) & alike & enough)
    pairs = met.select(F.greatest("digest", "x").alias("a"), F.least("digest", "x").alias("b")).distinct()
    return agreeing(pairs, distinct, LEAST_SURE)


def _rooted(rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """``rows`` with the component of the text in column ``name``; a text without links is its own."""
    held = roots.select(F.col("node").alias(name), F.col("root").alias("__root"))
    return rows.join(held, name, "left").withColumn(f"root_{name}", F.coalesce("__root", name)).drop("__root")


def similarity(pairs: DataFrame, total: int) -> DataFrame:
    """Exact weighted Jaccard similarity of (a, text_a, df_a, b, text_b, df_b)."""

    def run(batch: pa.RecordBatch):
        texts = [column(batch, c) for c in ("text_a", "text_b")]
        for begin in range(0, batch.num_rows, 128):
            part = batch.slice(begin, 128)
            (ha, ca, oa), (hb, cb, ob) = (shingles(t.slice(begin, part.num_rows)) for t in texts)
            wa, wb = (
                idf(np.concatenate([unpack_counts(p, n) for p, n in zip(column(part, c).to_pylist(), np.diff(o).tolist())]), total)
                for c, o in (("df_a", oa), ("df_b", ob))
            )
            out = []
            for i in range(part.num_rows):
                x, y = slice(oa[i], oa[i + 1]), slice(ob[i], ob[i + 1])
                _, p, q = np.intersect1d(ha[x], hb[y], assume_unique=True, return_indices=True)
                shared = float((wa[x][p] * np.minimum(ca[x][p], cb[y][q])).sum())
                whole = float((wa[x] * ca[x]).sum() + (wb[y] * cb[y]).sum()) - shared
                out.append(shared / whole if whole else 0.0)
            yield pa.RecordBatch.from_arrays([column(part, "a"), column(part, "b"), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b", "df_a", "df_b").mapInArrow(map_rows(run), "a binary, b binary, similarity double")


def links(pairs: DataFrame, texts: DataFrame, total: int, least: float) -> DataFrame:
    side = lambda name: texts.select(F.col("digest").alias(name), F.col("text").alias(f"text_{name}"), F.col("df").alias(f"df_{name}"))
    fetched = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    # The exact similarity may come out a rounding error below.
    return similarity(fetched, total).where(F.col("similarity") >= least - 1e-9).select("a", "b").distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that no links connect, with their components."""
    return _rooted(_rooted(pairs, roots, "a"), roots, "b").where("root_a <> root_b")


def _likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows whose digest is in ``wanted``, and few others: a bit a digest, sent to the rows.

    The bits are bounded; with more digests than they hold apart, more other rows stay.
    """
    size = min(max(BITS_EACH * wanted.count(), 1 << 15), MOST_BITS)
    place = F.pmod(F.xxhash64("digest"), F.lit(size)) + 1
    filled = wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("__part"))
    filled = filled.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bits"))
    placed = rows.withColumns({"__part": F.bitmap_bucket_number(place), "__bit": F.bitmap_bit_position(place)})
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    held = byte.bitwiseAND(F.expr("shiftleft(1, cast(__bit % 8 as int))")) != 0
    return placed.join(F.broadcast(filled), "__part").where(held).select(*rows.columns)


def _texts(pairs: DataFrame, keyed: DataFrame, distinct: DataFrame, files: int | None = None) -> DataFrame:
    """The texts of ``pairs`` and their frequencies. Joined on the id as well, so that copies spread.

    Texts that nobody asks for are left out before the join, which shuffles the others.
    """
    ends = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    wanted = settle(distinct.select("digest", F.col("doc_id").alias("__id"), "df").join(ends, "digest", "left_semi"), "dedup-ends", files)
    keyed = _likely(keyed, wanted)
    same = (keyed["digest"] == wanted["digest"]) & keyed["doc_id"].eqNullSafe(wanted["__id"])
    return keyed.join(wanted, same).select(keyed["digest"], "text", "df")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("digest", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("digest", "doc_id"), F.lit(buckets)).cast("int")


def _buckets(keyed: DataFrame) -> int:
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // BUCKET_BYTES))


def _files(df: DataFrame, buckets: int) -> int:
    """Most files of a table between two jobs: one for a bucket's worth of text, or for each core if that is more.

    So they follow the texts, not the number of shuffle partitions, of which each would write its own few rows.
    """
    return max(buckets, df.sparkSession.sparkContext.defaultParallelism)


def _dealt(keyed: DataFrame, buckets: int | None = None) -> DataFrame:
    """Digest, id and text, in buckets; shuffled once, as all that uses it takes all its columns."""
    rows = keyed.select("digest", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(_bucket(buckets or _buckets(keyed)).alias("bucket"), "*").repartition("bucket")


def text_classes(keyed: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per distinct text with words (digest), with its class.

    Also its smallest doc_id, its number of links, the class's smallest doc_id and size, and the
    digest of the text that speaks for the class: the one of that smallest doc_id.
    """
    keyed = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "digest")
    buckets = _buckets(keyed)
    files = _files(keyed, buckets)
    copies = settle(keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), "dedup-copies", files)
    total = copies.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    chosen = copies.select(_bucket(buckets).alias("bucket"), "digest", "copies")
    distinct = settle(sketches(_dealt(keyed, buckets), chosen, total, least), "dedup-sketches")
    pairs = settle(candidates(distinct), "dedup-pairs", files)
    texts = settle(_texts(pairs, keyed, distinct, files), "dedup-texts", files)
    # Each text's best candidate first: most classes are whole after that.
    best = pairs.select("a", "b", "agreement", F.col("a").alias("x")).union(pairs.select("a", "b", "agreement", "b"))
    best = best.groupBy("x").agg(F.max_by(F.struct("a", "b"), F.struct("agreement", "b", "a")).alias("p")).select("p.a", "p.b").distinct()
    found = settle(links(best, texts, total, least), "dedup-links", files)
    roots = components(found)
    open_ = _apart(pairs.join(best, ["a", "b"], "left_anti"), roots).select("a", "b")
    found = settle(found.union(links(open_, texts, total, least)), "dedup-links", files)
    roots = components(found)
    rest = settle(missed(distinct, roots, least, files), "dedup-missed", files)
    if not rest.isEmpty():
        texts = settle(_texts(rest, keyed, distinct, files), "dedup-texts", files)
        best = _apart(rest, roots).groupBy(F.least("root_a", "root_b").alias("x"), F.greatest("root_a", "root_b").alias("y"))
        best = settle(best.agg(F.max(F.struct("agreement", "a", "b")).alias("p")).select("p.a", "p.b"), "dedup-best", files)
        found = settle(found.union(links(best, texts, total, least)), "dedup-links", files)
        open_ = _apart(rest.join(best, ["a", "b"], "left_anti"), components(found)).select("a", "b")
        found = settle(found.union(links(open_, texts, total, least)), "dedup-links", files)
        roots = components(found)
    degree = found.select(F.col("a").alias("digest")).union(found.select("b")).groupBy("digest").agg(F.count("*").alias("n_links"))
    named = distinct.select("digest", "doc_id", "copies").join(roots.withColumnRenamed("node", "digest"), "digest", "left").withColumn("class_key", F.coalesce("root", "digest"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    sizes = named.groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"), F.min(first).getField("digest").alias("speaker"))
    return settle(
        named.join(sizes, "class_key").join(degree, "digest", "left").select("digest", "doc_id", "class_id", F.hex("class_key").alias("class_key"), "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"), "speaker"),
        "dedup-classes",
        files,
    )


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (the class's smallest doc_id), class_key, class_size, n_links.

    ``class_key`` identifies the class (null for texts without words); ``n_links`` counts the verified
    links of the document's text to different texts.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    rows = keyed.select("doc_id", "digest").join(text_classes(keyed, least).drop("doc_id", "speaker"), "digest", "left")
    return rows.select(
        "doc_id",
        F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def representatives(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that speak for their classes, one each; texts without words all stay."""
    columns, keyed = docs.columns, _keyed(docs)
    told = text_classes(keyed, least)
    speaking = told.where("digest = speaker").select("digest", F.col("doc_id").alias("__id"))
    # Joined on the id as well, so that the copies of a hot text spread over tasks.
    chosen = keyed.join(speaking, (keyed["digest"] == speaking["digest"]) & keyed["doc_id"].eqNullSafe(speaking["__id"]), "left_semi").dropDuplicates(["digest"])
    wordless = keyed.where(F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*$"))
    return chosen.select(*columns).unionByName(wordless.select(*columns))


@register("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
