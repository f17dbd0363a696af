"""Mixture-controlled packing: deficit round-robin over source queues.

1. Tokenize, and number every document's ids within the queue of its (task, source).
2. Sum those per task and source; a running sum over tasks gives every document its place in the
   queue of its source. Only these sums meet in one place, never documents.
3. The corpus is packed as ``segments`` of about ``segment_tokens`` ids. Segment ``l`` of ``L``
   takes from every queue of ``T`` ids those from ``floor(T*l/L)`` up to ``floor(T*(l+1)/L)``: each
   segment has the target mixture, a hot source is spread over all of them, and what rounding keeps
   back from a source (``frac(T*l/L)``) is its deficit, carried into the next segment.
4. Within a segment a window of ``width`` ids gives every source its quantum, the source's share of
   the segment times ``width``, plus its deficit; whole ids are taken from the head of its queue
   and the rest is carried to the next window. Ids left over by rounding go one by one to the
   sources with the largest deficits. Documents are cut wherever a quantum ends.
5. A segment's last ids, fewer than ``width``, become sequences whose lengths are powers of two,
   so nothing is padded.

Null text is empty and, like an empty one, has the end id alone. A null source shares the queue of
the empty one. Empty tables give no rows; repeated rows are packed as often as they come; columns
other than doc_id, text and source are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import BLANK, column, slices, utf8
from tidemark.llm.registry import register, table
from tidemark.llm.stretches import Known, bounds
from tidemark.session import scratch_path, settle

WIDTH, END_ID = 2048, 1
SEGMENT_TOKENS = 1 << 20
_LOWER = np.array([*range(65), *range(97, 123), *range(91, 256)], np.uint8)  # of ASCII bytes
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != ord("'")]] = True


class WordTokenizer:
    """Ids of whole texts, by words.

    The tokenizer lowers case, drops white space and joins nothing across it, nor across the place
    where an ASCII letter meets an ASCII mark other than the apostrophe. So a text's ids are those of
    the stretches in between, one after another. Recent stretches are remembered. A text that may
    spell a special token is left as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.known = Known(self._ids, "<u2")

    def _ids(self, words: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in got]

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the n + 1 places where each text's begin."""
        if not len(data):
            return np.zeros(0, "<u2"), np.zeros(len(offsets), np.int64)
        lower, ink = _LOWER[data], ~BLANK[data]
        begins = np.zeros(len(data), bool)  # where a stretch begins if there is ink
        begins[1:] = ~ink[:-1] | (lower[:-1] - np.uint8(97) < 26) & _MARK[data[1:]]
        special = np.searchsorted(offsets, np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)), "right") - 1
        for a, b in {(int(offsets[i]), int(offsets[i + 1])) for i in np.unique(special)}:
            lower[a:b] = data[a:b]
            begins[a + 1 : b] = ~ink[a : b - 1]
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        ends = np.append(begins[1:] | ~ink[1:], True)
        starts = np.flatnonzero(begins & ink)
        ids, counts = self.known.ids(lower, starts, np.flatnonzero(ends & ink) + 1)
        return ids, bounds(counts)[np.searchsorted(starts, offsets)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        ids, at = self.encode_all(np.frombuffer(b"".join(texts), np.uint8), bounds(np.array([len(t) for t in texts], np.int64)))
        return [ids[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the tokenizer's only one
    return WordTokenizer(path)


def queued(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Ids of every document, with its place among those of its source in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, task, ends = tokenizer(tokenizer_path), TaskContext.get().partitionId(), {}
        tail = np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            texts, sources, keys = column(batch, "text"), column(batch, "source").to_pylist(), column(batch, "doc_id")
            for begin, end in slices(texts):
                found, at = t.encode_all(*utf8(texts.slice(begin, end - begin)))
                packed, at = found.tobytes(), (at * 2).tolist()
                ids = [packed[a:b] + tail for a, b in zip(at, at[1:])]
                starts = []
                for source, packed in zip(sources[begin:end], ids):
                    starts.append(ends.get(source, 0))
                    ends[source] = starts[-1] + len(packed) // 2
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(begin, end - begin),
                        pa.array(sources[begin:end], pa.string()),
                        pa.array([task] * (end - begin), pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(i) // 2 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "task", "start", "n", "ids"],
                )

    docs = docs.select("doc_id", "text", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    return docs.mapInArrow(run, "doc_id long, source string, task int, start long, n long, ids binary")


def allot(shares: np.ndarray, carried: np.ndarray, width: int) -> np.ndarray:
    """Ids of each source in each full window, (windows, sources): deficit round-robin.

    ``shares`` are the ids that each source has, ``carried`` its deficit from before, below one.
    """
    total = int(shares.sum())
    windows = total // width
    out = np.zeros((windows, len(shares)), np.int64)
    quantum, deficit, left = shares * (width / max(total, 1)), carried.astype(np.float64), shares.copy()
    for w in range(windows):
        deficit = deficit + quantum
        take = np.minimum(np.maximum(np.floor(deficit), 0).astype(np.int64), left)
        room = width - int(take.sum())
        if room < 0:  # carried deficits may ask for a few ids too many: the smallest claims wait
            for i in np.lexsort((np.arange(len(take)), deficit - take)):
                back = min(int(take[i]), -room)
                take[i] -= back
                room += back
                if room == 0:
                    break
        while room > 0:  # round-robin in order of deficit
            open_ = np.flatnonzero(left > take)
            order = open_[np.lexsort((open_, -(deficit - take)[open_]))][:room]
            take[order] += 1
            room -= len(order)
        out[w], deficit, left = take, deficit - take, left - take
    return out


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_segment(rows: pd.DataFrame, width: int = WIDTH) -> pd.DataFrame:
    """Cut and place the stretches of one segment.

    ``rows``: segment, doc_id, source, place (in the queue), start (in the document), doc_tokens,
    ids, carried.
    """
    rows = rows.sort_values(["source", "place"], kind="stable")
    lengths = rows["ids"].map(len).to_numpy(np.int64) // 2
    _, first, of = np.unique(rows["source"].to_numpy(object).astype(str), return_index=True, return_inverse=True)
    shares = np.bincount(of, weights=lengths, minlength=len(first)).astype(np.int64)
    windows = allot(shares, rows["carried"].to_numpy(np.float64)[first], width)
    rest = shares - windows.sum(axis=0)
    # The tail's sequences take what is left of every queue, one queue after another.
    tail = powers_of_two(int(rest.sum()))
    sizes = [width] * len(windows) + tail
    # Where each source's runs end, in the order in which the sequences take them.
    cuts = np.concatenate([windows.ravel(), rest])
    source_of = np.concatenate([np.tile(np.arange(len(shares)), len(windows)), np.arange(len(shares))])
    used = cuts > 0
    cuts, source_of = cuts[used], source_of[used]
    queue_start = np.zeros(len(shares), np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])  # of the rows, sources one after another
    queue_start[:] = bounds[first]
    sequence_ends = np.cumsum(sizes)
    out: list[tuple] = []
    row_at, row_used = first.copy(), np.zeros(len(shares), np.int64)
    docs, starts, totals, ids = (rows[c].to_numpy() for c in ("doc_id", "start", "doc_tokens", "ids"))
    segment, at, sequence = int(rows["segment"].iloc[0]), 0, 0
    for count, s in zip(cuts.tolist(), source_of.tolist()):
        while count:
            r, skip = row_at[s], int(row_used[s])
            take = min(count, int(lengths[r]) - skip, int(sequence_ends[sequence]) - at)
            piece = np.frombuffer(ids[r], "<u2", take, skip * 2).astype("<u4")
            begin = int(sequence_ends[sequence]) - sizes[sequence]
            out.append((docs[r], int(starts[r]) + skip, take, zlib.crc32(piece.tobytes()), totals[r], (segment << 24) + sequence, at - begin))
            count -= take
            at += take
            if skip + take == lengths[r]:
                row_at[s] += 1
                row_used[s] = 0
            else:
                row_used[s] += take
            if at == sequence_ends[sequence]:
                sequence += 1
    got = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    got["doc_id"] = got["doc_id"].astype("Int64")
    return got


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, width: int = WIDTH, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Pieces of all documents, with the sequence and offset where each stands."""
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-ids")
    queued(docs, tokenizer_path).write.parquet(path)
    rows = spark.read.parquet(path)
    sums = rows.groupBy("source", "task").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("source")
    # Written first: Spark then knows its size, and need not shuffle the ids to join it if it is small.
    sums = settle(
        sums.select("source", "task", (F.sum("n").over(by.orderBy("task")) - F.col("n")).alias("before"), F.sum("n").over(by).alias("total")), "packing-sums"
    )
    everything = rows.agg(F.sum("n")).first()[0] or 0
    segments = max(1, -(-everything // segment_tokens))
    wide = "decimal(38,0)"
    placed = rows.join(sums, ["source", "task"]).withColumn("place", F.col("before") + F.col("start"))
    # Segment l begins at floor(total * l / segments); exact, as the products may pass 64 bits.
    of = lambda p: F.expr(f"cast((cast(({p}) + 1 as {wide}) * {segments} - 1) div total as bigint)")
    edge = lambda l: F.expr(f"cast((cast(({l}) as {wide}) * total) div {segments} as bigint)")
    placed = placed.withColumn("segment", F.explode(F.sequence(of("place"), of("place + n - 1"))))
    begin = F.greatest("place", edge("segment"))
    end = F.least(F.col("place") + F.col("n"), edge("segment + 1"))
    cut = placed.select(
        "segment",
        "doc_id",
        "source",
        begin.alias("place"),
        (begin - F.col("place")).alias("start"),
        F.col("n").alias("doc_tokens"),
        F.substring("ids", ((begin - F.col("place")) * 2 + 1).cast("int"), ((end - begin) * 2).cast("int")).alias("ids"),
        F.expr(f"cast((cast(segment as {wide}) * total) % {segments} as double) / {segments}").alias("carried"),
    )
    return cut.groupBy("segment").applyInPandas(lambda part: pack_segment(part, width), PACKED)


@register("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
