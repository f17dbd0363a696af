r"""Substring dedup: recurring passages are confirmed, then located by Aho-Corasick automata.

Words are runs of anything but ``[\x20\x09-\x0D]``; a window is ``WINDOW`` consecutive words. Every
word covered by a window that starts more than once in the corpus is removed, first copy included.

1. *Anchors.* Each window has an anchor, the smallest hash among its runs of ``ANCHOR`` words. Equal
   windows have equal anchors, and a text has about one anchor in fourteen words, so anchors are cheap
   to count. Windows whose anchor stands once in the corpus are unique and need no further look.
2. *Exact copies* of a text are counted by digest; one of them speaks for all, with weight two.
3. *Confirmation.* Windows under a recurring anchor are counted by a 96-bit hash. Those counted
   twice or more are the recurring passages; their places go back to their documents.
4. *Location.* Documents are dealt out by a hash of the row. For each slice of a task's documents an
   automaton over word numbers is compiled from the passages confirmed there (cut into windows, so
   that a passage serves any text that shares a part of it), and all documents of the slice stream
   through it. What it finds is removed.

The texts are shuffled once, for steps 3 and 4 together. Hot passages meet only as hashes: exact
copies and a text's own repeats are summed before the shuffle.

Null text has no words. Empty tables give no rows; repeated rows are copies of each other; other
columns pass through, those named like added ones are replaced.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tidemark.llm.arrays import BASE_A, BASE_B, column, gram_hashes, map_rows, slices, utf8, word_hashes, words
from tidemark.llm.registry import register, table
from tidemark.session import settle

WINDOW, ANCHOR = 35, 8
_KEY, _ANSWERS = "__row", ("places", "more", "copied")


def anchor_runs(w: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one text's word hashes: each anchor's hash, the first window it leads, and how many."""
    windows = len(w) - size + 1
    if windows < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, reach = gram_hashes(w, anchor), size - anchor + 1
    at = np.empty(windows, np.int64)
    for begin in range(0, windows, 1 << 15):
        end = min(begin + (1 << 15), windows)
        at[begin:end] = np.lib.stride_tricks.sliding_window_view(grams[begin : end + reach - 1], reach).argmin(axis=1) + np.arange(begin, end)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return grams[at[first]], first, np.diff(np.r_[first, windows])


def _merged(first: np.ndarray, led: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs in order of place, with those that touch made one."""
    if not len(first):
        return first, led
    new = np.flatnonzero(np.r_[True, first[1:] != first[:-1] + led[:-1]])
    end = first + led
    return first[new], end[np.r_[new[1:] - 1, len(first) - 1]] - first[new]


def _split_runs(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors with their runs packed as ``first << 16 | led``, and packed runs that need no other text.

    An anchor that stands twice in the text recurs already: its runs are merged and set apart, and
    it is told just twice, without a run. So a text that repeats itself stays small.
    """
    hashes, first, led = found
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order] = np.r_[False, same] | np.r_[same, False]
    own = _merged(first[twice], led[twice])
    again = np.repeat(np.unique(hashes[twice]), 2)
    packed = np.concatenate([first[~twice] << 16 | led[~twice], np.zeros(len(again), np.int64)])
    # A merged run may be long; its parts keep to 15 bits.
    parts = -(-own[1] // 0x7FFF)
    begin = np.repeat(own[0], parts) + 0x7FFF * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    length = np.minimum(np.repeat(own[0] + own[1], parts) - begin, 0x7FFF)
    return np.concatenate([hashes[~twice], again]), packed, begin << 16 | length


def anchors(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """Per row: its key, a digest of its text, its number of windows, its anchors with their runs, and own runs."""

    def run(batch: pa.RecordBatch):
        texts = column(batch, "text")
        for begin, end in slices(texts):
            data, offsets = utf8(texts.slice(begin, end - begin))
            starts, ends, bounds = words(data, offsets)
            w = word_hashes(data, starts, ends)
            found = [_split_runs(anchor_runs(w[a:b], size, anchor)) for a, b in zip(bounds[:-1], bounds[1:])]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(f[i]) for f in found]), pa.int32()), pa.array(np.concatenate([f[i] for f in found]).astype(np.int64)))
                for i in range(3)
            ]
            counts = np.maximum(np.diff(bounds) - size + 1, 0)
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c).slice(begin, end - begin) for c in (_KEY, "digest")), pa.array(counts, pa.int32()), *lists],
                [_KEY, "digest", "windows", "anchors", "runs", "own"],
            )

    keyed = docs.select(_KEY, F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    return keyed.mapInArrow(map_rows(run), f"{_KEY} long, digest binary, windows int, anchors array<long>, runs array<long>, own array<long>")


def _spans(runs: list[int]) -> np.ndarray:
    """The windows of all packed runs, in order, each once."""
    if not runs:
        return np.zeros(0, np.int64)
    return np.unique(np.concatenate([np.arange(r >> 16, (r >> 16) + (r & 0xFFFF)) for r in runs]))


def _distinct(one: np.ndarray, two: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """One of each of a text's windows ``at``, how often it stands there, and its other places."""
    order = np.lexsort((at, two[at], one[at]))
    at = at[order]
    new = np.r_[True, (one[at[1:]] != one[at[:-1]]) | (two[at[1:]] != two[at[:-1]])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(at)])
    more: list[bytes | None] = [None] * len(first)
    for i in np.flatnonzero(count > 1):
        more[i] = at[first[i] + 1 : first[i] + count[i]].astype("<i4").tobytes()
    return at[first], count, more


def candidate_windows(rows: DataFrame, size: int) -> DataFrame:
    """(h1, h2, weight, row, place, more): each window under a recurring anchor, once per text."""

    def run(batch: pa.RecordBatch):
        texts, runs, weights, keys = (column(batch, c) for c in ("text", "runs", "weight", _KEY))
        keys, weights = keys.to_numpy(), weights.to_numpy()
        for begin, end in slices(texts):
            data, offsets = utf8(texts.slice(begin, end - begin))
            starts, ends, bounds = words(data, offsets)
            w = word_hashes(data, starts, ends)
            one, two = gram_hashes(w, size, BASE_A), gram_hashes(w, size, BASE_B).astype(np.uint32)
            spans = [_spans(rs) for rs in runs.slice(begin, end - begin).to_pylist()]
            kept = [_distinct(one[b:], two[b:], a) if len(a) else (a, a, []) for a, b in zip(spans, bounds[:-1])]
            place, count = (np.concatenate([k[i] for k in kept]) for i in (0, 1))
            each = [len(k[0]) for k in kept]
            where = place + np.repeat(bounds[:-1], each)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one[where].view(np.int64)),
                    pa.array(two[where].view(np.int32)),
                    pa.array(count * np.repeat(weights[begin:end], each), pa.int32()),
                    pa.array(np.repeat(keys[begin:end], each)),
                    pa.array(place, pa.int32()),
                    pa.array([m for k in kept for m in k[2]], pa.binary()),
                ],
                ["h1", "h2", "weight", _KEY, "place", "more"],
            )

    return rows.mapInArrow(map_rows(run), f"h1 long, h2 int, weight int, {_KEY} long, place int, more binary")


def locate(word: np.ndarray, bounds: np.ndarray, places: list[np.ndarray], size: int) -> np.ndarray:
    """Which words of a slice are covered, by an automaton over the slice's confirmed passages.

    ``word`` numbers the words of all texts, ``bounds`` says where each text begins, ``places`` are
    each text's confirmed windows.
    """
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for begin, at in zip(bounds[:-1].tolist(), places):
        if not len(at):
            continue
        first = at[np.r_[True, np.diff(at) > 1]]
        last = at[np.r_[np.diff(at) > 1, True]]
        for a, b in zip(first.tolist(), last.tolist()):
            # The passage a .. b + size - 1, in windows end to end; the last is flush with its end.
            for i in {*range(a, b + 1, size), b}:
                automaton.add_word(tuple(word[begin + i : begin + i + size].tolist()))
    covered = np.zeros(len(word) + 1, np.int64)
    if len(automaton):
        automaton.make_automaton()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= size:
                ends = np.fromiter((e for e, _ in automaton.iter(tuple(word[a:b].tolist()))), np.int64)
                np.add.at(covered, a + ends - size + 1, 1)
                np.add.at(covered, a + ends + 1, -1)
    return np.cumsum(covered[:-1]) > 0


def strip_passages(rows: DataFrame, size: int, names: tuple[str, str, str]) -> DataFrame:
    """Replace ``places``, ``more`` and ``copied`` by the kept text and the numbers of words and removed words."""

    def run(batch: pa.RecordBatch):
        texts, places, more, copied = (column(batch, c) for c in ("text", *_ANSWERS))
        rest = [n for n in batch.schema.names if n not in (*_ANSWERS, _KEY)]
        for begin, end in slices(texts):
            data, offsets = utf8(texts.slice(begin, end - begin))
            starts, ends, bounds = words(data, offsets)
            n_windows = np.maximum(np.diff(bounds) - size + 1, 0)
            at = [
                np.arange(n) if c else np.sort(np.concatenate([np.array(p or [], np.int64), np.frombuffer(b"".join(m or []), "<i4")]))
                for p, m, c, n in zip(*(x.slice(begin, end - begin).to_pylist() for x in (places, more, copied)), n_windows)
            ]
            gone = np.zeros(len(starts), bool)
            if any(map(len, at)):
                _, number = np.unique(word_hashes(data, starts, ends), return_inverse=True)
                gone = locate(number, bounds, at, size)
            raw, kept, n_gone = data.tobytes(), [], []
            for i in range(end - begin):
                a, b = int(bounds[i]), int(bounds[i + 1])
                n_gone.append(int(gone[a:b].sum()))
                said = raw[offsets[i] : offsets[i + 1]].split()
                if n_gone[-1]:
                    said = [w for w, g in zip(said, gone[a:b].tolist()) if not g]
                kept.append(b" ".join(said).decode())
            part = batch.slice(begin, end - begin)
            yield pa.RecordBatch.from_arrays(
                [*(column(part, n) for n in rest), pa.array(kept, pa.string()), pa.array(np.diff(bounds), pa.int64()), pa.array(n_gone, pa.int64())], [*rest, *names]
            )

    schema = StructType([f for f in rows.schema if f.name not in (*_ANSWERS, _KEY)])
    return rows.mapInArrow(map_rows(run), schema.add(names[0], StringType()).add(names[1], LongType()).add(names[2], LongType()))


def dedup(docs: DataFrame, size: int = WINDOW, anchor: int = ANCHOR, kept: str = "kept_text", n_words: str = "n_words", n_removed: str = "n_removed") -> DataFrame:
    """Append the kept words (joined by one blank), the number of words and of removed ones."""
    docs = docs.drop(kept, n_words, n_removed, *_ANSWERS, _KEY)
    # A key by content: rows alike in id and text share it, and share all answers as well.
    keyed = docs.withColumn(_KEY, F.xxhash64("doc_id", "text"))
    found = settle(anchors(keyed, size, anchor), "substring-anchors").where("windows > 0")
    copies = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(_KEY).alias("speaker")).where("n > 1").select("digest", "speaker")
    roles = found.select(_KEY, "digest").join(copies, "digest").groupBy(_KEY).agg(F.max(F.col("speaker") == F.col(_KEY)).alias("speaks"))
    recurring = found.select(F.explode("anchors").alias("anchor")).groupBy("anchor").count().where("count > 1").select("anchor")
    runs = found.select(_KEY, F.explode(F.arrays_zip(F.col("anchors").alias("anchor"), F.col("runs").alias("run"))).alias("r")).select(_KEY, "r.*").where("run > 0")
    shared = runs.join(recurring, "anchor", "left_semi").select(_KEY, "run")
    wanted = shared.union(found.select(_KEY, F.explode("own"))).groupBy(_KEY).agg(F.collect_set("run").alias("runs"))
    # One of several copies speaks for all of them, with weight two; the others keep silent.
    wanted = wanted.join(roles, _KEY, "left").where(F.coalesce("speaks", F.lit(True))).select(_KEY, "runs", F.when(F.col("speaks"), 2).otherwise(1).alias("weight"))
    dealt = keyed.repartition(_KEY)
    # Both uses of ``dealt`` take all its columns, so that Spark shuffles the texts once.
    windows = candidate_windows(dealt.join(wanted, _KEY), size)
    same = Window.partitionBy("h1", "h2")
    confirmed = windows.withColumn("n", F.sum("weight").over(same)).where("n > 1").groupBy(_KEY).agg(F.collect_set("place").alias("places"), F.collect_set("more").alias("more"))
    silent = roles.where("not speaks").select(_KEY).withColumn("copied", F.lit(True))
    answers = confirmed.join(silent, _KEY, "full_outer")
    rows = dealt.join(answers, _KEY, "left").select(*docs.columns, _KEY, "places", "more", F.coalesce("copied", F.lit(False)).alias("copied"))
    return strip_passages(rows, size, (kept, n_words, n_removed))


@register("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
