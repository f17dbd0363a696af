r"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

Words are runs of anything but ``[\x20\x09-\x0D]``. A run is a stretch of consecutive words with
smallest period ``q`` (words ``q`` apart are identical) and length of at least
``max(LEAST_WORDS, LEAST_EXPONENT * q)`` that no neighbouring word extends keeping that period.

A batch of texts is cut into slices of about a megabyte; each slice gets one suffix array, in which
the suffixes of a text stand together:

1. *Ranks.* Words are numbered (two 64-bit hashes have to agree, else the words themselves are
   compared). Prefix doubling sorts the suffixes; the ranks of each round are kept, as they tell
   whether two stretches of ``2**k`` words are equal.
2. *LCP intervals.* Longest common prefixes of neighbours come from the kept ranks. Each boundary in
   the LCP table parts an interval of depth ``l`` in two; a stack finds the two sides, no nodes are built.
3. *Branching squares.* Each suffix ``i`` of the smaller side is looked up: if ``ISA[i + l]`` or
   ``ISA[i - l]`` lies in the other side, a square of period ``l`` starts there that cannot be
   rotated right. Smaller sides add up to at most ``n log n / 2`` suffixes.
4. *Rotation.* A square is rotated left as far as it goes, by halving steps over the kept ranks; this
   is its run. Of runs with the same stretch the one with the smallest period stays.

Memory grows with the longest text, by about ``4 * log2(longest repeat)`` bytes a word, and each
text is judged within its own task: nothing is shuffled.

Null text has no words. Empty tables give no rows, repeated rows repeat their results, other columns
pass through, and those named like added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.arrays import BASE_A, BASE_B, column, map_rows, range_hashes, slices, utf8, word_hashes, words
from tidemark.llm.registry import register, table

LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Suffixes looked up at a time.
CHUNK = 1 << 20


def number_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word; equal numbers exactly for equal words."""
    one = word_hashes(data, starts, ends)
    _, first, number = np.unique(one, return_index=True, return_inverse=True)
    two = range_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends, BASE_B)
    if (two != two[first[number]]).any():  # two words of one hash
        raw, seen = data.tobytes(), {}
        number = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
    return number


def _groups(key: np.ndarray) -> np.ndarray:
    """For sorted keys, the place at which each one's group begins."""
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return np.repeat(first, np.diff(np.r_[first, len(key)]))


def suffix_ranks(number: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of all texts and the ranks of each doubling round.

    ``text`` says which text (in order) a word belongs to. ``ranks[k][i] == ranks[k][j]`` holds
    exactly if ``2**k`` words at ``i`` and ``j`` lie within one text and are equal, or ``i == j``. Each
    rank table has one entry more, which equals no other; the last one is the inverse array.
    """
    n = len(number)
    key = text * (int(number.max()) + 1 if n else 1) + number
    order = np.argsort(key, kind="stable")
    begin = _groups(key[order])
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = begin
    ranks, k = [rank], 1
    while True:
        size = np.bincount(begin, minlength=n)[begin]
        open_ = np.flatnonzero(size > 1)
        if not len(open_):
            return order, ranks
        at = order[open_]
        then = np.minimum(at + k, n)
        # The rank of what follows within the text; a suffix that ends comes first.
        follows = np.where((at + k < n) & (text[np.minimum(then, n - 1)] == text[at]), ranks[-1][then].astype(np.int64) + 1, 0)
        key = ranks[-1][at].astype(np.int64) * (n + 1) + follows
        sort = np.argsort(key, kind="stable")
        order[open_] = at[sort]
        begin = begin.copy()
        begin[open_] = open_[_groups(key[sort])]
        rank = ranks[-1].copy()
        rank[order[open_]] = begin[open_]
        ranks.append(rank)
        k *= 2


def neighbour_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """``lcp[p]``: equal words at the head of suffixes ``p - 1`` and ``p`` of the array; 0 at both ends."""
    n = len(order)
    lcp = np.zeros(n + 1, np.int64)
    if n < 2:
        return lcp
    a, b = order[:-1], order[1:]
    equal, alive = [], np.arange(n - 1)
    for rank in ranks:
        alive = alive[rank[a[alive]] == rank[b[alive]]]
        equal.append(alive)
    for k, alive in enumerate(equal):
        lcp[alive + 1] = 1 << k
    for k in range(len(ranks) - 2, -1, -1):
        alive = equal[k + 1]
        length = lcp[alive + 1]
        more = alive[ranks[k][a[alive] + length] == ranks[k][b[alive] + length]]
        lcp[more + 1] += 1 << k
    return lcp


def interval_sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each boundary ``p`` with a common prefix: ``p``, its depth, and the interval ``lo .. hi - 1``
    that it parts into ``lo .. p - 1`` and ``p .. hi - 1``. Of equal depths, the first parts first.

    Stretches of boundaries too short to hold ``LEAST_EXPONENT`` suffixes are passed over.
    """
    p = np.flatnonzero(lcp)
    new = np.r_[True, np.diff(p) > 1] if len(p) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    length = np.diff(np.r_[first, len(p)])
    long = length >= LEAST_EXPONENT - 1
    p, first, length = p[np.repeat(long, length)], p[first[long]], length[long]
    if not len(p):
        return p, p, p, p
    # A boundary of depth 0 before each stretch closes the one before.
    heads = np.cumsum(length + 1) - length - 1
    m = len(p) + len(heads)
    inner = np.ones(m + 1, bool)
    inner[heads] = inner[m] = False
    depth, lower, upper = (np.zeros(m + 1, np.int64) for _ in range(3))
    depth[inner], lower[inner], upper[inner] = lcp[p], p, p
    lower[heads] = first - 1
    upper[np.r_[heads[1:], m]] = first + length
    left, right, stack = [0] * (m + 1), [0] * (m + 1), []
    depths = depth.tolist()
    for i, d in enumerate(depths):
        while stack and depths[stack[-1]] > d:
            right[stack.pop()] = i
        left[i] = stack[-1] if stack else 0
        if d:
            stack.append(i)
        else:
            stack = [i]
    inner = np.flatnonzero(inner)
    return p, depth[inner], lower[np.array(left)[inner]], upper[np.array(right)[inner]]


def branching_squares(order: np.ndarray, isa: np.ndarray, text: np.ndarray, bounds: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, period) of the squares that cannot be rotated right, in chunks."""
    p, depth, lo, hi = interval_sides(lcp)
    fits = (np.maximum(p - lo, hi - p) >= LEAST_EXPONENT - 1) & (LEAST_EXPONENT * depth <= np.diff(bounds)[text[order[p]]])
    p, depth, lo, hi = p[fits], depth[fits], lo[fits], hi[fits]
    left_smaller = p - lo <= hi - p
    begin, size = np.where(left_smaller, lo, p), np.minimum(p - lo, hi - p)
    other_lo, other_hi = np.where(left_smaller, p, lo), np.where(left_smaller, hi, p)
    total = np.cumsum(size)
    n = len(order)
    a = 0
    while a < len(p):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + CHUNK, "right")))
        each = size[a:b]
        which = np.repeat(np.arange(a, b), each)
        i = order[np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each) + begin[which]]
        period = depth[which]
        for start, partner in ((i, i + period), (i - period, i - period)):
            inside = (partner >= 0) & (partner < n)
            at = isa[np.where(inside, partner, n)]
            # Intervals hold suffixes of one text only, so a partner found in one is in the same text.
            hit = np.flatnonzero(inside & (at >= other_lo[which]) & (at < other_hi[which]))
            yield start[hit], period[hit]
        a = b


def _equal(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether ``length`` (at least 1) words at ``a`` and at ``b`` are equal; both lie within one text."""
    out = np.zeros(len(a), bool)
    level = np.frexp(length.astype(np.float64))[1] - 1
    for k in np.unique(level):
        if k < len(ranks):
            at = np.flatnonzero(level == k)
            rest = length[at] - (1 << int(k))
            out[at] = (ranks[k][a[at]] == ranks[k][b[at]]) & (ranks[k][a[at] + rest] == ranks[k][b[at] + rest])
    return out


def rotate_left(ranks: list[np.ndarray], start: np.ndarray, period: np.ndarray, first: np.ndarray) -> np.ndarray:
    """By how many words each square can be rotated left; ``first`` is the first word of its text."""
    turned = np.zeros(len(start), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        at = start - turned - (1 << k)
        can = at >= first
        at = np.where(can, at, 0)
        turned += np.where(can & (ranks[k][at] == ranks[k][at + period]), 1 << k, 0)
    return turned


def find_runs(number: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and then period; starts count over all texts.

    ``number`` numbers the words of all texts, ``bounds`` says where each text begins (n + 1 values).
    """
    nothing = np.zeros(0, np.int64)
    if len(number) < LEAST_WORDS:
        return nothing, nothing, nothing
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order, ranks = suffix_ranks(number, text)
    lcp = neighbour_prefixes(order, ranks)
    found = []
    for start, period in branching_squares(order, ranks[-1], text, bounds, lcp):
        first = bounds[text[start]]
        back = (LEAST_EXPONENT - 2) * period
        deep = np.flatnonzero(start - back >= first)
        start, period, first, back = start[deep], period[deep], first[deep], back[deep]
        deep = np.flatnonzero(_equal(ranks, start - back, start - back + period, back))
        start, period, first = start[deep], period[deep], first[deep]
        turned = rotate_left(ranks, start, period, first)
        found.append((start - turned, turned + 2 * period, period))
    if not found:
        return nothing, nothing, nothing
    start, length, period = (np.concatenate(x) for x in zip(*found))
    long = length >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * period)
    start, length, period = start[long], length[long], period[long]
    sort = np.lexsort((period, length, start))
    start, length, period = start[sort], length[sort], period[sort]
    smallest = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])] if len(start) else np.zeros(0, bool)
    start, length, period = start[smallest], length[smallest], period[smallest]
    sort = np.lexsort((period, start))
    return start[sort], length[sort], period[sort]


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def detect(docs: DataFrame, text: str = "text", n_words: str = "n_words", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Append the number of words, the runs by start and period, and the text without repetitions:
    a word goes if any run holds it after that run's first period; kept words are joined by one blank."""
    docs = docs.drop(n_words, runs, collapsed)

    def run(batch: pa.RecordBatch):
        texts = column(batch, text)
        for begin, end in slices(texts):
            part = batch.slice(begin, end - begin)
            data, offsets = utf8(texts.slice(begin, end - begin))
            starts, ends, bounds = words(data, offsets)
            found = find_runs(number_words(data, starts, ends), bounds)
            owner = np.searchsorted(bounds, found[0], "right") - 1
            edges = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edges, found[0] + found[2], 1)
            np.add.at(edges, found[0] + found[1], -1)
            gone = np.cumsum(edges[:-1]) > 0
            shortened = np.zeros(end - begin, bool)
            shortened[owner] = True
            raw, kept = data.tobytes(), []
            for i in range(end - begin):
                said = raw[offsets[i] : offsets[i + 1]].split()
                if shortened[i]:
                    said = [w for w, g in zip(said, gone[bounds[i] : bounds[i + 1]].tolist()) if not g]
                kept.append(b" ".join(said))
            at = np.searchsorted(owner, np.arange(end - begin + 1))
            fields = pa.StructArray.from_arrays(
                [pa.array(found[0] - bounds[owner], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int64())], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), fields), pa.array(kept, pa.binary()).cast(pa.string())],
                [*part.schema.names, n_words, runs, collapsed],
            )

    added = StructType.fromDDL(f"{n_words} long, {runs} {RUNS}").fields
    return docs.mapInArrow(map_rows(run), StructType([*docs.schema.fields, *added, StructField(collapsed, StringType())]))


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by crc32 ``h`` of the id, ends periodically.

    With ``g = h // 10``, word ``i >= a`` of n becomes word ``a + (i - a) % p`` for ``a = g % n`` and
    ``p = 1 + (n - a) // (3 + g % 8)``. Null texts and texts without words stay, and so do rows without an id.
    """
    h = F.expr("crc32(cast(cast(doc_id as string) as binary))")
    said = F.expr("filter(split(text, '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), w -> w != '')")
    # Variables of lambdas, so that each is worked out once a row.
    planted = F.transform(
        F.array(F.struct(said.alias("w"), F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10").alias("g"))),
        lambda r: F.transform(
            F.array(F.struct(r["w"].alias("w"), (r["g"] % F.greatest(F.size(r["w"]), F.lit(1))).cast("int").alias("a"), (F.lit(3) + r["g"] % 8).alias("by"))),
            lambda s: F.transform(
                F.array(F.struct(s["w"].alias("w"), s["a"].alias("a"), (1 + F.floor((F.size(s["w"]) - s["a"]) / s["by"])).cast("int").alias("p"))),
                lambda t: F.array_join(F.transform(t["w"], lambda w, i: F.when(i < t["a"], w).otherwise(F.get(t["w"], t["a"] + (i - t["a"]) % t["p"]))), " "),
            )[0],
        )[0],
    )[0]
    return docs.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


@register("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(with_planted_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return (
        found.withColumn("best", best)
        .withColumn("listed", F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""))
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("best.start")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.period")).alias("period"),
            F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
            F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
