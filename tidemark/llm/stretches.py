"""Ids of many short byte strings at once: found by hash in numpy, made only when met anew.

A tokenizer that works stretch by stretch (a word, say) needs few distinct stretches for most of a
text. ``Known`` looks up all stretches of a slice together by two 64-bit hashes and gathers their ids;
only those it does not remember are handed to the tokenizer. It remembers about ``size`` of them and
then begins anew. Stretches over ``LONGEST`` bytes are neither hashed nor remembered.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tidemark.llm.arrays import BASE_A, BASE_B, U64

LONGEST = 64
MEMORY = 1_000_000
#: Stretches looked up together; bounds the scratch arrays of a very long text.
TOGETHER = 1 << 17
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)  # the first n bytes of a word


def ranges(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``begin[i] .. begin[i] + counts[i] - 1`` for every i, one after another."""
    ends = np.cumsum(counts)
    return np.repeat(begin - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def bounds(counts: np.ndarray) -> np.ndarray:
    """The n + 1 places where n runs of these lengths begin and end."""
    return np.concatenate([[0], np.cumsum(counts)])


def hashes(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each stretch, eight bytes a step; ``padded`` has eight bytes after the last."""
    eights = np.ndarray(len(padded) - 7, "<u8", padded.data, strides=(1,))
    one, two = lengths.astype(U64), lengths.astype(U64) * U64(BASE_B)
    at, left = np.arange(len(starts)), lengths
    for step in range(0, LONGEST, 8):
        value = eights[starts[at] + step] & _FIRST[np.minimum(left, 8)]
        a, b = (one[at] ^ value) * U64(BASE_A), (two[at] + value) * U64(BASE_B)
        one[at], two[at] = a ^ a >> U64(32), b ^ b >> U64(29)
        more = left > 8
        at, left = at[more], left[more] - 8
        if not len(at):
            break
    return one * U64(BASE_B) ^ one >> U64(31), two


class Known:
    """Ids of recently met stretches. ``make`` gives the packed ids of a list of byte strings."""

    def __init__(self, make: Callable[[list[bytes]], list[bytes]], dtype: str, size: int = MEMORY):
        self.make, self.dtype, self.size = make, np.dtype(dtype), size
        self.bits = max(10, (2 * (size + TOGETHER) - 1).bit_length())
        self._clear()

    def _clear(self) -> None:
        room = self.size + 2 * TOGETHER  # of which only what is used takes memory
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.one, self.two, self.begin, self.count = np.empty(room, U64), np.empty(room, U64), np.empty(room, np.int64), np.empty(room, np.int32)
        self.entries, self.used, self.flat = 0, 0, np.empty(1 << 20, self.dtype)

    def _find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Entries with these hashes, -1 for none."""
        out, left = np.full(len(one), -1, np.int64), np.arange(len(one))
        at = (one >> U64(64 - self.bits)).astype(np.int64)
        while len(left):
            entry = self.slots[at]
            used = entry >= 0
            left, at, entry = left[used], at[used], entry[used]
            same = (self.one[entry] == one[left]) & (self.two[entry] == two[left])
            out[left[same]] = entry[same]
            left, at = left[~same], at[~same] + 1 & (1 << self.bits) - 1
        return out

    def _append(self, packed: list[bytes], one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Add entries; returns their numbers."""
        counts = np.array([len(p) for p in packed], np.int64) // self.dtype.itemsize
        new, used = slice(self.entries, self.entries + len(packed)), self.used + int(counts.sum())
        if used > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(used, self.dtype)])
        self.flat[self.used : used] = np.frombuffer(b"".join(packed), self.dtype)
        self.one[new], self.two[new], self.count[new] = one, two, counts
        self.begin[new] = self.used + np.cumsum(counts) - counts
        self.entries, self.used = new.stop, used
        return np.arange(new.start, new.stop)

    def _place(self, left: np.ndarray) -> None:
        """Enter these entries in the table."""
        at = (self.one[left] >> U64(64 - self.bits)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slots[at] < 0)
            self.slots[at[free]] = left[free]  # of several for one slot, one gets it
            out = self.slots[at] != left
            left, at = left[out], at[out] + 1 & (1 << self.bits) - 1

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``data[start:end]`` of every stretch, one after another, and each one's number of ids."""
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        got = [self._ids(padded, starts[i : i + TOGETHER], ends[i : i + TOGETHER]) for i in range(0, len(starts), TOGETHER)]
        if not got:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])

    def _ids(self, padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = ends - starts
        said = lambda where: [padded[a:b].tobytes() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
        short, long = np.flatnonzero(lengths <= LONGEST), np.flatnonzero(lengths > LONGEST)
        one, two = hashes(padded, starts[short], lengths[short])
        entry = self._find(one, two)
        if len(new := np.flatnonzero(entry < 0)):
            if self.entries > self.size:
                self._clear()
                entry, new = self._find(one, two), np.arange(len(short))
            order = new[np.lexsort((two[new], one[new]))]
            differs = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
            head = order[np.concatenate([[True], differs])]
            self._place(self._append(self.make(said(short[head])), one[head], two[head]))
            entry[new] = self._find(one[new], two[new])
        place = np.zeros(len(starts), np.int64)
        place[short] = entry
        keep = self.entries, self.used
        if len(long):  # entries for the moment, not in the table
            words = said(long)
            distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
            place[long] = self._append(self.make(list(distinct)), *np.zeros((2, len(distinct)), U64))[[distinct[w] for w in words]]
        counts = self.count[place].astype(np.int64)
        out = self.flat[ranges(self.begin[place], counts)]
        self.entries, self.used = keep
        return out, counts
