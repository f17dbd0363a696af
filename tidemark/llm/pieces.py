"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the characters and keeps, for each place, the best piece that ends there and
where it begins. Only the last ``longest piece`` places can still be continued, so as soon as the
backward paths from all of them meet in one place, the ids before it are final and are given out;
the window kept is what lies after it.

Two kinds of model are searched alike:

* unigram: a path's worth is the sum of its pieces' scores, the best predecessor wins;
* BPE (merges by score): a piece may follow another only if the two would not be merged otherwise
  when alone. An encoding is right exactly if all its neighbours get on so, and each place has
  just one such predecessor; the pieces are those of the merge procedure, without its queue.

Characters outside the vocabulary become byte pieces, or the unknown id if the model has none.

Short stretches are searched many at once in numpy, one place of all of them per step.

No piece continues over a blank that follows another character (checked when loading; a model
where one does is searched as one stretch). So paths always meet there, and the ids of the stretches
between are final and remembered, within a bound (``stretches``); a slice's are looked up together.
Decoding gathers the bytes of a slice's pieces.

Null and empty texts have no ids. Decoding gives back every text that holds no ``U+2581``, which
the format itself uses for blanks. Empty tables give no rows, repeated rows a row each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.arrays import BASE_A, U64, column, map_rows, mix, slices, utf8
from tidemark.llm.registry import register, table
from tidemark.llm.stretches import LONGEST, Known, bounds, ranges

BLANK = "▁"
#: Stretches searched together, at most.
AT_ONCE = 8192


class PairTable:
    """Whether two pieces get on, by the pair of their numbers: an open-addressed numpy table."""

    BITS = 21

    def __init__(self, decide):
        self.decide, self.count = decide, 0
        self.keys, self.values = np.full(1 << self.BITS, -1, np.int64), np.zeros(1 << self.BITS, bool)

    def of(self, keys: np.ndarray) -> np.ndarray:
        out, at = np.zeros(len(keys), bool), (mix(keys.astype(U64)) >> U64(64 - self.BITS)).astype(np.int64)
        left = np.arange(len(keys))
        missing = []
        while len(left):
            have = self.keys[at[left]]
            same = have == keys[left]
            out[left[same]] = self.values[at[left[same]]]
            missing.append(left[have == -1])
            left = left[~same & (have != -1)]
            at[left] = (at[left] + 1) & ((1 << self.BITS) - 1)
        missing = np.concatenate(missing) if missing else left
        if len(missing):
            new, back = np.unique(keys[missing], return_inverse=True)
            got = np.array([self.decide(int(k)) for k in new])
            self._add(new, got)
            out[missing] = got[back]
        return out

    def _add(self, keys: np.ndarray, values: np.ndarray) -> None:
        if self.count + len(keys) > 1 << (self.BITS - 1):
            self.keys[:], self.count = -1, 0
        if len(keys) > 1 << (self.BITS - 1):
            return
        self.count += len(keys)
        at = (mix(keys.astype(U64)) >> U64(64 - self.BITS)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == -1]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.values[at[won]] = keys[won], values[won]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.BITS) - 1)


class PieceModel:
    """The vocabulary of a model file, and the search over it."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.ids = {sp.id_to_piece(i): i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        self.splits = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.bpe = proto.ModelProto.FromString(sp.serialized_model_proto()).trainer_spec.model_type == proto.TrainerSpec.BPE
        self.text = [sp.id_to_piece(i).replace(BLANK, " ") if not (sp.is_control(i) or sp.is_unknown(i)) else "" for i in range(size)]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.known = Known(self._made, "<u4")
        spelled = [t.encode() if i not in self.byte_of else bytes([self.byte_of[i]]) for i, t in enumerate(self.text)]
        self.spelled, self.spelled_size = np.frombuffer(b"".join(spelled), np.uint8), np.array([len(x) for x in spelled], np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size
        self._lay_out()

    def _lay_out(self) -> None:
        """The vocabulary as arrays, for searching many stretches at once."""
        self.pieces = list(self.ids)
        n = len(self.pieces)
        self.number = np.array([self.ids[p] for p in self.pieces], "<u4")
        self.length = np.array([len(p) for p in self.pieces] + [1], np.int64)
        self.char = mix(np.arange(1, 0x110001, dtype=U64))
        self.key = np.zeros(n, U64)
        for i, p in enumerate(self.pieces):
            h = 0
            for c in p:
                h = (h * BASE_A + int(self.char[ord(c)])) & (2**64 - 1)
            self.key[i] = h
        if len(set(self.key.tolist())) < n:
            raise ValueError("two pieces share a hash")
        self.slots: list[np.ndarray] = []
        left = np.arange(n)
        while len(left):
            slot = np.full(1 << 18, -1, np.int32)
            slot[(self.key[left] >> U64(46)).astype(np.int64)] = left
            self.slots.append(slot)
            left = left[slot[(self.key[left] >> U64(46)).astype(np.int64)] != left]
        self.friends = PairTable(lambda k: self._get_on(self.pieces[k // (n + 1)] if k // (n + 1) < n else "", self.pieces[k % (n + 1)]))
        self.start = n  # stands for the place before the first piece

    def _piece_at(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 for none."""
        at, out = (hashes >> U64(46)).astype(np.int64), np.full(len(hashes), -1, np.int64)
        for slot in self.slots:
            found = slot[at].astype(np.int64)
            fits = (found >= 0) & (self.key[found] == hashes)
            out[fits] = found[fits]
        return out

    def _packed_many(self, stretches: list[str]) -> list[bytes]:
        """``_packed`` of many short stretches; the same trellis, a place of all of them at a time.

        A character outside the vocabulary is in no piece, so the place after it stays a beginning.
        """
        if not self.bpe:
            return [self._packed(s) for s in stretches]
        out: list[bytes] = [b""] * len(stretches)
        codes = np.frombuffer("".join(stretches).replace(" ", BLANK).encode("utf-32-le"), "<u4")
        sizes, chars = np.array([len(s) for s in stretches]), self.char[codes]
        rows = np.argsort(-sizes, kind="stable")
        rows = rows[: int(np.count_nonzero(sizes))]
        if not len(rows):
            return out
        begin, size, n, width = (np.cumsum(sizes) - sizes)[rows], sizes[rows], len(self.pieces), int(sizes[rows[0]])
        sums = np.zeros((width + 1, len(rows)), U64)
        last = np.full((width + 1, len(rows)), self.start, np.int64)
        up = [U64(pow(BASE_A, k, 1 << 64)) for k in range(self.longest + 1)]
        for end in range(1, width + 1):
            live = int(np.searchsorted(-size, -end, "right"))
            sums[end, :live] = sums[end - 1, :live] * up[1] + chars[begin[:live] + end - 1]
            todo = np.arange(live)
            for count in range(min(end, self.longest), 0, -1):
                piece = self._piece_at(sums[end, todo] - sums[end - count, todo] * up[count])
                hit = piece >= 0
                if hit.any():
                    rows_hit, piece = todo[hit], piece[hit]
                    good = self.friends.of(last[end - count, rows_hit] * (n + 1) + piece)
                    last[end, rows_hit[good]] = piece[good]
                    hit[hit] = good
                    todo = todo[~hit]
                    if not len(todo):
                        break
        # From the ends back to the beginnings, one piece of every stretch at a time.
        place, who, steps = size.copy(), np.arange(len(rows)), []
        while len(who):
            piece = last[place[who], who]
            place[who] -= self.length[piece]
            steps.append((who, piece, begin[who] + place[who]))
            who = who[place[who] > 0]
        who, piece, where = (np.concatenate(x)[::-1] for x in zip(*steps))
        order = np.argsort(who, kind="stable")
        who, piece, where = who[order], piece[order], where[order]
        # The ids: a piece has its own; a character outside the vocabulary those of its bytes.
        strange, of = np.unique(codes[where[piece == n]], return_inverse=True)
        spelled = [self.piece_ids(chr(c)) for c in strange.tolist()]
        table = np.concatenate([self.number, np.array([i for x in spelled for i in x], "<u4")]).astype("<u4")
        lengths = np.array([len(x) for x in spelled], np.int64)
        counts, first = np.ones(len(piece), np.int64), piece.copy()
        counts[piece == n], first[piece == n] = lengths[of], (n + np.cumsum(lengths) - lengths)[of]
        packed = table[ranges(first, counts)].tobytes()
        ends = (np.cumsum(np.bincount(who, counts, len(rows))) * 4).astype(np.int64)
        for i, a, b in zip(rows.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            out[i] = packed[a:b]
        return out

    def merged(self, text: str) -> list[str]:
        """The merge procedure itself, for short strings: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _get_on(self, one: str, two: str) -> bool:
        return self.merged(one + two) == [p for p in (one, two) if p]

    def search(self, text: str) -> Iterator[str]:
        """Pieces of ``text``, given out as soon as all open paths agree on them."""
        vocabulary, longest, bpe, friends = self.ids, self.longest, self.bpe, {}
        base, begin, last, worth = 0, [0], [""], [0.0]  # by place minus base
        for end in range(1, len(text) + 1):
            chosen, piece, value = -1, "", 0.0
            for start in range(max(base, end - longest), end):
                t = text[start:end]
                if t not in vocabulary:
                    if end - start > 1:
                        continue
                    s = -1e6
                else:
                    s = 0.0 if bpe else self.score[t]
                if bpe:
                    before = last[start - base]
                    if before is None:
                        continue
                    if t in vocabulary:
                        if (before, t) not in friends:
                            friends[before, t] = self._get_on(before, t)
                        if not friends[before, t]:
                            continue
                    chosen, piece = start, t
                    break
                s += worth[start - base]
                if chosen < 0 or s > value:
                    chosen, piece, value = start, t, s
            begin.append(chosen)
            last.append(piece if chosen >= 0 else None)
            worth.append(value)
            if (end - base) % (4 * longest) == 0:
                open_ends = {p for p in range(max(base, end - longest + 1), end + 1) if last[p - base] is not None}
                while len(open_ends) > 1:
                    far = max(open_ends)
                    open_ends.remove(far)
                    open_ends.add(begin[far - base])
                meet = open_ends.pop()
                if meet > base:
                    yield from self._back(begin, last, base, meet)
                    cut = meet - base
                    base, begin, last, worth = meet, begin[cut:], last[cut:], worth[cut:]
                    begin[0] = meet
        yield from self._back(begin, last, base, len(text))

    @staticmethod
    def _back(begin: list[int], last: list[str], base: int, end: int) -> list[str]:
        out = []
        while end > base:
            out.append(last[end - base])
            end = begin[end - base]
        return out[::-1]

    def piece_ids(self, piece: str) -> list[int]:
        if (i := self.ids.get(piece)) is not None:
            return [i]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def _packed(self, stretch: str) -> bytes:
        return np.array([i for p in self.search(stretch.replace(" ", BLANK)) for i in self.piece_ids(p)], "<u4").tobytes()

    def _made(self, stretches: list[bytes]) -> list[bytes]:
        """The packed ids of these stretches; long ones are searched in the bounded window."""
        out = [self._packed(x.decode()) if len(x) > LONGEST else b"" for x in stretches]
        short = [i for i, x in enumerate(stretches) if len(x) <= LONGEST]
        for at in range(0, len(short), AT_ONCE):
            part = short[at : at + AT_ONCE]
            for i, packed in zip(part, self._packed_many([stretches[i].decode() for i in part])):
                out[i] = packed
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the n + 1 places where each text's begin."""
        if not self.splits:
            packed = [self._packed(" " + t) if t else b"" for t in texts.to_pylist()]
            return np.frombuffer(b"".join(packed), "<u4"), bounds(np.array([len(p) // 4 for p in packed], np.int64))
        data, offsets = utf8(texts)
        full = offsets[1:] > offsets[:-1]
        offsets = offsets + bounds(full)  # with a blank before every text that is not empty
        begins, own = offsets[:-1][full], np.ones(offsets[-1], bool)
        own[begins] = False
        led = np.full(len(own), 0x20, np.uint8)
        led[own] = data
        blank = led == 0x20
        for at in np.flatnonzero((led[:-2] == 0xE2) & (led[1:-1] == 0x96) & (led[2:] == 0x81)) + np.arange(3)[:, None]:
            blank[at] = True  # the three bytes of BLANK
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[begins] = True
        starts = np.flatnonzero(start)
        ids, counts = self.known.ids(led, starts, np.append(starts[1:], len(led)))
        return ids, bounds(counts)[np.searchsorted(starts, offsets)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        ids, at = self.encode_all(pa.array(texts, pa.large_string()))
        packed, at = ids.tobytes(), (at * 4).tolist()
        return [packed[a:b] for a, b in zip(at, at[1:])]

    def decode_all(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The text of ``ids[at[i]:at[i + 1]]`` for every i."""
        sizes = self.spelled_size[ids]
        said = self.spelled[ranges(self.spelled_at[ids], sizes)].tobytes()
        ends, out = bounds(sizes)[at].tolist(), []
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            try:
                out.append(said[a:b].decode()[1:])
            except UnicodeDecodeError:  # byte pieces that spell no character
                out.append(self.decode(ids[at[i] : at[i + 1]].tobytes()))
        return out

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.text.__getitem__, ids))[1:]
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.text[i])
        out.append(run.decode("utf-8", "replace"))
        return "".join(out)[1:]


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One model per worker process."""
    return PieceModel(path)


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the ids of a text column as binary (little-endian 32-bit); a column of that name is replaced."""
    from pyspark.sql.types import BinaryType, StructType

    docs = docs.drop(ids)

    def run(batch: pa.RecordBatch):
        m, texts = model(model_path), column(batch, text)
        for begin, end in slices(texts):
            found, at = m.encode_all(texts.slice(begin, end - begin))
            packed, at = found.tobytes(), (at * 4).tolist()
            got = [packed[a:b] for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.slice(begin, end - begin).columns, pa.array(got, pa.binary())], [*batch.schema.names, ids])

    return docs.mapInArrow(map_rows(run), StructType(list(docs.schema)).add(ids, BinaryType()))


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Append the text of an id column; null ids give an empty text; a column of that name is replaced."""
    from pyspark.sql.types import StringType, StructType

    rows = rows.drop(text)

    def run(batch: pa.RecordBatch):
        m = model(model_path)
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            packed = [x or b"" for x in column(part, ids).to_pylist()]
            got = m.decode_all(np.frombuffer(b"".join(packed), "<u4"), bounds(np.array([len(x) // 4 for x in packed], np.int64)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.string())], [*batch.schema.names, text])

    return rows.mapInArrow(map_rows(run), StructType(list(rows.schema)).add(text, StringType()))


def piece_report(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document: number and checksum of its ids, and whether decoding them gives the text back."""

    def run(batch: pa.RecordBatch):
        m, texts, keys = model(model_path), column(batch, "text"), column(batch, "doc_id")
        for begin, end in slices(texts):
            ids, at = m.encode_all(texts.slice(begin, end - begin))
            part, raw, cuts = texts.slice(begin, end - begin).to_pylist(), ids.tobytes(), (at * 4).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(begin, end - begin),
                    pa.array([len(t or "") for t in part], pa.int64()),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    pa.array([d == (t or "") for d, t in zip(m.decode_all(ids, at), part)], pa.bool_()),
                ],
                ["doc_id", "n_text_chars", "n_ids", "ids_crc32", "round_trip"],
            )

    return docs.select("doc_id", "text").mapInArrow(map_rows(run), "doc_id long, n_text_chars long, n_ids long, ids_crc32 long, round_trip boolean")


@register("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
