r"""WARC archives: written by Spark, read back by verifying the chain of record boundaries.

*Writing.* Each page becomes one record, an HTTP response with the html (UTF-8) as payload. Of pages
with equal payloads the one with the largest id is stored as ``response``; the others become
``revisit`` records without payload that refer to it. Records are text rows parted by the blank
lines that end a WARC record, so Spark's own writer lays the files out, on any Hadoop file system.

Whose payload stands more than once is settled by counts per digest. Digests of more than 1 in
``HOT_SHARE`` pages are broadcast (at most ``HOT_SHARE`` rows, since shares add up to one); all others
are joined by digest, so no join key holds more than that share.

*Reading.* Files are scanned in splits, cut at each magic (``WARC/1.1`` on a new line). A magic may
also stand in a payload, so each is only a candidate:

1. Tasks emit every candidate with its header fields and its length, hence its successor. Sizes of
   what each split read add up to the offsets of splits within their file.
2. Within a split, pointer jumping finds for each candidate where its chain leaves the split. Over
   the offsets at which chains enter splits, rounds of self joins double the jumps until all that can
   be reached from the start of a file is marked: the logarithm of the number of splits of a file.
3. The one marked entry of each split is followed through it. What lies on the chain is a record, all
   else belongs to the payload of the record before; such payloads are put together again.

The chain of a file has to end at its last byte, else ``read`` raises an error that names the file.

Bounds: a task holds one batch of pieces, or the narrow rows of one split, or one record. Header
values keep no line breaks. Null html is an empty payload, null urls are left out. Repeated rows are
written each; rows alike in id and payload are all responses if theirs is the largest id. A null id
counts as smaller than all others, its record is a response only if no other row has the payload or
all such ids are null. An empty table writes no record, and reading no file or empty files gives no
rows. Other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.arrays import SLICE_BYTES, column
from tidemark.llm.registry import register, table
from tidemark.session import scratch_path, settle

#: Payloads smaller than this are stored each time they stand.
LEAST_REVISIT_BYTES = 0
#: A digest of more than one in so many pages is looked up by broadcast.
HOT_SHARE = 1000
# What a record begins with, its end, and the two alphabets of base 32.
MAGIC, END = "WARC/1.1", "\r\n\r\n"
#: Files are cut here: a magic on a new line. No part of it can overlap another cut, so none hides one.
CUT = f"\n{MAGIC}"
HEX_32, BASE_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a text's UTF-8 in base 32, without leaving the JVM: five hex digits give four."""
    digits = F.sha1(payload.cast("binary"))
    fours = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*fours), HEX_32, BASE_32)


def decide(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Append payload, its bytes and digest, and the id of the response that a page revisits, if any."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.col("payload")))
    counted = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("keeper")).where("n > 1")
    counted = settle(counted, "warc-digests")
    total = pages.count()
    hot = counted.where(F.col("n") * HOT_SHARE > total).select("payload_digest", F.col("keeper").alias("hot_keeper"), F.lit(True).alias("hot"))
    cold = counted.where(F.col("n") * HOT_SHARE <= total).select(F.col("payload_digest").alias("key"), "keeper")
    rows = rows.join(F.broadcast(hot), "payload_digest", "left")
    # A row that is settled already takes a key of its own, which meets no digest.
    key = F.when(F.col("hot"), F.concat(F.lit("-"), F.monotonically_increasing_id())).otherwise(F.col("payload_digest"))
    keeper = F.when(F.col("hot"), F.col("hot_keeper")).otherwise(F.col("keeper"))
    revisits = keeper.isNotNull() & ~F.col("page_id").eqNullSafe(keeper)
    joined = rows.withColumn("key", key).join(cold, "key", "left")
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(revisits, keeper).alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    """One header line; null where the value is. Line breaks and other controls become blanks."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\x00-\x1F\x7F]", " "), F.lit("\r\n"))


def records(decided: DataFrame) -> DataFrame:
    """One text column, ``value``: each record without the blank lines that end it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    urn = "<urn:page:"
    return decided.select(
        F.concat(
            F.lit(f"{MAGIC}\r\n"),
            F.concat_ws(
                "",
                _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
                _header("WARC-Record-ID", F.concat(F.lit(urn), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
                _header("WARC-Date", F.lit(DATE)),
                _header("WARC-Target-URI", F.col("url")),
                _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
                _header("WARC-Refers-To", F.concat(F.lit(urn), F.col("refers_to").cast("string"), F.lit(">"))),
                _header("WARC-Profile", F.when(revisit, PROFILE)),
                _header("Content-Type", F.lit("application/http;msgtype=response")),
                _header("Content-Length", length.cast("string")),
            ),
            F.lit("\r\n"),
            http,
            F.when(revisit, "").otherwise(F.col("payload")),
        ).alias("value")
    )


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_REVISIT_BYTES, compression: str = "none") -> None:
    """Write ``pages`` (page_id, url, html) as WARC files below ``path``."""
    records(decide(pages, least_bytes)).write.option("lineSep", END).option("compression", compression).text(path)


_FIELDS = "page_id long, url string, record_type string, refers_to long, stated_digest string, payload_bytes long, payload_digest string"
#: A piece: what stands between two magics of a file. ``place`` counts from the first piece of its split.
_PIECES = f"file string, split long, seq int, place long, size long, length long, head int, whole boolean, {_FIELDS}, raw binary"


def _number(text: bytes) -> int | None:
    return int(text) if text.isdigit() and len(text) < 19 else None


def _page(text: bytes) -> int | None:
    text = text.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(text) if text.removeprefix(b"-").isdigit() and len(text) < 20 else None


def _payload_fields(kind: str, block: bytes, stated: str | None) -> tuple[int | None, str | None]:
    """Size and digest of the full payload: counted from the bytes of a response, stated in a revisit."""
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank:
        return None, None
    if kind == "revisit":
        sizes = [_number(line[15:].strip()) for line in http.split(b"\r\n") if line[:15].lower() == b"content-length:"]
        return (sizes[0] if sizes else None), stated
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _parse(piece: bytes) -> tuple:
    """Length of the record that a piece would begin, its header's bytes, whether all is here, its fields.

    A length of null says that no record begins here.
    """
    head = piece.find(b"\r\n\r\n")
    nothing = (None, None, False, *(None,) * 7)
    if head < 0 or not piece.startswith(b"\r\n"):
        return nothing
    fields = {}
    for line in piece[2:head].split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields.setdefault(name.strip().lower(), value.strip())
    n = _number(fields.get(b"content-length", b""))
    if n is None:
        return nothing
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    stated = fields[b"warc-payload-digest"].decode("utf-8", "replace").removeprefix("sha1:") if b"warc-payload-digest" in fields else None
    url = fields[b"warc-target-uri"].decode("utf-8", "replace") if b"warc-target-uri" in fields else None
    whole = len(piece) - head - 4 >= n
    found = _payload_fields(kind, piece[head + 4 : head + 4 + n], stated) if whole else (None, None)
    length = len(MAGIC) + head + 4 + n + len(END)
    return length, head + 4, whole, _page(fields.get(b"warc-record-id", b"")), url, kind, _page(fields.get(b"warc-refers-to", b"")), stated, *found


def pieces(spark: SparkSession, path: str, raw: bool) -> DataFrame:
    """Candidates of all files below ``path``, with what their header says and where they would end.

    ``place`` is the offset of the piece's magic from the first byte that its split read; ``size`` is
    the bytes from there to the next magic. Without ``raw`` the bytes of a piece are kept only where
    it is no record by itself, or may belong to such a one before it in its split.
    """
    scan = spark.read.option("lineSep", CUT).text(path)
    scan = scan.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    arrow = to_arrow_schema(StructType.fromDDL(_PIECES))
    magic = MAGIC.encode()

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seq, place, reach = None, 0, 0, 0
        for batch in batches:
            rows, held = [], 0
            for file, split, value in zip(*(column(batch, c) for c in ("file", "split", "value"))):
                file, split, piece = file.as_py(), split.as_py(), value.as_py()
                if (file, split) != at:
                    at, seq, place, reach = (file, split), 0, 0, 0
                first = split == 0 and seq == 0
                if first:
                    # No line break leads the first magic, so it is part of the piece.
                    begins = piece.startswith(magic)
                    fields = _parse(piece[len(magic) :]) if begins else _parse(b"")
                    size = len(piece) + 1
                else:
                    fields, size = _parse(piece), len(CUT) + len(piece)
                body = piece[len(magic) :] if first else piece
                if fields[0] is not None and not fields[2]:
                    reach = max(reach, place + fields[0])
                rows.append((file, split, seq, place, size, *fields, body if raw or not fields[2] or place < reach else None))
                seq, place, held = seq + 1, place + size, held + size
                if held > SLICE_BYTES:
                    yield table_of(rows)
                    rows, held = [], 0
            if rows:
                yield table_of(rows)

    return scan.mapInArrow(run, _PIECES)


def jump(places: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Where the chain of each place leaves these places, by pointer jumping; -1 for a dead end.

    ``places`` rise; ``follows`` holds each one's successor, -1 for none. A successor below the last
    place that is none of the places is a dead end.
    """
    n = len(places)
    at = np.searchsorted(places, follows)
    inside = (at < n) & (places[np.minimum(at, max(n - 1, 0))] == follows) if n else np.zeros(0, bool)
    end = np.where(follows > (places[-1] if n else 0), follows, -1)
    to = np.where(inside, at, np.arange(n))
    while True:
        further = to[to]
        if (further == to).all():
            return end[to]
        to = further


def _by_split(rows: DataFrame, run, schema: str) -> DataFrame:
    return rows.groupBy("file", "split").applyInArrow(run, schema)


def _settled_reach(edges: DataFrame) -> DataFrame:
    """All (file, offset) that can be reached from offset 0 of a file over ``edges`` (file, offset, exit).

    Each round takes the reached set as far as it came, and doubles the jumps.
    """
    reached = settle(edges.where("offset = 0").select("file", "offset"), "warc-reached")
    jumps, n = edges.select("file", "offset", "exit"), reached.count()
    while True:
        onward = reached.join(jumps, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        further = settle(reached.union(onward).distinct(), "warc-reached")
        count = further.count()
        if count == n:
            return further
        reached, n = further, count
        ahead = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("beyond"))
        jumps = settle(jumps.join(ahead, ["file", "exit"]).select("file", "offset", F.col("beyond").alias("exit")), "warc-jumps")


def _spans(cut: DataFrame) -> DataFrame:
    """Per split (file, split) the bytes that it read and ``base``, the offset of the first."""
    order = Window.partitionBy("file").orderBy("split")
    sizes = cut.groupBy("file", "split").agg(F.sum("size").alias("bytes"))
    return settle(sizes.select("file", "split", "bytes", (F.sum("bytes").over(order) - F.col("bytes")).alias("base")), "warc-splits")


def chain(cut: DataFrame) -> DataFrame:
    """For each piece (file, split, seq) its ``offset``, ``owner``, the offset of the record it belongs
    to, and ``own``, whether that record begins with it. ``cut`` is the settled result of ``pieces``."""
    spans = _spans(cut)
    narrow = cut.select("file", "split", "seq", "place", "length").join(spans.select("file", "split", "base"), ["file", "split"])

    def in_order(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        rows = rows.sort_by("place")
        places = rows.column("place").to_numpy() + rows.column("base")[0].as_py()
        length = rows.column("length").to_pandas().fillna(-1).to_numpy(np.int64)
        return places, np.where(length < 0, -1, places + length), rows

    def exits(rows: pa.Table) -> pa.Table:
        places, follows, rows = in_order(rows)
        out = jump(places, follows)
        keep = np.flatnonzero(out >= 0)
        return pa.table({**{c: rows.column(c).take(pa.array(keep)) for c in ("file", "split")}, "offset": places[keep], "exit": out[keep]})

    edges = settle(_by_split(narrow, exits, "file string, split long, offset long, exit long"), "warc-edges")
    # Chains enter splits only where some chain leaves one; of all candidates, those and the starts stay.
    entries = edges.select("file", F.col("exit").alias("offset")).union(edges.select("file", F.lit(0).cast("long"))).distinct()
    edges = settle(edges.join(entries, ["file", "offset"]), "warc-entries")
    reached = _settled_reach(edges)

    # No cut follows the last piece, so its size counts a line break too many.
    ends = spans.groupBy("file").agg((F.sum("bytes") - 1).alias("offset"))
    broken = ends.join(reached, ["file", "offset"], "left_anti").limit(5).collect()
    if broken:
        raise ValueError("no chain of records ends at the last byte of " + ", ".join(r["file"] for r in broken))

    spot = edges.join(reached, ["file", "offset"], "left_semi").select("file", "split", F.col("offset").alias("entry"))
    marked = narrow.join(spot, ["file", "split"], "left")

    def follow(rows: pa.Table) -> pa.Table:
        places, follows, rows = in_order(rows)
        entry = rows.column("entry")[0].as_py()
        on = np.zeros(len(places), bool)
        at = np.searchsorted(places, entry) if entry is not None else len(places)
        while at < len(places) and places[at] == entry:
            on[at] = True
            entry = follows[at]
            at = np.searchsorted(places, entry) if entry >= 0 else len(places)
        last = np.maximum.accumulate(np.where(on, np.arange(len(places)), -1))
        owner = pa.array(places[np.maximum(last, 0)], mask=last < 0)
        return pa.table({"file": rows.column("file"), "split": rows.column("split"), "seq": rows.column("seq"), "offset": places, "owner": owner, "own": on})

    owned = settle(_by_split(marked, follow, "file string, split long, seq int, offset long, owner long, own boolean"), "warc-owners")
    # What precedes the first record of a split belongs to the last record of the splits before.
    lasts = owned.groupBy("file", "split").agg(F.max("owner").alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("file", "split", F.last("last", ignorenulls=True).over(before).alias("carried"))
    return owned.join(carried, ["file", "split"]).select("file", "split", "seq", "offset", F.coalesce("owner", "carried").alias("owner"), "own")


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records below ``path``: page_id, url, record_type, refers_to, payload_bytes, payload_digest
    and, if asked for, the ``payload`` of responses as binary.

    Size and digest of a response are those of the bytes read; a revisit states those of the payload
    it refers to. A response whose bytes do not match its stated digest raises an error.
    """
    cut = settle(pieces(spark, path, payloads), "warc-pieces")
    owned = settle(chain(cut), "warc-chain")
    key = ["file", "split", "seq"]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "stated_digest"]
    joined = owned.where("own").select(*key, "owner").join(cut.select(*key, "length", "head", "whole", *names, *(["raw"] if payloads else [])), key)
    block = F.expr("substring(raw, head + 1, int(length) - 12 - head)") if payloads else F.lit(None).cast("binary")
    whole = joined.where("whole").select(*names, block.alias("block"))

    # Records with magics in their payload: their pieces meet again, one record a group.
    split_up = joined.where("not whole").select("file", "owner", F.col("length").alias("record_length"), F.col("head").alias("record_head"), *names[:4], "stated_digest")
    wanted = settle(owned.drop("own").join(split_up, ["file", "owner"]), "warc-wanted")
    parts = wanted.join(cut.select(*key, "raw"), key)
    if parts.where("raw is null").limit(1).count():
        # A record goes on in a split that could not know it: its pieces are read again, by offset.
        again = settle(pieces(spark, path, True), "warc-pieces")
        found = again.join(_spans(again), ["file", "split"]).select("file", (F.col("base") + F.col("place")).alias("offset"), "raw")
        parts = wanted.join(found, ["file", "offset"])
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, stated_digest string, block binary"

    def put_together(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("offset")
        first = rows.slice(0, 1).to_pylist()[0]
        raw = CUT.encode().join(rows.column("raw").to_pylist())
        n = first["record_length"] - len(MAGIC) - len(END)
        block = raw[first["record_head"] : n]
        size, digest = _payload_fields(first["record_type"], block, first["stated_digest"])
        out = {k: [first[k]] for k in names[:4]} | {"payload_bytes": [size], "payload_digest": [digest], "stated_digest": [first["stated_digest"]], "block": [block if payloads else None]}
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()])})

    together = parts.groupBy("file", "owner").applyInArrow(put_together, schema)
    both = whole.union(together)
    wrong = (F.col("record_type") == "response") & F.col("stated_digest").isNotNull() & ~F.col("stated_digest").eqNullSafe(F.col("payload_digest"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.coalesce("url", F.lit("?"))))).otherwise(F.col("payload_digest"))
    out = both.select(*names[:5], checked.cast("string").alias("payload_digest"), "block")
    if not payloads:
        return out.drop("block")
    # The payload follows the HTTP header.
    at = F.expr("instr(decode(block, 'ISO-8859-1'), '\\r\\n\\r\\n')")
    return out.select("*", F.when(F.col("record_type") == "response", F.substring(F.col("block"), at + 4, F.length("block"))).alias("payload")).drop("block")


@register(
    "op13_warc",
    """
    with p as (select page_id, coalesce(html, '') as payload from pages),
    q as (select page_id, octet_length(encode(payload)) as payload_bytes, sha1(payload) as h, max(page_id) over (partition by payload) as keeper from p)
    select page_id, payload_bytes::bigint as payload_bytes,
        array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31), 1) for i in range(32)], '') as payload_digest,
        case when page_id = keeper then 'response' else 'revisit' end as record_type,
        case when page_id <> keeper then keeper end as refers_to
    from q
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
