import base64
import glob
import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.warc import END, MAGIC, jump, read, write
from tidemark.session import scratch_path

SCHEMA = "page_id long, url string, html string"
FAKE = f"{END}{MAGIC}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 12\r\n\r\nHTTP/1.1 200{END}"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    """The contract: the largest id of each payload is the response."""
    best = {}
    for page_id, _, html in rows:
        best[html or ""] = max(best.get(html or "", page_id), page_id, key=lambda i: (i is not None, i))
    out = []
    for page_id, _, html in rows:
        keeper = best[html or ""]
        out.append((page_id, len((html or "").encode()), digest(html), "response" if page_id == keeper else "revisit", None if page_id == keeper else keeper))
    return sorted(out, key=repr)


def pages(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def awkward_rows():
    rng = random.Random(2)
    rows = [
        (1, "http://a", "<p>one"),
        (2, "http://b", "<p>one"),
        (3, None, None),
        (4, "http://c\r\nWARC-Type: evil", ""),
        (5, "http://d", f"before{FAKE}after"),
        (6, "http://e/WARC/1.1", FAKE * 3),
        (7, "u", END),
        (8, "u", MAGIC),
        (9, "u", f"{END}{MAGIC}"),
        (90, "u", f"{END}{MAGIC}\r\n"),
        (10, "u", f"{END}{MAGIC}\r\nContent-Length: 99999999999\r\n\r\n"),
        (11, "u", f"x{END}{MAGIC}\r\nContent-Length: 5\r\n\r\nabc"),
        (12, "ünï", "größe 日本語 🎉" * 50),
        (13, "u", "z" * 300_000),
        (14, "u", (FAKE + "word " * 40) * 500),
        (15, "u", "<p>one"),
        (16, "u", "\r\n\r\n\r\n"),
        (500, "u", "\n\n\nWARC/1.1\nWARC/1.1WARC/1.1\r\n\r\nWARC/1.1"),
        (17, "u", "WARC/1.1"),
        (-5, "u", "<p>minus"),
        (None, "u", "<p>one"),
        (None, "u", "only here"),
    ]
    return rows + [(100 + i, f"http://x/{i}", rng.choice(["same", f"<p>{i}", FAKE, f"{i}{FAKE}", "word " * rng.randint(0, 400)])) for i in range(150)]


def as_rows(frame):
    return sorted((tuple(r) for r in frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("split", ["128m", "64k", "1777b"])
def test_round_trip_at_any_split_size(spark, split):
    rows = awkward_rows()
    path = scratch_path(spark, "warc-test")
    write(pages(spark, rows), path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], split)
        spark.conf.set(names[1], "0")
        got = read(spark, path)
        assert as_rows(got) == expected(rows)
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_payloads_and_files(spark):
    rows = awkward_rows()
    path = scratch_path(spark, "warc-test")
    write(pages(spark, rows), path, compression="gzip")
    got = read(spark, path, payloads=True).collect()
    html = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    for r in got:
        if r["page_id"] is not None and r["record_type"] == "response":
            assert bytes(r["payload"]) == html[r["page_id"]]
        if r["record_type"] == "revisit":
            assert r["payload"] is None and html[r["refers_to"]] == (html[r["page_id"]] if r["page_id"] is not None else b"<p>one")
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[12] == "ünï" and urls[3] is None and urls[4] == "http://c  WARC-Type: evil" and urls[6].endswith("WARC/1.1")


def plain_records(data):
    """A reader that walks one file from its first byte."""
    at = 0
    while at < len(data):
        assert data[at:].startswith(MAGIC.encode())
        head = data.index(b"\r\n\r\n", at)
        n = next(int(line.split(b":")[1]) for line in data[at:head].split(b"\r\n") if line.lower().startswith(b"content-length"))
        yield data[at:head], data[head + 4 : head + 4 + n]
        at = head + 4 + n + 4
        assert data[at - 4 : at] == END.encode()


def test_files_are_plain_warc(spark):
    rows = awkward_rows()
    path = scratch_path(spark, "warc-test")
    write(pages(spark, rows), path)
    bodies = [r for f in sorted(glob.glob(f"{path}/part-*")) for r in plain_records(open(f, "rb").read())]
    assert len(bodies) == len(rows)
    stored = sorted(b.split(b"\r\n\r\n", 1)[1] for h, b in bodies if b"WARC-Type: response" in h)
    assert stored == sorted({(r[2] or "").encode() for r in rows})


def test_least_bytes_and_hot_payloads(spark, monkeypatch):
    rows = [(i, "u", "tiny" if i % 3 else "long enough") for i in range(60)]
    path = scratch_path(spark, "warc-test")
    write(pages(spark, rows), path, least_bytes=5)
    got = read(spark, path)
    assert got.where("payload_bytes = 4 and record_type <> 'response'").count() == 0
    assert got.where("record_type = 'revisit' and refers_to = 57").count() == 19
    for share in (1, 1000):
        monkeypatch.setattr(warc, "HOT_SHARE", share)
        path = scratch_path(spark, "warc-test")
        write(pages(spark, rows), path)
        assert as_rows(read(spark, path)) == expected(rows)


def test_repeated_rows_empty_tables_and_clashing_columns(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "b", "x"), (2, "b", "x"), (2, "c", "y")]
    frame = pages(spark, rows)
    for name in ("payload", "key", "hot", "keeper", "value", "n", "file", "split"):
        frame = frame.withColumn(name, F.lit("there before"))
    path = scratch_path(spark, "warc-test")
    write(frame, path)
    assert as_rows(read(spark, path)) == expected(rows)
    path = scratch_path(spark, "warc-test")
    write(pages(spark, rows).limit(0), path)
    assert read(spark, path).collect() == [] and read(spark, path, payloads=True).collect() == []


def test_damage_is_told(spark):
    path = scratch_path(spark, "warc-test")
    write(pages(spark, [(i, "u", f"page {i} " * 50) for i in range(20)], 1), path)
    (file,) = glob.glob(f"{path}/part-*")
    whole = open(file, "rb").read()

    def put(data):
        folder = scratch_path(spark, "warc-damaged")
        os.makedirs(folder)
        with open(f"{folder}/part-0", "wb") as out:
            out.write(data)
        return folder

    assert read(spark, put(whole)).count() == 20
    for damaged in (whole[:-30], whole.replace(b"Content-Length: 4", b"Content-Length: 5", 1), b"junk" + whole):
        with pytest.raises(ValueError, match="last byte"):
            read(spark, put(damaged)).collect()
    with pytest.raises(Exception, match="differs from its digest"):
        read(spark, put(whole.replace(b"page 7 page", b"page 8 page", 1))).collect()


def test_jump_against_walking():
    rng = random.Random(4)
    for _ in range(200):
        places = np.array(sorted(rng.sample(range(100), rng.randint(1, 20))))
        follows = np.array([rng.choice([-1, rng.randint(p + 1, 130), *(q for q in places if q > p)]) for p in places])
        nexts = dict(zip(places.tolist(), follows.tolist()))
        want = []
        for p in places.tolist():
            while p in nexts:
                p = nexts[p]
            want.append(p if p > places[-1] else -1)
        assert jump(places, follows).tolist() == want
