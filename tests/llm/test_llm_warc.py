import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import warc

PAGES = [(1, "http://a/1", "<p>one</p>", "x"), (2, "http://a/2", "<p>one</p>", "x"), (3, None, None, "x"), (4, "u", "", "x"),
         (5, "http://a/5\r\nX: y é", "ünï" * 100_000, "x"), (6, "http://a/6", "<p>one</p>\r\n\r\n", "x"), (7, "http://a/7", "ünï" * 100_000, "x"),
         (None, "http://a/8", "no id", "x"), (None, "http://a/9", "<p>one</p>", "x"), (2, "http://a/2", "<p>one</p>", "x"),
         (1, "http://b/1", "<p>one</p>", "x")]


def want(rows, min_bytes):
    firsts = {}
    for page_id, _, html, _ in rows:
        if page_id is not None:
            firsts[html or ""] = min(firsts.get(html or "", page_id), page_id)
    out = []
    for page_id, url, html, _ in rows:
        data = (html or "").encode()
        first = firsts.get(html or "")
        response = page_id == first or len(data) < min_bytes
        out.append((page_id, len(data), warc.digest(data), "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


def number(text):
    return None if text is None else int(text)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, sha string").repartition(3)


@pytest.mark.parametrize("min_bytes, archive_bytes", [(0, 1 << 28), (5, 1), (1 << 20, 3000)])
def test_round_trip(pages, min_bytes, archive_bytes):
    folder, index = warc.write_archives(pages, min_bytes=min_bytes, archive_bytes=archive_bytes)
    assert index.count() == len(PAGES) and index.columns == warc.INDEX
    rows = warc.read_records(folder, index, range_bytes=2000, gap_bytes=10).collect()
    got = sorted(((number(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in rows), key=str)
    assert got == want(PAGES, min_bytes)
    by_digest = {r["payload_digest"]: bytes(r["payload"]) for r in rows if r["payload"] is not None}
    assert {warc.digest((h or "").encode()) for _, _, h, _ in PAGES} == set(by_digest)
    assert all(warc.digest(p) == d for d, p in by_digest.items())


def test_chosen_records_only(pages):
    folder, index = warc.write_archives(pages)
    chosen = index.filter("url = 'http://a/6'")
    rows = warc.read_records(folder, chosen).collect()
    assert [bytes(r["payload"]) for r in rows] == [b"<p>one</p>\r\n\r\n"]
    twice = chosen.unionAll(chosen)
    assert warc.read_records(folder, twice, with_payload=False).count() == 2


def test_neighbours_are_read_together():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("b", 0, 10), ("b", 0, 10), ("b", 10, 500), ("b", 510, 1)]
    reads = [(a, lo, hi, len(r)) for a, lo, hi, r in warc.ranges(iter(rows), 60, 5)]
    assert reads == [("a", 0, 30, 3), ("a", 100, 110, 1), ("b", 0, 10, 2), ("b", 10, 510, 1), ("b", 510, 511, 1)]
    assert list(warc.ranges(iter([]), 60, 5)) == []


def test_a_damaged_record_is_noticed():
    data, own = warc.record("1", "u", b"payload", None, True)
    assert own == warc.digest(b"payload") and warc.parse(data)["payload"] == b"payload"
    raw = zlib.decompress(data, 31).replace(b"payload\r\n\r\n", b"paylaod\r\n\r\n")
    packer = zlib.compressobj(wbits=31)
    with pytest.raises(ValueError):
        warc.parse(packer.compress(raw) + packer.flush())


def test_digest_is_base32_sha1():
    assert len(warc.digest(b"")) == 32 and hashlib.sha1(b"").hexdigest().startswith("da39")
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_revisits_name_the_record_of_their_response(pages):
    folder, index = warc.write_archives(pages)
    members = []
    for name in os.listdir(folder):
        data = open(f"{folder}/{name}", "rb").read()
        while data:
            unpacker = zlib.decompressobj(31)
            members.append(unpacker.decompress(data).partition(b"\r\n\r\n")[0].decode())
            data = unpacker.unused_data
    fields = [dict(line.split(": ", 1) for line in m.split("\r\n")[1:]) for m in members]
    responses = {f["WARC-Record-ID"]: f for f in fields if f["WARC-Type"] == "response"}
    revisits = [f for f in fields if "WARC-Refers-To" in f]
    assert len(revisits) >= 3
    for f in revisits:
        named = responses[f["WARC-Refers-To"]]
        assert named["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] and named["WARC-Page-ID"] == f["WARC-Refers-To-Page"]


def test_archives_are_read_by_several_tasks(spark):
    rng = random.Random(1)
    rows = [(i, f"http://a/{i}", "".join(rng.choice("abcdefghijklmnop") for _ in range(40_000))) for i in range(150)]
    folder, index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    assert index.select("archive").distinct().count() == 1
    read = warc.read_records(folder, index)
    assert read.rdd.getNumPartitions() > 1 and read.select(F.spark_partition_id()).distinct().count() > 1
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in read.collect()} == {(str(i), h) for i, _, h in rows}


def test_no_rows(spark):
    folder, index = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == 0 and warc.read_records(folder, index).count() == 0
