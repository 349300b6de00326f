import gzip
import hashlib
import random
from base64 import b32encode

import pytest
from helpers import CLASHES, collected
from pyspark.sql import functions as F

from ledgermart.llm import warc
from ledgermart.llm.common import written

SCHEMA = "page_id long, url string, html string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def sha1(payload):
    return b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows, least=0):
    """The smallest page_id of each payload is the response; null ids come last, ties by url, then any one."""
    groups = {}
    for page, url, html in rows:
        groups.setdefault((html or "").encode(), []).append((page is None, page or 0, url is None, url or ""))
    found = []
    for payload, own in groups.items():
        own.sort()
        page = lambda r: None if r[0] else r[1]
        for i, r in enumerate(own):
            first = i == 0 or len(payload) < least
            found.append((page(r), len(payload), sha1(payload), "response" if first else "revisit", None if first else page(own[0])))
    return sorted(found, key=repr)


def made(n, seed):
    rng = random.Random(seed)
    odd = ["", "a\r\n\r\nWARC/1.1\r\nb", "é日😀 " * 50, "x" * 300_000, "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "\r\n\r\n", None, "\x00\x01"]
    rows = [(i, f"https://h{i % 9}.example/{i}?q={i}#f", rng.choice(odd) if rng.random() < 0.5 else f"<p>{rng.randrange(60)}</p>") for i in range(n)]
    rows += [rows[3], rows[3], (3, None, rows[3][2]), (None, "u", "same"), (None, None, "same"), (7_000, "a\r\nb c", "same"), (7_001, "", "same"), (None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip_equals_the_definition(spark, least):
    rows = made(150, 1)
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in (*CLASHES, "digest", "size", "copy", "n", "first", "value")}).repartition(5)
    got = warc.round_trip(pages, least)
    assert got.columns == list(COLUMNS)
    assert sorted(collected(got, *COLUMNS), key=repr) == plain(rows, least)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_captures_hold_their_transaction(spark, tmp_path):
    rows = [(1, "http://a.example/x?y#z", "one"), (2, "http://b.example", "one"), (3, "c", "two\r\n\r\n")]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"))
    records = written(warc.read_records(spark, str(tmp_path / "w")), "records")
    assert records.count() == 9 and records.select("record_id").distinct().count() == 9
    got = {r["target_uri"]: r for r in warc.assemble(records).collect()}
    assert [got[u]["record_type"] for _, u, _ in rows] == ["response", "revisit", "response"]
    assert bytes(got["c"]["response"]["payload"]) == b"two\r\n\r\n" and got["http://b.example"]["response"]["payload"] is None
    assert got["http://b.example"]["refers_to"] == got["http://a.example/x?y#z"]["capture_id"]
    for page, url, _ in rows:
        assert len(got[url]["requests"]) == len(got[url]["metadata"]) == 1
        assert got[url]["metadata"][0]["fields"] == {"pageid": str(page), "copy": "0"}
    asked = records.filter("record_type = 'request'").select("target_uri", F.col("payload").cast("string")).collect()
    assert len(asked) == 3
    declared = records.filter("record_type = 'response'").select("declared_digest", "payload_digest").collect()
    assert all(d == f"sha1:{p}" for d, p in declared)


def test_archives_are_plain_records(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(1, "http://a.example/x", "é\r\n\r\n")], SCHEMA), str(tmp_path / "w"))
    text = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*")))
    heads = [r.split(b"\r\n\r\n")[0].decode().split("\r\n") for r in text.split(b"WARC/1.1\r\n")[1:]]
    assert sorted(h[0] for h in heads) == ["WARC-Type: metadata", "WARC-Type: request", "WARC-Type: response"]
    assert b"GET /x HTTP/1.1\r\nHost: a.example\r\n\r\n" in text
    assert text.endswith(b"pageId: 1\r\ncopy: 0\r\n\r\n\r\n")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 6\r\n\r\n" + "é\r\n\r\n".encode()
    assert block in text and f"Content-Length: {len(block)}" in next(h for h in heads if h[0].endswith("response"))


def record(kind, own, block=b"", **more):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", *[f"{k.replace('_', '-')}: {v}" for k, v in more.items()], f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.0", *head]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_of_other_writers_in_any_order_and_file(spark, tmp_path):
    http = {"Content_Type": "application/http;msgtype=response"}
    files = {
        "one.warc": [record("warcinfo", "<i>", b"software: x\r\n"), record("request", "<q1>", b"GET"), record("metadata", "<m1>", b"a: 1\r\n b\r\n", WARC_Concurrent_To="<q1>", Content_Type="application/warc-fields")],
        "two.warc.gz": [record("response", "<r1>", b"HTTP/1.1 200\r\n\r\nbody", WARC_Concurrent_To="<q1>", **http), record("response", "<r2>", b"raw\r\n\r\n")],
        "three.warc.gz": [record("metadata", "<m2>", WARC_Concurrent_To="<r2>"), record("metadata", "<m3>", WARC_Concurrent_To="<gone>"), record("request", "<q4>")],
    }
    for name, records in files.items():
        (tmp_path / name).write_bytes(b"".join(gzip.compress(r) if name.endswith("gz") else r for r in records))
    got = {r["capture_id"]: r for r in warc.assemble(written(warc.read_records(spark, str(tmp_path)), "others")).collect()}
    assert got.keys() == {"<r1>", "<r2>", "<m3>", "<q4>", "<i>"}
    assert bytes(got["<r1>"]["response"]["payload"]) == b"body" and bytes(got["<r2>"]["response"]["payload"]) == b"raw\r\n\r\n"
    assert [m["record_id"] for m in got["<r1>"]["requests"]] == ["<q1>"]
    assert [(m["record_id"], m["fields"]) for m in got["<r1>"]["metadata"]] == [("<m1>", {"a": "1 b"})]
    assert [m["record_id"] for m in got["<r2>"]["metadata"]] == ["<m2>"] and got["<r2>"]["requests"] == []
    assert got["<m3>"]["response"] is None and len(got["<m3>"]["metadata"]) == 1 and len(got["<q4>"]["requests"]) == 1
    assert sorted(r["record_type"] for r in warc.digests(warc.assemble(written(warc.read_records(spark, str(tmp_path)), "again"))).collect()) == ["response"] * 2


def test_an_archive_cut_short_is_an_error():
    whole = record("response", "<r>", b"x" * 100_000)
    assert [r[7] for r in warc.parsed(whole)] == [100_000]
    for cut in (whole[:50_000], gzip.compress(whole)[:-30]):
        with pytest.raises(ValueError, match="ends after"):
            list(warc.parsed(cut))
    with pytest.raises(ValueError, match="no record begins"):
        list(warc.parsed(b"hello\r\n"))


def test_large_members_are_read_piece_by_piece():
    rng = random.Random(1)
    payloads = [rng.randbytes(3_000_000), b"\x00" * 5_000_000, b""]
    for content in (b"".join(gzip.compress(record("response", "<r>", p)) for p in payloads), gzip.compress(b"".join(record("response", "<r>", p) for p in payloads))):
        assert [r[8] for r in warc.parsed(content)] == [sha1(p) for p in payloads]
