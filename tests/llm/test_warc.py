import base64
import gzip
import hashlib
import io
import os

from pyspark.sql import functions as F

from enrichkit.llm import warc

TRAP = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (1, "http://a.example/x", "<html>é</html>"),
    (2, "http://a.example/y z\r\n", TRAP),
    (3, None, TRAP),
    (4, "http://b.example/", None),
    (5, "", ""),
    (5, "", ""),
    (None, "u", "<p>only</p>"),
    (6, "u", "x" * 300_000),
    (7, "u", "\r\n\r\n" * 50 + "end"),
]


def write(spark, tmp_table, rows, **options):
    path, out = tmp_table("pages"), tmp_table("archives")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("uid", F.lit("q")).withColumn("_metadata", F.lit(2))
    df.repartition(3).write.parquet(path)
    warc.write_archives(spark, path, out, **options)
    return out


def rows_of(spark, out):
    return warc.captures(warc.read_records(spark, out)).collect()


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_table):
    out = write(spark, tmp_table, PAGES)
    got = rows_of(spark, out)
    assert len(got) == len(PAGES)
    groups = {}
    for i, _, html in PAGES:
        groups.setdefault(html or "", []).append(i)
    responses = {}
    for r in got:
        c, page = r["capture"], r["metadata"][0]["page_id"]
        assert r["request"][0]["http_head"].startswith("GET ")
        if c["type"] == "response":
            html = bytes(c["payload"]).decode()
            assert c["digest_ok"] and c["payload_digest"] == digest(html) and r["original"]["page_id"] == page
            responses[html] = page
        else:
            html = next(h for h in groups if digest(h) == c["payload_digest"])
            assert not c["payload"]
        assert r["original"]["payload_bytes"] == len(html.encode())
        assert (None if page is None else int(page)) in groups[html]
    assert {h: (None if p is None else int(p)) for h, p in responses.items()} == {
        h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()
    }


def test_small_payloads_are_all_responses(spark, tmp_table):
    got = rows_of(spark, write(spark, tmp_table, PAGES, min_bytes=10))
    kinds = {(r["metadata"][0]["page_id"], r["capture"]["type"]) for r in got}
    assert ("4", "response") in kinds and ("5", "response") in kinds and ("2", "revisit") in kinds


def test_archives_are_plain_warc(spark, tmp_table):
    out = write(spark, tmp_table, PAGES, max_records=4)
    files = spark.read.format("binaryFile").load(out).select("content").collect()
    assert len(files) >= 7
    data = b"".join(gzip.decompress(bytes(f["content"])) for f in files)
    kinds = [h["warc-type"] for h, _ in warc.parse_records(io.BytesIO(data))]
    assert sorted(set(kinds)) == ["metadata", "request", "response", "revisit"] and len(kinds) == 3 * len(PAGES)


def test_empty_table(spark, tmp_table):
    assert rows_of(spark, write(spark, tmp_table, [])) == []


def test_hot_page_many_copies(spark, tmp_table):
    rows = [(i, "u", "same" if i % 3 else f"own {i}") for i in range(300)]
    got = rows_of(spark, write(spark, tmp_table, rows))
    revisits = [r for r in got if r["capture"]["type"] == "revisit"]
    assert len(revisits) == 199 and {r["original"]["page_id"] for r in revisits} == {"299"}


def archive(*records):
    out = b""
    for kind, name, headers, block in records:
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *headers, f"Content-Length: {len(block)}"]
        out += "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return out


def read(spark, tmp_table, data):
    folder = tmp_table("foreign").replace("file:", "")
    os.makedirs(folder)
    with open(f"{folder}/a.warc", "wb") as f:
        f.write(data)
    return warc.read_records(spark, folder)


HTTP = b"HTTP/1.1 200 OK\r\n\r\nhello"


def test_all_records_and_links_of_foreign_archives(spark, tmp_table, monkeypatch):
    """Several metadata records, one tied to two captures, ties by either side, a wrong digest, records without a capture."""
    data = archive(
        ("response", "r1", ["WARC-Payload-Digest: sha1:WRONG"], HTTP),
        ("response", "r2", ["WARC-Concurrent-To: <q2>", f"WARC-Payload-Digest: sha1:{digest('hello')}"], HTTP),
        ("request", "q1", ["WARC-Concurrent-To: <r1>"], b"GET /1 HTTP/1.1\r\n\r\n"),
        ("request", "q2", [], b"GET /2 HTTP/1.1\r\n\r\n"),
        ("metadata", "m1", ["WARC-Concurrent-To: <r1>"], b"page-id: 1\r\n"),
        ("metadata", "m2", ["WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <r2>"], b"page-id: 2\r\n"),
        ("metadata", "m3", ["WARC-Concurrent-To: <r1>"], b"page-id: 3\r\n"),
        ("metadata", "m4", ["WARC-Concurrent-To: <nowhere>"], b""),
        ("request", "q3", [], b"GET /3 HTTP/1.1\r\n\r\n"),
    )
    records = read(spark, tmp_table, data)
    got = {r["capture"]["record_id"]: r for r in warc.captures(records).collect()}
    ids = lambda rows: [x["record_id"] for x in rows]
    assert {k: (ids(r["request"]), ids(r["metadata"])) for k, r in got.items()} == {
        "<r1>": (["<q1>"], ["<m1>", "<m2>", "<m3>"]), "<r2>": (["<q2>"], ["<m2>"])
    }
    assert [got[k]["capture"]["digest_ok"] for k in ("<r1>", "<r2>")] == [False, True]
    assert got["<r1>"]["capture"]["payload_digest"] == digest("hello") and got["<r1>"]["capture"]["declared_digest"] == "WRONG"
    assert sorted(r["record_id"] for r in warc.unassembled(records).collect()) == ["<m4>", "<q3>"]
    monkeypatch.setattr(warc, "AT_ONCE", 2)
    parts = [r for r in warc.captures(records).collect() if r["capture"]["record_id"] == "<r1>"]
    assert sorted(x for r in parts for x in ids(r["metadata"])) == ["<m1>", "<m2>", "<m3>"] and len(parts) > 1
