import base64
import hashlib

from pyspark.sql import functions as F

from carelake.llm import arc
from carelake.llm.common import shared_path

PAGES = "page_id long, url string, html string, header string, refers_to long"
TRAP = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nfiledesc://a 1 1 1 1\nhttp://x 0 0 t 9\n\n"


def test_round_trip_of_odd_pages(spark):
    rows = [(1, "http://a/ b", "same"), (2, "http://b/", "same"), (9, None, "same"), (3, "u", None), (4, "", ""),
            (5, "http://c/", TRAP), (6, "http://d/", TRAP), (7, "http://e/", "é漢\r\n\n" * 5000),
            (8, "http://f/", "x" * 300_000), (None, "http://g/", "alone"), (10, "http://h/", "twice"),
            (10, "http://h/", "twice")]
    pages = spark.createDataFrame([(*r, "clash", 5) for r in rows], PAGES)
    got = arc.archive_pages(pages).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    for g in got:
        text = next(h or "" for i, _, h in rows if i == g.key)
        data = text.encode()
        assert g.payload_bytes == len(data)
        assert g.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if g.record_type == "revisit":
            assert g.refers_to == largest[text]
        else:
            assert g.refers_to is None and (-1 if g.key is None else g.key) == largest[text]
    assert sorted(g.record_type for g in got).count("response") == len(largest)


def test_empty_table(spark):
    assert arc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def parsed(data: bytes, name: str = "f.arc"):
    return list(arc.parse_arc(name, arc.Lines(iter(data.rstrip(b"\n").split(b"\n")))))


def test_versions_and_damage():
    said1 = b"1 0 org\nURL IP-address Archive-date Content-type Archive-length\n"
    one = (b"filedesc://a 0.0.0.0 20010203040506 text/plain %d\n%s\n" % (len(said1), said1)
           + b"http://x/a b 1.2.3.4 20010203040506 text/html 23\nHTTP/1.0 200 OK\r\n\r\nbody\n"
           + b"not a header line\n"
           + b"dns:x 1.2.3.4 2001 text/dns 4\nabcd\n"
           + b"http://x/cut 1.2.3.4 bad text/html 500\nHTTP/1.0 200 OK\r\n")
    r = parsed(one)
    assert [x[1] for x in r] == ["warcinfo", "response", "resource", "response"]
    assert r[1][2] == "http://x/a b" and r[1][4] == "2001-02-03T04:05:06Z" and r[1][7] == b"body"
    assert r[2][4] == "2001-01-01T00:00:00Z" and r[2][7] == b"abcd"
    assert r[3][4].startswith("1970") and r[3][12] is True
    said2 = b"2 0 org\n" + arc.ARC_FIELDS[2].encode() + b"\n"
    two = (b"filedesc://a 0.0.0.0 20010203040506 text/plain 200 - - 0 a.arc %d\n%s\n" % (len(said2), said2)
           + b"http://x/ 1.2.3.4 20010203040506 text/html 200 sum - 77 a.arc 4\n\xff\x00\n\xfe\n")
    r = parsed(two)
    assert [x[13] for x in r] == [2, 2] and r[1][7] == b"\xff\x00\n\xfe"
    assert parsed(two)[1][0] == r[1][0] != parsed(two, "g.arc")[1][0]  # ids are of the file and the place


def test_warc_files_are_whole(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    a, w = shared_path(spark, "arc"), shared_path(spark, "warc")
    arc.write_arc(pages, a)
    records = arc.read_arc(spark, a)
    assert {r[0] for r in records.select("arc_version").distinct().collect()} <= {1, 2}
    arc.write_warc(arc.mark_revisits(records, arc.page_key(F.col("header"))), w)
    back = arc.read_warc(spark, w)
    assert back.where("not block_intact").count() == 0
    assert back.where("type in ('response', 'revisit')").count() == pages.count()
    assert back.where("type = 'warcinfo'").count() >= 1
    assert spark.read.text(w, wholetext=True).first()[0].startswith("WARC/1.1\r\nWARC-Type: ")


def test_plain_files_are_read_whole_however_they_are_split(spark, tmp_path):
    said = b"2 0 org\n" + arc.ARC_FIELDS[2].encode() + b"\n"
    want = set()
    for f in range(3):
        data = b"filedesc://a 0.0.0.0 20010203040506 text/plain 200 - - 0 a.arc %d\n%s\n" % (len(said), said)
        for i in range(300):
            body = b"HTTP/1.0 200 OK\r\n\r\n" + b"line %d of %d\n" % (i, f) * (i % 50)
            data += b"http://x/%d/%d 1.2.3.4 20010203040506 text/html 200 s - 77 a.arc %d\n%s\n" % (f, i, len(body), body)
            want.add((f"http://x/{f}/{i}", body[19:], False))
        (tmp_path / f"{f}.arc").write_bytes(data)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = arc.read_arc(spark, f"file://{tmp_path}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {(r.uri, bytes(r.payload), r.truncated) for r in rows if r.type == "response"} == want
    assert len(rows) == 903 and {r.arc_version for r in rows} == {2}
