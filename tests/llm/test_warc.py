import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from reelgap.llm import catalogue, warc

ROWS = [
    (5, "http://a.example/x?y#z", "same"),
    (3, "https://b.example", "same"),
    (9, None, "same"),
    (1, "http://c.example/", None),
    (2, "http://c.example/2", ""),
    (7, "http://ü.example/\r\nInjected: yes", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nünï"),
    (8, "u", "x" * 200_000),
    (None, "http://d.example/", "other"),
    (None, "http://d.example/", "same"),
    (4, "http://e.example/", "twice"),
    (4, "http://e.example/", "twice"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None and len(data) >= least]
        again = bool(ids) and page != min(ids)
        out.append((page, len(data), digest(html), "revisit" if again else "response", min(ids) if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("id", F.lit(1))
    for least in (0, 3, 1000):
        warc.write(pages, f"file://{tmp_path}/{least}", min_bytes=least)
        out = catalogue.warc_digest(warc.captures(warc.read(spark, f"file://{tmp_path}/{least}")))
        assert sorted(map(tuple, out.collect()), key=str) == expected(ROWS, least)


def test_captures_are_whole(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:7], "page_id long, url string, html string")
    warc.write(pages, f"file://{tmp_path}/a")
    got = {r.metadata.page_id: r for r in warc.captures(warc.read(spark, f"file://{tmp_path}/a", with_payload=True)).collect()}
    assert len(got) == 7 and all(r.request and r.response.intact for r in got.values())
    assert bytes(got[7].response.payload).decode() == ROWS[5][2] and got[7].response.target_uri == "http://ü.example/%0D%0AInjected: yes"
    assert got[9].response.target_uri is None and got[9].response.refers_to == got[3].response.record_id and got[9].response.payload is None


def test_empty_table(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/e")
    assert warc.captures(warc.read(spark, f"file://{tmp_path}/e")).count() == 0


def test_a_lone_record(spark):
    lone = spark.createDataFrame([("<r>", "request", "<gone>", None, None, None, None, None, True, None)], warc.RECORD)
    row = warc.captures(lone).collect()[0]
    assert row.capture_id == "<gone>" and row.response is None and row.request.record_id == "<r>"


def records(n, size=10):
    out = []
    for i in range(n):
        body = b"HTTP/1.1 200 OK\r\n\r\n" + bytes([97 + i % 26]) * size
        out.append(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n" % (i, len(body)) + body + b"\r\n\r\n")
    return out


@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_members_and_pieces(piece):
    for n, size in ((0, 0), (1, 0), (3, 5), (40, 300), (2, 3_000_000)):
        own = records(n, size)
        for data in (b"".join(own), gzip.compress(b"".join(own)), b"".join(map(gzip.compress, own)), b"".join(gzip.compress(x) + b"\0\0" for x in own)):
            if size > 1000 and piece < 1000:
                continue
            got = [(f["warc-record-id"], len(b)) for f, b in warc.walk(warc.inflated(data, piece))]
            assert got == [(f"<{i}>", 19 + size) for i in range(n)], (n, size)
    with pytest.raises(ValueError):
        list(warc.walk([records(1)[0][:-20]]))
    with pytest.raises(ValueError):
        list(warc.walk([b"no archive\r\n\r\n"]))


def test_reads_an_archive_with_a_member_for_each_record(spark, tmp_path):
    (tmp_path / "part-0.warc.gz").write_bytes(b"".join(map(gzip.compress, records(500, 2000))))
    (tmp_path / "part-1.warc").write_bytes(b"".join(records(3)))
    got = warc.read(spark, f"file://{tmp_path}", with_payload=True).collect()
    assert len(got) == 503 and sum(len(r.payload) for r in got) == 500 * 2000 + 30


def test_large_pages_have_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE", 4000)
    monkeypatch.setattr(warc, "LARGE", 1000)
    rows = [(i, f"http://x.example/{i}", "y" * 5000 + str(i) if i % 3 == 0 else f"small {i}") for i in range(30)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/a")
    assert len(list((tmp_path / "a").glob("part-*"))) >= 10 + 20 / 4
    out = catalogue.warc_digest(warc.captures(warc.read(spark, f"file://{tmp_path}/a")))
    assert sorted(map(tuple, out.collect()), key=str) == expected(rows, 0)
