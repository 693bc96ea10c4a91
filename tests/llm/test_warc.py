import hashlib
import zlib

import pytest

from tests.conftest import DATA
from tierline.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, n int, header string"


def brute(rows):
    out = []
    for k, (i, _, h) in enumerate(rows):
        data = (h or "").encode()
        group = [j for j, (_, _, g) in enumerate(rows) if (g or "").encode() == data]
        first = min(group, key=lambda j: (rows[j][0] is None, rows[j][0] or 0, rows[j][1] is not None, rows[j][1] or "", j))
        lead = len(data) < 100 or k == first
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if lead else "revisit", None if lead else rows[first][0]))
    return sorted(out, key=repr)


def run(spark, place, rows):
    df = spark.createDataFrame([(*r, "d", 1, "h") for r in rows], SCHEMA)
    warc.write_archive(df, place("archive"))
    found = warc.read_archive(spark, place("archive")).collect()
    number = lambda x: None if x is None else int(x)
    return found, sorted(((number(r.page), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found), key=repr)


def test_round_trip(spark, place):
    long = "<p>é中😀</p>" * 20
    rows = [
        (3, "http://a/é?x=1#y", long), (1, "http://b/", long), (2, None, long), (5, "http://c/", "short"), (4, "http://c/", "short"), (6, "u", None), (7, "u", ""),
        (8, "http://d/\r\nX: y", long + "x"), (9, "", long + "x"), (9, "", long + "x"), (9, None, long + "x"), (None, "n", long), (None, "m", "z" * 200), (-4, "k", "y" * 100),
        (-3, "k", "y" * 100), (11, "k", "y" * 99), (10, "k", "y" * 99),
    ]
    found, got = run(spark, place, rows)
    assert got == brute(rows)
    assert len({r.record_id for r in found}) == len(rows)
    html = {(i, hashlib.sha256((h or "").encode()).hexdigest()): (h or "").encode() for i, _, h in rows}
    for r in found:
        assert bytes(r.payload) == html[(None if r.page is None else int(r.page), r.payload_digest)]
        head, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert rest.endswith(b"\r\n\r\n") and len(rest) - 4 == int(named["Content-Length"])
        assert rest[:-4].endswith(bytes(r.payload)) if r.record_type == "response" else rest[:-4].endswith(b"\r\n\r\n")


def test_payloads_are_stored_once(spark, place):
    rows = [(i, "u", "same page " * 50) for i in range(20)] + [(20, "u", "other")]
    run(spark, place, rows)
    assert spark.read.parquet(place("archive") + "/payloads").count() == 2
    assert spark.read.parquet(place("archive") + "/headers").count() == 21


def test_table(spark, place):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert run(spark, place, rows)[1] == brute(rows)


def test_empty(spark, place):
    assert run(spark, place, [])[1] == []


def test_a_damaged_payload_fails(spark, place):
    df = spark.createDataFrame([(1, "u", "page " * 50, "d", 1, "h")], SCHEMA)
    warc.write_archive(df, place("archive"))
    from pyspark.sql import functions as F

    stored = spark.read.parquet(place("archive") + "/payloads").withColumn("packed", F.lit(bytearray(zlib.compress(b"other"))))
    stored.write.parquet(place("damaged") + "/payloads")
    spark.read.parquet(place("archive") + "/headers").write.parquet(place("damaged") + "/headers")
    with pytest.raises(Exception, match="has digest"):
        warc.read_archive(spark, place("damaged")).collect()
