import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from llm.warc import MAGIC, _leave, read_archives, write_archives
from tidymart.session import scratch_path

SCHEMA = "page_id long, url string, html string, refers_to long, kind string, file string"
FAKE = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def pages(spark, texts, first=1):
    rows = [(*(t if isinstance(t, tuple) else (first + i, t)), 5, "k", "f") for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, "http://x/\r\nWARC/1.0\r\n", h, r, k, f) for i, h, r, k, f in rows], SCHEMA)


def expected(rows, least=0):
    first = {}
    for i, h in rows:
        first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, h in rows:
        data = (h or "").encode()
        again = len(data) >= least and first[h or ""] != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out)


TEXTS = ["<p>é</p>", "", None, FAKE, "<p>é</p>", f"x{FAKE}{FAKE}y\r\n\r\n", MAGIC, MAGIC * 3, "WARC/1.0\r\nContent-Length: 0\r\n\r\n", FAKE, "\r\n\r\n", "a" * 70000, "<p>é</p>"]


@pytest.mark.parametrize("least", [0, 9])
@pytest.mark.parametrize("block", ["128m", "4k", "300"])
def test_round_trip_keeps_look_alikes_inside_payloads(spark, least, block):
    texts = TEXTS + [f"page {i} " + "z" * (i * 37 % 900) + (FAKE if i % 5 == 0 else "") for i in range(60)]
    path = scratch_path(spark, "warc")
    write_archives(pages(spark, texts).coalesce(2), path, least)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = read_archives(spark, path)
        assert sorted(map(tuple, found.collect())) == expected([(i + 1, t) for i, t in enumerate(texts)], least)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_archive_is_plain_records(spark):
    path = scratch_path(spark, "warc")
    write_archives(pages(spark, ["ab", "ab"]).coalesce(1), path)
    data = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    assert data.count(MAGIC) == 2 and data.endswith("\r\n\r\n") and "Content-Length: 2\r\n\r\nab\r\n\r\n" in data
    assert "WARC-Refers-To: <urn:page:1>\r\n" in data and "%0D%0AWARC/1.0%0D%0A" in data


def test_null_ids_repeated_rows_and_empty_table(spark):
    path = scratch_path(spark, "warc")
    write_archives(pages(spark, [(None, "q"), (3, "r"), (3, "r"), (4, "r")]), path)
    found = read_archives(spark, path).select("page_id", "record_type", "refers_to").collect()
    want = [(None, "response", None), (3, "response", None), (3, "response", None), (4, "revisit", 3)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    empty = scratch_path(spark, "warc")
    write_archives(pages(spark, ["a"]).limit(0), empty)
    assert read_archives(spark, empty).count() == 0


def test_a_chain_ends_at_damage(spark):
    path = scratch_path(spark, "warc")
    good = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nhi"
    bad = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:2>\r\nContent-Length: 999\r\n\r\nhi"
    rows = spark.createDataFrame([(0, good), (1, bad), (2, good.replace("page:1", "page:3"))], "i int, value string").coalesce(1).sortWithinPartitions("i")
    rows.select(F.col("value")).write.option("lineSep", "\r\n\r\n").text(path)
    assert 3 not in [r["page_id"] for r in read_archives(spark, path).collect()]


def test_local_chain():
    assert _leave([0, 10, 20, 30], [10, 30, 25, 50], 40) == [50, 50, 25, 50]
