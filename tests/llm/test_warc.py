import hashlib
import re

import pytest
from pyspark.sql import functions as F

from logweave.llm import warc
from logweave.llm.common import new_path

LONG = "<p>" + "ünïcödé 😀 " * 40 + "</p>"
PAGES = [(7, "http://a/7", LONG), (3, "http://a/3", LONG), (9, None, LONG), (3, "http://a/3", LONG), (1, "http://a/1", "short"),
         (2, "http://a\r\nX: y", "short"), (4, "u", None), (5, "u", ""), (None, "u", LONG), (None, "u", "only without id " * 20),
         (6, "u", "x" * 100), (8, "u", "x" * 100), (10, "u", "y" * 99), (11, "u", "y" * 99), (12, "u", "z" * 300_000)]


def frame(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in ("id", "digest", "payload", "key", "first_id", "header", "date")})


def expected(rows=PAGES):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in data:
        if i is not None and i < first.get(b, i + 1):
            first[b] = i
    out = []
    for i, b in data:
        again = len(b) >= 100 and i != first.get(b)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def test_archive_against_brute_force(spark):
    path = new_path(spark, "test-warc")
    warc.write_archive(frame(spark), path)
    rows = warc.read_archive(spark, path)
    got = [tuple(r) for r in rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == expected()
    # Each payload is stored once, and every record resolves to its own bytes.
    stored = [bytes(r.payload) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert sorted(stored) == sorted({(h or "").encode() for _, _, h in PAGES})
    back = sorted(((r.page_id, bytes(r.payload)) for r in warc.payloads(spark, path).collect()), key=str)
    assert back == sorted(((i, (h or "").encode()) for i, _, h in PAGES), key=str)


def test_records_have_the_fields_of_the_format(spark):
    path = new_path(spark, "test-warc")
    warc.write_archive(frame(spark).withColumn("seen", F.expr("timestamp'2020-02-03 04:05:06'")), path, date="seen")
    records = warc.record_bytes(spark, path).collect()
    assert len(records) == len(PAGES)
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and fields["WARC-Date"] == "2020-02-03T04:05:06Z"
        assert {"WARC-Type", "WARC-Record-ID", "Content-Length"} <= set(fields) and rest.endswith(b"\r\n\r\n")
        assert len(rest) - 4 == int(fields["Content-Length"])
    path = new_path(spark, "test-warc")
    warc.write_archive(frame(spark), path)
    assert all(re.search(r"\r\nWARC-Date: \d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\r\n", r.header) for r in warc.read_archive(spark, path).collect())


def test_empty_table_and_damage(spark):
    path = new_path(spark, "test-warc")
    warc.write_archive(frame(spark).limit(0), path)
    assert warc.read_archive(spark, path).count() == 0
    path, broken = new_path(spark, "test-warc"), new_path(spark, "test-warc")
    warc.write_archive(frame(spark), path)
    spark.read.parquet(f"{path}/headers").write.parquet(f"{broken}/headers")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.expr("payload || X'00'")).write.parquet(f"{broken}/payloads")
    with pytest.raises(Exception, match="missing or damaged"):
        warc.read_archive(spark, broken).collect()
