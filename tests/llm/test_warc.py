"""Archives written and read back, against hashlib."""

from __future__ import annotations

import base64
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tariffa.llm import warc
from tariffa.session import new_table_path

ROWS = [
    (5, "http://a/", "<p>x</p>", "d"),
    (3, "http://b/", "<p>x</p>", "d"),
    (3, "http://b/", "<p>x</p>", "d"),
    (8, None, None, "d"),
    (9, "http://c/\r\nWARC-Type: response\r\n", "", "d"),
    (None, "http://d/", "<p>x</p>", "d"),
    (None, "http://e/", "öäü\r\n\r\nWARC/1.1\r\n\r\n€", "d"),
    (1, "http://f/", "y" * 300_000, "d"),
]
SCHEMA = "page_id long, url string, html string, digest string"


def test_records_come_back(spark):
    found = warc.archive_and_read(spark.createDataFrame(ROWS, SCHEMA)).collect()
    by_payload = {}
    for i, _, html, _ in ROWS:
        by_payload.setdefault((html or "").encode(), []).append(i)
    want = []
    for payload, ids in by_payload.items():
        sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is None, i))
        want.append((ids[0], len(payload), sha1, "response", None))
        want += [(i, len(payload), sha1, "revisit", ids[0]) for i in ids[1:]]
    got = [tuple(r[c] for c in ("id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in found:
        record, payload = bytes(r["record"]), bytes(r["payload"])
        head, rest = record.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest.endswith(b"\r\n\r\n")
        assert len(rest) - 4 == r["content_length"]
        http, body = rest[:-4].split(b"\r\n\r\n", 1)
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        assert body == (payload if r["record_type"] == "response" else b"")


def test_payloads_are_stored_once_and_small_ones_never_revisit(spark):
    folder = warc.write_archive(spark.createDataFrame(ROWS, SCHEMA), new_table_path(spark, "archive"), min_bytes=5)
    assert spark.read.parquet(os.path.join(folder, "payloads")).count() == len({(h or "").encode() for _, _, h, _ in ROWS})
    parsed = warc.parse_records(warc.read_records(spark, folder))
    assert parsed.filter("octet_length(payload) < 5 and record_type = 'revisit'").count() == 0
    assert parsed.filter("record_type = 'revisit'").count() == 3


def test_a_damaged_payload_is_an_error(spark):
    folder = warc.write_archive(spark.createDataFrame(ROWS[:2], SCHEMA), new_table_path(spark, "archive"))
    store = os.path.join(folder, "payloads")
    damaged = spark.createDataFrame(
        [(r["digest"], b"other") for r in spark.read.parquet(store).collect()], "digest string, payload binary"
    )
    damaged.write.mode("overwrite").parquet(store)
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_records(spark, folder).collect()


def test_a_payload_that_most_records_revisit_is_digested_once(spark):
    rows = [(i, f"http://{i}/", "z" * 5000 if i % 3 else f"own {i}", "d") for i in range(300)]
    folder = warc.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(4), new_table_path(spark, "archive"))
    records = warc.read_records(spark, folder)
    # below the join, not above it
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join") < plan.index("sha1(")
    parsed = warc.parse_records(records)
    hot = parsed.filter("payload_bytes = 5000")
    assert hot.count() == 200 and hot.filter("record_type = 'response'").first()["id"] == 1
    assert hot.filter("octet_length(record) > 5000").count() == 1
    assert {r[0] for r in hot.select("payload_sha1").collect()} == {base64.b32encode(hashlib.sha1(b"z" * 5000).digest()).decode()}


def test_empty_table(spark):
    assert warc.archive_and_read(spark.createDataFrame([], SCHEMA)).count() == 0


def test_base32_of_sha1(spark):
    for text in ("", "abc", "ä" * 1000):
        want = base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        assert spark.range(1).select(warc.sha1_base32(F.encode(F.lit(text), "UTF-8"))).first()[0] == want
