from __future__ import annotations

import base64
import gzip
import hashlib
import random
from collections import Counter
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from rulestream.llm.warc import parsed, read_records, record, write_archives

SCHEMA = "page_id BIGINT, url STRING, html STRING, digest STRING, record_type STRING, size STRING, refers_to STRING"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


ROWS = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/\r\nWARC-Type: fake", "<p>one</p>"),
    (3, None, None),
    (4, "http://d/", ""),
    (5, "http://e/", "WARC/1.1\r\n\r\nbody \U0001f44d é\r\n\r\n\r\n"),
    (6, "http://f/", "long " * 200_000),
    (7, "http://g/", "<p>one</p>"),
    (7, "http://g/", "<p>one</p>"),
    (None, "http://none/", "<p>one</p>"),
    (None, "http://none/", "alone"),
    (0, "http://zero/", "twice"),
    (0, "http://zero/", "twice"),
]


def expected(rows, smallest=0):
    first, out = {}, Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None:
            first[raw] = min(first.get(raw, page), page)
    for page, _, html in rows:
        raw = (html or "").encode()
        to = first.get(raw, page) if len(raw) >= smallest else page
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[(page, len(raw), digest, "response", None) if to == page else (page, len(raw), digest, "revisit", to)] += 1
    return out


def found(records):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return Counter(tuple(r) for r in records.select(*columns).collect())


@pytest.mark.parametrize("smallest", [0, 6])
def test_pages_come_back_as_written(spark, smallest):
    rng = random.Random(1)
    rows = ROWS + [(100 + i, f"http://h/{i}", f"page {rng.randrange(60)}") for i in range(200)]
    index = write_archives(pages(spark, rows), smallest=smallest, archive_bytes=2_000)
    assert found(read_records(index)) == expected(rows, smallest)
    assert found(read_records(index, gap=0, most=1)) == expected(rows, smallest)
    payloads = {r.page_id: r.payload for r in read_records(index, payload=True).where("record_type = 'response'").collect()}
    assert payloads[5] == bytearray(ROWS[4][2].encode()) and payloads[6] == bytearray(ROWS[5][2].encode())


def test_the_index_gives_single_records_and_archives_are_whole(spark):
    index = write_archives(pages(spark, ROWS))
    one = read_records(index.where("url = 'http://e/'"), payload=True).collect()
    assert [(r.page_id, r.url, r.payload) for r in one] == [(5, "http://e/", bytearray(ROWS[4][2].encode()))]
    for row in index.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("parts")).collect():
        with open(urlparse(row.archive).path, "rb") as file:
            raw = file.read()
        parts = sorted(tuple(p) for p in row.parts)
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert len(raw) == sum(n for _, n in parts)
        assert gzip.decompress(raw).count(b"WARC-Record-ID: ") >= len(parts)


def test_no_pages(spark):
    assert read_records(write_archives(pages(spark, []))).collect() == []


def test_damage_is_noticed():
    raw = record(1, "http://a/", b"payload", 7, base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, "1970-01-01T00:00:00Z")
    assert parsed(raw)["payload"] == b"payload"
    wrong = record(1, "http://a/", b"payloaD", 7, base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="not what its header says"):
        parsed(wrong)
