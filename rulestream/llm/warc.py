"""WARC archives with an index that is read first."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulestream.llm.common import kept
from rulestream.sources.shared import run_folder

INDEX = "archive STRING, offset BIGINT, length BIGINT, url STRING, digest STRING, record_type STRING"
PAGE = re.compile(r"<urn:page:(-?\d+|null)>")
CRLF = b"\r\n"
#: Fixed by the format: the profile of a revisit of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def header(lines: list[tuple[str, object]], first: str) -> bytes:
    """A header block; line ends within values are escaped."""
    clean = ((name, str(value).replace("\r", "%0D").replace("\n", "%0A")) for name, value in lines)
    return "\r\n".join([first, *(f"{name}: {value}" for name, value in clean), "", ""]).encode()


def record(page: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One gzip member: a response with its payload, or a revisit, which has none."""
    name = "<urn:page:{}>".format
    kind = "revisit" if payload is None else "response"
    block = header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)], "HTTP/1.1 200 OK") + (payload or b"")
    lines = [("WARC-Type", kind), ("WARC-Record-ID", name("null" if page is None else page)), ("WARC-Date", date)]
    if url is not None:
        lines.append(("WARC-Target-URI", url))
    lines.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if payload is None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    pack = zlib.compressobj(wbits=31)
    return pack.compress(header(lines, "WARC/1.1") + block + CRLF + CRLF) + pack.flush()


def parsed(raw: bytes) -> dict:
    """What a record of one gzip member says, with its payload's digest checked."""
    data = zlib.decompress(raw, wbits=31)
    head, _, rest = data.partition(CRLF + CRLF)
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if first != "WARC/1.1" or rest[len(block) :] != CRLF + CRLF:
        raise ValueError("Not a whole WARC record")
    http, _, payload = block.partition(CRLF + CRLF)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page, to = (PAGE.fullmatch(fields.get(name, "<urn:page:null>"))[1] for name in ("WARC-Record-ID", "WARC-Refers-To"))
    if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"The payload of {fields['WARC-Record-ID']} is not what its header says")
    return {
        "page_id": None if page == "null" else int(page),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if to == "null" else int(to),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def write_archives(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    smallest: int = 0,
    archive_bytes: int = 256_000_000,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page and return the index: archive, offset, length, url, digest, record_type.

    Of equal payloads of at least ``smallest`` bytes, pages with the smallest key are responses and the
    others revisit it; null keys count as largest, and repeated rows of the smallest key
    are responses each. A null html is an empty payload; a null url is left out of its record.
    Pages move once, without order, and only light rows meet by payload, so that a payload that a third of
    all pages have is no burden. Archives are gzip files of one member per record in the shared
    folder; a task that is run again writes new files, and the index names only those of the
    attempt that Spark kept.
    """
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), body.alias("payload"), F.sha1(body).alias("sha1"))
    light = rows.where(F.octet_length("payload") >= smallest).select("page_id", "sha1")
    first = light.groupBy("sha1").agg(F.min("page_id").alias("refers_to"))
    revisits = light.join(first, "sha1").where("NOT page_id <=> refers_to").distinct()
    revisits = revisits.select(F.col("page_id").alias("_page"), F.col("sha1").alias("_sha1"), "refers_to")
    same = rows["page_id"].eqNullSafe(revisits["_page"]) & (rows["sha1"] == revisits["_sha1"])
    known = rows.join(revisits.hint("shuffle_hash"), same, "left").select(
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("size"),
        F.unhex("sha1").alias("sha1"),
        "refers_to",
    )
    folder = run_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name, file, entries, offset = "", None, [], 0

        def finished() -> pa.RecordBatch:
            file.close()
            return pa.RecordBatch.from_pylist(entries, schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                if file is None:
                    name, entries, offset = f"{uuid.uuid4().hex}.warc.gz", [], 0
                    file = system.open_output_stream(f"{base}/{name}", compression=None)
                digest = base64.b32encode(row["sha1"]).decode()
                raw = record(row["page_id"], row["url"], row["payload"], row["size"], digest, row["refers_to"], date)
                file.write(raw)
                kind = "response" if row["refers_to"] is None else "revisit"
                entries.append(
                    {"archive": f"{folder}/{name}", "offset": offset, "length": len(raw), "url": row["url"], "digest": digest, "record_type": kind}
                )
                offset += len(raw)
                if offset >= archive_bytes:
                    yield finished()
                    file = None
        if file is not None:
            yield finished()

    text, number = pa.string(), pa.int64()
    kinds = (text, number, number, text, text, text)
    schema = pa.schema([(part.split()[0], kind) for part, kind in zip(INDEX.split(", "), kinds, strict=True)])
    return kept(known.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, *, gap: int = 65_536, most: int = 8_000_000, payload: bool = False) -> DataFrame:
    """The records that rows of an index name, read back and checked.

    Rows are dealt out by stretches of archives and sorted by offset; ranges at most ``gap`` bytes apart are
    read together, up to ``most`` bytes at a time. Returns page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, and the payload if asked for (null for a revisit).
    """
    ddl = "page_id BIGINT, url STRING, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = pa.schema([(part.split()[0], kind) for part, kind in zip(ddl.split(", "), kinds, strict=True)])
    if payload:
        ddl, schema = f"{ddl}, payload BINARY", schema.append(pa.field("payload", pa.binary()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fetched(archive: str, ranges: list[tuple[int, int]]) -> pa.RecordBatch:
            system, path = pafs.FileSystem.from_uri(archive)
            start = ranges[0][0]
            with system.open_input_file(path) as file:
                data = file.read_at(max(a + n for a, n in ranges) - start, start)
            rows = [parsed(data[a - start : a - start + n]) for a, n in ranges]
            return pa.RecordBatch.from_pylist([{c: row[c] for c in schema.names} for row in rows], schema=schema)

        archive, ranges = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            for name, offset, length in zip(*columns, strict=True):
                if ranges and (
                    name != archive or offset > sum(ranges[-1]) + gap or offset + length - ranges[0][0] > most
                ):
                    yield fetched(archive, ranges)
                    ranges = []
                archive = name
                ranges.append((offset, length))
        if ranges:
            yield fetched(archive, ranges)

    stretch = F.floor(F.col("offset") / (4 * most))
    dealt = index.repartition("archive", stretch).sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(read, ddl)
