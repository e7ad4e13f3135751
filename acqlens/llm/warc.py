"""Dictionary-compressed WARC archives (``.warc.zst``).

Every page is one WARC/1.1 record: a ``response`` with its HTTP block, or, where
another page has the same payload, a ``revisit`` that refers to it.  Records are
gathered into archives of about ``archive_bytes``.  For each archive a Zstandard
dictionary is trained on all its records; it leads the file in a skippable frame
and every record follows as a frame of its own, so a reader can start at any
record.

An archive is one cell of a table that Spark's Parquet writer commits: files of
failed or repeated tasks never show, on any store.  ``export`` puts the cells out
as files.  Equal payloads are found by SHA-1 with one aggregate, which is stored:
in the join with its rows the pages are shuffled once and adaptive execution
splits a frequent payload.

Edge cases: a null html is an empty payload; a null url gives no target URI;
control characters in a url are percent-encoded; a null page id counts as smaller
than any other and comes back null; rows that share page id and payload have the
same standing; an empty table gives no archive; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from acqlens.llm.common import stored

# Fixed value: the skippable frame that holds a WARC file's dictionary.
SKIPPABLE = 0x184D2A5D
# Fixed value: the profile of revisits that share a payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "<urn:x-page:%s>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) has no payload."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_RECORD_ID % ('' if page_id is None else page_id)}",
             f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_RECORD_ID % refers_to}", f"WARC-Profile: {SAME_PAYLOAD}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}",
              "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compress_archive(records: list[bytes], dict_bytes: int, level: int) -> bytes:
    """Leading dictionary frame, then one frame a record."""
    try:
        trained = zstandard.train_dictionary(dict_bytes, records, k=256, d=8)
    except zstandard.ZstdError:  # too few or too short records to train on
        trained = zstandard.ZstdCompressionDict(b"".join(records)[-dict_bytes:],
                                                dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(level=level)
    one = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    raw = trained.as_bytes()
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(one.compress, records)])


def archive_dictionary(content: bytes) -> tuple[zstandard.ZstdCompressionDict, int]:
    """The dictionary of an archive and where its records begin."""
    magic, size = struct.unpack_from("<II", content)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame in front")
    return zstandard.ZstdCompressionDict(content[8:8 + size]), 8 + size


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive, one after the other."""
    dictionary, start = archive_dictionary(content)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        memoryview(content)[start:], read_across_frames=True), 1 << 16)
    while version := stream.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError("not at a record's start")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("record does not end where its length says")
        yield headers, block


def archives(pages: DataFrame, revisit_from: int = 0, archive_bytes: int = 32 << 20,
             dict_bytes: int = 64 << 10, level: int = 3, date: str = "2020-01-01T00:00:00Z",
             id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(archive, content): payloads of ``revisit_from`` bytes or more that occur
    again are stored once, with the largest page id."""
    body = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    page = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"),
                        body.alias("payload")).withColumn("sha1", F.unhex(F.sha1("payload")))
    last = stored(page.groupBy("sha1").agg(F.max("page").alias("last")), "payloads")
    refers = F.when((F.octet_length("payload") >= revisit_from)
                    & ~F.col("page").eqNullSafe(F.col("last")), F.col("last"))
    rows = page.join(last, "sha1").select("page", "url", "payload", "sha1", refers.alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page_id, url, payload, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                digest = base64.b32encode(sha1).decode()
                held.append(record(page_id, url, payload, digest, refers_to, date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield _cell(f"{task:06d}-{number:05d}", compress_archive(held, dict_bytes, level))
                    number, held, size = number + 1, [], 0
        if held:
            yield _cell(f"{task:06d}-{number:05d}", compress_archive(held, dict_bytes, level))

    return rows.mapInArrow(run, "archive string, content binary")


def _cell(name: str, content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"archive": [f"{name}.warc.zst"], "content": [content]})


def export(cells: DataFrame, folder: str) -> None:
    """Write each archive as a file below ``folder`` (a path or URI that all
    executors reach): under a name of the attempt's own, then renamed."""

    def run(rows) -> None:
        import uuid
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        for row in rows:
            part = f"{base}/.{row.archive}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as f:
                f.write(row.content)
            store.move(part, f"{base}/{row.archive}")

    cells.foreachPartition(run)


PAGES = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])
_ID = re.compile(r"<urn:x-page:(-?\d*)>")


def read_pages(cells: DataFrame) -> DataFrame:
    """Per record of the archives: page, payload's length and digest, type and the
    page a revisit refers to.  The digest of every stored payload is recomputed
    and compared with the header."""

    def number(text: str | None) -> int | None:
        found = _ID.fullmatch(text or "")
        return int(found[1]) if found and found[1] else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(batch.schema.get_field_index("content")):
                out = []
                for headers, block in records(cell.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if headers["warc-type"] == "response":
                        real = base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()
                        if (len(payload), real) != (size, digest):
                            raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
                    out.append((number(headers["warc-record-id"]), size, digest, headers["warc-type"],
                                number(headers.get("warc-refers-to"))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), PAGES)], schema=PAGES)

    return cells.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long")


def write_and_read(pages: DataFrame, **options) -> DataFrame:
    """Archives of ``pages`` in the shared folder, read back page by page."""
    return read_pages(stored(archives(pages, **options), "warc"))
