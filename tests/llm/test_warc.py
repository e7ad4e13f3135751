import base64
import hashlib
import struct

import zstandard
from conftest import same_rows
from hypothesis import given, settings, strategies as st

from acqlens.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 string, refers string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_round_trip_with_copies_nulls_and_long_pages(spark):
    long = "é<p>" * 60_000
    rows = [(i, f"http://x/{i}", "copy" if i % 3 == 0 else f"page {i} " * i) for i in range(120)]
    rows += [(200, None, None), (201, "http://x/\r\nWARC-Type: forged", ""), (202, "u", long), (203, "u", long)]
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), i)
    want = [(i, len((h or "").encode()), sha(h), "response" if last[h or ""] == i else "revisit",
             None if last[h or ""] == i else last[h or ""]) for i, _, h in rows]
    for options in ({}, {"archive_bytes": 5_000}):
        same_rows(warc.write_and_read(pages(spark, rows), **options), want)


def test_small_payloads_are_not_revisited(spark):
    got = warc.write_and_read(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]),
                              revisit_from=3)
    same_rows(got, [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)],
              ["page_id", "record_type", "refers_to"])


def test_null_ids_repeated_rows_and_empty_table(spark):
    got = warc.write_and_read(pages(spark, [(None, "u", "a"), (5, "u", "a"), (5, "u", "a"), (None, "u", "b")]))
    same_rows(got, [(None, "revisit", 5), (5, "response", None), (5, "response", None), (None, "response", None)],
              ["page_id", "record_type", "refers_to"])
    assert warc.write_and_read(pages(spark, [])).count() == 0


def test_layout_dictionary_first_and_a_frame_a_record(spark):
    rows = [(i, f"http://x/{i}", f"<html><body>some shared boilerplate {i % 7} and {i} words</body></html>" * 3)
            for i in range(300)]
    cells = warc.archives(pages(spark, rows).coalesce(1)).collect()
    content = max((c.content for c in cells), key=len)
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D and size > 0
    dictionary, at = warc.archive_dictionary(content)
    assert at == 8 + size and dictionary.dict_id() != 0
    frames, rest = 0, bytes(content[at:])
    while rest:  # every record can be decompressed by itself
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
        frames, rest = frames + 1, one.unused_data
    assert frames == len(list(warc.records(content)))


def test_export_writes_readable_files(spark, tmp_path):
    rows = [(i, "u", f"text {i}") for i in range(50)]
    cells = warc.archives(pages(spark, rows))
    warc.export(cells, tmp_path.as_uri())
    files = list(tmp_path.glob("*.warc.zst"))
    assert files and not list(tmp_path.glob(".*"))
    read = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst").select("path", "content")
    assert {r.page_id for r in warc.read_pages(read).collect()} == set(range(50))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=200), min_size=1, max_size=20))
def test_any_payload_survives(payloads):
    made = [warc.record(i, "http://x", p, sha("x"), None, "2020-01-01T00:00:00Z") for i, p in enumerate(payloads)]
    back = [b.partition(b"\r\n\r\n")[2] for _, b in warc.records(warc.compress_archive(made, 4096, 3))]
    assert back == payloads


def test_frequent_payload_is_split(spark):
    conf = {"spark.sql.shuffle.partitions": "64",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096"}
    old = {k: spark.conf.get(k, None) for k in conf}
    rows = [(i, f"http://x/{i}", "parked" if i % 3 == 0 else f"page {i}") for i in range(30_000)]
    df = pages(spark, rows).repartition(8)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = warc.archives(df)
        found = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert sum(1 for c in found for _ in warc.records(bytes(c.content))) == 30_000
