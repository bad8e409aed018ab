"""WARC archives: format, dictionary frame and round trip."""

import base64
import hashlib
import struct
from collections import Counter

import pytest

from voltledger.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def index(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return warc.archive_and_index(df, **options)


def test_odd_rows(spark):
    rows = [(3, "http://a/3", "same"), (1, "http://a/1\r\nX: y", "same"), (2, None, None), (4, "", ""), (None, "u", "same"),
            (5, "http://a/5%", "ünï" * 50_000), (6, "u", "six"), (6, "u", "six")]
    found = index(spark, rows).collect()
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
    for r in found:
        assert r.payload_bytes == len(payload[r.page_id])
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload[r.page_id]).digest()).decode()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in found), key=str)
    assert kinds == sorted([(1, "response", None), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None), (4, "revisit", 2),
                            (5, "response", None), (6, "response", None), (6, "revisit", 6)], key=str)
    assert {r.page_id: r.url for r in found}[1] == "http://a/1\r\nX: y"


def test_short_payloads_below_the_limit_are_all_responses(spark):
    found = index(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], min_revisit_bytes=3).collect()
    assert {r.page_id: r.record_type for r in found} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert index(spark, []).collect() == []


def test_archives_carry_their_dictionary(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = f"file://{tmp_path}/archives"
    warc.write_archives(pages, path, sample_bytes=50_000)
    seen = []
    for file in (tmp_path / "archives").glob("part-*"):
        content = file.read_bytes()
        if not content:
            continue
        magic, size = struct.unpack_from("<II", content)
        assert magic == 0x184D2A5D and content[8:12] == warc.ZSTD_DICT_MAGIC and 0 < size <= warc.DICT_BYTES
        for raw in warc.frames_of(content):
            assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
            seen.append(warc.parse(raw))
    html = {r.page_id: r.html for r in pages.collect()}
    assert {s["page_id"]: s["payload"].decode() for s in seen} == html
    assert sum(f.stat().st_size for f in (tmp_path / "archives").glob("part-*")) < sum(map(len, html.values())) / 2


def test_damage_is_noticed():
    raw = warc.record(1, 0, "u", b"payload", None, False, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"payload", b"poyload"))


def test_dictionary_of_few_records_is_raw_content():
    content = warc.dictionary([b"one record"], 1000)
    assert not content.startswith(warc.ZSTD_DICT_MAGIC) and content
