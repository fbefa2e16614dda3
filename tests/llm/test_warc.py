"""WARC round trip: what is read back from the archives is what was given."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections import Counter

import pytest

from stratalake.llm import warc

SCHEMA = "page_id long, url string, html string, first string, chunk int, payload string"


@pytest.fixture
def pages(spark):
    return lambda *rows: spark.createDataFrame([(i, f"http://x/{i}\r\nX: y", h, "f", 1, "p") for i, h in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def check(found, made, least=0):
    first = {}
    for i, h in sorted(made):
        first.setdefault(h or "", i)
    want = []
    for i, h in made:
        size = len((h or "").encode())
        response = first[h or ""] == i or size < least
        want.append((i, size, digest(h), "response" if response else "revisit", None if response else first[h or ""]))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("chunk_bytes", [3, 1 << 20])
def test_round_trip(pages, chunk_bytes):
    made = [(i, h) for i, h in enumerate(["a", "b\r\n\r\nWARC/1.1\r\n", "a", "", None, "é𝄞" * 5, "é𝄞" * 5, "x\r\n\r\n", "\r\n"])]
    check(warc.archive(pages(*made), chunk_bytes=chunk_bytes).collect(), made)


def test_long_payloads_are_chunked(pages):
    made = [(1, "<p>abc</p>" * 300_000), (2, "short"), (3, "<p>abc</p>" * 300_000), (4, "q" * 1_048_576)]
    check(warc.archive(pages(*made)).collect(), made)
    rows = warc.chunks(warc.records(pages(*made))).collect()
    assert Counter(r["page_id"] for r in rows) == {1: 3, 2: 1, 3: 1, 4: 1} and max(len(r["bytes"] or b"") for r in rows) <= warc.CHUNK_BYTES


def test_small_payloads_may_all_be_responses(pages):
    made = [(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd")]
    check(warc.archive(pages(*made), least_bytes=3).collect(), made, least=3)


def test_odd_pages(pages):
    found = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive(pages((None, "a"), (5, "a"), (5, "a"), (None, "z"), (None, "z"))).collect())
    assert found == {(None, "revisit", 5): 1, (5, "response", None): 2, (None, "response", None): 2}
    assert warc.archive(pages()).collect() == []


def test_archives_are_gzip_members_of_whole_records(spark, pages, tmp_path):
    manifest = warc.write(pages((1, "body"), (2, "body")), str(tmp_path / "warc")).collect()
    data = b"".join(gzip.decompress(open(r["archive"], "rb").read()) for r in manifest)
    assert data.count(b"WARC/1.1\r\n") == 2 == sum(r["records"] for r in manifest)
    assert b"Content-Length: 4\r\n" in data and b"\r\n\r\nbody\r\n\r\n" in data and b"WARC-Refers-To: <urn:page:1>" in data


def test_a_broken_archive_is_noticed():
    whole = warc._member(warc._header(1, "u", None, digest("body"), 4)) + warc._member(b"body\r\n\r\n")
    assert [r[1:] for r in warc._records_in(io.BytesIO(whole))] == [(4, digest("body"))]
    with pytest.raises(ValueError):
        list(warc._records_in(io.BytesIO(warc._member(warc._header(1, "u", None, digest("body"), 4)) + warc._member(b"bo"))))
    with pytest.raises(ValueError):
        list(warc._records_in(io.BytesIO(warc._member(b"HTTP/1.1 200\r\n\r\n"))))
