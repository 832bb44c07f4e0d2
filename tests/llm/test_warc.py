import base64
import hashlib
import io
from collections import Counter

import pytest

from pagelathe.llm import warc
from pagelathe.llm.common import new_folder


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/", "x" * 100), (2, "http://b/", "x" * 100), (2, "http://b/", "x" * 100), (3, None, None), (4, "http://c/\r\nEvil: y", ""), (None, "http://d/", "x" * 100), (5, "u", "é\r\n\r\nWARC/1.1\r\n" * 5000), (6, "v", "alone"), (None, None, "w"), (7, "q", "x" * 9), (8, "q", "x" * 9)]
    return spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id bigint, url string, html string, payload string, sha1 string").repartition(3)


def by_hand(rows, least):
    best, seen, out = {}, set(), []
    for r in rows:
        best[r.html or ""] = max(best.get(r.html or "", -1), -1 if r.page_id is None else r.page_id)
    for r in rows:
        data = (r.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        top = best[r.html or ""]
        win = top == (-1 if r.page_id is None else r.page_id) and data not in seen
        if win:
            seen.add(data)
        key = None if r.page_id is None else str(r.page_id)
        out.append((key, len(data), digest, "response" if win or len(data) < least else "revisit", None if win or len(data) < least else str(top)))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 50])
def test_records_come_back(pages, least):
    found = warc.archive_pages(pages, least=least).collect()
    assert len({r.record_id for r in found}) == len(found)
    assert Counter(tuple(r)[1:] for r in found) == by_hand(pages.collect(), least)


def test_chunks_carry_bytes_and_digests(spark, pages):
    folder = new_folder(spark, "warc")
    chunks = warc.read_chunks(warc.write_warc(pages, folder), folder, size=1000)
    rows = {}
    for r in chunks.collect():
        rows.setdefault(r.record_id, []).append(r)
    whole = set()
    for parts in rows.values():
        parts.sort(key=lambda r: r.chunk_no)
        assert [r.chunk_no for r in parts] == list(range(len(parts)))
        assert [r.last for r in parts] == [False] * (len(parts) - 1) + [True]
        data = b""
        for r in parts:
            data += r.data
            assert len(r.data) <= 1000 and r.bytes_so_far == len(data)
            assert r.digest_so_far == base64.b32encode(hashlib.sha1(data).digest()).decode()
        if parts[0].record_type == "response":
            assert parts[0].declared_digest == parts[-1].digest_so_far
            whole.add(data)
    assert whole == {(r.html or "").encode() for r in pages.collect()}


def test_cut_off_archives_are_refused():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    import gzip

    assert [x[2] for x in warc.chunks_of(io.BytesIO(gzip.compress(record) * 2), 3)] == [b"hel", b"lo"] * 2
    for wrong in (record[:-6], record[:30], b"HTTP/1.1\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.chunks_of(io.BytesIO(gzip.compress(wrong)), 3))


def test_empty_table(pages):
    assert warc.archive_pages(pages.limit(0)).count() == 0
