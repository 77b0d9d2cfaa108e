import base64
import hashlib

import pytest

from recmill.llm import warc
from recmill.sources.scratch import scratch_path

HTML = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/ c%20\r\nX: y", "<p>one</p>"),
    (3, None, None),
    (4, "http://d/", ""),
    (5, "http://e/", "blank\r\n\r\nline\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nend\r\n"),
    (6, "http://e/", "ends in breaks\r\n\r\n"),
    (7, "http://f/", "\r\n\r\n"),
    (8, "http://f/", "é漢🙂" * 10_000),
    (9, "http://f/", "é漢🙂" * 10_000),
    (2, "http://g/", "<p>one</p>"),
    (None, "http://h/", "<p>one</p>"),
    (10, "http://same/", "same"),
    (10, "http://same/", "same"),
    (11, "http://i/", "\r"),
    (12, "http://i/", "\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(HTML, "page_id long, url string, html string").repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def written(spark, pages, **options):
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.resolve(warc.records_of(pages), **options), path)
    return path


def test_round_trip(spark, pages):
    records = warc.read_archive(spark, written(spark, pages)).collect()
    assert all(r.intact for r in records) and len(records) == len(HTML)
    assert sorted(str((r.page_id, r.url, r.payload_digest)) for r in records) == sorted(str((i, u, digest(h))) for i, u, h in HTML)
    payloads = {digest(h): h or "" for _, _, h in HTML}
    assert all(r.payload == payloads[r.payload_digest] for r in records if r.record_type == "response")
    assert len({r.record_id for r in records}) == len(records)
    assert len({r.payload_digest for r in records if r.record_type == "response"}) == len(payloads) == sum(
        r.record_type == "response" for r in records
    )


def test_revisits_name_the_smallest_page(spark, pages):
    found = warc.join_revisits(warc.read_archive(spark, written(spark, pages))).collect()
    for row in found:
        same = [i for i, _, h in HTML if digest(h) == row.payload_digest and i is not None]
        first = min(same)
        assert (row.refers_to if row.record_type == "revisit" else row.page_id) == first
        assert row.payload_bytes == next(len((h or "").encode()) for _, _, h in HTML if digest(h) == row.payload_digest)


def test_small_payloads_are_not_deduplicated(spark, pages):
    found = warc.read_archive(spark, written(spark, pages, min_bytes=10)).collect()
    small = [r for r in found if len(next((h or "").encode() for _, _, h in HTML if digest(h) == r.payload_digest)) < 10]
    assert small and all(r.record_type == "response" for r in small)
    assert sum(r.record_type == "revisit" for r in found) == 3 + 1


def test_archives_are_valid_gzip_records(spark, pages, tmp_path):
    import glob
    import gzip

    for file in glob.glob(written(spark, pages).removeprefix("file:") + "/part-*"):
        data = gzip.open(file).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data = rest[size + 4 :]


def test_dedupe_of_archives_that_overlap(spark, pages):
    one = written(spark, pages.filter("page_id > 1 OR page_id IS NULL"))
    two = written(spark, pages.filter("page_id = 1"))
    target = scratch_path(spark, "deduped")
    warc.dedupe_archive(spark, [one, two], target)
    found = warc.join_revisits(warc.read_archive(spark, target)).collect()
    assert len(found) == len(HTML) and all(r.intact for r in found)
    assert sum(r.record_type == "response" for r in found) == len({digest(h) for _, _, h in HTML})
    assert {r.refers_to for r in found if r.payload_digest == digest("<p>one</p>") and r.record_type == "revisit"} == {1}


def test_empty_and_cut_archives(spark, pages):
    assert warc.read_archive(spark, written(spark, pages.limit(0))).count() == 0
    whole = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 50"
    assert [r["whole"] for r in warc.parse_records(iter([whole, "short"]))] == [False]
    assert list(warc.parse_records(iter([]))) == []
