"""Archives of incremental crawls: revisits without their response, and records of other types."""

from recmill.llm import warc
from recmill.sources.scratch import scratch_path

ABSENT = "A" * 32


def record(kind, block="", **fields):
    head = {"WARC-Type": kind, **{k.replace("_", "-"): v for k, v in fields.items()}, "Content-Length": len(block.encode())}
    return "WARC/1.0\r\n" + "\r\n".join(f"{k}: {v}" for k, v in head.items()) + "\r\n\r\n" + block + "\r\n\r\n"


def archived(spark, *records):
    path = scratch_path(spark, "source")
    text = "".join(records).removesuffix("\r\n\r\n")
    frame = spark.createDataFrame([(text,)], "value string").coalesce(1)
    frame.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    return path


def deduped(spark, source, **options):
    target = scratch_path(spark, "target")
    warc.dedupe_archive(spark, source, target, **options)
    return warc.read_archive(spark, target, with_rest=True).collect()


def test_no_record_is_lost(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>one</p>"), (2, "http://b/", "two")], "page_id long, url string, html string")
    crawl = scratch_path(spark, "crawl")
    warc.write_archive(warc.resolve(warc.records_of(pages)), crawl)
    one = next(r.payload_digest for r in warc.read_archive(spark, crawl).collect() if r.page_id == 1)
    source = archived(
        spark,
        record("warcinfo", "software: x\r\n\r\nformat: y\r\n", WARC_Record_ID="<urn:uuid:i>", Content_Type="application/warc-fields"),
        record("revisit", WARC_Record_ID="<urn:uuid:gone>", WARC_Target_URI="http://c/%20d", WARC_Payload_Digest=f"sha1:{ABSENT}", WARC_Refers_To="<urn:uuid:z>", X_Page_Id=3),
        record("revisit", "HTTP/1.1 304 Not Modified\r\n\r\n", WARC_Record_ID="<urn:uuid:bare>", WARC_Target_URI="http://e/"),
        record("revisit", WARC_Record_ID="<urn:uuid:un>", WARC_Target_URI="http://f/", WARC_Payload_Digest=f"sha1:{one}", X_Page_Id=4),
        record("revisit", WARC_Record_ID="<urn:uuid:other>", WARC_Target_URI="http://g/", WARC_Payload_Digest=f"sha1:{one}", WARC_Refers_To="<urn:uuid:z>", X_Page_Id=5),
        record("resource", "é text", WARC_Record_ID="<urn:uuid:r>", WARC_Target_URI="http://h/", Content_Type="text/plain"),
        record("request", "GET / HTTP/1.1\r\nHost: a\r\n\r\n", WARC_Record_ID="<urn:uuid:q>", WARC_Target_URI="http://a/"),
        record("metadata", "k: v", WARC_Record_ID="<urn:uuid:m>", WARC_Concurrent_To="<urn:uuid:q>"),
        record("conversion", "", WARC_Record_ID="<urn:uuid:c>"),
    )
    rows = deduped(spark, [crawl, source])
    assert len(rows) == 11 and all(r.intact for r in rows)
    by_id = {r.record_id: r for r in rows}
    blocks = {"i": "software: x\r\n\r\nformat: y\r\n", "bare": "HTTP/1.1 304 Not Modified\r\n\r\n", "r": "é text", "q": "GET / HTTP/1.1\r\nHost: a\r\n\r\n", "m": "k: v", "c": "", "gone": ""}
    assert {k: by_id[f"urn:uuid:{k}"].block for k in blocks} == blocks
    gone = by_id["urn:uuid:gone"]
    assert (gone.record_type, gone.page_id, gone.url, gone.refers_to_id, gone.payload_digest) == ("revisit", 3, "http://c/ d", "urn:uuid:z", ABSENT)
    assert ("WARC-Concurrent-To", "<urn:uuid:q>") in [(h["name"], h["value"]) for h in by_id["urn:uuid:m"].headers]
    first = next(r for r in rows if r.record_type == "response" and r.page_id == 1)
    found = {r.page_id: r for r in rows if r.record_type == "revisit"}
    assert {i: found[i].refers_to_id for i in (4, 5)} == {4: first.record_id, 5: first.record_id}
    assert sorted(r.record_type for r in deduped(spark, crawl)) == ["response", "response"]


def test_revisits_meet_their_response_by_digest(spark):
    source = archived(
        spark,
        record("response", "HTTP/1.1 200 OK\r\n\r\nabc", WARC_Record_ID="<a>", WARC_Payload_Digest="sha1:X", X_Page_Id=1),
        record("response", "HTTP/1.1 200 OK\r\n\r\nabc", WARC_Record_ID="<b>", WARC_Payload_Digest="sha1:X", X_Page_Id=2),
        record("revisit", WARC_Record_ID="<c>", WARC_Payload_Digest="sha1:X", WARC_Refers_To="<b>"),
        record("revisit", WARC_Record_ID="<d>", WARC_Payload_Digest="sha1:X"),
        record("revisit", WARC_Record_ID="<e>", WARC_Payload_Digest="sha1:Y"),
    )
    found = {r.record_id: r for r in warc.join_revisits(warc.read_archive(spark, source)).collect()}
    assert {k: (r.refers_to, r.payload_bytes) for k, r in found.items()} == {"a": (None, 3), "b": (None, 3), "c": (2, 3), "d": (1, 3), "e": (None, None)}


def test_revisits_of_small_payloads_become_responses(spark):
    pages = spark.createDataFrame([(i, "http://a/", "<p>one</p>") for i in (1, 2)], "page_id long, url string, html string")
    crawl = scratch_path(spark, "crawl")
    warc.write_archive(warc.resolve(warc.records_of(pages)), crawl)
    rows = deduped(spark, crawl, min_bytes=100)
    assert sorted((r.page_id, r.record_type, r.payload, r.intact) for r in rows) == [(i, "response", "<p>one</p>", True) for i in (1, 2)]
