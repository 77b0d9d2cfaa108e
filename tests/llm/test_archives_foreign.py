"""An archive made by hand, with what crawls hold: binary and Latin-1 bodies, other status codes, headers of their own."""

import gzip

from recmill.llm import warc
from recmill.sources.scratch import scratch_path

PNG = bytes(range(256)) * 5 + b"\r\n\r\nWARC/1.0\r\n\r\n" + b"\xff\xd8\x00"


def record(kind, block, name, uri, date, *more):
    lines = [f"WARC-Type: {kind}", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}", f"WARC-Record-ID: <urn:uuid:{name}>", *more]
    return b"\r\n".join([b"WARC/1.0", *[x.encode("latin-1") for x in lines], b"Content-Length: %d" % len(block)]) + b"\r\n\r\n" + block


def http(status, body, *headers):
    return "\r\n".join([f"HTTP/1.1 {status}", *headers]).encode("latin-1") + b"\r\n\r\n" + body


IP, HTML = "WARC-IP-Address: 10.0.0.1", "Content-Type: application/http; msgtype=response"
MISSING = record("response", http("404 Not Found", b"<h1>gone \xe9</h1>", "Server: x", "Content-Type: text/html; charset=latin-1"), "a", "https://a.b/c%20d?q=%E9+1", "2020-01-02T03:04:05Z", IP, HTML)
IMAGE = record("response", http("200 OK", PNG, "Content-Type: image/png", "ETag: caf\xe9"), "b", "https://a.b/i.png", "2020-01-02T03:04:06Z", HTML)
LATER = record("response", http("200 Fine", PNG, "Content-Type: image/png", "X-Own: yes"), "c", "https://z.b/i.png", "2021-05-05T00:00:00Z", IP, HTML)
DNS = record("response", b"20200102\r\na.b. 300 IN A 10.0.0.1\r\n", "d", "dns:a.b", "2020-01-02T03:04:04Z", "Content-Type: text/dns")
INFO = record("warcinfo", b"software: \xff\r\n", "i", "x:y", "2020-01-01T00:00:00Z")


def stored(path, *records, whole=False):
    path.mkdir(exist_ok=True)
    parts = [r + b"\r\n\r\n" for r in records]
    (path / "x.warc.gz").write_bytes(gzip.compress(b"".join(parts)) if whole else b"".join(map(gzip.compress, parts)))
    return str(path)


def deduped(spark, *sources, **options):
    target = scratch_path(spark, "target")
    warc.dedupe_archive(spark, list(sources), target, **options)
    lines = spark.read.option("lineSep", warc.BREAK).schema("value string").text(target)
    raw = lines.selectExpr("CAST(value AS BINARY) AS v", "input_file_name() AS f", "monotonically_increasing_id() AS i").collect()
    out = []
    for f in sorted({r.f for r in raw}):
        pieces = [bytes(r.v) for r in sorted(raw, key=lambda r: r.i) if r.f == f]
        out += [r["head"] + b"\r\n\r\n" + r["block"] for r in warc.parse_records(pieces) if r["whole"]]
    return sorted(out)


def test_records_survive_byte_for_byte(spark, tmp_path):
    given = [MISSING, IMAGE, DNS, INFO]
    for whole in (False, True):
        assert deduped(spark, stored(tmp_path / f"x{whole}", *given, whole=whole)) == sorted(given)
    rows = warc.read_archive(spark, str(tmp_path / "xTrue")).collect()
    assert {r.record_id: r.payload_bytes for r in rows}["urn:uuid:b"] == len(PNG)


def test_repeats_become_revisits_with_their_own_head(spark, tmp_path):
    found = deduped(spark, stored(tmp_path / "one", LATER, INFO), stored(tmp_path / "two", MISSING, IMAGE))
    assert {MISSING, IMAGE, INFO} < set(found) and len(found) == 4
    (made,) = set(found) - {MISSING, IMAGE, INFO}
    head, _, block = made.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    assert block == http("200 Fine", b"", "Content-Type: image/png", "X-Own: yes")
    assert (fields[b"WARC-Type"], fields[b"WARC-Refers-To"]) == (b"revisit", b"<urn:uuid:b>")
    assert (fields[b"WARC-Target-URI"], fields[b"WARC-Date"]) == (b"https://z.b/i.png", b"2021-05-05T00:00:00Z")
    assert (fields[b"WARC-Refers-To-Target-URI"], fields[b"WARC-Refers-To-Date"]) == (b"https://a.b/i.png", b"2020-01-02T03:04:06Z")
    assert fields[b"WARC-IP-Address"] == b"10.0.0.1" and fields[b"WARC-Record-ID"] not in (b"<urn:uuid:c>", b"<urn:uuid:b>")
    again = deduped(spark, stored(tmp_path / "three", *found))
    assert sorted(r.split(b"\r\n\r\n")[1] for r in again) == sorted(r.split(b"\r\n\r\n")[1] for r in found)
    back = {r for r in deduped(spark, stored(tmp_path / "four", *found), min_bytes=10**6)}
    (again,) = [r for r in back if b"X-Own" in r]
    assert again.partition(b"\r\n\r\n")[2] == http("200 Fine", PNG, "Content-Type: image/png", "X-Own: yes")


def test_shuffled_decisions_agree(spark, tmp_path, monkeypatch):
    source = stored(tmp_path / "one", LATER, IMAGE, IMAGE, MISSING)
    want = deduped(spark, source)
    assert len(want) == 4 and want.count(IMAGE) == 1
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert deduped(spark, source) == want


def test_a_record_cut_short_is_marked(spark, tmp_path):
    (found,) = deduped(spark, stored(tmp_path / "one", MISSING[:-5].removesuffix(b"\r\n")))
    assert b"WARC-Truncated: unspecified" in found and b"<h1>gone" in found
