"""WARC archives of pages, with equal payloads stored once.

Records meet by payload digest as headers only; the one with the smallest page id keeps
its payload as a response, every other becomes a revisit that refers to it. Archives are
gzip files written and read by Spark's text source: a WARC record ends with the blank
line that serves as the source's line separator, and the reader puts the pieces together
again by each record's Content-Length.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recmill.sources.scratch import materialise

# Fixed values of the format.
BREAK = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

DATE = "2024-01-01T00:00:00Z"
MIN_BYTES = 0
BROADCAST_ROWS = 500_000  # most repeated digests sent to every executor
SMALL_BYTES = 256  # payloads up to this size may be sent with them
READ = (
    "page_id long, url string, record_type string, record_id string, refers_to_id string, "
    "payload_digest string, payload_bytes long, intact boolean, payload string"
)
REST = ", headers array<struct<name:string,value:string>>, block string"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are 32 characters, four for every five hex digits."""

    def four(digits: Column) -> list[Column]:
        value = F.conv(digits, 16, 10).cast("int")
        place = [F.shiftright(value, shift).bitwiseAND(31) + 1 for shift in (15, 10, 5, 0)]
        return [F.substr(F.lit(BASE32), p, F.lit(1)) for p in place]

    hexed = F.sha1(payload)
    return F.concat(*itertools.chain(*[four(F.substring(hexed, 1 + 5 * i, 5)) for i in range(8)]))


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest) of each page; a null html is an empty payload."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": sha1_base32(F.col("payload"))}
    )


def _least(names: list[str]) -> Column:
    """Orders rows by the columns, nulls last."""
    return F.struct(*itertools.chain(*[(F.col(n).isNull().alias(f"no_{n}"), F.col(n)) for n in names]))


def _record_id(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    hexed = F.md5(F.to_json(F.struct(page_id.alias("p"), url.alias("u"), digest.alias("d"), copy.alias("c"))))
    parts = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def resolve(records: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Decide which record of each payload is the response; adds record_type, record_id, original.

    ``records`` has the columns of ``records_of``; payload may be null where another record
    of the digest holds it. Of the records with equal payloads of at least ``min_bytes``
    bytes, the response is the one with the smallest page id among those that hold the
    payload (null ids last, then by url); ``original`` (page_id, url) is null for it. Rows
    that repeat page id, url and payload are records of their own, one of them the
    response. Smaller payloads are all responses. Other columns are dropped.
    """
    heads = records.filter(F.col("payload_bytes") >= min_bytes).select(
        "payload_digest", F.col("payload").isNull().alias("bare"), "page_id", "url"
    )
    copies = heads.groupBy("payload_digest", "bare", "page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct("bare", _least(["page_id", "url"]).alias("key"), "copies")).alias("first")
    repeated = copies.groupBy("payload_digest").agg(first, F.sum("copies").alias("n")).filter("n > 1 AND NOT first.bare")
    repeated = materialise(
        repeated.select(
            F.col("payload_digest").alias("_digest"),
            F.col("first.key.page_id").alias("_page_id"),
            F.col("first.key.url").alias("_url"),
            F.col("first.copies").alias("_copies"),
        ),
        "repeated",
    )
    few = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    here = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_bytes)
    met = records.join(F.broadcast(repeated) if few else repeated, here, "left")
    same = F.col("page_id").eqNullSafe(F.col("_page_id")) & F.col("url").eqNullSafe(F.col("_url"))
    is_first = F.col("_digest").isNotNull() & same & F.col("payload").isNotNull()
    met = met.withColumn("_first", is_first).withColumn("_again", is_first & (F.col("_copies") > 1))

    revisit = F.col("_digest").isNotNull() & ~F.col("_first")
    single = met.filter(~F.col("_again")).withColumn("_copy", F.lit(0))
    once = met.filter("_again").dropDuplicates(["payload_digest"]).withColumn("_copy", F.lit(0))
    more = met.filter("_again").groupBy("payload_digest", "payload_bytes", "page_id", "url").agg(
        (F.count(F.lit(1)) - 1).cast("int").alias("_n")
    )
    more = more.select(
        "page_id",
        "url",
        F.lit(None).cast("string").alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.lit("revisit").alias("record_type"),
        F.col("page_id").alias("_page_id"),
        F.col("url").alias("_url"),
        F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy"),
    )
    columns = more.columns
    kept = F.when(~revisit, F.col("payload"))
    single = single.unionByName(once).withColumns(
        {"record_type": F.when(revisit, "revisit").otherwise("response"), "payload": kept}
    )
    rows = single.select(*columns).unionByName(more)
    back = F.col("record_type") == "revisit"
    return rows.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        "record_type",
        _record_id(F.col("page_id"), F.col("url"), F.col("payload_digest"), F.col("_copy")).alias("record_id"),
        F.when(back, _record_id(F.col("_page_id"), F.col("_url"), F.col("payload_digest"), F.lit(0))).alias("refers_to_id"),
        F.when(back, F.struct(F.col("_page_id").alias("page_id"), F.col("_url").alias("url"))).alias("original"),
    )


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value. Control characters are percent-encoded, and so is %."""
    text = value.cast("string")
    unsafe = text.rlike(r"[\x00-\x20%\x7F]")
    return F.concat(F.lit(f"\r\n{name}: "), F.when(unsafe, F.url_encode(text)).otherwise(text))


def _archive_lines(resolved: DataFrame, date: str) -> DataFrame:
    is_response = F.col("record_type") == "response"
    payload = F.coalesce("payload", F.lit(""))
    head = F.concat(F.lit(HTTP_HEAD), F.col("payload_bytes").cast("string"), F.lit(BREAK))
    block = F.when(is_response, F.concat(head, payload)).otherwise(F.lit(""))
    lines = [
        F.concat(F.lit(f"{VERSION}\r\nWARC-Type: "), F.col("record_type")),
        F.concat(F.lit("\r\nWARC-Record-ID: <"), F.col("record_id"), F.lit(">")),
        F.lit(f"\r\nWARC-Date: {date}"),
        _line("WARC-Target-URI", F.col("url")),
        _line("X-Page-Id", F.col("page_id")),
        F.concat(F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(is_response, F.lit("\r\nContent-Type: application/http; msgtype=response")),
        F.concat(F.lit("\r\nWARC-Refers-To: <"), F.col("refers_to_id"), F.lit(">")),
        _line("WARC-Refers-To-Target-URI", F.col("original.url")),
        F.when(~is_response, F.lit(f"\r\nWARC-Refers-To-Date: {date}\r\nWARC-Profile: {PROFILE}")),
    ]
    with_block = resolved.withColumn("_block", block)
    length = F.concat(F.lit("\r\nContent-Length: "), F.octet_length("_block").cast("string"), F.lit(BREAK))
    record = F.concat(*[F.coalesce(line, F.lit("")) for line in lines], length, F.col("_block"))
    return with_block.select(record.alias("value"))


def _write_lines(lines: DataFrame, path: str) -> None:
    lines.write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def write_archive(resolved: DataFrame, path: str, date: str = DATE) -> None:
    """Write resolved records as gzip WARC files, each with headers made for this archive."""
    _write_lines(_archive_lines(resolved, date), path)


def _decoded(value: str | None) -> str | None:
    from urllib.parse import unquote_plus

    return None if value is None else unquote_plus(value) if "%" in value else value


def parse_records(pieces: Iterator[bytes | str]) -> Iterator[dict]:
    """Records from the pieces between blank lines, in the order of one file.

    A record ends after the bytes its Content-Length names, so payloads may hold blank lines.
    """
    pieces = (p if isinstance(p, bytes) else p.encode("utf-8", "surrogatepass") for p in pieces)
    carry = b""
    separator = BREAK.encode()
    while True:
        data, carry = carry.lstrip(b"\r\n"), b""
        while not data:
            following = next(pieces, None)
            if following is None:
                return
            data = following.lstrip(b"\r\n")
        head, found, block = data.partition(separator)
        lines = head.decode("utf-8", "replace").split("\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = int(fields.get("content-length", 0))
        parts, have, whole = [block], len(block), True
        if not found:
            parts, have = [], -len(separator)  # the separator after the head, then the block
        while have < size:
            following = next(pieces, None)
            if following is None:
                whole = False
                break
            parts.append(following)
            have += len(separator) + len(following)
        block = separator.join(parts)
        block, carry = block[:size], block[size:]
        yield {"version": lines[0], "lines": lines[1:], "fields": fields, "head": head, "block": block, "whole": whole}


def _row(record: dict, with_payload: bool, with_rest: bool = False) -> dict:
    fields, block = record["fields"], record["block"]
    kind = fields.get("warc-type")
    payload = block.partition(BREAK.encode())[2] if kind == "response" else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    intact = record["whole"]
    if payload is not None:
        intact = intact and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
    page_id = fields.get("x-page-id")
    rest = {}
    if with_rest:
        named = [(k, v.strip()) for k, _, v in (line.partition(":") for line in record["lines"])]
        rest = {
            "headers": [{"name": k, "value": v} for k, v in named],
            "block": None if kind == "response" and digest else block.decode("utf-8", "replace"),
        }
    return rest | {
        "page_id": int(page_id) if page_id else None,
        "url": _decoded(fields.get("warc-target-uri")),
        "record_type": kind,
        "record_id": fields.get("warc-record-id", "").strip("<>") or None,
        "refers_to_id": fields.get("warc-refers-to", "").strip("<>") or None,
        "payload_digest": digest,
        "payload_bytes": None if payload is None else len(payload),
        "intact": intact,
        "payload": payload.decode("utf-8", "replace") if with_payload and payload is not None else None,
    }


def read_archive(spark: SparkSession, path: str | list[str], with_payload: bool = True, with_rest: bool = False) -> DataFrame:
    """The records of the archives under ``path``; intact is false where a payload and its digest differ.

    Files are read one after the other within a task; a file that ends inside a record
    gives that record with what is there, not intact. ``with_rest`` adds the headers as
    they stand, and the block where it is not a response's.
    """
    schema = pa.schema(
        [(n, {"long": pa.int64(), "boolean": pa.bool_()}.get(t, pa.string())) for n, t in (c.split() for c in READ.split(", "))]
    )
    if with_rest:
        header = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        schema = schema.append(pa.field("headers", header)).append(pa.field("block", pa.string()))

    return _records(
        spark, path, lambda record: _row(record, with_payload, with_rest), schema, READ + (REST if with_rest else ""), with_payload
    )


def _records(spark: SparkSession, path: str | list[str], row: Callable[[dict], dict], schema: pa.Schema, kinds: str, large: bool) -> DataFrame:
    """``row`` of every record under ``path``, whatever bytes it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (
            (file, piece)
            for batch in batches
            for file, piece in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
        )
        rows, size = [], 0
        for _, of_file in itertools.groupby(pieces, key=lambda x: x[0]):
            for record in parse_records(piece for _, piece in of_file):
                rows.append(row(record))
                size += len(record["block"]) if large else 200
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    lines = spark.read.option("lineSep", BREAK).schema("value string").text(path)
    raw = lines.select(F.col("value").cast("binary").alias("value"), F.input_file_name().alias("file"))
    return raw.mapInArrow(run, kinds)


def join_revisits(found: DataFrame) -> DataFrame:
    """Give every revisit its response's page id and payload size; headers alone move, by digest.

    Of the responses with a revisit's digest the one whose record id it names counts, or
    else the one with the smallest page id. Both stay null where there is none.
    """
    heads = materialise(found.drop("payload"), "headers")
    responses = heads.filter("record_type = 'response' AND payload_digest IS NOT NULL")
    of = F.struct("page_id", "payload_bytes")
    named = responses.groupBy(F.col("payload_digest").alias("_digest"), F.col("record_id").alias("_id")).agg(F.min(of).alias("_named"))
    least = F.struct(_least(["page_id", "record_id"]).alias("key"), of.alias("of"))
    any_of = responses.groupBy(F.col("payload_digest").alias("_any_digest")).agg(F.min(least)["of"].alias("_any"))
    back = F.col("record_type") == "revisit"
    meet = back & (F.col("payload_digest") == F.col("_digest")) & (F.col("refers_to_id") == F.col("_id"))
    met = heads.join(named, meet, "left").join(any_of, back & (F.col("payload_digest") == F.col("_any_digest")), "left")
    response = F.coalesce("_named", "_any")
    return met.select(
        "page_id",
        "url",
        "record_type",
        "record_id",
        "payload_digest",
        F.coalesce("payload_bytes", response["payload_bytes"]).alias("payload_bytes"),
        response["page_id"].alias("refers_to"),
        "intact",
    )


# Archives of others -------------------------------------------------------------------------

RAW = "kind string, page_id long, url string, date string, record_id string, declared string, digest string, bytes long, raw binary"
_OWN = ("warc-type", "warc-record-id", "content-type", "content-length", "warc-profile", "warc-block-digest")
_BACK = ("warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date")


def _http(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head, payload) of a response's block; one of another protocol is payload alone."""
    head, found, payload = block.partition(BREAK.encode())
    return (head + found, payload) if block.startswith(b"HTTP/") else (b"", block)


def _raw_row(record: dict) -> dict:
    fields, head, block = record["fields"], record["head"], record["block"]
    latin = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("latin-1").split("\r\n")[1:])}
    kind, payload = fields.get("warc-type"), _http(block)[1]
    if not record["whole"]:  # what is there, under a length that is true
        kind, head = "cut", _head(head, ("content-length",), [("WARC-Truncated", "unspecified"), ("Content-Length", len(block))])
    is_response = kind == "response"
    page_id = fields.get("x-page-id", "")
    return {
        "kind": kind,
        "page_id": int(page_id) if page_id.removeprefix("-").isdecimal() else None,
        "url": latin.get("warc-target-uri"),
        "date": latin.get("warc-date"),
        "record_id": latin.get("warc-record-id", "").strip("<>") or None,
        "declared": latin.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if is_response else None,
        "bytes": len(payload) if is_response else None,
        "raw": head + BREAK.encode() + block,
    }


def _head(head: bytes, without: tuple[str, ...], added: list[tuple]) -> bytes:
    """A record's header lines, less some, with others after them; nothing for a value that is None."""
    first, *lines = head.split(b"\r\n")
    kept = [line for line in lines if line.partition(b":")[0].strip().lower().decode("latin-1") not in without]
    return b"\r\n".join([first, *kept, *[f"{k}: {v}".encode("latin-1", "replace") for k, v in added if v is not None]])


def _rewritten(raw: bytes, row: int, action: str, record_id: str | None, digest: str, to: tuple, small: bytes | None) -> bytes:
    """A response or revisit as a revisit of ``to`` (id, uri, date), or a revisit as a response with the block ``small``."""
    head, _, block = raw.partition(BREAK.encode())
    http = _http(block)[0]
    if action == "response":
        block = http + _http(small)[1] if http else small
        added = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id}>" if record_id else None)]
        content = "application/http; msgtype=response" if block.startswith(b"HTTP/") else None
        added += [("Content-Type", content), ("Content-Length", len(block))]
        return _head(head, _OWN + _BACK, added) + BREAK.encode() + block
    if action == "revisit":  # a record of its own: the one it was made from may stand elsewhere
        record_id, block = f"urn:uuid:{uuid.UUID(hashlib.md5(f'{record_id} {row}'.encode()).hexdigest())}", http
    target, uri, date = to
    content = "application/http; msgtype=response" if http else None
    added = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id}>" if record_id else None)]
    added += [("WARC-Refers-To", f"<{target}>" if target else None), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date)]
    added += [("WARC-Profile", PROFILE), ("Content-Type", content), ("Content-Length", len(block))]
    without = _OWN + _BACK
    if action == "revisit":
        without, added = (*without, "warc-payload-digest"), [*added[:2], ("WARC-Payload-Digest", f"sha1:{digest}"), *added[2:]]
    return _head(head, without, added) + BREAK.encode() + block


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["raw", "_row", "action", "record_id", "group", "to_id", "to_url", "to_date", "small"]
    for batch in batches:
        out = []
        for values in zip(*(batch.column(n).to_pylist() for n in names)):
            raw, row, action, record_id, digest, to_id, to_url, to_date, small = values
            out.append(raw if action is None else _rewritten(raw, row, action, record_id, digest, (to_id, to_url, to_date), small))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def dedupe_archive(spark: SparkSession, source: str | list[str], target: str, min_bytes: int = MIN_BYTES) -> None:
    """Read archives that may repeat payloads and hold revisits, and write them deduplicated.

    Every record is carried as bytes and stays, in some place. Of responses with equal payloads of at
    least ``min_bytes`` bytes, the one of the smallest page id (none last; then by target, date
    and id) stays as it is; the others become revisits of it, with an id of their own, their own
    target, date, other headers and HTTP head. Revisits find their response by payload digest and
    are given new references to the one that stays, or become responses again where its
    payload is smaller. Revisits whose response is in none of the archives, and records of other
    types, pass byte for byte. A record that its file cuts short is given its true length and
    marked as truncated. Archives may be gzipped record by record or as a whole; the written ones are
    gzipped file by file.
    """
    arrow = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(n, arrow[t]) for n, t in (c.split() for c in RAW.split(", "))])
    found = _records(spark, source, _raw_row, schema, RAW, True)
    found = materialise(found.withColumn("_row", F.monotonically_increasing_id()), "records")

    responses = found.filter("kind = 'response'")
    place = F.min(_least(["page_id", "url", "date", "record_id", "_row"])).alias("p")
    groups = responses.select("digest", "page_id", "url", "date", "record_id", "_row", "bytes").groupBy("digest").agg(
        place, F.count(F.lit(1)).alias("n"), F.max("bytes").alias("size")
    )
    groups = groups.select(
        F.col("digest").alias("group"), "n", "size", F.col("p._row").alias("kept"), F.col("p.record_id").alias("to_id"),
        F.col("p.url").alias("to_url"), F.col("p.date").alias("to_date"),
    )
    groups = materialise(groups, "groups")
    tiny = responses.filter(F.col("bytes") < min_bytes).groupBy(F.col("digest").alias("_tiny")).agg(F.min("raw").alias("_raw"))
    blocks = tiny.mapInArrow(_blocks, "_tiny string, small binary")

    declared = responses.select(F.coalesce("declared", "digest").alias("key"), "digest").unionByName(
        responses.select(F.col("digest").alias("key"), "digest")
    )
    keys = materialise(declared.groupBy("key").agg(F.min("digest").alias("group")), "keys")
    again = responses.select("_row", F.col("digest").alias("group")).join(groups.filter(F.col("n") > 1), "group")
    again = again.filter((F.col("_row") != F.col("kept")) & (F.col("size") >= min_bytes)).withColumn("action", F.lit("revisit"))
    back = found.filter("kind = 'revisit'").select("_row", "declared").join(keys, F.col("declared") == F.col("key"))
    back = back.join(groups, "group").withColumn("action", F.when(F.col("size") < min_bytes, "response").otherwise("again"))
    wanted = ["_row", "action", "group", "to_id", "to_url", "to_date"]
    decided = again.select(*wanted).unionByName(back.select(*wanted)).join(blocks, F.col("group") == F.col("_tiny"), "left")
    decided = materialise(decided.drop("_tiny").withColumnRenamed("_row", "_decided"), "decided")
    few = decided.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS and min_bytes <= SMALL_BYTES
    met = found.join(F.broadcast(decided) if few else decided, F.col("_row") == F.col("_decided"), "left")
    columns = ["raw", "_row", "action", "record_id", "group", "to_id", "to_url", "to_date", "small"]
    written = met.select(*columns).mapInArrow(_rewrite, "value binary")
    _write_lines(written.select(F.col("value").cast("string").alias("value")), target)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The block of each (digest, raw record)."""
    for batch in batches:
        blocks = [raw.partition(BREAK.encode())[2] for raw in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blocks, pa.binary())], ["_tiny", "small"])
