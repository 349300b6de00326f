"""WARC archives: captures written as transactions of records, and put together again.

A capture is a transaction: a request, a response (or a revisit, which has no payload and
refers to the response that has it) and metadata, each a record of its own with an
identifier, tied together by WARC-Concurrent-To. Records may lie in any order and in any
file. Archives are text that Spark's writer lays down record by record, gzipped; each
task reads whole files and gives one row per record. ``assemble`` joins the records
through their identifiers and gives one nested row per capture.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from base64 import b32encode
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermart.llm.common import written
from ledgermart.session import new_work_dir

#: Payloads of fewer bytes are kept with each capture.
MIN_REVISIT_BYTES = 0
CAPTURED = "2024-01-01T00:00:00Z"
RESPONSE, REVISIT, REQUEST, METADATA = "response", "revisit", "request", "metadata"
#: Records that begin a capture.
CAPTURES = (RESPONSE, REVISIT)

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_BETWEEN = "\r\n\r\n"  # after a header, and after a block
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RECORDS = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "declared_digest string, payload_bytes long, payload_digest string, payload binary, fields map<string,string>, place long"
)


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 160 bits are four times eight digits of five bits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _CONV_DIGITS, BASE32_DIGITS)


# -- writing -------------------------------------------------------------------


def _record_id(kind: str, *of: Column) -> Column:
    digits = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(c.cast("string"), F.lit("\r")) for c in of]))
    cut = [F.substring(digits, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(headers: Sequence[tuple[str, Column | str]], block: Column) -> Column:
    """A whole record but for the line breaks after its block; a null header is left out."""
    size = F.octet_length(block).cast("string")
    lines = [F.lit(VERSION)]
    for name, value in [*headers, ("Content-Length", size)]:
        lines.append(F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_BETWEEN), block)  # concat_ws leaves nulls out


def _one_line(value: Column) -> Column:
    """A header's value can't hold line breaks: they are percent-encoded, as a URI has them."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _transaction(c: dict[str, Column], kind: str, date: str) -> Column:
    """The three records of a capture; ``c``: page_id, url, copy, digest, size, payload, first_id, first_url."""
    own, uri = _record_id("capture", c["page_id"], c["url"], c["digest"], c["copy"]), _one_line(c["url"])
    base = lambda type_, id_: [("WARC-Type", type_), ("WARC-Record-ID", id_), ("WARC-Date", date), ("WARC-Target-URI", uri)]
    side = lambda type_: base(type_, _record_id(type_, c["page_id"], c["url"], c["digest"], c["copy"])) + [("WARC-Concurrent-To", own)]
    path = F.coalesce(F.nullif(F.regexp_extract(uri, r"^[^?#]*?://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    host = F.coalesce(F.regexp_extract(uri, "^[^?#]*?://([^/?#]*)", 1), F.lit(""))
    asked = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(_BETWEEN))
    answered = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), c["size"].cast("string"), F.lit(_BETWEEN))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c["digest"]))
    http = lambda what: ("Content-Type", f"application/http; msgtype={what}")
    if kind == RESPONSE:
        main = _record([*base(kind, own), digest, http("response")], F.concat(answered, c["payload"]))
    else:
        refers = [("WARC-Refers-To", c["first_id"]), ("WARC-Refers-To-Target-URI", _one_line(c["first_url"])), ("WARC-Refers-To-Date", F.lit(date))]
        main = _record([*base(kind, own), digest, *refers, ("WARC-Profile", PROFILE), ("WARC-Truncated", "length"), http("response")], answered)
    known = F.concat(F.coalesce(F.concat(F.lit("pageId: "), c["page_id"].cast("string"), F.lit("\r\n")), F.lit("")), F.lit("copy: "), c["copy"].cast("string"), F.lit("\r\n"))
    return F.array(
        _record([*side(REQUEST), http("request")], asked),
        main,
        _record([*side(METADATA), ("Content-Type", "application/warc-fields")], known),
    )


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = CAPTURED,
) -> None:
    """Writes a transaction for every row of ``pages`` to gzipped archives in a new ``folder``.

    The payload is the html in UTF-8, null being empty. Of captures with equal payloads of
    ``min_revisit_bytes`` or more the one with the smallest page_id (null last, ties by url, null last) is the
    response and the others revisit it; of rows equal in all, one. Payloads that occur
    often are brought together before they travel, and revisits are written without one.
    Rows that repeat get identifiers of their own. Other columns aren't read.
    """
    text = F.coalesce(pages[html].cast("string"), F.lit(""))
    raw = text.cast("binary")
    at = F.struct(pages[page_id].isNull().alias("no_page"), pages[page_id].cast("long").alias("page_id"), pages[url].isNull().alias("no_url"), pages[url].cast("string").alias("url"))
    each = pages.select(at.alias("at"), payload_digest(raw).alias("digest"), F.xxhash64(raw).alias("check"), F.octet_length(raw).cast("long").alias("size"), text.alias("payload"))
    alone = F.when(F.col("size") < min_revisit_bytes, F.col("at"))  # of these each row is a class of its own
    classes = each.groupBy("digest", "check", "size", alone.alias("alone")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.first("payload").alias("payload"))
    small = F.col("size") < min_revisit_bytes
    last = F.when(small, F.col("n") - 1).otherwise(F.lit(0).cast("long"))
    responses = classes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    cols = lambda at: {k: F.col(k) for k in ("digest", "size", "payload", "copy", "first_id", "first_url")} | {k: F.col(f"{at}.{k}") for k in ("page_id", "url")}
    full = responses.select(F.explode(_transaction(cols("first"), RESPONSE, date)).alias("value"))

    rows = each.filter(~small).groupBy("digest", "check", "size", "at").agg(F.count(F.lit(1)).alias("n"))
    firsts = rows.groupBy("digest", "check", "size").agg(F.min("at").alias("first"), F.sum("n").alias("all")).filter(F.col("all") > 1).drop("all")
    again = rows.join(firsts, ["digest", "check", "size"])  # a payload that many rows share is split by the skew join
    since = F.when(F.col("at").eqNullSafe(F.col("first")), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    numbers = F.when(since < F.col("n"), F.sequence(since, F.col("n") - 1)).otherwise(F.array().cast("array<bigint>"))
    again = again.withColumn("copy", F.explode(numbers))
    first_id = _record_id("capture", F.col("first.page_id"), F.col("first.url"), F.col("digest"), F.lit(0))
    again = again.withColumn("first_id", first_id).withColumn("first_url", F.col("first.url"))
    short = again.select(F.explode(_transaction(cols("at") | {"payload": F.lit(None)}, REVISIT, date)).alias("value"))
    full.unionByName(short).write.option("lineSep", _BETWEEN).option("compression", "gzip").text(folder)


# -- reading -------------------------------------------------------------------


class _Plain(io.RawIOBase):
    """The text of an archive, gzipped (in one member or one for each record) or not, a piece at a time."""

    def __init__(self, content: bytes, piece: int = 1 << 20):
        self.content, self.at, self.piece = memoryview(content), 0, piece
        self.packed = content[:2] == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        found = b""
        while not found:
            if not self.packed:
                found = self.content[self.at : self.at + len(into)]
                self.at += len(found)
                break
            waiting = self.unzip.unconsumed_tail
            if not waiting:
                waiting = bytes(self.content[self.at : self.at + self.piece])
                self.at += len(waiting)
            found = self.unzip.decompress(waiting, len(into))
            if self.unzip.eof:  # the next member
                self.at -= len(self.unzip.unused_data)
                self.unzip = zlib.decompressobj(31)
            elif not waiting:
                break
        into[: len(found)] = found
        return len(found)


def _headers(stream: io.BufferedReader) -> list[tuple[str, str]]:
    """Names in lower case and values, up to the empty line; folded lines are joined."""
    out: list[tuple[str, str]] = []
    while (line := stream.readline()).strip(b"\r\n"):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[0] in " \t" and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        else:
            name, _, value = text.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def parsed(content: bytes, keep_payload: bool = True) -> Iterator[tuple]:
    """One tuple per record of an archive, in the order of RECORDS; a record cut short is an error."""
    stream = io.BufferedReader(_Plain(content), 1 << 18)
    place = 0
    while line := stream.readline():
        if not line.strip(b"\r\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        pairs = _headers(stream)
        head = dict(reversed(pairs))
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"record {head.get('warc-record-id')} ends after {len(block)} of {size} bytes")
        kind, fields = head.get("warc-type", ""), None
        payload = block
        if head.get("content-type", "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        elif head.get("content-type", "").startswith("application/warc-fields"):
            fields = list(dict(_headers(io.BufferedReader(io.BytesIO(block)))).items())
        full = kind != REVISIT
        yield (
            head.get("warc-record-id"), kind, [v for n, v in pairs if n == "warc-concurrent-to"], head.get("warc-refers-to"), head.get("warc-target-uri"),
            head.get("warc-date"), head.get("warc-payload-digest"), len(payload) if full else None,
            b32encode(hashlib.sha1(payload).digest()).decode() if full else None, payload if keep_payload and full else None, fields, place,
        )
        place += 1


_TYPES = [
    pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(),
    pa.map_(pa.string(), pa.string()), pa.int64(),
]
#: Records and payload bytes that travel together.
_BATCH, _BATCH_BYTES = 5000, 8 << 20


def read_records(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives in ``folder``: see RECORDS. A file is one task's work and held packed.

    payload_bytes and payload_digest are of the payload as read; without ``payloads`` it is
    left out. A revisit has none. Fields are those of application/warc-fields.
    """
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for record in parsed(content.as_py(), payloads):
                    held.append(record)
                    size += len(record[9] or b"")
                    if len(held) >= _BATCH or size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), _TYPES)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), _TYPES)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).filter("length > 0")
    return files.select("content").mapInArrow(work, RECORDS)


# -- assembly ------------------------------------------------------------------


def assemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: capture_id, target_uri, date, record_type, response, requests, metadata, refers_to.

    A request or metadata record belongs to the response or revisit that it names in
    WARC-Concurrent-To, that names it, or that a record named by it belongs to (metadata
    that names the request). Records that lead to no capture are one of their own, without
    response. Of capture records that share an identifier each is a row, with the
    same others. ``records`` are read several times; payloads travel once, with their capture.
    """
    is_capture = F.col("record_type").isin(*CAPTURES)
    narrow = records.select("record_id", "record_type", "concurrent_to")
    captures = narrow.filter(is_capture).select(F.col("record_id").alias("capture_id")).distinct()
    said = narrow.filter(~is_capture).select(F.col("record_id").alias("id"), F.explode_outer("concurrent_to").alias("to")).distinct()
    heard = narrow.filter(is_capture).select(F.explode("concurrent_to").alias("id"), F.col("record_id").alias("capture_id"))
    direct = said.join(captures, said["to"] == captures["capture_id"]).select("id", "capture_id").unionByName(heard).distinct()
    by_way = said.join(direct.withColumnRenamed("id", "to"), "to").select("id", "capture_id")
    by_way = by_way.join(direct.select("id"), "id", "left_anti")
    owner = direct.unionByName(by_way).distinct()

    side = records.filter(~is_capture).withColumnRenamed("record_id", "id").join(owner, "id", "left")
    side = side.withColumn("capture_id", F.coalesce("capture_id", "id"))
    own = F.struct(F.col("id").alias("record_id"), "target_uri", "date", "payload_bytes", *(["payload"] if payloads else []), "fields")
    kinds = {"requests": F.col("record_type") == REQUEST, "metadata": F.col("record_type") == METADATA}
    others = side.groupBy("capture_id").agg(*[F.collect_list(F.when(match, own)).alias(name) for name, match in kinds.items()])
    response = F.struct("record_id", "declared_digest", "payload_bytes", "payload_digest", *(["payload"] if payloads else []))
    heads = records.filter(is_capture).select(F.col("record_id").alias("capture_id"), "record_type", "target_uri", "date", "refers_to", response.alias("response"))
    lists = [F.coalesce(F.col(name), F.array()).alias(name) for name in kinds]
    return heads.join(others, "capture_id", "full").select(*heads.columns, *lists)


def digests(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of captures: revisits take the payload's from the response.

    page_id is that which the metadata give; refers_to is the page_id of the response that a revisit names.
    """
    page = F.get(F.filter(F.transform("metadata", lambda m: m["fields"]["pageid"]), lambda p: p.isNotNull()), 0)
    flat = captures.filter("record_type is not null").select(
        "capture_id", "record_type", "refers_to", page.cast("long").alias("page_id"), "response.payload_bytes", "response.payload_digest"
    )
    first = flat.filter(F.col("record_type") == RESPONSE)
    seen = flat.filter(F.col("record_type") == REVISIT).drop("payload_bytes", "payload_digest")
    named = first.select(F.col("capture_id").alias("refers_to"), F.col("page_id").alias("first_page"), "payload_bytes", "payload_digest")
    found = seen.join(named, "refers_to", "left")  # hot responses are split by the skew join
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type")
    own = first.select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(found.select(*columns, F.col("first_page").alias("refers_to")))


def round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """The pages written to archives in the shared folder, read back and assembled: see ``digests``.

    An empty table gives no rows. See ``write_archives`` for nulls, ties and repeated rows.
    """
    folder = new_work_dir(pages.sparkSession, "warc")
    write_archives(pages, folder, min_revisit_bytes=min_revisit_bytes)
    records = written(read_records(pages.sparkSession, folder, payloads=False), "warc-records")
    return digests(assemble(records, payloads=False))
