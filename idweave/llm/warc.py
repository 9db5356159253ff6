"""WARC archives: write segmented records, read them back, reassemble the segments.

Writing: a payload is framed as a chunked HTTP response; a block above
``segment_bytes`` becomes a first record and continuation records. Spark's
text writer stores the records (its line separator is the record's closing
CRLF CRLF), gzipped, a bounded number to a file. Reading: files are parsed by
their Content-Length headers; continuation records are grouped by origin
identifier, ordered by segment number, checked against the total length, and
the chunked transfer framing is decoded.

Defined results: a null html is an empty payload; a null page id is not
written and reads back as null; repeated page ids make separate records; a
group of segments with a gap, a repeat or another total length, and a body
whose framing is broken, give ``ok`` false and a null payload; no pages give
no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, numbered, store, texts

SEGMENT_BYTES, HTTP_CHUNK, RECORDS_PER_FILE, MIN_REVISIT = 16_384, 8_192, 2_000, 1_000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def chunked(body: bytes, size: int = HTTP_CHUNK) -> bytes:
    """Chunked transfer framing of ``body``."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (body[i:i + size] for i in range(0, len(body), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes | None:
    """The body of a chunked transfer; None where the framing is broken."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = data[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None
        n, at = int(size, 16), end + 2
        if data[at + n:at + n + 2] != b"\r\n" and n:
            return None
        if not n:
            return b"".join(out)
        out.append(data[at:at + n])
        at += n + 2


def block_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response block; None where it is broken."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r\n", b"\n")) else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record without its closing CRLF CRLF, which the file writer adds."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive, by Content-Length."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        head = {k.decode().strip().lower(): v.decode() for k, v in _FIELDS.findall(data[at:end + 2])}
        n = int(head["content-length"])
        yield head, data[end + 4:end + 4 + n]
        at = end + 4 + n


def record_id(row_no: int, part: int = 0) -> str:
    """A repeatable record identifier."""
    h = hashlib.md5(f"{row_no}/{part}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def page_records(row_no: int, page_id: int | None, url: bytes, payload: bytes, refers: int | None,
                 segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    uri = re.sub(r"\s+", "%20", url.decode("utf-8", "replace")) or None
    date, digest = "2024-01-01T00:00:00Z", f"sha1:{hashlib.sha1(payload).hexdigest()}"
    base = [("WARC-Record-ID", record_id(row_no)), ("WARC-Date", date), ("WARC-Target-URI", uri), ("Page-ID", page_id),
            ("WARC-Payload-Digest", digest)]
    if refers is not None:
        yield record([("WARC-Type", "revisit"), *base, ("WARC-Profile", REVISIT_PROFILE),
                      ("WARC-Refers-To", record_id(refers))], b"")
        return
    block = HTTP_HEAD + chunked(payload)
    base.append(("Content-Type", "application/http; msgtype=response"))
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), *base], block)
        return
    starts = range(0, len(block), segment_bytes)
    yield record([("WARC-Type", "response"), *base, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for no, start in enumerate(starts[1:], 2):
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(row_no, no)), ("WARC-Date", date),
                      ("WARC-Segment-Origin-ID", record_id(row_no)), ("WARC-Segment-Number", no),
                      ("WARC-Segment-Total-Length", len(block) if no == len(starts) else None)],
                     block[start:start + segment_bytes])


def revisits(pages: DataFrame, page_id: str, html: str, min_bytes: int) -> DataFrame:
    """(row_no, refers): rows that repeat a payload, and the row that holds it (the largest page id)."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    each = store(pages.select("row_no", F.col(page_id).cast("bigint").alias("id"), F.sha2(payload, 256).alias("same"),
                              F.length(payload).alias("n")).filter(F.col("n") >= min_bytes), "payloads")
    groups = each.groupBy("same", "n").agg(F.max(F.struct("id", "row_no")).alias("held"), F.count("*").alias("rows"))
    held = store(groups.filter("rows > 1").select("same", "n", F.col("held.row_no").alias("refers")), "held")
    return each.join(held, ["same", "n"]).filter("row_no != refers").select("row_no", "refers")


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE,
               min_revisit: int = MIN_REVISIT) -> None:
    """Write one record, or one response with its continuations, for each row of ``pages`` (a table just read)."""
    pages = numbered(pages)
    again = store(revisits(pages, page_id, html, min_revisit), "revisits")
    rows = pages.select("row_no", F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).alias("html"))
    small = again.count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(again) if small else again, "row_no", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in ("row_no", "page_id")), texts(batch, "url"),
                           texts(batch, "html"), batch.column("refers").to_pylist()):
                for r in page_records(*row, segment_bytes):
                    made.append(r)
                    size += len(r)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])
                    made, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
     .text(path))


_RECORD = ("record_id string, record_type string, page_id bigint, refers_to string, digest string, origin string, "
           "segment int, total bigint, block binary")


def parse_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; a file is parsed in one piece, so its size is bounded when written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                           ("refers_to", pa.string()), ("digest", pa.string()), ("origin", pa.string()),
                           ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])
        number = lambda h, k: int(h[k]) if k in h else None
        for batch in batches:
            for i in range(batch.num_rows):
                made, size = [], 0
                for h, block in records(gzip.decompress(batch.column("content")[i].as_py())):
                    made.append((h.get("warc-record-id"), h.get("warc-type"), number(h, "page-id"),
                                 h.get("warc-refers-to"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                 h.get("warc-segment-origin-id") or (h.get("warc-record-id") if "warc-segment-number" in h
                                                                     else None),
                                 number(h, "warc-segment-number"), number(h, "warc-segment-total-length"), block))
                    size += len(block)
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*made), types)], schema=types)
                        made, size = [], 0
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*made), types)], schema=types)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return files.mapInArrow(run, _RECORD)


def reassembled(parsed: DataFrame) -> DataFrame:
    """Records with their whole blocks: segments grouped by origin, in order, their total length verified."""
    plain = parsed.filter("origin IS NULL").select("record_id", "record_type", "page_id", "refers_to", "digest", "block")
    parts = parsed.filter("origin IS NOT NULL").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        *(F.max(c).alias(c) for c in ("page_id", "refers_to", "digest")),
        F.max(F.when(F.col("record_type") != "continuation", F.col("record_type"))).alias("record_type"))
    whole: Column = F.expr("reduce(parts.block, X'', (a, b) -> a || b)")
    in_order = (F.col("parts.segment") == F.sequence(F.lit(1), F.size("parts"))) & (F.length(whole) == F.col("total"))
    joined = parts.select(F.col("origin").alias("record_id"), "record_type", "page_id", "refers_to", "digest",
                          F.when(in_order, whole).alias("block"))
    return plain.unionByName(joined)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit: record_id, record_type, page_id, refers_to, digest (of the header), payload, ok."""
    schema = ("record_id string, record_type string, page_id bigint, refers_to string, digest string, payload binary, "
              "payload_bytes bigint, payload_sha1 string, ok boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, digests = batch.column("record_type").to_pylist(), batch.column("digest").to_pylist()
            data = [None if k == "revisit" or b is None else block_payload(b)
                    for k, b in zip(kinds, batch.column("block").to_pylist())]
            sha = [None if p is None else hashlib.sha1(p).hexdigest() for p in data]
            ok = [k == "revisit" or s is not None and d in (None, s) for k, s, d in zip(kinds, sha, digests)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(data, pa.binary()),
                 pa.array([None if p is None else len(p) for p in data], pa.int64()), pa.array(sha, pa.string()),
                 pa.array(ok, pa.bool_())],
                names=["record_id", "record_type", "page_id", "refers_to", "digest", "payload", "payload_bytes",
                       "payload_sha1", "ok"])

    return reassembled(parse_warc(spark, path)).mapInArrow(run, schema)


def archive_report(archive: DataFrame) -> DataFrame:
    """Per record of a read archive: page_id, payload_bytes, payload_digest, record_type, refers_to (a page id), ok.

    A revisit takes the figures of the response it refers to; it is ok when
    that response is there, whole, and of the digest that the revisit names.
    """
    each = store(archive.drop("payload"), "archive")
    own = each.filter("record_type != 'revisit'").select(
        "page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type",
        F.lit(None).cast("bigint").alias("refers_to"), "ok")
    held = each.filter("record_type != 'revisit'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("held_id"), F.col("payload_bytes").alias("n"),
        F.col("payload_sha1").alias("sha"), F.col("ok").alias("held_ok"))
    back = each.filter("record_type = 'revisit'").select("page_id", "digest", "record_type", "refers_to").join(
        held, "refers_to", "left").select(
        "page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("held_id").alias("refers_to"), F.coalesce(F.col("held_ok") & (F.col("sha") == F.col("digest")),
                                                        F.lit(False)).alias("ok"))
    return own.unionByName(back)
