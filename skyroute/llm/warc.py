"""WARC archives: writing pages as records, reading them back, reassembling segments.

Writing: every page becomes a ``response`` record whose block is an HTTP message with
chunked transfer framing. Of pages with equal payloads of at least ``revisit_bytes``
bytes the one with the smallest id is the response and the others are ``revisit``
records without a payload. Blocks longer than ``segment_bytes`` are cut: the first
segment keeps the record's type, the rest are ``continuation`` records that name the
origin record, their segment number and, on the last one, the total length. Spark's
text writer stores the records, with the record end as line separator and gzip, so the
part files are archives and lie wherever Spark can write.

Reading: archives are parsed by Content-Length in ``mapInArrow``; only segments of cut
records are shuffled, grouped by origin, ordered by segment number, checked (numbers
without gaps, total length) and joined; then the chunk framing is decoded.

``read_archives`` gives each response a ``status``: ``ok``, ``incomplete`` (missing or
wrong segments) or ``framing`` (the chunk framing is broken); faulty ones have no payload.
Records of other types (``warcinfo``, ``request`` and so on) are left out. An archive that is
cut or damaged gives its records up to that place and one row with status ``broken``.

Cases: null html is an empty payload, null urls are empty; control characters in urls are
percent-encoded; equal rows with the smallest id are all responses; a null id is a
response only in a group without any id; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroute.llm.common import stored

RECORD_END = b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: Records in one archive file at most, so that a file fits a task's memory.
FILE_RECORDS = 4096


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken or does not end."""
    out, at = [], 0
    while (eol := body.find(b"\r\n", at)) >= 0:
        head = body[at:eol].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", head):
            return None
        n, at = int(head, 16), eol + 2
        if n == 0:  # trailer lines may follow; an empty line ends them
            return b"".join(out) if body.startswith(b"\r\n", at) or RECORD_END in body[at:] else None
        if len(body) < at + n + 2 or body[at + n:at + n + 2] != b"\r\n":
            return None
        out.append(body[at:at + n])
        at += n + 2
    return None


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response message; None if it is broken."""
    head, mark, body = block.partition(RECORD_END)
    if not mark:
        return None
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def _head(kind: str, record_id: str, date: str, n: int, **fields: object) -> bytes:
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date, "Content-Length": n}
    named |= {k.replace("_", "-"): v for k, v in fields.items() if v is not None}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()) + "\r\n").encode()


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_records(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, row: int,
                 date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page, without their record ends; ``row`` makes record ids unique."""
    name = lambda k: uuid.UUID(bytes=hashlib.md5(f"{page_id}/{row}/{k}".encode()).digest()).urn
    own = {"WARC_Target_URI": _safe(url), "WARC_Payload_Digest": f"sha256:{digest}", "X_Page_ID": page_id}
    if refers_to is not None:
        yield _head("revisit", name(1), date, 0, **own, X_Refers_To_Page_ID=refers_to,
                    WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    for k, part in enumerate(parts, 1):
        cut = {"WARC_Segment_Number": k if len(parts) > 1 else None,
               "WARC_Segment_Origin_ID": f"<{name(1)}>" if k > 1 else None,
               "WARC_Segment_Total_Length": len(block) if k == len(parts) > 1 else None}
        yield _head("response" if k == 1 else "continuation", name(k), date, len(part),
                    **(own if k == 1 else {}), **cut, Content_Type="application/http; msgtype=response") + part


def with_revisits(pages: DataFrame, revisit_bytes: int, page_col: str, html_col: str) -> DataFrame:
    """Adds ``digest`` and ``refers_to``; the join carries each text through one shuffle."""
    text = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.withColumn("digest", F.sha2(text.cast("binary"), 256))
    firsts = (rows.where(F.octet_length(text) >= revisit_bytes).groupBy(F.col("digest").alias("__digest"))
              .agg(F.min(page_col).alias("__first"), F.count(F.lit(1)).alias("__copies"))
              .where("__copies > 1"))
    return (rows.join(firsts, F.col("digest") == F.col("__digest"), "left")
            .withColumn("refers_to", F.when(~F.col(page_col).eqNullSafe(F.col("__first")), F.col("__first")))
            .drop("__digest", "__first", "__copies"))


def write_archives(pages: DataFrame, path: str, page_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", revisit_bytes: int = 100, segment_bytes: int = 1 << 15,
                   chunk_bytes: int = 1 << 13, date: datetime = datetime(2000, 1, 1, tzinfo=timezone.utc)) -> None:
    """Write gzip archives under ``path``; ``date`` is the records' date."""
    plain = pages.select(F.col(page_col).cast("long").alias("page"), F.coalesce(url_col, F.lit("")).alias("url"),
                         F.col(html_col).alias("html"))
    rows = with_revisits(plain, revisit_bytes, "page", "html")
    rows = rows.select("page", "url", "html", "digest", "refers_to", F.monotonically_increasing_id().alias("row"))
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                out = [r for x in b.slice(i, 256).to_pylist()
                       for r in page_records(x["page"], x["url"], (x["html"] or "").encode(), x["digest"],
                                             x["refers_to"], x["row"], stamp, segment_bytes, chunk_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", RECORD_END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(lower-case headers, block) of each record; raises ValueError on a broken record."""
    at = 0
    while at < len(data):
        end = data.find(RECORD_END, at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode().split("\r\n")[1:]
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop:stop + 4] != RECORD_END:
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield head, data[start:stop]
        at = stop + 4


def inflated(data: bytes) -> tuple[bytes, bool]:
    """What an archive holds, and whether that is all: gzip members one after the other, or plain bytes."""
    if data[:2] != b"\x1f\x8b":
        return data, True
    out, at = [], 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof and at < len(data):
            try:
                out.append(member.decompress(data[at:at + (1 << 16)]))
            except zlib.error:
                return b"".join(out), False
            at = min(at + (1 << 16), len(data)) - len(member.unused_data)
        if not member.eof:
            return b"".join(out), False
    return b"".join(out), True


_PARSED = ("record_id string, record_type string, page_id long, refers_to long, digest string, segment int, "
           "total long, block binary, payload_bytes long, payload_digest string, payload binary, status string")


def _finished(block: bytes | None, keep: bool) -> dict:
    payload = None if block is None else http_payload(block)
    if payload is None:
        return {"status": "incomplete" if block is None else "framing"}
    return {"status": "ok", "payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(),
            "payload": payload if keep else None}


def joined(segments: list[tuple[int, int | None, bytes]]) -> bytes | None:
    """The block of ordered (number, total, bytes) segments; None if one lacks or the length is wrong."""
    total = segments[-1][1]
    block = b"".join(s[2] for s in segments)
    whole = [s[0] for s in segments] == list(range(1, len(segments) + 1)) and total == len(block)
    return block if whole else None


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per response or revisit record, cut records put together again, and one per broken archive."""
    fields = [x.split()[0] for x in _PARSED.split(", ")]
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(),
                             "binary": pa.binary()}[t]) for n, t in (x.split() for x in _PARSED.split(", "))])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{f: r.get(f) for f in fields} for r in rows], schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data, whole = inflated(content.as_buffer().to_pybytes())
                rows, held, records = [], 0, parse_records(data)
                while True:
                    try:
                        head, block = next(records)
                    except StopIteration:
                        break
                    except (ValueError, KeyError):  # decoding errors are value errors
                        whole = False
                        break
                    number = head.get("warc-segment-number")
                    r = {"record_id": head.get("warc-segment-origin-id", head["warc-record-id"]),
                         "record_type": head["warc-type"],
                         "page_id": int(head["x-page-id"]) if "x-page-id" in head else None,
                         "refers_to": int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
                         "digest": head.get("warc-payload-digest", "").removeprefix("sha256:")}
                    if number:
                        r |= {"segment": int(number), "block": block,
                              "total": int(head.get("warc-segment-total-length", 0)) or None}
                    elif r["record_type"] == "response":
                        r |= _finished(block, keep_payload)
                    elif r["record_type"] == "revisit":
                        r["status"] = "ok"
                    else:
                        continue
                    rows.append(r)
                    held += len(block)
                    if held > 1 << 22 or len(rows) >= 1024:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows if whole else [*rows, {"status": "broken"}])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                rows = []
                for x in b.slice(i, 64).to_pylist():
                    s = sorted(x["segments"], key=lambda s: s["segment"])
                    head = next((y for y in s if y["segment"] == 1), {})
                    block = joined([(y["segment"], y["total"], y["block"]) for y in s])
                    rows.append({"record_id": x["record_id"], "record_type": head.get("record_type"),
                                 "page_id": head.get("page_id"), "digest": head.get("digest")}
                                | _finished(block, keep_payload))
                yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    records = stored(files.mapInArrow(parse, _PARSED), "warc-records")
    cut = (records.where("segment is not null").groupBy("record_id")
           .agg(F.collect_list(F.struct("segment", "total", "block", "record_type", "page_id", "digest"))
                .alias("segments")))
    out = ["record_id", "record_type", "page_id", "refers_to", "digest", "payload_bytes", "payload_digest", "payload",
           "status"]
    put_together = cut.mapInArrow(assemble, _PARSED).where("record_type is null or record_type = 'response'")
    return records.where("segment is null").select(out).unionByName(put_together.select(out))


def resolved(records: DataFrame) -> DataFrame:
    """Revisits get length and digest of the payload that they refer to; ``digest`` must agree."""
    target = (records.where("record_type = 'response' and status = 'ok'")
              .groupBy(F.col("page_id").alias("__page"), F.col("payload_digest").alias("__digest"))
              .agg(F.max("payload_bytes").alias("__bytes")))
    same = (F.col("refers_to") == F.col("__page")) & (F.col("digest") == F.col("__digest"))
    return (records.join(target, same, "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "__bytes"))
            .withColumn("payload_digest", F.coalesce("payload_digest", "__digest"))
            .drop("__page", "__digest", "__bytes"))
