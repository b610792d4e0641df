"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256, after a check that equal
digests mean equal payloads (length, CRC-32 and XXH64 must agree); record
headers are kept exactly, byte for byte, in a table of their own. A record is
its header joined with the payload that its digest names, hashed again when it
is read. Records are written as WARC/1.1 files, one gzip member each,
and everything that is asked of the archive is parsed from the bytes of those files.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.llm.common import Scratch, with_groups

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: bytes of a file, about: members are gathered until they have so many
FILE_BYTES = 32 << 20


def _header_safe(c: Column) -> Column:
    """Header values hold no line breaks: percent signs, CR and LF are percent-encoded."""
    out = c
    for raw, enc in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        out = F.replace(out, F.lit(raw), F.lit(enc))
    return out


def _unsafe(value: bytes) -> str:
    for raw, enc in ((b"\n", b"%0A"), (b"\r", b"%0D"), (b"%", b"%25")):
        value = value.replace(enc, raw)
    return value.decode()


def write_archive(pages: DataFrame, scratch: Scratch, min_revisit_bytes: int = 1000, text: str = "html",
                  key: str = "page_id", url: str = "url", date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the tables ``records`` (header, type, address) and ``payloads`` (address, payload); returns both, read back.

    A null payload counts as empty, a null url has no Target-URI line, a null
    id no Page-ID line. Of rows with one payload of at least
    ``min_revisit_bytes`` bytes the largest id is the response (null ids
    last); rows equal in id and payload are all responses, and revisits refer
    to the first of them. Each record has a UUID of its own, whatever ids
    repeat. ``date`` is the records' WARC-Date (the time of writing). A very frequent
    payload is reduced to one row by partial aggregation before any shuffle,
    and only its responses are joined to its bytes.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"), F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("payload")).withColumn("address", F.unhex(F.sha2("payload", 256)))
    facts = scratch.store(rows.select(
        "uid", "id", "url", "address", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("sha1"),
        F.struct(F.crc32("payload"), F.xxhash64("payload"), F.octet_length("payload")).alias("check")), "facts")
    records = with_groups(facts, ["address"], [F.max(F.struct("id", (-F.col("uid")).alias("uid"))).alias("best"),
                                               F.min("check").alias("lo"), F.max("check").alias("hi")], scratch, "groups")
    n = F.when(F.col("lo") == F.col("hi"), F.col("n")).otherwise(F.raise_error(F.lit("one digest, two payloads")))
    revisit = (n >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("best.id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def urn(uid: Column) -> Column:
        h = F.md5(F.concat(F.lit(scratch.base + ":"), uid.cast("string")))      # version 8: an own scheme
        part = lambda a, b: F.substring(h, a, b)
        return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-8"), part(18, 3),
                        F.lit("-"), part(21, 12), F.lit(">"))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n.cast("string"),
                    F.lit(CRLF * 2))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("uid"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", _header_safe(F.col("url"))), F.lit("")),
        F.coalesce(line("Page-ID", F.col("id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(-F.col("best.uid"))),
                                 line("WARC-Refers-To-Date", F.lit(date)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.length(http) + F.when(revisit, 0).otherwise(n)).cast("string")), F.lit(CRLF), http)
    head = scratch.store(records.select(header.cast("binary").alias("header"), F.when(~revisit, F.col("address")).alias("address")), "records")
    body = scratch.store(rows.groupBy("address").agg(F.first("payload").alias("payload")), "payloads")
    scratch.drop("facts", "groups")
    return head, body


def rebuilt(records: DataFrame, payloads: DataFrame) -> DataFrame:
    """The exact bytes of every record (``record``): header, a response's payload, two CRLF.

    A payload that no longer has the digest it is stored under raises.
    """
    body = payloads.select(
        F.col("address").alias("a"),
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")).otherwise(
            F.raise_error(F.lit("stored payload does not match its digest"))).alias("payload"))
    joined = records.join(body, F.col("address") == F.col("a"), "left")
    lacking = F.col("address").isNotNull() & F.col("a").isNull()
    return joined.select(F.concat(
        F.col("header"), F.when(lacking, F.raise_error(F.lit("no payload of this digest")).cast("binary")).otherwise(
            F.coalesce("payload", F.lit(b""))), F.lit((CRLF * 2).encode())).alias("record"))


_EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def write_warc_files(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """The records' bytes as WARC files of about ``file_bytes`` (a longer record has its own), a gzip member a record.

    A task gathers members up to a file's size, so no file outgrows what a
    reader takes as a whole. Spark's text sink writes the bytes as they are and
    ends a row with the separator; the last byte of a gzip member is the high byte of its
    length, zero under 16 MB, so it is that byte; a member of a longer
    record is followed by an empty one.
    """
    def pack(batches):
        held, size = [], 0

        def file():
            whole = b"".join(held)
            return pa.RecordBatch.from_arrays([pa.array([whole[:-1] if not whole[-1] else whole + _EMPTY_MEMBER[:-1]], pa.binary())],
                                              names=["members"])

        for b in batches:
            for record in b.column("record"):
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                held.append(z.compress(record.as_buffer()) + z.flush())
                size += len(held[-1])
                if size >= file_bytes:
                    yield file()
                    held, size = [], 0
        if held:
            yield file()

    files = records.mapInArrow(pack, "members binary").select(F.col("members").cast("string").alias("value"))
    files.write.mode("overwrite").option("lineSep", "\0").option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def gzip_members(data: memoryview, step: int = 1 << 16) -> Iterator[bytes]:
    """The content of each member of a gzip file, empty ones too; raises where one is broken or cut off."""
    at = 0
    while at < len(data):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if at >= len(data):
                raise ValueError("a gzip member is cut off")
            part = data[at:at + step]
            out.append(z.decompress(part))
            at += len(part)
        at -= len(z.unused_data)
        yield b"".join(out)


def parse_record(record: bytes) -> dict:
    """Fields of one record's bytes; raises where its lengths or digests don't agree."""
    head, gap, rest = record.partition((CRLF * 2).encode())
    version, *lines = head.split(CRLF.encode())
    fields = dict(x.split(b": ", 1) for x in lines)
    length = int(fields[b"Content-Length"])
    if not version.startswith(b"WARC/1.") or not gap or rest[length:] != (CRLF * 2).encode():
        raise ValueError("not a whole WARC record")
    http, payload = rest[:length].split((CRLF * 2).encode(), 1)
    kind, digest = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload digest differs")
    uri, page = fields.get(b"WARC-Target-URI"), fields.get(b"Page-ID")
    refers = fields.get(b"WARC-Refers-To")
    return {"record_id": fields[b"WARC-Record-ID"].decode(), "id": None if page is None else int(page), "url": None if uri is None else _unsafe(uri),
            "type": kind, "date": fields[b"WARC-Date"].decode(), "refers": refers and refers.decode(), "sha1": digest,
            "n": len(payload), "header": head, "payload": payload if kind == "response" else None}


_PARSED = ("record_id string, id long, url string, type string, date string, refers string, sha1 string, n long, header binary")


def parse_files(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the WARC files under ``path``, parsed from their bytes (payloads of responses only)."""
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "binary": pa.binary()}.get(c.split()[1], pa.string())) for c in _PARSED.split(", ")]
                       + [("payload", pa.binary())] * with_payload)

    def run(batches):
        for b in batches:
            for content in b.column("content"):
                out, size = [], 0
                for member in gzip_members(memoryview(content.as_buffer())):
                    if member:
                        row = parse_record(member)
                        out.append({n: row[n] for n in schema.names})
                        size += len(member)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _PARSED + (", payload binary" if with_payload else ""))


def read_archive(spark: SparkSession, path: str, scratch: Scratch, with_payload: bool = False) -> DataFrame:
    """``id, url, type, refers_to, sha1, n, date, header`` (and ``payload``, also of revisits) of all records under ``path``.

    A revisit is completed from the record it refers to; one that refers to no record, or to another payload, raises.
    """
    parsed = scratch.store(parse_files(spark, path, with_payload), "parsed")
    more = ["payload"] if with_payload else []
    whole = parsed.where("type = 'response'")
    of = whole.select(F.col("record_id").alias("r_record"), F.col("id").alias("refers_to"), F.col("sha1").alias("r_sha1"),
                      F.col("n").alias("r_n"), *[F.col(c).alias(f"r_{c}") for c in more])
    again = parsed.where("type = 'revisit'").join(of, F.col("refers") == F.col("r_record"), "left")
    sha1 = F.when(F.col("sha1") == F.col("r_sha1"), F.col("sha1")).otherwise(
        F.raise_error(F.lit("a revisit refers to no record of its payload digest")))
    keep = ["id", "url", "type", "refers_to", "sha1", "n", "date", "header", *more]
    again = again.select("id", "url", "type", "refers_to", sha1.alias("sha1"), F.col("r_n").alias("n"), "date", "header",
                         *[F.col(f"r_{c}").alias(c) for c in more])
    return whole.withColumn("refers_to", F.lit(None).cast("long")).select(keep).unionByName(again)


def archive_pages(pages: DataFrame, min_revisit_bytes: int = 1000, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes all pages as WARC files and reads those back: ``page_id, payload_bytes, payload_digest, record_type,
    refers_to, url``, one row per page. Other columns are ignored; an empty table gives no rows."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    records, payloads = write_archive(pages, scratch, min_revisit_bytes)
    write_warc_files(rebuilt(records, payloads), scratch.path("files"), file_bytes)
    scratch.drop("records", "payloads")
    back = read_archive(spark, scratch.path("files"), scratch)
    return back.select(F.col("id").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
                       F.col("type").alias("record_type"), "refers_to", "url")


def pages_sql(min_revisit_bytes: int = 1000) -> str:
    """DuckDB SQL for the rows of ``archive_pages``."""
    return f"""
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
        f AS (SELECT page_id, url, octet_length(encode(html)) AS n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS best FROM p),
        r AS (SELECT *, n >= {min_revisit_bytes} AND page_id IS DISTINCT FROM best AS again FROM f)
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN best END AS refers_to, url FROM r"""
