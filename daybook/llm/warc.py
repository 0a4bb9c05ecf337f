"""WARC archives: written by Spark's own writer, read by byte ranges.

Every record is a gzip member. The members of a task are the lines of a text file whose line separator is the zero byte
that ends every member of a record below 16 MB (the high byte of the length), so archives come from Spark's committed
output and hold no partial or repeated files when tasks are lost; a longer record is followed by an empty member.

A reading task scans its byte range for the gzip magic and decodes each candidate: only one that is a whole member and
starts with a WARC header is a record. It owns the records that start inside its range and reads past its end for them.
Bytes that look like a member inside another one's data are not met after a record, as the scan goes on at its end; at
the start of a range they would have to be a stored copy of a whole compressed record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.llm.common import folder, ship, spread, whole

_MAGIC, _STEP = b"\x1f\x8b\x08", 1 << 15
_RECORD = "record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string"


def gzip_member(data: bytes, level: int) -> bytes:
    """``data`` as one gzip member, or with an empty one after it, so that the last byte is zero."""
    def one(part: bytes) -> bytes:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        return packer.compress(part) + packer.flush()

    out = one(data)
    return out if out[-1] == 0 else out + one(b"")


def base32(digest: bytes) -> str:
    """Bare upper-case base32."""
    return base64.b32encode(digest).decode()


def name_of(page) -> str:
    """An id as part of a header: percent signs for what a URI can't hold, nothing for null, one sign for empty text."""
    return "" if page is None else quote(str(page), safe="") or "%"


def record(page, url: str | None, sha1: bytes, length: int, first, payload: bytes | None, prefix: str, date: str) -> bytes:
    """The WARC record of a page: a response, or without the payload a revisit of page ``first``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
             f"WARC-Record-ID: <{prefix}{name_of(page)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{prefix}{name_of(first)}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{base32(sha1)}",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0, prefix: str = "urn:page:", date: str = "2000-01-01T00:00:00Z", level: int = 4) -> None:
    """Write a record per row, its payload the html in UTF-8, as ``*.warc.gz`` content below ``path``.

    Of rows with equal payloads of ``least_bytes`` or more, those of the smallest id are responses and the others are
    revisits of it; rows that repeat the smallest id are all responses, as are rows without an id. Null html is empty.

    Each task gives a payload to the shuffle once, however many of its rows share it; rows travel with its digests
    alone and meet the payload only if they are responses.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), whole(html_col).cast("binary").alias("payload"))
    rows = rows.withColumn("_sha", F.unhex(F.sha2("payload", 256)))
    first = rows.groupBy("_sha").agg(F.min("page").alias("first"), F.first("payload").alias("payload"))
    told = rows.select("page", "url", F.unhex(F.sha1("payload")).alias("sha1"), F.octet_length("payload").alias("length"), "_sha")
    revisit = F.coalesce((F.col("length") >= least_bytes) & (F.col("page") != F.col("first")), F.lit(False))
    told = told.join(first, "_sha").select("page", "url", "sha1", "length", F.when(revisit, F.col("first")).alias("first"),
                                           F.when(~revisit, F.col("payload")).alias("payload"))

    def members(batches):
        from daybook.llm import warc as own

        for batch in batches:
            # A few records at a time, so that a batch isn't held as Arrow, Python and compressed bytes at once.
            for at in range(0, batch.num_rows, 64):
                rows = zip(*[c.to_pylist() for c in batch.slice(at, 64).columns])
                out = [own.gzip_member(own.record(*row, prefix, date), level)[:-1] for row in rows]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    packed = told.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
    packed.write.option("lineSep", "\0").text(path)


def read_records(file, start: int, stop: int):
    """(place, data) of each record whose gzip member starts in [start, stop) of a seekable file."""
    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    held = read(start, stop - start + len(_MAGIC) - 1)
    at = start
    while (found := held.find(_MAGIC, at - start)) >= 0 and start + found < stop:
        place = start + found
        data, end = _decoded(held, found, start, read)
        if data is None:
            at = place + 1
            continue
        yield place, data
        at = end
        if at >= stop:
            return


def _decoded(held: bytes, found: int, start: int, read) -> tuple[bytes | None, int]:
    """The content and end of the member at ``held[found:]``; None if it isn't one that starts as a WARC record does."""
    unpacker, parts, at, checked = zlib.decompressobj(31), [], found, False
    while not unpacker.eof:
        piece = held[at:at + _STEP] if at < len(held) else read(start + at, _STEP)
        if not piece:
            return None, 0
        at += len(piece)
        try:
            parts.append(unpacker.decompress(piece))
        except zlib.error:
            return None, 0
        if not checked and sum(map(len, parts)) >= 5:
            checked = True
            if not b"".join(parts).startswith(b"WARC/"):
                return None, 0
    return (b"".join(parts) if checked else None), start + at - len(unpacker.unused_data)


def parse(data: bytes) -> tuple | None:
    """(record id, type, target, refers to, payload bytes, payload digest, payload) of a record; None if it is damaged."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    size = fields.get("content-length", "")
    if not size.isdigit() or len(rest) < int(size):
        return None
    block, http = rest[:int(size)], {}
    if fields.get("content-type", "").startswith("application/http"):
        inner, _, block = block.partition(b"\r\n\r\n")
        http = _fields(inner)
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    if fields.get("warc-type") == "revisit":
        length = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return bare("warc-record-id"), "revisit", bare("warc-target-uri"), bare("warc-refers-to"), length, digest, None
    return (bare("warc-record-id"), fields.get("warc-type"), bare("warc-target-uri"), bare("warc-refers-to"), len(block),
            base32(hashlib.sha1(block).digest()), block)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def read_archives(spark: SparkSession, path: str, range_bytes: int = 32 << 20, with_payload: bool = False) -> DataFrame:
    """A row per record of all files below ``path``: its id, type, target, what it refers to, and its payload's bytes
    and digest, of a revisit those that the archive states; ``with_payload`` adds the payload (null for revisits).

    Executors open the files by their own path, which Arrow's file systems must know (local, HDFS, S3, GCS).
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    ranges = files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))

    def records(batches):
        from pyarrow import fs

        from daybook.llm import warc as own

        for batch in batches:
            for uri, length, start in zip(*[c.to_pylist() for c in batch.columns]):
                system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
                rows, held = [], 0
                with system.open_input_file(name) as file:
                    for _, data in own.read_records(file, start, min(start + range_bytes, length)):
                        if (row := own.parse(data)) is not None:
                            rows.append(row)
                            held += len(row[6] or b"")
                        if len(rows) >= 1000 or with_payload and held >= 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    kinds = [*[pa.string()] * 4, pa.int64(), pa.string(), *[pa.binary()] * with_payload]
    names = [*[c.split()[0] for c in _RECORD.split(", ")], *["payload"] * with_payload]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return spread(ranges, "path", "start").mapInArrow(records, _RECORD + ", payload binary" * with_payload)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             least_bytes: int = 0) -> DataFrame:
    """The pages written to archives in the shared folder and read back: (id, payload_bytes, payload_digest,
    record_type, refers_to) per row. An empty table gives an empty result."""
    spark, prefix = pages.sparkSession, "urn:page:"
    path = f"{folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id_col, url_col, html_col, least_bytes, prefix)
    kind = pages.schema[id_col].dataType

    def number(c: str) -> Column:
        name = F.substring(c, len(prefix) + 1, (1 << 31) - 1)
        return F.when(name == "%", "").when(name != "", F.url_decode(name)).cast(kind)

    return read_archives(spark, path).select(number("record_id").alias(id_col), "payload_bytes", "payload_digest",
                                             "record_type", number("refers_to").alias("refers_to"))
