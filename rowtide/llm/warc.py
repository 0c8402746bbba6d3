"""WARC archives without repeated payloads: revisit records, resolved by payload digest.

Only headers (id, address, digest, length) are shuffled by digest. The largest id of each digest is the response, the
others become revisits of it; both get fresh headers. Records are written by Spark's text writer, whose line separator
is the record terminator of the format, so a lost executor's file is committed once or not at all, in any store that
Spark writes to. A file written here is one gzip stream. Reading takes files of any number of gzip members
(``*.gz``), inflates them piece by piece and goes by Content-Length, a record at a time; a cut member or record raises, and
each payload's digest is computed anew and compared.

A null html is an empty payload; a null url leaves its header out; a null id is written as ``null`` and read as null,
and never refers or is referred to unless all copies lack an id (then all are responses). Repeated rows of one id and
payload are the same kind. An empty table gives an archive without records. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.blocks import written

# Fixed values of the format.
END = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

FILE_BYTES = 64 << 20
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def payload_digest(payload: Column) -> Column:
    """Bare base32 SHA-1: every five hex digits are four base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def headers_of(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", payload_digest(html).alias("digest"), F.octet_length(html).cast("long").alias("bytes"))


def originals(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The response (id and address) of each digest that several records share."""
    return (
        headers.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max(F.struct("page_id", "url")).alias("original"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("original.page_id").isNotNull())
        .select("digest", "bytes", F.col("original.page_id").alias("refers_to"), F.col("original.url").alias("refers_url"))
    )


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Each record that repeats another's payload, with the response that it refers to."""
    first = written(originals(headers, min_bytes), "warc-originals")
    return (
        headers.join(first, ["digest", "bytes"])
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to", "refers_url")
        .distinct()
    )


def _line(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null; line ends inside it are escaped."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def record_text(date: str) -> Column:
    """One record without its terminator, from page_id, url, html, digest, refers_to and refers_url."""
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(again, 0).otherwise(F.octet_length("html"))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.coalesce(_urn(F.col("page_id")), F.lit("<urn:page:null>"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(again, PROFILE)),
        _line("WARC-Refers-To", F.when(again, _urn(F.col("refers_to")))),
        _line("WARC-Refers-To-Target-URI", F.when(again, F.col("refers_url"))),
        _line("WARC-Refers-To-Date", F.when(again, date)),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
        F.when(again, "").otherwise(F.col("html")),
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``path``; files hold about ``file_bytes``."""
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    headers = written(headers_of(pages), "warc-headers")
    total = headers.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    again = revisits(headers, min_bytes).withColumnRenamed("page_id", "again_id").withColumnRenamed("digest", "again_digest")
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), payload_digest(html).alias("digest"))
    rows = rows.join(again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    each = max(1, int(file_bytes * total["n"] / max(1, total["bytes"])))
    rows.select(record_text(date).alias("value")).write.options(lineSep=END, compression="gzip", maxRecordsPerFile=each).text(path)


def inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of all members of a gzip file, in pieces of at most ``step`` bytes; raises where one is cut short."""
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        feed = data[at : at + step]
        while True:
            piece = member.decompress(feed, step)
            yield piece
            if member.eof:
                break
            feed = member.unconsumed_tail
            if not feed and len(piece) < step:
                at += step
                feed = data[at : at + step]
                if not feed:
                    raise ValueError(f"gzip member cut short at byte {len(data)}")
        at = min(at + step, len(data)) - len(member.unused_data)


class _Stream:
    """A moving piece of an archive."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held, self.at, self.passed = pieces, bytearray(), 0, 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        if self.at:
            del self.held[: self.at]
            self.passed, self.at = self.passed + self.at, 0
        self.held += piece
        return True

    def ended(self) -> bool:
        while self.at >= len(self.held):
            if not self.more():
                return True
        return False

    def up_to(self, mark: bytes) -> bytes:
        """What stands before the mark; both are used up."""
        looked = 0
        while (end := self.held.find(mark, self.at + looked)) < 0:
            looked = max(0, len(self.held) - self.at - len(mark))
            if not self.more():
                raise ValueError(f"broken record at byte {self.passed + self.at}")
        out = bytes(self.held[self.at : end])
        self.at = end + len(mark)
        return out

    def take(self, size: int) -> bytes:
        while len(self.held) - self.at < size:
            if not self.more():
                raise ValueError(f"record cut short at byte {self.passed + self.at}")
        out = bytes(self.held[self.at : self.at + size])
        self.at += size
        return out


def parse(archive: bytes | Iterator[bytes]) -> Iterator[tuple]:
    """The responses and revisits of an archive, in the order of ``RECORD``; raises where a record is broken.

    One record is held at a time. Other record types are passed over.
    """
    stream = _Stream(iter([archive]) if isinstance(archive, (bytes, bytearray)) else archive)
    while not stream.ended():
        at = stream.passed + stream.at
        first, *lines = stream.up_to(b"\r\n\r\n").decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines)
        block = stream.take(int(head["Content-Length"]))
        if not first.startswith("WARC/1.") or stream.take(4) != b"\r\n\r\n":
            raise ValueError(f"broken record at byte {at}")
        kind = head["WARC-Type"]
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "revisit":
            payload = None
        elif len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
        ids = [x if x is None else x[len("<urn:page:") : -1] for x in (head["WARC-Record-ID"], head.get("WARC-Refers-To"))]
        page, refers = (None if x in (None, "null") else int(x) for x in ids)
        yield page, head.get("WARC-Target-URI"), kind, refers, size, digest, payload


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``; ``payload=False`` leaves the payloads (checked all the same) out."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def read(batches):
        for batch in batches:
            for content in batch.column(0):
                records = parse(inflated(content.as_py()))
                while rows := list(islice(records, 500)):
                    columns = list(zip(*rows))
                    if not payload:
                        columns[-1] = [None] * len(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(read, RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """Revisit records get the payload of the response that they refer to; a lost response leaves it null."""
    first = records.where(F.col("record_type") == "response").select(F.col("page_id").alias("refers_to"), F.col("payload").alias("found"))
    first = first.dropDuplicates(["refers_to"])
    return records.join(first, "refers_to", "left").withColumn("payload", F.coalesce("payload", "found")).select(*records.columns)
