"""WARC archives: writing, and reading as a table of payload chunks.

A page becomes one ``response`` record, or a ``revisit`` without payload where
an equal payload is already there. A payload larger than a segment is written
as segments (``continuation`` records), so no record has to be built whole. The
reader unpacks archives as a stream and returns (record, chunk number) rows with
the digest of the payload so far: the last chunk carries the whole digest.

Records lie one after the other in the files of Spark's own text writer, whose
row separator is the pair of line ends that closes a WARC record.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.llm.common import quoted

#: Least payload that a revisit may stand for, bytes of a segment, bytes of a chunk.
REVISIT_BYTES, SEGMENT_BYTES, CHUNK_BYTES = 1000, 1 << 20, 1 << 18
_END = "\r\n"

CHUNKS = ("page_id string, record_type string, refers_to string, target string, chunk int, data binary, "
          "payload_bytes long, payload_digest string, last boolean, intact boolean")


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                 least: int = REVISIT_BYTES) -> DataFrame:
    """One row per page: key, url, payload (binary), payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least ``least`` bytes the one with the largest key
    is the response (null is smaller than any; repeated rows of that key are
    all responses), the others revisit it. Null is the empty payload.
    """
    body = F.coalesce(F.col(quoted(payload)).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(quoted(key)).alias("page_id"), F.col(quoted(url)).cast("string").alias("url"),
                        body.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    groups = (rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1"))
    rows = rows.join(groups, "payload_digest", "left")
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"))


def write_archives(records: DataFrame, path: str, segment: int = SEGMENT_BYTES, date: str | None = None) -> None:
    """Write planned records as gzip-compressed WARC 1.1 files under ``path`` (a new folder)."""
    when = F.lit(date) if date else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    last = F.greatest(F.ceil(size / F.lit(segment)) - 1, F.lit(0)).cast("int")
    rows = records.withColumn("part", F.explode(F.sequence(F.lit(0), last))).withColumn("last", last)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(_END + _END))
    piece = F.coalesce(F.expr(f"substring(payload, part * {segment} + 1, {segment})"), F.lit(b""))
    block = F.concat(F.when(F.col("part") == 0, http).otherwise("").cast("binary"), piece)
    first, split = F.col("part") == 0, F.col("last") > 0

    def line(title: str, value: Column, if_: Column = F.lit(True)) -> Column:
        return F.when(if_ & value.isNotNull(), F.concat(F.lit(f"{title}: "), value, F.lit(_END))).otherwise("")

    def urn(id_: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), id_, F.lit(">"))

    part = (F.col("part") + 1).cast("string")
    head = F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, urn(name)).otherwise(urn(F.concat(name, F.lit(":"), part)))),
        line("WARC-Date", when),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        line("Content-Type", F.lit("application/http; msgtype=response"), first),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")), first),
        line("WARC-Refers-To", urn(F.col("refers_to").cast("string")), first),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
             F.col("record_type") == "revisit"),
        line("WARC-Segment-Number", part, split),
        line("WARC-Segment-Origin-ID", urn(name), ~first),
        line("WARC-Segment-Total-Length", (F.octet_length(http) + size).cast("string"), split & (F.col("part") == F.col("last"))),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_END))
    record = F.concat(head.cast("binary"), block).cast("string")
    rows.select(record.alias("value")).write.option("lineSep", _END + _END).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str, chunk: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk table of all archives under ``path``: one row per record and chunk of its payload, from 0.

    ``payload_bytes`` and ``payload_digest`` (bare SHA-1) cover the payload up to
    and including the chunk; a revisit has one row with the figures of the
    payload it stands for. ``intact`` tells, on the last row, whether digest and
    length are those the record names. Without ``with_data`` the bytes are left out.
    A file with no records gives no rows; one that breaks off is an error.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target", pa.string()),
            ("chunk", pa.int32()), ("data", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("last", pa.bool_()), ("intact", pa.bool_())])
        rows, held = [], 0
        for batch in batches:
            for content in batch.column(0):
                for row in _records(Stream(content.as_buffer()), chunk):
                    held += len(row[5]) if with_data else 0
                    rows.append(row if with_data else (*row[:5], None, *row[6:]))
                    if len(rows) == 4096 or held >= 8 * chunk:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, CHUNKS)


class Stream:
    """Bytes of a file, unpacked a little at a time."""

    def __init__(self, packed: pa.Buffer, step: int = 1 << 16):
        self.packed, self.at, self.step = memoryview(packed), 0, step
        self.unpack = zlib.decompressobj(47)
        self.ready = bytearray()

    def fill(self) -> bool:
        """Unpack some more; False at the end."""
        if self.at >= len(self.packed) and not self.unpack.unconsumed_tail:
            return False
        if self.unpack.unconsumed_tail:
            got = self.unpack.decompress(self.unpack.unconsumed_tail, 4 * self.step)
        else:
            piece = self.packed[self.at:self.at + self.step]
            self.at += len(piece)
            got = self.unpack.decompress(piece, 4 * self.step)
        if self.unpack.eof and (self.unpack.unused_data or self.at < len(self.packed)):  # the next member of the file
            self.at -= len(self.unpack.unused_data)
            self.unpack = zlib.decompressobj(47)
        self.ready += got
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Everything before the next ``mark``, which is skipped; None at the end of the file."""
        seen = 0
        while (place := self.ready.find(mark, seen)) < 0:
            seen = max(0, len(self.ready) - len(mark))
            if not self.fill():
                if self.ready.strip():
                    raise ValueError("the archive breaks off")
                return None
        out = bytes(self.ready[:place])
        del self.ready[:place + len(mark)]
        return out

    def take(self, most: int) -> bytes:
        """Up to ``most`` bytes, at least one."""
        while not self.ready:
            if not self.fill():
                raise ValueError("the archive breaks off")
        out = bytes(self.ready[:most])
        del self.ready[:most]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(_END)
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _records(stream: Stream, chunk: int) -> Iterator[tuple]:
    """Chunk rows of a file. Segments of a record follow one another."""
    blank = (_END + _END).encode()
    digest, total, number, buffer, first = None, 0, 0, bytearray(), {}

    def row(data: bytes, last: bool) -> tuple:
        intact = (digest.hexdigest() == first["payload-digest"] and total == first["payload-length"]) if last else None
        return (first["page"], "response", None, first["target"], number, data, total, digest.hexdigest(), last, intact)

    while (head := stream.until(blank)) is not None:
        fields = _fields(head.lstrip(b"\r\n"))
        left, kind = int(fields["content-length"]), fields["warc-type"]
        if kind != "continuation":
            http = stream.until(blank)
            left -= len(http) + len(blank)
            whole = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
            page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">") or None
            named = fields["warc-payload-digest"].removeprefix("sha1:")
            if kind == "revisit":
                origin = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">") or None
                yield (page, kind, origin, fields.get("warc-target-uri"), 0, b"", whole, named, True, left == 0)
                stream.until(blank)
                continue
            first = {"page": page, "target": fields.get("warc-target-uri"), "payload-digest": named, "payload-length": whole}
            digest, total, number, buffer = hashlib.sha1(), 0, 0, bytearray()
        while left:
            got = stream.take(min(left, chunk - len(buffer)))
            left -= len(got)
            buffer += got
            if len(buffer) == chunk and total + chunk < first["payload-length"]:
                digest.update(buffer)
                total += len(buffer)
                yield row(bytes(buffer), False)
                number, buffer = number + 1, bytearray()
        if "warc-segment-number" not in fields or "warc-segment-total-length" in fields:
            digest.update(buffer)
            total += len(buffer)
            yield row(bytes(buffer), True)
        stream.until(blank)
