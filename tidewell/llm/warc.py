"""WARC archives: write records, read them back, resolve revisits, write without duplicates.

Records travel as rows; payloads are strings of the file, headers are small. Duplicates are found
on headers alone: they are grouped by payload digest (combined before the shuffle), and records
join the original of their digest, a join that AQE splits where one digest is hot. Only the joined
rows carry payloads, once, to the archive files.

Files are plain gzip-compressed WARC/1.1, at most ``per_file`` records each, written by Spark's
own text writer (so any store Spark knows will do) with the blank lines that end a record as line
separator. Readers take records by Content-Length, so nothing in a payload can end one early.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "\r\n\r\n"
LEAST = 1000  # payload bytes from which a copy becomes a revisit
PER_FILE = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()), T.StructField("url", T.StringType())]
    + [T.StructField("digest", T.StringType()), T.StructField("payload_bytes", T.LongType())]
    + [T.StructField("refers_to", T.LongType()), T.StructField("actual_digest", T.StringType()), T.StructField("payload", T.BinaryType())]
)


def from_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One response record per page: (page_id, url, payload, digest, payload_bytes). Null html is empty."""
    payload = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )


def resolve(records: DataFrame, least: int = LEAST) -> DataFrame:
    """Adds ``record_type`` and ``refers_to``: of equal payloads the largest page_id is the response.

    Payloads under ``least`` bytes are all responses. Records that share the largest page_id (and
    payload) are all responses, as are records without page_id if no copy has one; other records
    without page_id revisit. An empty table gives an empty result.
    """
    headers = records.where(F.col("payload_bytes") >= least).select("digest", "page_id")
    copies = headers.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("_n"))
    copies = copies.where("_n > 1 AND original IS NOT NULL").select("digest", "original")
    big = F.when(F.col("payload_bytes") >= least, F.col("digest"))
    rows = records.withColumn("_key", big).join(copies.withColumnRenamed("digest", "_key"), "_key", "left").drop("_key")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.withColumns(
        {
            "record_type": F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
            "refers_to": F.when(revisit, F.col("original")),
        }
    ).drop("original")


def _record_id(page_id):
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", per_file: int = PER_FILE) -> None:
    """Write resolved records with fresh headers; revisits have no payload of their own."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    # A header is one line: white space and control characters of the address are escaped.
    uri = F.regexp_replace(F.regexp_replace("url", r"[\r\n]", "%0A"), r"[\x00-\x20\x7F]", "%20")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Refers-To", _record_id(F.col("refers_to")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
    )
    out = records.select(F.concat(head, body).alias("value")).write
    out.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The content of a gzip file, all members, in parts of about ``step`` bytes."""
    while data:
        one = zlib.decompressobj(31)
        while not one.eof:
            part = one.decompress(data, step)
            data = one.unconsumed_tail
            if part:
                yield part
            elif not data and not one.eof:
                raise ValueError("the file is cut")
        data = one.unused_data


class Feed:
    """Parts of a file, from which records are taken by length."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.held, self.taken = iter(parts), bytearray(), 0

    def more(self) -> bool:
        part = next(self.parts, None)
        self.held += part or b""
        return part is not None

    def upto(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is passed over; none at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self.more():
                if self.held:
                    raise ValueError(f"the record at byte {self.taken} is cut")
                return None
        return self.take(at + len(mark))[:at]

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError(f"the record at byte {self.taken} is cut")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.taken += n
        return out


def _page(text: bytes | None) -> int | None:
    tail = (text or b"none").rpartition(b":")[2].rstrip(b">")
    return None if tail == b"none" else int(tail)


def parse(parts: Iterator[bytes]) -> Iterator[tuple]:
    """Records of one archive, by their lengths; one of them is in memory at a time."""
    feed = Feed(parts)
    while (head := feed.upto(END.encode())) is not None:
        lines = head.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record before byte {feed.taken}")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
        size = int(head[b"content-length"])
        payload = feed.take(size)
        if feed.take(4) != END.encode():
            raise ValueError(f"the record before byte {feed.taken} is longer than it says")
        kind = head[b"warc-type"].decode()
        url = head.get(b"warc-target-uri")
        yield (
            _page(head[b"warc-record-id"].strip(b"<>")), kind, url and url.decode(),
            head[b"warc-payload-digest"].decode().removeprefix("sha1:"), None if kind == "revisit" else size,
            _page(head[b"warc-refers-to"].strip(b"<>")) if kind == "revisit" else None,
            None if kind == "revisit" else hashlib.sha1(payload).hexdigest(), payload,
        )


def read(spark: SparkSession, path: str, payloads: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """The records of all archives below ``path``. In memory are one file as it is compressed, and a batch of records."""
    schema = RECORD if payloads else T.StructType(RECORD.fields[:-1])
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def work(batches):
        def made(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds[: len(schema)])], schema.names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for record in parse(inflated(content.as_py())):
                    rows.append(record[: len(schema)])
                    size += len(record[-1]) if payloads else 200
                    if size > batch_bytes:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(work, schema)


def join_originals(records: DataFrame) -> DataFrame:
    """Give revisits the length and ``actual_digest`` of the payload that they refer to, found by digest and page."""
    copied = ["payload_bytes", "actual_digest"]
    found = records.where("record_type = 'response'").select("digest", F.col("page_id").alias("refers_to"), *copied)
    found = found.dropDuplicates(["digest", "refers_to"])
    visits = records.where("record_type = 'revisit'").drop(*copied).join(found, ["digest", "refers_to"], "left")
    return records.where("record_type = 'response'").unionByName(visits)
