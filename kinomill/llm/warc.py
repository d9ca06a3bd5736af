"""WARC archives: write pages as records, read archives back, keep them content-addressed.

Writing is a join of small rows: digests of all payloads decide which record
carries the bytes (response) and which point to it (revisit); payloads meet
that decision by record id, so a payload shared by a third of all pages is no
hot key of a join that carries bytes. Records are written by Spark's text
writer, whose line separator is the blank line that ends a WARC record; files
are gzipped and hold a bounded number of records and bytes.

Reading parses each file as a stream. Records of all types keep their bytes, also those of other writers. The archive store keeps payload bytes once per
SHA-256 (recomputed from the bytes, and checked against the digests the record
states) and the exact bytes of each record's headers apart from them; a join
puts original records together again.

Defined results: null payload is empty; a null URL leaves the target URI out, line
breaks in URLs are percent-encoded. A null page id sorts after all others.
Rows that repeat a page id and its payload are records of the same kind. An empty
table gives an empty store.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
RECORDS_PER_FILE = 2_000
FILE_BYTES = 1_500_000_000  # a file is read back as one value
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 bits, i.e. ten hex digits, make eight characters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), *BASE32)


def _payloads(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return pages.select("page_id", "url", payload.alias("payload")).withColumn("sha256", F.sha2("payload", 256))


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, sha256, head): ``head`` is the page that carries the payload; its own for payloads below ``min_bytes``."""
    seen = _payloads(pages).select("page_id", "sha256", (F.octet_length("payload") >= min_bytes).alias("shared")).distinct()
    heads = seen.groupBy("sha256").agg(F.min("page_id").alias("head"))
    joined = seen.join(heads, "sha256")
    return joined.select("page_id", "sha256", F.when(F.col("shared"), F.col("head")).otherwise(F.col("page_id")).alias("head"))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, date: str, min_bytes: int = 0) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to gzipped WARC files below ``path``."""
    decided = decide(pages, min_bytes).withColumnsRenamed({"page_id": "d_page", "sha256": "d_sha"})
    rows = _payloads(pages)
    rows = rows.join(decided, rows["page_id"].eqNullSafe(decided["d_page"]) & (rows["sha256"] == decided["d_sha"]))
    is_head = F.col("page_id").eqNullSafe(F.col("head"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(is_head, "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: "),
        _record_id(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.when(is_head, "").otherwise(
            F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _record_id(F.col("head")), F.lit("\r\n"))
        ),
        F.lit("WARC-Payload-Digest: sha1:"),
        sha1_base32(F.col("payload")),
        F.lit("\r\nX-Payload-SHA256: "),
        F.col("sha256"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(is_head, F.octet_length("payload")).otherwise(0)).cast("string"),
        F.lit(END),
    )
    body = F.when(is_head, F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.concat(fields, http).cast("binary"), body).cast("string")
    longest = pages.agg(F.max(F.octet_length("html") + F.coalesce(F.octet_length("url"), F.lit(0)))).first()[0] or 0
    per_file = max(1, min(RECORDS_PER_FILE, FILE_BYTES // (longest + 2_000)))
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", per_file
    ).text(path)


RECORD_SCHEMA = (
    "page_id bigint, record_type string, refers_to bigint, stated_sha1 string, stated_sha256 string, "
    "header binary, packed binary, payload_bytes bigint, sha1 string, sha256 string"
)


def _chunks(content: bytes, size: int = 1 << 20):
    """Uncompressed pieces of a file that may be gzipped, in one or many members."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + size] for i in range(0, len(content), size))
        return
    rest = content
    while rest:
        member = zlib.decompressobj(wbits=31)
        piece = member.decompress(rest, size)
        while piece or not member.eof:
            yield piece
            if not piece and not member.unconsumed_tail:
                break
            piece = member.decompress(member.unconsumed_tail, size)
        rest = member.unused_data.lstrip(b"\0")


def parse_records(content: bytes):
    """(field dict, exact header bytes incl. HTTP header, payload) of each record; a cut-off record is an error."""
    end = END.encode()
    buffer, pieces = bytearray(), _chunks(content)

    def fill() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        buffer.extend(piece)
        return True

    while True:
        while (at := buffer.find(end)) < 0:
            if not fill():
                if buffer.strip():
                    raise ValueError("archive ends inside a record header")
                return
        head = bytes(buffer[: at + 4])
        lines = head.decode("utf-8").split("\r\n")
        fields = {name.strip(): value.strip() for name, colon, value in (line.partition(":") for line in lines[1:]) if colon}
        total = at + 4 + int(fields["Content-Length"]) + 4
        while len(buffer) < total:
            if not fill():
                raise ValueError("archive ends inside a record")
        block = bytes(buffer[at + 4 : total - 4])
        del buffer[:total]
        cut = block.find(end) + 4 if fields.get("Content-Type", "").startswith("application/http") else 0
        yield fields, head + block[:cut], block[cut:]


def _stated_sha1(digest: str | None) -> str | None:
    """The stated SHA-1 in upper-case base32, from base32 or hex; null for other digests."""
    label, _, value = (digest or "").partition(":")
    if label.lower() != "sha1":
        return None
    return base64.b32encode(bytes.fromhex(value)).decode() if len(value) == 40 else value.upper()


def _number(record_id: str | None):
    tail = (record_id or "").rstrip(">").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def _parse_batches(batches):
    names = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
    types = dict.fromkeys(("page_id", "refers_to", "payload_bytes"), pa.int64()) | dict.fromkeys(("header", "packed"), pa.binary())
    schema = pa.schema([(n, types.get(n, pa.string())) for n in names])
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for content in batch.column("content"):
            out, held = [], 0
            for fields, header, payload in parse_records(content.as_py()):
                own = fields["WARC-Type"] != "revisit"
                out.append(
                    (
                        _number(fields.get("WARC-Record-ID")),
                        fields["WARC-Type"],
                        _number(fields.get("WARC-Refers-To")),
                        _stated_sha1(fields.get("WARC-Payload-Digest")),
                        fields.get("X-Payload-SHA256"),
                        header,
                        pack(payload) if own else None,
                        len(payload) if own else None,
                        base64.b32encode(hashlib.sha1(payload).digest()).decode() if own else None,
                        hashlib.sha256(payload).hexdigest() if own else None,
                    )
                )
                held += len(header) + len(payload)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files below ``path``: payloads in zstd frames, and the digests recomputed from their bytes."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse_batches, RECORD_SCHEMA)


def _unpacked(batches):
    """Payload bytes from their frames, checked against the digest they are stored by."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        payloads = [unpack(x.as_py()) for x in batch.column("packed")]
        for digest, payload in zip(batch.column("sha256").to_pylist(), payloads):
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"stored payload differs from its digest {digest}")
        yield pa.RecordBatch.from_arrays([batch.column("sha256"), pa.array(payloads, pa.binary())], names=["sha256", "payload"])


PAYLOADS = "sha256 string, sha1 string, payload_bytes bigint, packed binary"
HEADERS = "page_id bigint, record_type string, refers_to bigint, sha256 string, stated_sha1 string, carried boolean, header binary"


@dataclass(frozen=True)
class Store:
    """Content-addressed archive below a folder: ``payloads`` once per digest, ``headers`` per record.

    One writer at a time. Payloads are written before the headers that need them, and the headers of an addition have a
    folder of their own, so an addition that died is simply made again under the same name.
    """

    spark: SparkSession
    path: str

    def _there(self, name: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def add(self, records: DataFrame, name: str | None = None) -> None:
        """Write records as read; payloads already stored are not written again.

        Adding under a ``name`` that is there replaces that addition's headers. A payload that differs from its stated digests stops the job.
        """
        wrong = (F.col("sha256") != F.col("stated_sha256")) | (F.col("sha1") != F.col("stated_sha1"))
        digest = F.when(
            wrong, F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.coalesce("stated_sha256", "stated_sha1")))
        ).otherwise(F.coalesce("sha256", "stated_sha256"))
        checked = records.withColumn("sha256", digest)
        bodies = checked.where(F.col("packed").isNotNull()).select("sha256", "sha1", "payload_bytes", "packed").dropDuplicates(["sha256"])
        if self._there("payloads"):
            bodies = bodies.join(self.payloads().select("sha256"), "sha256", "left_anti")
        bodies.write.mode("append").parquet(f"{self.path}/payloads")
        heads = checked.select(
            "page_id", "record_type", "refers_to", "sha256", "stated_sha1", F.col("packed").isNotNull().alias("carried"), "header"
        )
        heads.write.mode("overwrite").parquet(f"{self.path}/headers/addition={name or uuid.uuid4().hex}")

    def headers(self) -> DataFrame:
        """Header bytes of all records; a revisit that states only a SHA-1 finds its payload by it."""
        heads = self.spark.read.schema(HEADERS).parquet(f"{self.path}/headers").drop("addition")
        named = heads.where("sha256 is not null or stated_sha1 is null")
        rest = heads.where("sha256 is null and stated_sha1 is not null").drop("sha256")
        known = self.payloads().groupBy(F.col("sha1").alias("stated_sha1")).agg(F.min("sha256").alias("sha256"))
        return named.unionByName(rest.join(known, "stated_sha1", "left")).drop("stated_sha1")

    def payloads(self) -> DataFrame:
        return self.spark.read.schema(PAYLOADS).parquet(f"{self.path}/payloads")

    def described(self) -> DataFrame:
        """Each record with length and SHA-1 of its full payload, null if the store lacks it; reads no payload bytes."""
        known = self.payloads().select("sha256", "sha1", "payload_bytes")
        return self.headers().drop("header", "carried").join(known, "sha256", "left")

    def rebuilt(self) -> DataFrame:
        """(page_id, record_type, record): the original bytes of each record, and ``full_payload`` also for revisits."""
        whole = self.payloads().select("sha256", "packed").mapInArrow(_unpacked, "sha256 string, payload binary")
        joined = self.headers().join(whole, "sha256", "left")
        body = F.when(F.col("carried"), F.col("payload")).otherwise(F.lit(b""))
        record = F.concat(F.col("header"), body, F.lit(END.encode()))
        return joined.select("page_id", "record_type", record.alias("record"), F.col("payload").alias("full_payload"))
