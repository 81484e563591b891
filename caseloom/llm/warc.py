"""Legacy ARC archives to WARC.

An ARC file is a version block and then, per document, a header line and the declared number of bytes.  Version 1 lines have
five fields (URL, IP, date, type, length), version 2 lines ten (with result code, checksum, location, offset, file name).
The converter reads lines by the version their file declares, takes exactly the declared bytes, and makes WARC records:
an identifier, an ISO timestamp, a record type, payload and block digests.  Equal payloads are stored once; the others
become revisit records that keep their HTTP head and refer to the stored one.

Archives are written by Spark's text sink (records end in a line end in both formats; bytes pass through unchanged), rolled
by record count, and read back whole by ``binaryFile``, unpacked as a stream; so they work on any file system Spark has.

Identifiers are version 8 UUIDs (free layout): 57 bits of a hash of archive and position, and the record's 64-bit key if its
HTTP head has one, so a reference can be resolved without looking the other record up.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import map_batches
from caseloom.session import work_path

ARCHIVE_RECORDS = 5_000  # records in one archive file
ARC_DATE = "20010203040506"
KEY_HEADER = "X-Record-Key"  # carries an integer key of the caller through ARC, WARC and back
NO_URL = "urn:none"
_BATCH_BYTES = 4 << 20
_V1 = "URL IP-address Archive-date Content-type Archive-length"
_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"


# ---------------------------------------------------------------- writing
def _text(value: Column) -> Column:
    """Bytes as they are, for the text sink."""
    return value.cast("string")


def _position() -> Column:
    """Row number inside the task that writes."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def _write_archives(records: DataFrame, header: Column, path: str) -> None:
    """``record`` (string without its last line end) to gzip files of ARCHIVE_RECORDS; each starts with ``header``."""
    numbered = records.withColumn("at", _position())
    first = F.col("at") % ARCHIVE_RECORDS == 0
    numbered = numbered.select(F.concat(F.when(first, header).otherwise(""), "record").alias("value"))
    writer = numbered.write.option("maxRecordsPerFile", ARCHIVE_RECORDS).option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").text(path)


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as ARC files, versions 1 and 2 by turns; html NULL: empty, page_id NULL: no key."""
    body = F.coalesce("html", F.lit(""))
    # a URL field holds no white space
    url = F.col("url")
    for space, code in (("\t", "%09"), ("\n", "%0A"), ("\x0b", "%0B"), ("\f", "%0C"), ("\r", "%0D"), (" ", "%20")):
        url = F.replace(url, F.lit(space), F.lit(code))
    url = F.coalesce(url, F.lit(NO_URL))
    url = F.when(url == "", NO_URL).otherwise(url)
    key = F.coalesce(F.concat(F.lit(f"{KEY_HEADER}: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n"), key, F.lit("\r\n"),
    )
    rows = pages.select(url.alias("url"), head.alias("head"), body.alias("body"))
    size = (F.octet_length("head") + F.octet_length("body")).cast("string")
    # the version is a property of the file: it follows from the place of the record, as the file does
    at = _position()
    second = F.floor(at / ARCHIVE_RECORDS) % 2 == 1
    line1 = F.concat_ws(" ", "url", F.lit("0.0.0.0"), F.lit(ARC_DATE), F.lit("text/html"), size)
    line2 = F.concat_ws(" ", "url", F.lit("0.0.0.0"), F.lit(ARC_DATE), F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"), size)
    records = rows.select(F.concat(F.when(second, line2).otherwise(line1), F.lit("\n"), "head", "body").alias("record"))
    v1, v2 = f"1 0 pages\n{_V1}\n", f"2 0 pages\n{_V2}\n"
    start1 = f"filedesc://pages.arc 0.0.0.0 {ARC_DATE} text/plain {len(v1)}\n{v1}\n"
    start2 = f"filedesc://pages.arc 0.0.0.0 {ARC_DATE} text/plain 200 - - 0 pages.arc {len(v2)}\n{v2}\n"
    _write_archives(records, F.when(F.floor(F.col("at") / ARCHIVE_RECORDS) % 2 == 1, start2).otherwise(start1), path)


# ---------------------------------------------------------------- reading
class _Stream:
    """Exact reads from gzip members, unpacked as needed: memory follows one record, not the archive."""

    def __init__(self, packed: bytes):
        self._packed = memoryview(packed)
        self._zip = zlib.decompressobj(31) if packed[:2] == b"\x1f\x8b" else None
        self._buffer = bytearray()
        self._at = 0

    def _more(self) -> bool:
        if self._at >= len(self._packed):
            return False
        piece = bytes(self._packed[self._at : self._at + (1 << 18)])
        self._at += len(piece)
        while self._zip is not None and piece:
            self._buffer += self._zip.decompress(piece)
            if not self._zip.eof:
                return True
            piece = self._zip.unused_data
            self._zip = zlib.decompressobj(31)
        self._buffer += piece
        return True

    def take(self, n: int) -> bytes:
        while len(self._buffer) < n:
            if not self._more():
                raise ValueError(f"archive ends {n - len(self._buffer)} bytes early")
        out = bytes(self._buffer[:n])
        del self._buffer[:n]
        return out

    def line(self) -> bytes | None:
        """Next line without its end; None after the last."""
        at = 0
        while (end := self._buffer.find(b"\n", at)) < 0:
            at = len(self._buffer)
            if not self._more():
                return self.take(at) if at else None
        return self.take(end + 1)[:-1]


def parse_arc(packed: bytes) -> Iterator[dict]:
    """Documents of one ARC file: place, version, url, ip, date, mime, block.  Lengths are taken as declared."""
    stream = _Stream(packed)
    version, place = 0, 0
    while (line := stream.line()) is not None:
        if not line.strip():
            continue  # documents are set apart by line ends
        fields = line.decode("utf-8", "replace").split(" ")
        if not version:  # the first record says how the others are to be read; a page may well have such an address too
            if not fields[0].startswith("filedesc:"):
                raise ValueError(f"an ARC file begins with its version block, not with {line[:100]!r}")
            block = stream.take(int(fields[-1]))
            version = int(block.split(b" ", 1)[0])
            if version not in (1, 2):
                raise ValueError(f"ARC version {version} is not known")
            continue
        if len(fields) != {1: 5, 2: 10}[version]:
            raise ValueError(f"not an ARC {version} header line: {line[:100]!r}")
        url, ip, date, mime = fields[:4]
        yield {"place": place, "version": version, "url": url, "ip": ip, "date": date, "mime": mime, "block": stream.take(int(fields[-1]))}
        place += 1


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; a block without a head is all payload."""
    if block.startswith(b"HTTP/"):
        end = block.find(b"\r\n\r\n")
        if end >= 0:
            return block[: end + 4], block[end + 4 :]
    return b"", block


def sha1_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def http_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def record_id(archive: str, place: int, key: int | None) -> str:
    """Version 8 UUID: 48 + 9 bits of hash, a bit that says whether there is a key, then the key."""
    h = int.from_bytes(hashlib.sha1(f"{archive}#{place}#{key is None}".encode()).digest()[:8], "big")
    low = (key if key is not None else 0) & 0xFFFFFFFFFFFFFFFF
    bits = (h >> 16) << 80 | 8 << 76 | (h & 0x1FF) << 67 | (key is not None) << 66 | (low >> 62) << 64 | 2 << 62 | (low & 0x3FFFFFFFFFFFFFFF)
    return f"urn:uuid:{uuid.UUID(int=bits)}"


def key_of(identifier: str) -> int | None:
    """The key inside an identifier made by :func:`record_id`; None if it has none."""
    bits = uuid.UUID(identifier.removeprefix("urn:uuid:")).int
    if not bits >> 66 & 1:
        return None
    key = (bits >> 64 & 3) << 62 | bits & 0x3FFFFFFFFFFFFFFF
    return key - (1 << 64) if key >> 63 else key


def iso_date(date: str) -> str:
    """14-digit ARC date to ISO; missing digits are filled with the earliest moment."""
    full = (date + "00000101000000"[len(date) :])[:14] if date.isdigit() else "00010101000000"
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def convert_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records to be: record_id, key, uri, ip, date, head, payload, payload_bytes, digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                name = archive.as_py()
                for d in parse_arc(content.as_py()):
                    head, payload = split_http(d["block"])
                    key = http_field(head, KEY_HEADER)
                    key = int(key) if key is not None else None
                    rows.append((record_id(name, d["place"], key), key, d["url"], d["ip"], iso_date(d["date"]), head, payload, len(payload), sha1_digest(payload)))
                    size += len(d["block"]) + 200
                    if size >= _BATCH_BYTES:
                        yield _batch(rows, _CONVERTED)
                        rows, size = [], 0
        if rows:
            yield _batch(rows, _CONVERTED)

    return map_batches(_files(spark, path), run, "record_id string, key long, uri string, ip string, date string, head binary, payload binary, payload_bytes long, digest string")


_CONVERTED = pa.schema(
    [("record_id", pa.string()), ("key", pa.int64()), ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("head", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string())]
)
_READ = pa.schema([("record_id", pa.string()), ("key", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("uri", pa.string()), ("date", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def write_warc(records: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Converted records as WARC 1.1 files.  Of records with equal payloads of ``least_bytes`` or more, the one with the
    largest key is a response and the others revisit it; all smaller ones are responses."""
    # one row per payload that occurs more than once: sizes and digests only, counted before they are shuffled
    kept = records.where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
    kept = kept.agg(F.max(F.struct(F.coalesce("key", F.lit(-(2**63))).alias("key"), F.col("record_id"))).alias("best"), F.count("*").alias("n"))
    kept = kept.where("n > 1").select("digest", "payload_bytes", F.col("best.record_id").alias("stored"))
    rows = records.join(kept, ["digest", "payload_bytes"], "left")
    revisit = F.coalesce(F.col("stored") != F.col("record_id"), F.lit(False))
    head, payload = _text(F.col("head")), _text(F.col("payload"))
    size = F.octet_length("head") + F.when(revisit, 0).otherwise(F.octet_length("payload"))
    fields = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <"), F.col("record_id"), F.lit(">\r\nWARC-Date: "), F.col("date"),
        F.lit("\r\nWARC-Target-URI: "), F.col("uri"), F.lit("\r\nWARC-IP-Address: "), F.col("ip"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <"), F.col("stored"), F.lit(">\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"),
    )
    record = F.concat(fields, head, F.when(revisit, "").otherwise(payload), F.lit("\r\n\r"))  # the sink adds the last \n
    info = "software: caseloom\r\nformat: WARC File Format 1.1\r\n"
    start = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{record_id('warcinfo', 0, None)}>\r\nWARC-Date: {iso_date(ARC_DATE)}\r\n"
        f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n{info}\r\n\r\n"
    )
    _write_archives(rows.select(record.alias("record")), F.lit(start), path)


def parse_warc(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of each record of a WARC file; lengths are taken as declared."""
    stream = _Stream(packed)
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:100]!r}")
        fields: dict[str, str] = {}
        while (line := stream.line()) is not None and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.take(int(fields["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of WARC files: record_id, key, record_type, payload_bytes and payload_digest (both of the full
    payload; digests of stored payloads are computed anew and must agree), refers_to_id, uri, date."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for content in batch.column(1):
                for fields, block in parse_warc(content.as_py()):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, payload = split_http(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = len(payload)
                    if kind == "revisit":
                        size = int(http_field(head, "Content-Length") or 0)
                    elif sha1_digest(payload) != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                    key = http_field(head, KEY_HEADER)
                    refers = fields.get("warc-refers-to", "").strip("<>") or None
                    rows.append((fields["warc-record-id"].strip("<>"), int(key) if key is not None else None, kind, size, digest, refers, fields.get("warc-target-uri"), fields.get("warc-date")))
                    if len(rows) >= 4096:
                        yield _batch(rows, _READ)
                        rows = []
        if rows:
            yield _batch(rows, _READ)

    return map_batches(_files(spark, path), run, "record_id string, key long, record_type string, payload_bytes long, payload_digest string, refers_to_id string, uri string, date string")


def archive_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write pages as ARC, convert to WARC, read back: page_id, payload_bytes, payload_digest, record_type, refers_to, uri.

    NULL html is an empty payload, a NULL url ``urn:none``; white space in a URL is percent-encoded.  A NULL page_id stays NULL,
    ranks lowest, and where all copies of a payload have none ``refers_to`` is NULL too.  Repeated rows are records of their own: one
    of them is the response.  Payload bytes may be anything.  An empty table gives no rows; further columns are left out.
    """
    spark = pages.sparkSession
    folder = work_path(spark, "archives")
    write_arc(pages.select("page_id", "url", "html"), f"{folder}/arc")
    write_warc(convert_arc(spark, f"{folder}/arc"), f"{folder}/warc", least_bytes)
    found = read_warc(spark, f"{folder}/warc")
    words = F.split(F.substring("refers_to_id", 10, 36), "-")
    # the key inside the identifier: two bits of the third-but-last group, 62 of the last two
    return found.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", _key_column(words).alias("refers_to"), "uri"
    )


def _key_column(words: Column) -> Column:
    """:func:`key_of` as a column, from the groups of an identifier."""
    number = lambda text: F.conv(text, 16, 10).cast("long")
    top = number(F.get(words, F.lit(2))).bitwiseAND(F.lit(3))
    middle = number(F.get(words, F.lit(3))).bitwiseAND(F.lit(0x3FFF))
    key = F.shiftleft(top, 62).bitwiseOR(F.shiftleft(middle, 48)).bitwiseOR(number(F.get(words, F.lit(4))))
    return F.when(number(F.get(words, F.lit(2))).bitwiseAND(F.lit(4)) > 0, key)
