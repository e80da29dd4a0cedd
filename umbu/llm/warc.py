"""Web archives of Zstandard frames with a shared dictionary: a writer and a reader.

A file begins with a skippable frame that holds the dictionary (itself a frame);
every record is a frame of its own. Tasks write files of bounded size into the
shared folder, first under a name of their own, and rename them when complete, so
that a repeated task replaces its files. The reader streams a file frame by frame
and holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbu.llm.tables import about, if_small, keep, table
from umbu.sources.shared import scratch_folder

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20
# The dictionary is trained on the starts of at most so many pages.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 256, 16_384, 64 << 10
CRAWL_DATE = "2025-01-01T00:00:00Z"
_READ = 1 << 20

_RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; too few of them are one themselves."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor().compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit (without the payload) if it refers to another page."""
    named = lambda x: f"<urn:x-page:{'' if x is None else x}>"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    address = "about:blank" if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", named(page_id)),
        ("WARC-Date", CRAWL_DATE),
        ("WARC-Target-URI", address),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", named(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _writer(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        part, done, out, own = TaskContext.get().partitionId(), [], None, ""

        def close() -> None:
            out.close()
            name = f"part-{part:06d}-{len(done):05d}.warc.zst"
            store.move(own, f"{root}/{name}")
            done.append(f"{folder}/{name}")

        for batch in batches:
            for row in zip(*[c for c in batch.columns]):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                if out is None:
                    own = f"{root}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(own, compression=None)
                    if dictionary:
                        out.write(dictionary_frame(dictionary))
                payload = (html or "").encode()
                record = record_bytes(page_id, url, payload, sha1_base32(payload), refers_to)
                out.write(packer.compress(record))
                if out.tell() >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["path"])

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every page into ``folder``; returns the files' paths.

    Of pages with equal payloads the one of largest page_id is the response, the
    others revisit it. A null html is an empty payload. Rows without page_id
    revisit a numbered one if there is any, else they are responses; so are rows
    that repeat both the id and the payload of the response. A null url is
    about:blank. An empty table writes no file.
    """
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    rows = pages.select(
        F.col("page_id").cast("bigint"), "url", "html",
        F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"),
    )
    groups = rows.groupBy("sha1").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    groups = if_small(keep(groups.where("n > 1").drop("n"), "equal-payloads"))
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    rows = rows.join(groups, "sha1", "left").select("page_id", "url", "html", refers_to.alias("refers_to"))
    start = F.coalesce(F.substring("html", 1, SAMPLE_CHARS), F.lit("")).alias("start")
    some = about(pages.select("page_id", "url", start), SAMPLE_PAGES, pages.count(), "page_id", "url")
    dictionary = train_dictionary([r["start"].encode() for r in some.collect()])
    return keep(rows.mapInArrow(_writer(folder, dictionary), "path string"), "archives")


def frames(source: BinaryIO) -> Iterator[bytes]:
    """Contents of the frames of an archive, one after the other.

    The dictionary is taken from a leading skippable frame, if there is one; later
    skippable frames are left out. A frame that is cut off raises ``ValueError``.
    """
    buffer = source.read(_READ)

    def fill(n: int) -> None:
        nonlocal buffer
        while len(buffer) < n and (more := source.read(max(_READ, n - len(buffer)))):
            buffer += more
        if len(buffer) < n:
            raise ValueError("the archive is cut off")

    shared, leading = None, True
    while buffer or (buffer := source.read(_READ)):
        fill(4)
        if buffer[1:4] == b"\x2a\x4d\x18" and 0x50 <= buffer[0] <= 0x5F:
            fill(8)
            magic, size = struct.unpack("<II", buffer[:8])
            fill(8 + size)
            if leading and magic == SKIPPABLE:
                held = buffer[8 : 8 + size]
                if held[:4] == FRAME:
                    held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
                shared = zstandard.ZstdCompressionDict(held)
            buffer, leading = buffer[8 + size :], False
            continue
        leading = False
        unpacker = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
        out = [unpacker.decompress(buffer)]
        while not unpacker.eof:
            if not (more := source.read(_READ)):
                raise ValueError("the last frame is cut off")
            out.append(unpacker.decompress(more))
        buffer = unpacker.unused_data
        yield b"".join(out)


def parse_record(record: bytes) -> dict:
    """Fields and payload of one record; anything out of order raises ``ValueError``."""
    head, found, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version not in (b"WARC/1.0", VERSION):
        raise ValueError(f"no record begins with {version[:20]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"no header field: {line[:60]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"the record has no {name}")
    size = fields["content-length"]
    if not size.isdecimal() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"a block of {len(rest) - 4} bytes is declared as {size}")
    block = rest[:-4]
    http, found, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return {"fields": fields, "payload": block, "payload_bytes": len(block)}
    if not found:
        raise ValueError("the block has no end of its HTTP header")
    lengths = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if len(lengths) != 1 or not lengths[0].isdigit():
        raise ValueError("the HTTP header has no length")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit has a payload, or refers to nothing")
    if kind == "response" and len(payload) != int(lengths[0]):
        raise ValueError(f"a payload of {len(payload)} bytes is declared as {lengths[0].decode()}")
    digest = fields.get("warc-payload-digest", "")
    if kind == "response" and digest != f"sha1:{sha1_base32(payload)}":
        raise ValueError("the payload does not have its digest")
    return {"fields": fields, "payload": payload, "payload_bytes": int(lengths[0])}


def _page(reference: str) -> int | None:
    number = reference.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RECORD.split(", ")] + ["payload"] * payloads
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * payloads
        schema = pa.schema(list(zip(names, types)))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_stream(place, compression=None) as source:
                    for frame in frames(source):
                        record = parse_record(frame)
                        fields = record["fields"]
                        refers_to = fields.get("warc-refers-to")
                        url = fields.get("warc-target-uri")
                        row = {
                            "page_id": _page(fields["warc-record-id"]),
                            "url": None if url == "about:blank" else url,
                            "record_type": fields["warc-type"],
                            "refers_to": None if refers_to is None else _page(refers_to),
                            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
                            "payload_bytes": record["payload_bytes"],
                        }
                        if payloads:
                            row["payload"] = record["payload"]
                            held += len(record["payload"])
                        rows.append(row)
                        if len(rows) == 4096 or held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(paths: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the archives, one row each, validated; a fault fails the job.

    Columns page_id, url, record_type, refers_to, payload_digest and
    payload_bytes, and with ``payloads`` the payload (empty for a revisit). Without
    files there are no rows; a file that is listed twice is read twice.
    """
    files = paths.select("path").repartition(max(1, paths.count()), "path")
    return files.mapInArrow(_reader(payloads), _RECORD + ", payload binary" * payloads)


def op6_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back; see ``write_archives`` for all cases."""
    pages = table(spark, sf_dir, "pages")
    paths = write_archives(pages, scratch_folder(spark, "warc"))
    return read_archives(paths).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x,
  max(page_id) OVER (PARTITION BY h) AS kept FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(x, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)), 1)), '') AS payload_digest,
  CASE WHEN kept IS DISTINCT FROM page_id AND kept IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept IS DISTINCT FROM page_id THEN kept END AS refers_to
FROM s
"""
