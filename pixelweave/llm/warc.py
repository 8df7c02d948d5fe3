"""WARC archives under a Zstandard dictionary (operator 2).

Every page becomes one WARC record. Of records with equal payloads the one with the smallest
key is a ``response`` and the others ``revisit`` it without storing the payload again; payloads
under ``LEAST_SHARED`` bytes are stored each time. Records are compressed one by one, so each
can be read alone, and a dictionary makes up for the context they lack: it is trained on
archived records and stands in a skippable frame at the head of each archive.

The dictionary comes from at most ``SAMPLE`` records, those smallest in a hash of their key,
and at most ``SAMPLE_BYTES`` of each; it changes the size of the archives and nothing else.
Everything else covers all records. Copies are found by aggregating digests of payloads, and
only digests that occur twice are joined back, against tables on both sides, so that adaptive
execution splits a payload that many pages share.

Tasks write archives of at most ``ARCHIVE_BYTES`` plus one record under names no other attempt
uses; the index lists those of tasks that succeeded.

Defined cases: a null payload is empty; a null address is written as ``about:blank``; null
keys come after all others and, if a payload has no other key, each of them is a response;
rows that repeat a key and a payload are the same record written twice, of the same type; an
empty table gives no archive; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from pixelweave.functions.storage import locate
from pixelweave.workspace import materialize

# Skippable frame of a dictionary, and the date of records without one.
SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"

LEAST_SHARED = 100
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16_384, 65_536
ARCHIVE_BYTES = 256 << 20
LEVEL = 3

_INDEX = StructType([
    StructField("path", StringType()), StructField("records", LongType()), StructField("bytes", LongType()),
])
_READ = StructType([
    StructField("page_id", LongType()), StructField("url", StringType()),
    StructField("record_type", StringType()), StructField("refers_to", LongType()),
    StructField("payload_bytes", LongType()), StructField("payload_digest", StringType()),
    StructField("payload", BinaryType()),
])


def _name(key: int | None) -> str:
    return f"<urn:page:{'none' if key is None else key}>"


def _key(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def _address(url: str | None) -> str:
    # Header lines end at a line break, so control characters are escaped.
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")


def record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC/1.1 record. The HTTP header tells the full payload's length in either type."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(key)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_address(url)}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_name(refers_to)}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines if line)


def parse(data: bytes) -> tuple:
    """Key, address, type, key referred to, payload length and digest, and the payload (none
    for a revisit). A payload that does not match its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(_headers(http)["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind, refers_to = fields["WARC-Type"], None
    if kind == "revisit":
        payload, refers_to = None, _key(fields["WARC-Refers-To"])
    elif len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return _key(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, refers_to, size, digest, payload


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary for records like ``samples``: trained, or the samples themselves where there
    are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def head(dictionary: bytes) -> bytes:
    """The leading skippable frame."""
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def records_of(file: pa.NativeFile, chunk: int = 1 << 16) -> Iterator[bytes]:
    """Decompressed frames of an archive, read in order with bounded memory."""
    import zstandard

    magic, size = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE:
        raise ValueError("an archive begins with its dictionary")
    decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(file.read(size)))
    rest = file.read(chunk)
    while rest:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else file.read(chunk)
        yield b"".join(parts)
        rest = rest or file.read(chunk)


def originals(pages: DataFrame) -> DataFrame:
    """``pages`` (key, digest, size, ...) with ``first``, the smallest key among equal payloads
    of which there are several."""
    shared = (
        pages.where(F.col("size") >= LEAST_SHARED)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    return pages.join(materialize(shared, "warc-shared"), "digest", "left")


def _sample(pages: DataFrame) -> list[bytes]:
    """Records that the dictionary is made of, at most SAMPLE * SAMPLE_BYTES bytes."""
    chosen = pages.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    parts = pages.join(F.broadcast(chosen.distinct()), "key").select(
        "key", "url", "digest", F.substring("payload", 1, SAMPLE_BYTES).alias("payload")
    )
    rows = parts.orderBy(F.xxhash64("key"), "key", "digest").limit(SAMPLE).collect()
    return [record(r["key"], r["url"], bytes(r["payload"]), r["digest"], None, False) for r in rows]


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """Archive ``pages`` under ``folder``; returns the index (path, records, bytes)."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    narrow = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    narrow = narrow.select(
        "*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size")
    )
    dictionary = train(_sample(narrow))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        filesystem, base = locate(folder)
        filesystem.create_dir(base, recursive=True)
        compressor = zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(dictionary))
        out, path, n, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [size]})

        for batch in batches:
            columns = [batch.column(c) for c in ("key", "url", "payload", "digest", "first")]
            for k, u, p, d, first in zip(*columns):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    out, n, size = _open(filesystem, path), 0, 0
                    size += out.write(head(dictionary))
                k, first = k.as_py(), first.as_py()
                revisit = first is not None and k != first
                data = record(k, u.as_py(), p.as_py(), d.as_py(), first, revisit)
                size += out.write(compressor.compress(data))
                n += 1
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    placed = originals(narrow).select("key", "url", "payload", "digest", "first")
    return materialize(placed.mapInArrow(save, _INDEX), "archives")


def _open(filesystem: pafs.FileSystem, path: str) -> pa.NativeFile:
    # Without this the file system would compress by the name's ending.
    return filesystem.open_output_stream(locate(path)[1], compression=None)


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and, if asked for, the payload."""
    fields = _READ.fields if with_payload else _READ.fields[:-1]
    schema = StructType(fields)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            rows = [(k, u, t, r, n, d, p) for k, u, t, r, n, d, p in rows]
            columns = list(zip(*rows))[: len(fields)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], schema.names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, place = locate(path)
                rows, held = [], 0
                with filesystem.open_input_stream(place, compression=None) as file:
                    for data in records_of(file):
                        rows.append(parse(data))
                        held += len(data) if with_payload else 0
                        if len(rows) >= 2000 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    paths = index.select("path").repartition(max(1, index.count()))
    return paths.mapInArrow(load, schema)
