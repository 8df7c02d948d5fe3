"""WARC archives: exact round trips, revisits and the format of the files."""

import glob
import hashlib
import struct

import pyarrow as pa
import pytest
from conftest import MEDIUM

from pixelweave.llm import warc

LONG = "<p>" + "x" * 200 + "</p>"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def expected(pages):
    payloads = [(k, (h or "").encode()) for k, _, h in pages]
    out = []
    for k, p in payloads:
        same = [j for j, q in payloads if q == p and j is not None]
        first = min(same) if len(p) >= 100 and same else None
        revisit = first is not None and k != first
        out.append((k, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


CASES = {
    "empty": [],
    "one": [(1, "u", "short")],
    "copies": [(5, "u", LONG), (3, "v", LONG), (9, "w", LONG), (4, "x", LONG + "y"), (2, "a", "s"), (1, "b", "s")],
    "odd": [(1, None, None), (2, "a\r\nWARC-Type: x", ""), (None, "n", LONG), (3, "ü é", "ä" * 60), (4, "z", "ä" * 60),
            (7, "h", "a\r\n\r\nb" * 40), (7, "h", "a\r\n\r\nb" * 40), (8, "nul", "\x00" * 120)],
    "no keys": [(None, "a", LONG), (None, "b", LONG)],
    "edge": [(1, "a", "x" * 99), (2, "a", "x" * 99), (3, "a", "x" * 100), (4, "a", "x" * 100)],
    "long": [(i, "a", "abc " * 200_000 + str(i % 2)) for i in range(4)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_cases(spark, tmp_path, case):
    pages = [(*row, "clash", 1) for row in CASES[case]]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, digest string, first int")
    index = warc.write(frame.repartition(2), f"{tmp_path}/a")
    got = warc.read(index)
    narrow = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(narrow) == expected([r[:3] for r in pages])
    stored = {(r["page_id"], bytes(r["payload"])) for r in got.collect() if r["record_type"] == "response"}
    assert stored <= {(k, (h or "").encode()) for k, _, h, *_ in pages}


def test_files(spark, tmp_path):
    """A dictionary in a leading skippable frame, one frame per record, and a use for it."""
    import zstandard

    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    index = warc.write(pages, f"{tmp_path}/a").collect()
    assert sum(r["records"] for r in index) == pages.count()
    (path,) = glob.glob(f"{tmp_path}/a/*.warc.zst")
    data = open(path, "rb").read()
    assert len(data) == index[0]["bytes"]
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 10_000
    records = list(warc.records_of(pa.BufferReader(data), chunk=1000))
    assert len(records) == pages.count() and all(r.startswith(b"WARC/1.1\r\n") for r in records)
    plain = sum(len(zstandard.ZstdCompressor(3).compress(r)) for r in records)
    assert len(data) - 8 - size < 0.9 * plain


def test_damage_is_an_error():
    data = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False)
    assert warc.parse(data)[0] == 1
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n", b"paylOad\r\n"))


def test_split_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 100_000)
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    index = warc.write(pages, f"{tmp_path}/a")
    assert index.count() > 3 and warc.read(index).count() == pages.count()
