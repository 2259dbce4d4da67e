"""WARC archives of pages with a Zstandard dictionary, and their reading back.

An archive starts with a skippable frame that holds a dictionary built from records
spread over it; every record is a frame of its own, compressed with it. A
payload of ``MIN_REVISIT`` bytes or more is stored once, under the smallest
page_id; other pages with it are revisit records, which carry the HTTP header of
the full payload and its digest but no payload.

A task writes archives of some ``ARCHIVE_BYTES`` of payload to the shared folder
under names of their own; only those a finished task lists are read, so a
repeated task leaves no doubles.

Defined results: null html is an empty payload; of repeated rows of the smallest
page_id all are responses; a null page_id is never the one referred to and comes
back as null; an empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from zoneferry.llm.common import batch_of, slices, spread
from zoneferry.session import fresh_dir, stage

MIN_REVISIT = 100
ARCHIVE_BYTES = 32_000_000
#: The dictionary is fitted on every n-th record of its archive, some so many bytes in all.
SAMPLE_BYTES, DICTIONARY_BYTES = 2_000_000, 16_384
# Fixed value: the magic number of the frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
LEVEL = 3
#: A frame is read in pieces of so many bytes: what follows it is copied only so far.
READ_BYTES = 16_384


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Payload-Digest: sha256:{digest}"]
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The bytes of one archive."""
    samples = records[:: max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))]
    try:
        fitted = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:  # too few or too small samples to fit one
        fitted = zstandard.ZstdCompressionDict(samples[0][-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    body = fitted.as_bytes()
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=fitted)
    frames = [compressor.compress(r) for r in records]
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(body)), body, *frames])


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive starts with its dictionary")
    body = data[8 : 8 + size]
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
    view, at = memoryview(data), 8 + size
    while at < len(data):
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            piece = view[at : at + READ_BYTES]
            if not piece:
                raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def parsed(data: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """page_id, payload bytes, digest, type, refers_to and payload of a record."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(field: str) -> int | None:
        number = fields.get(field, "<urn:page:>").removeprefix("<urn:page:").rstrip(">")
        return int(number) if number else None

    return page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To"), payload


_FILES = pa.schema([("path", pa.string()), ("records", pa.int64())])
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _writer(folder: str):
    def run(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        kept, size = [], 0

        def close() -> pa.RecordBatch:
            name = f"{root}/{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(name) as out:
                out.write(archive(kept))
            return batch_of(_FILES, [[name], [len(kept)]])

        for batch in slices(batches, 64):
            for page_id, url, html, digest, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                payload = html.encode()
                kept.append(record(page_id, url, payload, digest, refers))
                size += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    kept, size = [], 0
        if kept:
            yield close()

    return run


def _reader(folder: str):
    def run(batches):
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(path) as source:
                    data = source.read()
                rows: list[list] = [[] for _ in _READ]
                for r in records_of(data):
                    for column, value in zip(rows, parsed(r)):
                        column.append(value)
                yield batch_of(_READ, rows)

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages below ``folder``; returns (path, records) of the archives."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    ids = pages.where(F.octet_length("html") >= MIN_REVISIT).select("page_id", "digest")
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = ids.join(firsts, "digest").where("coalesce(page_id > refers_to, refers_to is not null)").distinct()
    again = stage(again, "warc-revisits").toDF("digest_2", "page_id_2", "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("page_id_2")) & (F.col("digest") == F.col("digest_2"))
    records = pages.join(again, same, "left").select("page_id", "url", "html", "digest", "refers_to")
    return stage(records.mapInArrow(_writer(folder), "path string, records bigint"), "warc-files")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return spread(files.select("path")).mapInArrow(_reader(folder), "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def round_trip(pages: DataFrame) -> DataFrame:
    folder = fresh_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
