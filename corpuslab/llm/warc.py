"""WARC archives with per-record Zstandard frames and a dictionary at the head of each file.

Layout of a ``.warc.zst`` file: a skippable frame (magic 0x184D2A5D) that holds the dictionary, then one frame
for each record, compressed with it. Any reader that knows the layout can seek to a record and expand it alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, materialise, narrow, new_run_dir

# Magic number of the dictionary frame, record version, profile of records without payload.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20  # raw record bytes after which a task closes an archive
SAMPLE_BYTES = 1 << 20  # raw record bytes of an archive that train its dictionary
PIECE_BYTES = 8 << 10  # longest sample
DICTIONARY_BYTES = 32 << 10
LEVEL = 3


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: bytes, page: int | str | None, url: str | None, payload: bytes, sha: str, refers: int | str | None, date: str) -> bytes:
    """A response record, or a revisit record that keeps the HTTP head only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if kind == b"revisit" else head + payload
    uri = " ".join((url or "").split()).encode()
    lines = [VERSION, b"WARC-Type: " + kind, b"WARC-Date: " + date.encode()]
    name = lambda x: b"" if x is None else quote(str(x), safe="").encode()
    lines.append(b"WARC-Record-ID: <urn:page:%s>" % name(page))
    lines.append(b"WARC-Target-URI: " + uri)
    lines.append(b"WARC-Payload-Digest: sha1:" + sha.encode())
    if kind == b"revisit":
        lines += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: <urn:page:%s>" % name(refers)]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def samples(records: list[bytes], sample_bytes: int = SAMPLE_BYTES, piece: int = PIECE_BYTES) -> list[bytes]:
    """Evenly spaced pieces of an archive, ``sample_bytes`` at most: records up to ``piece`` bytes whole, of longer ones stretches of that size."""
    starts = list(accumulate(map(len, records), initial=0))
    total = starts[-1]
    count = max(1, min(sample_bytes, total) // piece) if total > sample_bytes else -(-total // 64)
    chosen = {}
    for k in range(count):
        at = k * total // count
        number = bisect_right(starts, at) - 1
        offset = (at - starts[number]) // piece * piece
        chosen[number, offset] = records[number][offset : offset + piece]
    return [x for x in chosen.values() if x]


def dictionary_of(records: list[bytes], sample_bytes: int = SAMPLE_BYTES, size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """Dictionary trained on samples of an archive's records, whatever their number and size.

    Where there is too little to train on, the samples themselves are the dictionary; None only where there are not even eight bytes.
    """
    sample = samples(records, sample_bytes)
    try:
        return zstandard.train_dictionary(size, sample, k=256, d=8)
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(sample)[-size:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(raw) >= 8 else None


def archive(records: list[bytes]) -> Iterator[bytes]:
    """Frames of an archive file. Without a dictionary the leading frame is empty."""
    trained = dictionary_of(records)
    raw = trained.as_bytes() if trained else b""
    yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True)
    for one in records:
        yield packer.compress(one)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it of a plain path or of a URI; local ones may be written ``file:/x`` or ``file:///x``."""
    if re.match("file:/", path):
        return pafs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if re.match("[A-Za-z][A-Za-z0-9+.-]*://", path) else (pafs.LocalFileSystem(), path)


def parse(one: bytes) -> dict:
    """Fields of an expanded record, ids as text; the payload is None for a revisit."""
    head, _, block = one.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = block[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    named = lambda name: unquote(x.decode()) if (x := fields.get(name, b"<urn:page:>")[10:-1]) else None
    kind = fields[b"WARC-Type"].decode()
    return {
        "page_id": named(b"WARC-Record-ID"),
        "url": fields[b"WARC-Target-URI"].decode(),
        "record_type": kind,
        "payload_digest": fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"),
        "payload_bytes": length,
        "refers_to": named(b"WARC-Refers-To"),
        "payload": payload if kind == "response" else None,
    }


def expand(stream) -> Iterator[bytes]:
    """Records of an archive read from a file object, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the head of the archive")
    raw = stream.read(size)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    frame, parts = None, []
    while data := stream.read(1 << 16):
        while data:
            frame = frame or unpacker.decompressobj()
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else b""
            if frame.eof:
                yield b"".join(parts)
                frame, parts = None, []
    if frame is not None:
        raise ValueError("the archive ends within a record")


def with_references(pages: DataFrame, min_bytes: int = 0, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``pages`` and ``_first``: the smallest id among equal payloads, null where the payload is alone or too small.

    Payloads are compared by SHA-1 and length; a null payload is empty. Groups are counted with a fold before the shuffle and
    written, so that the join with them may split a payload that a large share of the pages has.
    """
    body = F.coalesce(F.col(html_column).cast("binary"), F.lit(b""))
    keyed = pages.select("*", F.unhex(F.sha1(body)).alias("_sha"), F.octet_length(body).alias("_bytes"))
    groups = keyed.where(F.col("_bytes") >= min_bytes).groupBy("_sha", "_bytes")
    several = groups.agg(F.count("*").alias("n"), F.min(id_column).alias("_first")).where("n > 1").drop("n")
    return keyed.join(materialise(several, "payloads"), ["_sha", "_bytes"], "left").drop("_sha", "_bytes")


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    id_column: str = "page_id", url_column: str = "url", html_column: str = "html", archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row and return the written table of archives: ``path``, ``n_records``, ``n_bytes``.

    ``folder`` must be reachable by all executors; by default it is a new one below ``spark.checkpoint.dir``. Of rows with
    equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a response, the others revisit it;
    rows that repeat that id are responses as well. A row without an id never is the response of a group that has an id.
    Null html is an empty payload; a null url is empty. Each task attempt writes files of its own names and the table
    lists those of successful attempts only, so a repeated task does no harm. An empty table gives no archives.
    """
    spark = pages.sparkSession
    folder = folder or new_run_dir(spark, "warc")
    rows = with_references(narrow(pages, id_column, url_column, html_column), min_bytes, id_column, html_column)
    rows = rows.select(id_column, url_column, html_column, "_first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        held, size, count = [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, count
            name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{count:04d}.warc.zst"
            written = 0
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                for frame in archive(held):
                    out.write(frame)
                    written += len(frame)
            made = pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [len(held)], "n_bytes": [written]})
            held, size, count = [], 0, count + 1
            return made

        for batch in batches:
            ids, firsts = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            urls, bodies = batch.column(1), batch.column(2)
            for row, page in enumerate(ids):
                payload, first = as_bytes(bodies.slice(row, 1))[0], firsts[row]
                again = first is not None and page != first
                kind = b"revisit" if again else b"response"
                one = record(kind, page, urls[row].as_py(), payload, digest(payload), first, date)
                held.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    return materialise(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "archives")


def read_archives(archives: DataFrame, payload: bool = True, id_type: str = "long") -> DataFrame:
    """The records of a table with archive ``path``s, read record by record; a response's digest is computed from its payload.

    ``id_type`` is the type of the page ids, which an archive holds as text.

    Fails where a payload doesn't have the digest or length that its record states.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
             ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, root = file_system(path)
                rows, size = [], 0
                with files.open_input_stream(root, compression=None) as stream:
                    for one in expand(stream):
                        found = parse(one)
                        if found["payload"] is not None:
                            if digest(found["payload"]) != found["payload_digest"] or len(found["payload"]) != found["payload_bytes"]:
                                raise ValueError(f"damaged record of page {found['page_id']} in {path}")
                        size += len(one) if payload else 200
                        if not payload:
                            found["payload"] = None
                        rows.append(found)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    spark = archives.sparkSession
    n = max(1, min(archives.count(), 4 * spark.sparkContext.defaultParallelism))
    found = archives.select("path").repartition(n).mapInArrow(
        run, "page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"
    )
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
