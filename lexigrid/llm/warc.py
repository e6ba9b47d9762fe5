"""WARC archives with a Zstandard dictionary.

A dictionary is trained on a bounded sample of the records to be archived.  Every archive
begins with a skippable frame that holds it; each record follows as a frame of its own, so
any record can be read with the dictionary and its offset alone.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table
from lexigrid.session import shared_folder, stored

DICTIONARY_FRAME = 0x184D2A5D
READ_BYTES = 1 << 16
CHUNK_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def one_line(value: str) -> str:
    """A header value on one line: percent signs and control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c == "%" or ord(c) < 32 or ord(c) == 127 else c for c in value)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit if it refers to another page with the same payload.

    A revisit keeps the HTTP header, which tells the size of the payload that it leaves out.
    """
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Fields of a record; a response's digest is worked out from the payload and compared."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (base32_sha1(payload) != digest or len(payload) != size):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {
        "page_id": None if page is None else int(page),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
        "payload": payload,
    }


def train_dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A dictionary of the samples, or none if they are too few or too alike to train on."""
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def records(source, dictionary: bytes, most: int | None = None) -> Iterator[bytes]:
    """The frames of a stream of records, decompressed one by one."""
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    unpack = zstandard.ZstdDecompressor(dict_data=shared)
    left, pending = most, b""
    while True:
        frame, out = unpack.decompressobj(), []
        while not frame.eof:
            if not pending:
                pending = source.read(READ_BYTES if left is None else min(READ_BYTES, left))
                left = None if left is None else left - len(pending)
                if not pending:
                    if out:
                        raise ValueError("the archive ends within a record")
                    return
            out.append(frame.decompress(pending))
            pending = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def read_dictionary(source) -> bytes:
    """The dictionary in the leading frame; the stream then stands at the first record."""
    head = source.read(8)
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICTIONARY_FRAME:
            return source.read(size)
    source.seek(0)
    return b""


MANIFEST = "archive string, start long, length long, n_records long"


def write_archives(
    pages: DataFrame, path: str, samples: int = 1000, sample_bytes: int = 16 << 10, level: int = 6
) -> DataFrame:
    """Write one archive per partition into ``path``; the manifest of chunks comes back.

    ``pages`` has page_id, url and html.  Of equal payloads the smallest page_id is the
    response and the others revisit it; null ids come last.  A null html is an empty payload.
    Rows equal in id and payload are one capture and get the same type.  Other columns are
    ignored; an empty table gives no archives.  The dictionary learns from at most
    ``samples`` different records of at most ``sample_bytes`` each, drawn by a hash.
    A task writes under a name of its own and renames the whole archive, so one that runs
    again or twice leaves the same file.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    firsts = rows.groupBy("sha").agg(
        F.min("page_id").alias("first_page"), F.count("*").alias("copies")
    )
    n_rows = max(1, rows.count())
    learned = (
        rows.where(F.pmod(F.xxhash64("sha"), F.lit(n_rows)) < 2 * samples)
        .select("sha", F.substring("payload", 1, sample_bytes).alias("payload"))
        .dropDuplicates(["sha"]).limit(samples).select("payload").collect()
    )
    dictionary = train_dictionary([bytes(r.payload) for r in learned])
    target, base = arrow_fs.FileSystem.from_uri(path)
    target.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, folder = arrow_fs.FileSystem.from_uri(path)
        name = f"{folder}/part-{context.partitionId():08d}.warc.zst"
        trial = f"{name}.{context.taskAttemptId()}"
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=level, dict_data=shared)
        sink, chunks, at = None, [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                if sink is None:
                    sink = system.open_output_stream(trial)
                    if dictionary:
                        sink.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                        at = 8 + len(dictionary)
                page_id, url, payload, first = (batch.column(c)[k].as_py() for c in range(4))
                frame = pack.compress(make_record(page_id, url, payload, None if first == page_id else first))
                if not chunks or chunks[-1][1] >= CHUNK_BYTES:
                    chunks.append([at, 0, 0])
                sink.write(frame)
                at += len(frame)
                chunks[-1][1] += len(frame)
                chunks[-1][2] += 1
        if sink is not None:
            sink.close()
            system.move(trial, name)
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": [name] * len(chunks),
                    "start": [c[0] for c in chunks],
                    "length": [c[1] for c in chunks],
                    "n_records": [c[2] for c in chunks],
                }
            )

    typed = rows.join(firsts, "sha").select("page_id", "url", "payload", "first_page")
    return stored(typed.mapInArrow(run, MANIFEST), "warc-manifest")


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(manifest: DataFrame, path: str, payloads: bool = True) -> DataFrame:
    """The records of archives, a task per few chunks; payloads only if asked for."""
    columns = [c.split()[0] for c in RECORDS.split(", ")][: None if payloads else -1]
    schema = ", ".join(RECORDS.split(", ")[: len(columns)])
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = arrow_fs.FileSystem.from_uri(path)
        for batch in batches:
            for chunk in batch.to_pylist():
                with system.open_input_file(chunk["archive"]) as source:
                    dictionary = read_dictionary(source)
                    source.seek(chunk["start"])
                    rows, held = [], 0
                    for record in records(source, dictionary, chunk["length"]):
                        rows.append(parse_record(record))
                        held += len(record)
                        if held > CHUNK_BYTES or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in rows], arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in rows], arrow)

    return manifest.repartition("archive", "start").mapInArrow(run, schema)


def archive_bytes(pages: list[tuple], dictionary: bytes = b"") -> bytes:
    """An archive of (page_id, url, payload, refers_to) in memory."""
    out = io.BytesIO()
    if dictionary:
        out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    for page in pages:
        out.write(pack.compress(make_record(*page)))
    return out.getvalue()


@query(
    "op4_warc_dictionary",
    """
    WITH hashed AS (
        SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
               sha1(coalesce(html, '')) AS hex
        FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_page FROM hashed)
    SELECT page_id, payload_bytes,
           array_to_string([
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (((
                   (instr('0123456789abcdef', hex[5 * i // 4 + 1]) - 1) * 16
                   + greatest(instr('0123456789abcdef', hex[5 * i // 4 + 2]), 1) - 1)
                   >> (3 - (5 * i) % 4)) & 31)]
               FOR i IN range(0, 32)], '') AS payload_digest,
           CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_page THEN first_page END AS refers_to
    FROM firsts
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(manifest, path, payloads=False)
