"""WARC archives: dictionary-compressed writing, and reading back.

A page is a record: ``response`` with its payload, or ``revisit`` with headers only if a page
of a larger id has the same payload. Records are gathered up to ``archive_bytes``, a Zstandard
dictionary is trained on records from all over that archive, and the archive is written as
a skippable frame with the dictionary and a frame of its own for each record, so a record can
be read alone from its offset. An archive with too few records to train on has their bytes as a
raw dictionary.

Payloads meet their first copies by SHA-256 (SHA-1, the digest WARC names, can be forged). Keys
that repeat are combined before their shuffle and written; those that a thousandth of the
repeated rows have, a thousand at most, are broadcast, and their rows spread over all tasks.

Tasks write into a folder of their own under names no other attempt has; the manifest, which
Spark commits, lists the files of attempts that count, and only those are moved to the
archives. A move that was made before is left alone, so lost executors and repeated tasks
change nothing, and what failed attempts left goes with their folder.

Cases: a NULL html is the empty payload. A NULL page_id is read back as NULL and is never the
response that others refer to, unless a payload has no known id: then all its pages are responses.
Repeated rows are a record each; pages that share the largest id of a payload are all
responses. A NULL url is written as an unknown URN, control characters and spaces in one are
percent-encoded. An empty table gives no archives and no rows. Further columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.common import saved, ship
from flowspark.scratch import delete, new_folder

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
#: Bytes of records that a dictionary is trained on.
SAMPLE_BYTES = 4 << 20
#: At most this many payloads are broadcast.
HOT_PAYLOADS = 1000

MANIFEST = "archive string, offset long, length long, page_id long, record_type string"
RECORDS = (
    "archive string, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def _opened(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a URI or a plain path, and the path in it."""
    if re.match(r"^[a-zA-Z][\w+.-]*:", path):
        return files.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return files.LocalFileSystem(), path


def _field(text: str) -> str:
    return "".join(c if "!" <= c else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _name(page_id: int | None, own: str) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{own}>"


def _page_of(name: str) -> int | None:
    number = name.split(":")[2]
    return int(number) if number else None


def record(
    page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1: str,
    refers_to: int | None, own: str, date: str,
) -> bytes:
    """One WARC record; a revisit has no ``payload``. ``own`` makes a revisit's name unique."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    ).encode()
    if payload is None:
        kind, name = "revisit", _name(page_id, own)
        more = [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {_name(refers_to, digest)}"]
    else:
        kind, name, more = "response", _name(page_id, digest), []
        block += payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {'urn:x-unknown' if url is None else _field(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *more,
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return b"".join([*(f.encode() + b"\r\n" for f in fields), b"\r\n", block, b"\r\n\r\n"])


def information(name: str, date: str) -> bytes:
    """The record that describes an archive."""
    block = b"software: flowspark\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:x-archive:{name}>",
        f"WARC-Date: {date}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields",
        f"Content-Length: {len(block)}",
    ]
    return b"".join([*(f.encode() + b"\r\n" for f in fields), b"\r\n", block, b"\r\n\r\n"])


def dictionary(records: list[bytes], size: int, sample_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary of records that are evenly spread over these."""
    step = max(1, -(-sum(map(len, records)) // sample_bytes))
    samples = [r[:sample_bytes] for r in records[::step]]
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8)
    except zstandard.ZstdError:  # too few
        raw = b"".join(samples)[-size:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(
    records: list[bytes], name: str, date: str, dictionary_bytes: int, sample_bytes: int, level: int
) -> tuple[list[bytes], list[tuple[int, int]]]:
    """(parts of the file, offset and length of each record)."""
    known = dictionary(records, dictionary_bytes, sample_bytes)
    stored = zstandard.ZstdCompressor(level=level).compress(known.as_bytes())
    compress = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True).compress
    head = struct.pack("<II", DICTIONARY_FRAME, len(stored)) + stored
    parts = [head, compress(information(name, date))]
    at, places = sum(map(len, parts)), []
    for one in records:
        frame = compress(one)
        parts.append(frame)
        places.append((at, len(frame)))
        at += len(frame)
    return parts, places


def decompressor(source) -> zstandard.ZstdDecompressor:
    """For the records of an archive, whose leading frame is read from ``source``."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    stored = source.read(size)
    if stored.startswith(ZSTD_MAGIC):
        stored = zstandard.ZstdDecompressor().decompress(stored)
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stored))


def parsed(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a stream of uncompressed records."""
    reader = io.BufferedReader(stream, 1 << 18)
    while line := reader.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := reader.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = reader.read(size)
        if len(block) != size or reader.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends too early")
        yield fields, block


def content(fields: dict[str, str], block: bytes) -> tuple | None:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of a page's
    record, None of others. A payload that does not have its digest is an error."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    page_id, url = _page_of(fields["warc-record-id"]), fields["warc-target-uri"]
    if kind == "revisit":
        return page_id, url, size, digest, kind, _page_of(fields["warc-refers-to"]), None
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if found != digest or size != len(payload):
        raise ValueError(f"the payload of page {page_id} is damaged")
    return page_id, url, size, digest, kind, None, payload


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, size, sha1 and refers_to of each page; the payload is NULL where
    it is the same as that of ``refers_to``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.unhex(F.sha2(payload, 256)).alias("key"),
    )
    repeated = saved(
        rows.where(F.col("size") >= min_bytes)
        .groupBy("key")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and response is not null"),
        "payloads",
    )
    all_rows = repeated.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * HOT_PAYLOADS >= all_rows
    hot = repeated.where(often).select("key", F.col("response").alias("_hot"))
    rare = repeated.where(~often).select(F.col("key").alias("_key"), "response")
    row = F.monotonically_increasing_id().cast("string")
    placed = rows.join(F.broadcast(hot), "key", "left").withColumn(
        "_own", F.when(F.col("_hot").isNull(), F.col("key")).otherwise(F.encode(row, "utf-8"))
    )
    response = F.coalesce("_hot", "response")
    joined = placed.join(rare, placed["_own"] == rare["_key"], "left")
    target = F.when(~F.col("page_id").eqNullSafe(response), response)
    return joined.select("*", target.alias("refers_to")).select(
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "size",
        F.sha1("payload").alias("sha1"),
        "refers_to",
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    dictionary_bytes: int = DICTIONARY_BYTES,
    sample_bytes: int = SAMPLE_BYTES,
    level: int = 3,
    date: str | None = None,
) -> DataFrame:
    """Writes the archives; archive, offset, length, page_id and record_type of every record.

    ``folder`` is a path or URI that all executors reach. A task holds the records of one
    archive, ``archive_bytes`` and one record at most.
    """
    spark = pages.sparkSession
    ship(spark)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    staged = f"{folder}/_staged-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(staged)
        system.create_dir(root, recursive=True)
        task = TaskContext.get()
        prefix = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}"
        held: list[bytes] = []
        kinds: list[tuple] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            name = f"{prefix}-{number:05d}.warc.zst"
            parts, places = archive(held, name, date, dictionary_bytes, sample_bytes, level)
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                for part in parts:
                    out.write(part)
            rows = [(name, *place, *kind) for place, kind in zip(places, kinds)]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["archive", "offset", "length", "page_id", "record_type"],
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                one = record(*row, f"{prefix}-{number:05d}.{len(held)}", date)
                held.append(one)
                kinds.append((row[0], "response" if row[2] is not None else "revisit"))
                size += len(one)
                if size >= archive_bytes:
                    yield flush()
                    held.clear()
                    kinds.clear()
                    size, number = 0, number + 1
        if held:
            yield flush()

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _opened(folder)
        _, source = _opened(staged)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                made = system.get_file_info(f"{root}/{name}").type
                if made == files.FileType.NotFound:
                    system.move(f"{source}/{name}", f"{root}/{name}")
            yield batch

    manifest = saved(with_responses(pages, min_bytes).mapInArrow(write, MANIFEST), "manifest")
    names = manifest.select("archive").distinct().mapInArrow(publish, "archive string")
    saved(names, "published")
    delete(spark, staged)
    return manifest


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The pages' records of all archives in a folder, each checked against its digest.

    ``payloads=False`` leaves the ``payload`` column NULL. Archives are read record by record.
    """
    ship(spark)
    schema = pa.schema([
        ("archive", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = _opened(path)
                name, rows, size = place.rsplit("/", 1)[-1], [], 0
                with system.open_input_stream(place, compression=None) as source:
                    unpack = decompressor(source)
                    stream = unpack.stream_reader(source, read_across_frames=True)
                    for fields, block in parsed(stream):
                        found = content(fields, block)
                        if found is None:
                            continue
                        rows.append((name, *(found if payloads else (*found[:-1], None))))
                        size += len(block) if payloads else 0
                        if len(rows) >= 4096 or size >= 16 << 20:
                            yield _batch(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, schema)

    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return paths.select("path").mapInArrow(read, RECORDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def read_record(path: str, offset: int, length: int) -> tuple:
    """One page's record from its place in the manifest, without the records before it."""
    system, place = _opened(path)
    with system.open_input_file(place) as source:
        unpack = decompressor(source)
        source.seek(offset)
        frame = unpack.decompress(source.read(length))
    ((fields, block),) = parsed(io.BytesIO(frame))
    return content(fields, block)


def warc_round_trip(pages: DataFrame, **settings) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, read from the archives."""
    spark = pages.sparkSession
    folder = new_folder(spark, "archives")
    write_archives(pages, folder, **settings)
    return read_archives(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response
  FROM pages
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    ((CAST('0x' || substr(h, i // 4 * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1
    AS BIGINT), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM payloads
"""
