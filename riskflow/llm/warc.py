"""WARC archives with a Zstandard dictionary in each.

An archive is a file of Zstandard frames. The first is a skippable frame that holds a dictionary built from the archive's
own records; each record is a frame of its own, compressed with it. Payloads that occur more than once are written once,
as a response; the others are revisit records that refer to it.

Which payloads repeat is found by their digests: a filter over digests lets unique pages pass without a shuffle, and the
revisit records of the others are made from ids and digests alone. Only one page of each repeated payload is shuffled.
Files are written by Spark's text sink, whose commit protocol leaves no half file behind a lost executor: one row is one
archive, and the line separator is an empty skippable frame, so that a file holds Zstandard frames only.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.llm.common import Batches, map_batches, new_path, stored
from riskflow.llm.exact_dedup import filter_of, with_repeated

# Bytes of records in an archive; a longer record is in one of its own.
ARCHIVE_BYTES = 24_000_000
# The dictionary and the records it is built from, spread evenly over the archive.
DICTIONARY_BYTES = 64_000
SAMPLE_BYTES = 2_000_000
# Parameters of the dictionary builder: length of the pieces it counts and of the segments it chooses.
PIECE, SEGMENT = 8, 256
LEVEL = 3
STEP_BYTES = 1 << 15
# Fixed values of the formats: the magic numbers of skippable frames and of other frames, and an empty skippable frame.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")
RECORD = "page_id string, url string, html string, digest string, bytes long, refers_to string, type string"


def record_id(page_id: str | None, digest: str, kind: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr((page_id, digest, kind, nth)))}>"


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC record. A revisit has the HTTP headers of its page, with the payload's length, and no payload."""
    payload = (row["html"] or "").encode() if row["type"] == "response" else b""
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", row["type"]),
        ("WARC-Record-ID", record_id(row["page_id"], digest, row["type"], row["nth"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["url"] and _CONTROL.sub(lambda m: quote(m[0]), row["url"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(http + payload).digest()).decode()}"),
        ("X-Page-ID", None if row["page_id"] is None else quote(row["page_id"], safe="")),
    ]
    if row["type"] == "revisit":
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(row["refers_to"], digest, "response", 0)),
            ("X-Refers-To-Page-ID", None if row["refers_to"] is None else quote(row["refers_to"], safe="")),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(http) + len(payload))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    return head.encode() + http + payload + b"\r\n\r\n"


def dictionary_of(records: list[bytes]) -> bytes:
    """A dictionary built from records spread evenly over the list; of few records, their own bytes."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    sample = records[::step]
    size = min(DICTIONARY_BYTES, max(sum(map(len, sample)) // 8, 256))
    try:
        return zstandard.train_dictionary(size, sample, k=SEGMENT, d=PIECE).as_bytes()
    except zstandard.ZstdError:  # too few records to count anything
        return b"".join(sample)[-DICTIONARY_BYTES:]


def archive_of(records: list[bytes]) -> bytes:
    content = dictionary_of(records)
    chosen = zstandard.ZstdCompressionDict(content)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=chosen, write_checksum=True, write_content_size=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content + b"".join(map(compressor.compress, records))


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time, by the dictionary in its leading frame."""
    view, at, decompressor = memoryview(archive), 0, None
    while at < len(view):
        (magic,) = struct.unpack_from("<I", view, at)
        if magic in SKIPPABLE:
            (size,) = struct.unpack_from("<I", view, at + 4)
            if at == 0 and magic == DICTIONARY_MAGIC:
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size])))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            frame, parts = (decompressor or zstandard.ZstdDecompressor()).decompressobj(), []
            while not frame.eof:  # in small steps, as what a step does not use is copied
                if at >= len(view):
                    raise ValueError("an archive ends within a record")
                parts.append(frame.decompress(view[at : at + STEP_BYTES]))
                at = min(at + STEP_BYTES, len(view))
            at -= len(frame.unused_data)
            yield b"".join(parts)
        else:
            raise ValueError(f"no frame begins at byte {at}")


def parsed(record: bytes) -> dict:
    """The fields of a record, its payload, and the length of the payload by its HTTP headers."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"]
    return fields | {"payload": payload, "length": int(length)}


def _archives(date: str):
    def archives(batches: Batches) -> Batches:
        records: list[bytes] = []
        size = 0

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([archive_of(records)], pa.binary())], names=["archive"])

        for batch in batches:
            for row in (r for part in _rows(batch) for r in part):
                record = record_bytes(row, date)
                if records and size + len(record) > ARCHIVE_BYTES:
                    yield full()
                    records.clear()
                    size = 0
                records.append(record)
                size += len(record)
        if records:
            yield full()

    return archives


def _rows(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    for low in range(0, batch.num_rows, 256):
        yield batch.slice(low, 256).to_pylist()


def _planned(pages: DataFrame, least_bytes: int) -> DataFrame:
    """One row per record to write: page_id, url, html (of responses), digest, bytes, refers_to, type, nth."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("string").alias("page_id"), F.col("page_id").alias("_order"), F.col("url").cast("string").alias("url"), "html",
        F.octet_length(html).cast("long").alias("bytes"), F.sha1(html).alias("digest"), F.sha2(html, 256).alias("_sha"),
    )
    known = rows.drop("html").filter(F.col("bytes") >= least_bytes)
    # Null ids and null addresses come last.
    place = F.struct(F.col("_order").isNull().alias("n"), F.col("_order").alias("o"), F.col("url").isNull().alias("u"), F.col("url").alias("url"))
    pairs = stored(known.groupBy("_sha", "_order", "url").agg(F.count(F.lit(1)).alias("_rows"), F.first("page_id").alias("page_id"), F.first("digest").alias("digest"), F.first("bytes").alias("bytes")), "pages")
    groups = pairs.groupBy("_sha").agg(F.min(place).alias("_first"), F.min_by("page_id", place).alias("_response"), F.sum("_rows").alias("_all")).filter("_all > 1")
    groups = stored(groups.drop("_all"), "payloads")
    blocks = stored(filter_of(groups.select(F.xxhash64("_sha").alias("hash"))), "filter")
    flagged = with_repeated(rows.withColumn("_hash", F.xxhash64("_sha")), "_hash", blocks, "_maybe")
    flagged = flagged.withColumn("_maybe", F.col("_maybe") & (F.col("bytes") >= least_bytes))
    null, response = F.lit(None).cast("string").alias("refers_to"), F.lit("response").alias("type")
    written = ["page_id", "url", "html", "digest", "bytes"]
    zero = F.lit(0).cast("long").alias("nth")
    # Without a refers_to of their own, records of equal ids and payloads below least_bytes are told apart by no number.
    single = flagged.filter("not _maybe").select(*written, null, response, zero)
    # Possibly repeated: those that are not go as they are. Of the others only the first of each payload needs its text.
    keys = groups.select("_sha", "_first", "_response")
    again = flagged.filter("_maybe").withColumn("_place", place)
    others = again.join(groups.select("_sha"), "_sha", "left_anti").select(*written, null, response, zero)
    firsts = stored(filter_of(groups.select(F.xxhash64("_sha", "_first").alias("hash"))), "filter")
    chosen = with_repeated(again.withColumn("_spot", F.xxhash64("_sha", "_place")), "_spot", firsts, "_chosen").filter("_chosen")
    chosen = chosen.join(keys, "_sha").filter(F.col("_place") == F.col("_first"))
    whole = chosen.groupBy("_sha").agg(*[F.max(c).alias(c) for c in written]).select(*written, null, response, zero)
    copies = pairs.join(keys, "_sha").withColumn("_is_first", place == F.col("_first"))
    copies = copies.withColumn("_rows", F.col("_rows") - F.col("_is_first").cast("long")).filter("_rows > 0")
    # Repetitions in chunks, so that no row holds a list that grows with them.
    chunk = 10_000
    copies = copies.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_rows - 1) div {chunk})")))
    copies = copies.withColumn("nth", F.explode(F.expr(f"sequence(_chunk * {chunk}L, least(_chunk * {chunk}L + {chunk - 1}L, _rows - 1))")))
    revisits = copies.select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "bytes", F.col("_response").alias("refers_to"), F.lit("revisit").alias("type"), "nth")
    return single.unionByName(others).unionByName(whole).unionByName(revisits)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: dt.datetime | None = None) -> None:
    """Archives of all `pages` (page_id, url, html; other columns are left out) in the new folder `path`.

    The payload of a page is its html in UTF-8; null is empty. Of pages with equal payloads of at least `least_bytes`
    bytes, that with the smallest page_id is the response, and the others are revisits of it; null ids come last, and
    of rows that repeat id and payload one is the response. An empty table gives a folder without archives.
    """
    stamp = (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    archives = map_batches(_planned(pages, least_bytes), _archives(stamp), "archive binary")
    archives.select(F.col("archive").cast("string")).write.options(lineSep=SEPARATOR, maxRecordsPerFile=1).text(path)


def _read(batches: Batches) -> Batches:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
    for batch in batches:
        for archive in batch.column("content"):
            rows, size = [], 0
            for record in map(parsed, records_of(archive.as_py())):
                digest, payload = record["WARC-Payload-Digest"].removeprefix("sha1:"), record["payload"]
                response = record["WARC-Type"] == "response"
                if response and (base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != record["length"]):
                    raise ValueError(f"the payload of {record['WARC-Record-ID']} is damaged")
                ids = [record.get(k) for k in ("X-Page-ID", "X-Refers-To-Page-ID")]
                page_id, refers_to = (None if i is None else unquote(i) for i in ids)
                rows.append((page_id, record.get("WARC-Target-URI"), record["length"], digest, record["WARC-Type"], refers_to, payload.decode() if response else None))
                size += len(payload)
                if size > 4_000_000:
                    yield _batch(names, rows)
                    rows, size = [], 0
            yield _batch(names, rows)


def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "payload_bytes" else pa.string()) for n, c in zip(names, columns, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The records of all archives in `path`: page_id, url, payload_bytes, payload_digest, record_type, refers_to, html.

    Responses are compared with their digest; a damaged archive raises. Revisits have no html.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, html string"
    rows = map_batches(files, _read, schema)
    return rows.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the archives of `pages` into the shared folder and reads them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path, pages.schema["page_id"].dataType.simpleString())
