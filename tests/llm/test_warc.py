"""WARC archives: round trip, revisits and format."""

import base64
import hashlib
import struct
from collections import Counter

import pytest
import zstandard

from riskflow.llm import warc
from riskflow.llm.common import new_path

SCHEMA = "page_id long, url string, html string, digest string, _sha string, bytes int"
PAGES = [
    (7, "http://a/7", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, "http://a/9", "<p>Same</p>"), (4, None, None), (5, "http://a/ ü\r\nX: 1", ""),
    (None, "http://n", "<p>same</p>"), (11, "http://a/11", "twice"), (11, "http://a/11", "twice"), (12, "http://a/12", "x\r\n\r\ny\r\n\r\n"), (13, "u", "ü" * 700_000),
    (11, "http://a/12", "other"), (None, None, "nobody"), (None, None, "nobody"), (14, "http://a/14", "\0WARC/1.1"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "s", 1) for r in rows], SCHEMA)


def expected(rows, least=0):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = Counter()
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is None, i))
        for k, page_id in enumerate(ids):
            again = k > 0 and len(payload) >= least
            out[page_id, len(payload), digest, "revisit" if again else "response", ids[0] if again else None] += 1
    return out


@pytest.mark.parametrize("least", [0, 7, 10**9])
def test_records_read_back(spark, least):
    got = warc.archived(frame(spark, PAGES * 2), least).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(PAGES * 2, least)
    htmls = {p: h or "" for p, _, h in PAGES}
    assert all(r["html"] == htmls[r["page_id"]] for r in got if r["record_type"] == "response" and r["page_id"] not in (11, None))
    assert all(r["html"] is None for r in got if r["record_type"] == "revisit")
    assert {r["url"] for r in got if r["page_id"] == 5} == {"http://a/%20ü%0D%0AX:%201"}


def test_no_pages(spark):
    assert warc.archived(frame(spark, []).limit(0)).count() == 0


def test_files_are_frames_with_a_leading_dictionary(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = new_path(spark, "warc")
    warc.write_archives(pages.repartition(2), path)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    plain, packed, ids = 0, 0, set()
    for data in files:
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC
        records = list(warc.records_of(data))
        plain += sum(map(len, records))
        packed += len(data) - size - 8
        ids |= {warc.parsed(r)["WARC-Record-ID"] for r in records}
        # Each record is a frame of its own: it can be read alone with the dictionary.
        tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        assert tool.decompress(data[8 + size :], allow_extra_data=True) == records[0]
        with pytest.raises(zstandard.ZstdError):
            zstandard.ZstdDecompressor().decompress(data[8 + size :], allow_extra_data=True)
    assert len(ids) == pages.count()
    alone = sum(len(zstandard.compress(r, warc.LEVEL)) for data in files for r in warc.records_of(data))
    assert packed < 0.65 * alone and alone < plain


def test_archives_are_cut_by_size(spark, monkeypatch):
    rows = [{"page_id": str(i), "url": "u", "html": f"page {i} " * 50, "digest": "00" * 20, "bytes": 1, "refers_to": None, "type": "response", "nth": 0} for i in range(100)]
    import pyarrow as pa

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 9_000)
    out = [b.column(0)[0].as_py() for b in warc._archives("2024-01-01T00:00:00Z")(iter([pa.RecordBatch.from_pylist(rows)]))]
    assert len(out) > 5
    assert [warc.parsed(r)["X-Page-ID"] for data in out for r in warc.records_of(data)] == [str(i) for i in range(100)]


def test_damage_is_seen(spark):
    data = warc.archive_of([warc.record_bytes({"page_id": "1", "url": "u", "html": "text " * 99, "digest": "00" * 20, "bytes": 495, "refers_to": None, "type": "response", "nth": 0}, "d")])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.records_of(data[:-5]))
    with pytest.raises(ValueError):
        list(warc.records_of(b"not zstd"))
