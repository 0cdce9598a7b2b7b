"""WARC archives against a plain version of their records, and their edge cases."""

import base64
import glob
import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from flowspark.llm import warc

PAGES = [
    (1, "http://a.example/?q=1", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"),
    (3, "http://c.example/a b\r\nX: y", "<p>zwei é漢😀</p>\r\n\r\nWARC/1.1\r\n"), (4, None, None), (5, "u", ""),
    (6, "u", "x" * 3_000_000), (7, "u", "x" * 3_000_000), (8, "same", "same"), (8, "same", "same"),
    (None, "n", "<p>one</p>"), (None, "n", "unknown only"), (None, "n", "unknown only"), (9, "é", "last"),
]


def table(spark, rows):
    rows = [(*r, "payload", 1) for r in rows]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, payload string, size int"
    ).repartition(3)


def expected(rows, min_bytes=0):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        known = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(known, default=page_id)
        revisit = page_id != first and len(payload) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [{}, {"min_bytes": 5}, {"archive_bytes": 500}, {"dictionary_bytes": 300}])
def test_round_trip(spark, settings):
    got = warc.warc_round_trip(table(spark, PAGES), **settings).collect()
    assert sorted(map(tuple, got), key=repr) == expected(PAGES, settings.get("min_bytes", 0))


def test_hot_and_rare_payloads(spark):
    """More repeated payloads than are broadcast, and one that a third of the rows have."""
    rows = [(i, "u", f"pair {i // 2}") for i in range(4000)]
    rows += [(10_000 + i, "u", "hot") for i in range(2000)]
    got = warc.warc_round_trip(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(p, len(h), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
          *(("response", None) if p == top else ("revisit", top)))
         for p, _, h in rows for top in [11_999 if h == "hot" else p | 1]], key=repr)


def test_payloads_and_places(spark, tmp_path):
    rows = [(i, f"http://x.example/{i}", f"<html><p>page {i % 7} of a site</p></html>" * 20) for i in range(400)]
    manifest = warc.write_archives(table(spark, rows), str(tmp_path), archive_bytes=40_000).collect()
    names = {r.archive for r in manifest}
    assert len(manifest) == 400 and len(names) > 1
    assert {f.rsplit("/", 1)[1] for f in glob.glob(f"{tmp_path}/*")} == names
    back = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    texts = {page: html for page, _, html in rows}
    for r in manifest:
        one = warc.read_record(f"{tmp_path}/{r.archive}", r.offset, r.length)
        assert one[0] == r.page_id and one[4] == r.record_type == back[r.page_id].record_type
        of = back[r.page_id].refers_to or r.page_id
        assert back[of].payload.decode() == texts[r.page_id]
        assert back[r.page_id].url == f"http://x.example/{r.page_id}"


def test_archive_layout():
    """A skippable frame with a dictionary, and one frame for each record, as the format has it."""
    records = [warc.record(i, "http://x.example/", f"<p>text {i}</p>".encode() * 30, 12,
                           hashlib.sha1(b"").hexdigest(), None, "a", "2026-01-01T00:00:00Z")
               for i in range(300)]
    parts, places = warc.archive(records, "a.warc.zst", "2026-01-01T00:00:00Z", 4096, 1 << 20, 3)
    data = b"".join(parts)
    magic, size = struct.unpack("<II", data[:8])
    known = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert magic == 0x184D2A5D and known.startswith(b"\x37\xa4\x30\xec")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known))
    assert [unpack.decompress(data[o : o + n]) for o, n in places] == records
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) < alone
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(data[places[0][0] : sum(places[0])])


def test_damage_is_an_error():
    one = warc.record(1, "u", b"payload", 7, hashlib.sha1(b"payload").hexdigest(), None, "a", "d")
    ((fields, block),) = warc.parsed(io.BytesIO(one))
    assert warc.content(fields, block)[6] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.content(fields, block.replace(b"payload", b"Payload"))
    with pytest.raises(ValueError, match="too early"):
        list(warc.parsed(io.BytesIO(one[:-8])))


def test_empty_table(spark):
    assert warc.warc_round_trip(table(spark, PAGES).limit(0)).count() == 0


def test_attempts_that_do_not_count_are_not_read(spark, tmp_path):
    """Files of a lost attempt lie in the staging folder and go with it."""
    warc.write_archives(table(spark, PAGES[:3]).where(F.col("page_id") > 0), str(tmp_path))
    assert not glob.glob(f"{tmp_path}/_staged*")
    assert warc.read_archives(spark, str(tmp_path)).count() == 3
