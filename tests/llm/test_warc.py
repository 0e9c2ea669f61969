"""Archives: round trip, revisits, and what a reader must refuse."""

import hashlib
import io
import struct
from base64 import b32encode

import pytest
import zstandard

from panelweave.llm import warc

PAGES = [(3, "http://a/3", "<p>same</p>"), (1, "http://a/1", "<p>same</p>"), (2, None, None), (4, "u", ""), (5, "u", "Ünïcode " * 3000), (None, "u", "<p>same</p>")]


@pytest.fixture(scope="module")
def pages(spark):
    more = [(10 + k, f"http://h/{k}", f"<html><body>page {k} of many {'text ' * (k % 50)}</body></html>" * 8) for k in range(300)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(PAGES + more, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("clash") for c in ("digest", "salt", "low", "payload", "first", "archive")})


def test_every_page_comes_back(spark, pages):
    got = {r.page_id: r for r in warc.archive_pages(spark, pages).collect()}
    rows = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert len(got) == len(rows) and all(r.error is None for r in got.values())
    for page, payload in rows.items():
        assert got[page].payload_bytes == len(payload)
        assert got[page].payload_digest == b32encode(hashlib.sha1(payload).digest()).decode()
    kinds = {p: (got[p].record_type, got[p].refers_to) for p in (1, 2, 3, 4, 5, None)}
    assert kinds == {1: ("response", None), 3: ("revisit", 1), None: ("revisit", 1), 2: ("response", None), 4: ("revisit", 2), 5: ("response", None)}
    assert warc.archive_pages(spark, pages.where("false")).count() == 0


def test_small_payloads_are_never_revisits(pages):
    marked = warc.mark_revisits(pages, min_bytes=100)
    assert marked.where("first IS NOT NULL").count() == 0


def archive(records, dictionary=None, level=3):
    out = b""
    coder = zstandard.ZstdCompressor(level=level)
    if dictionary:
        out += struct.pack("<II", warc.DICTIONARY_FRAME, len(dictionary)) + dictionary
        coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return out + b"".join(coder.compress(r) for r in records)


def read(data):
    return [(d, e) for _, d, e in warc.frames(io.BytesIO(data))]


def test_frames_with_and_without_dictionary():
    records = [warc.record(k, "u", b"payload %d" % k, None) for k in range(5)]
    samples = [warc.record(k, "u", b"<html>%d</html>" % k * 20, None) for k in range(400)]
    trained = zstandard.train_dictionary(4096, samples).as_bytes()
    assert [d for d, _ in read(archive(records))] == records
    assert [d for d, _ in read(archive(records, trained))] == records
    packed = zstandard.ZstdCompressor().compress(trained)
    stored = struct.pack("<II", warc.DICTIONARY_FRAME, len(packed)) + packed + archive(records, trained)[8 + len(trained) :]
    assert [d for d, _ in read(stored)] == records
    other = archive(records[:2]) + struct.pack("<II", 0x184D2A50, 3) + b"abc" + archive(records[2:])
    assert [d for d, _ in read(other)] == records
    assert read(b"") == []


def test_damage_is_reported():
    records = [warc.record(k, "u", b"x" * 1000, None) for k in range(2)]
    whole = archive(records)
    assert read(whole[:-5])[-1][1] is not None
    assert read(whole + b"\x00garbage")[-1][1] == "not a frame"
    with pytest.raises(ValueError, match="Content-Length"):
        warc.parse(records[0][:-4])
    with pytest.raises(ValueError, match="digest"):
        warc.parse(records[0].replace(b"xxx", b"yyy"))
    with pytest.raises(ValueError, match="missing"):
        warc.parse(records[0].replace(b"WARC-Date", b"X-Date"))
    with pytest.raises(ValueError, match="no WARC header"):
        warc.parse(b"hello")
    with pytest.raises(ValueError, match="one record"):
        warc.parse(records[0] + records[1])
