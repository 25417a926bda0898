"""WARC archives: round trip, and archives that are not as they should be."""

import io

import pytest
import zstandard

from tripgrid.llm import warc
from tripgrid.session import scratch_path

PAGE = "<html><body>" + "word <b>bold</b> " * 40
ROWS = (
    [(i, f"http://h/{i}?a=b c\r\né", PAGE + str(i)) for i in range(40)]
    + [(100 + i, "http://same", PAGE) for i in range(5)]
    + [(104, "http://again", PAGE)]
    + [(200, None, None), (201, "http://e", ""), (None, "http://n", "only null id"), (300, "http://big", "é" * 400_000)]
)


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, payload string, refers_to int")


def test_round_trip(spark, monkeypatch):
    manifest = warc.write_archives(frame(spark))
    out = {}
    for r in warc.read_archives(manifest).collect():
        out.setdefault(r.page_id, []).append(r)
    assert sum(map(len, out.values())) == len(ROWS)
    for i, url, html in ROWS:
        payload = (html or "").encode()
        r = next(r for r in out[i] if html != PAGE or i != 104 or r.url == url)
        assert r.payload_bytes == len(payload) and r.payload_digest == warc.base32_sha1(payload)
        want = {**{100 + k: 104 for k in range(4)}, 200: 201}.get(i)
        assert (r.record_type, r.refers_to) == (("response", None) if want is None else ("revisit", want))
        assert r.payload == (payload if want is None else None)
    assert out[1][0].url == "http://h/1?a=b%20c%0D%0A%C3%A9"


def test_min_payload(spark):
    out = warc.read_archives(warc.write_archives(frame(spark), min_payload=10**6)).collect()
    assert {r.record_type for r in out} == {"response"} and len(out) == len(ROWS)


def test_archives_in_a_folder(spark, scratch):
    manifest = warc.write_archives(frame(spark), folder=f"file://{scratch}/a")
    listed = warc.list_archives(spark, f"file://{scratch}/a")
    assert listed.count() == manifest.count()
    assert warc.read_archives(listed).count() == len(ROWS)


def test_empty_table(spark):
    manifest = warc.write_archives(frame(spark).where("false"), folder=scratch_path(spark, "no-archives"))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def archive(records, dictionary):
    writer = warc.ArchiveWriter(dictionary)
    for r in records:
        writer.add(r)
    return writer.buffer.getvalue()


RECORDS = [warc.record(i, "http://x", (PAGE + str(i)).encode(), None, "2024-01-01T00:00:00Z") for i in range(60)]
DICTIONARY = warc.train_dictionary([(PAGE * 3 + str(i * 7919)).encode() for i in range(200)])


@pytest.mark.parametrize("dictionary", [b"", DICTIONARY, b"<html><body>word <b>bold</b> " * 30])
def test_frames(dictionary):
    data = archive(RECORDS, dictionary)
    assert list(warc.read_archive(io.BytesIO(data))) == RECORDS
    assert int.from_bytes(data[:4], "little") == (warc.SKIPPABLE_MAGIC if dictionary else int.from_bytes(warc.ZSTD_MAGIC, "little"))


def test_a_plain_dictionary_is_read_too():
    data = archive(RECORDS[:3], DICTIONARY)
    size = int.from_bytes(data[4:8], "little")
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    head = warc.SKIPPABLE_MAGIC.to_bytes(4, "little") + len(plain).to_bytes(4, "little") + plain
    assert list(warc.read_archive(io.BytesIO(head + data[8 + size :]))) == RECORDS[:3]


def test_bad_archives():
    data = archive(RECORDS, DICTIONARY)
    with pytest.raises(ValueError, match="frame is cut off"):
        list(warc.read_archive(io.BytesIO(data[:-3])))
    with pytest.raises(ValueError, match="dictionary frame"):
        list(warc.read_archive(io.BytesIO(data[:20])))


@pytest.mark.parametrize(
    "change,message",
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9"), "not a"),
        (lambda r: r.replace(b"WARC-Date", b"X-Date"), "without warc-date"),
        (lambda r: r[:-6] + r[-4:], "Content-Length"),
        (lambda r: r[:-4] + b"xxxx", "end mark"),
        (lambda r: r.replace(b"word", b"w0rd", 1), "digest differs"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"), "WARC-Refers-To"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-Date "), "colon|without"),
    ],
)
def test_bad_records(change, message):
    assert warc.parse_record(RECORDS[0])["page_id"] == 0
    with pytest.raises(ValueError, match=message):
        warc.parse_record(change(RECORDS[0]))
