"""WARC archives compressed with Zstandard and a dictionary (operator 6).

An archive begins with a skippable frame that holds the dictionary (itself a
Zstandard frame), followed by one frame per record, so each record can be read
alone. Writers roll to a new archive at a target size and name their files by
task attempt; only the files that the manifest of the successful attempts
lists are read, so a lost executor or a repeated task leaves nothing wrong
behind. Readers stream an archive frame by frame: memory is bounded by the
largest record. Each record's version line, mandatory headers, Content-Length,
end mark and payload digest are checked; a bad one raises ``ValueError``.

Archives are opened with pyarrow's file systems (local or mounted folders,
HDFS, S3, GCS); the pages themselves are read by Spark.

Defined results: a null html counts as an empty payload; of records with equal
payloads (SHA-1 and length) the one with the largest page id is a response and
the others are revisits that refer to it; rows that repeat this id and payload
are responses too; records with null ids come last, and if all ids of a group
are null all are responses; a null url is written as an empty target; an empty
table gives no archive and an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import bounded_batches, materialize, parallelism
from tripgrid.session import scratch_path

ARCHIVE_BYTES = 16 << 20
READ_BYTES = 1 << 16
LEVEL = 3

# The dictionary is trained on at most this many payloads of at most this size.
DICTIONARY_ROWS = 256
DICTIONARY_ROW_BYTES = 1 << 16
DICTIONARY_BYTES = 1 << 15

# Fixed values of the file formats.
SKIPPABLE_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")
RECORD_URN = "urn:x-page:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id) -> str:
    return f"<{RECORD_URN}{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[bytes, bytes]:
    out = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def parse_record(data: bytes) -> dict:
    """Check a record and return its fields."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not mark or version != VERSION:
        raise ValueError(f"not a {VERSION.decode()} record: {data[:40]!r}")
    headers = _headers(lines)
    missing = [h.decode() for h in MANDATORY if h not in headers]
    if missing:
        raise ValueError(f"record without {', '.join(missing)}")
    size = int(headers[b"content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {size}, but {len(rest) - 4} bytes before the end mark")
    block = rest[:size]
    if headers.get(b"warc-block-digest", b"").partition(b":")[2] not in (b"", base32_sha1(block).encode()):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(_headers(http.partition(b"\r\n")[2]).get(b"content-length", b"-1"))
    kind = headers[b"warc-type"].decode()
    digest = headers.get(b"warc-payload-digest", b"").partition(b":")[2].decode()
    if kind == "response" and (n != len(payload) or digest != base32_sha1(payload)):
        raise ValueError("payload length or digest differs")
    if kind == "revisit" and b"warc-refers-to" not in headers:
        raise ValueError("revisit without WARC-Refers-To")
    return {
        "page_id": _page_id(headers[b"warc-record-id"]),
        "url": headers.get(b"warc-target-uri", b"").decode(),
        "record_type": kind,
        "payload_bytes": n,
        "payload_digest": digest,
        "refers_to": _page_id(headers.get(b"warc-refers-to", b"")),
        "payload": payload if kind == "response" else None,
    }


def _page_id(urn: bytes) -> int | None:
    m = re.fullmatch(rf"<{RECORD_URN}(-?\d+)>", urn.decode())
    return int(m[1]) if m else None


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A Zstandard dictionary, or nothing where the samples are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, payloads).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """Collects records into one archive in memory."""

    def __init__(self, dictionary: bytes) -> None:
        import zstandard

        self.buffer, self.records = io.BytesIO(), 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        if dictionary:
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
            self.buffer.write(SKIPPABLE_MAGIC.to_bytes(4, "little") + len(frame).to_bytes(4, "little") + frame)

    def add(self, data: bytes) -> None:
        self.buffer.write(self.compressor.compress(data))
        self.records += 1


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard

    head = stream.read(8)
    dictionary = None
    rest = head
    if len(head) == 8 and int.from_bytes(head[:4], "little") == SKIPPABLE_MAGIC:
        content = stream.read(size := int.from_bytes(head[4:], "little"))
        if len(content) != size:
            raise ValueError("the dictionary frame is cut off")
        if content.startswith(ZSTD_MAGIC):
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary, rest = zstandard.ZstdCompressionDict(content), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(rest))
            rest = frame.unused_data
            if frame.eof:
                break
            rest = stream.read(READ_BYTES)
            if not rest:
                raise ValueError("a frame is cut off")
        yield b"".join(parts)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def with_revisits(df: DataFrame, id_col: str, url_col: str, payload: Column, min_payload: int) -> DataFrame:
    """``(page_id, url, payload, refers_to)``; ``refers_to`` is null for responses."""
    pages = df.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(payload, F.lit(b"")).alias("payload"),
    )
    keys = pages.select(F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n"), "page_id")
    repeated = (
        keys.where(F.col("n") >= min_payload)
        .groupBy(F.col("sha").alias("r_sha"), F.col("n").alias("r_n"))
        .agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("response_id"))
        .where("copies > 1")
    )
    same = (F.sha1("payload") == F.col("r_sha")) & (F.octet_length("payload") == F.col("r_n"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
    return pages.join(repeated, same, "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(
    df: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_payload: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row of ``df``; the manifest ``(path, records, bytes)`` is returned, written."""
    spark = df.sparkSession
    payload = F.col(payload_col).cast("string").cast("binary")
    sample = df.select(payload.alias("payload")).where(F.octet_length("payload").between(64, DICTIONARY_ROW_BYTES))
    sample = sample.where(F.pmod(F.xxhash64("payload"), F.lit(8)) == 0).limit(DICTIONARY_ROWS)
    dictionary = train_dictionary([bytes(r.payload) for r in sample.collect()])
    folder = folder or scratch_path(spark, "warc")
    rows = with_revisits(df, id_col, url_col, payload, min_payload)
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = _open(folder)
        stem = f"{task.partitionId():06d}-{task.taskAttemptId():08d}"
        written: list[tuple] = []
        archive = ArchiveWriter(dictionary)

        def close(archive: ArchiveWriter) -> None:
            name = f"{stem}-{len(written):05d}.warc.zst"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(archive.buffer.getbuffer())
            written.append((f"{folder}/{name}", archive.records, archive.buffer.tell()))

        system.create_dir(root, recursive=True)
        for batch in batches:
            for page_id, url, body, refers_to in zip(*batch.columns, strict=True):
                archive.add(record(page_id.as_py(), url.as_py(), body.as_py(), refers_to.as_py(), date))
                if archive.buffer.tell() >= ARCHIVE_BYTES:
                    close(archive)
                    archive = ArchiveWriter(dictionary)
        if archive.records:
            close(archive)
        yield from bounded_batches(((64, w) for w in written), schema)

    return materialize(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


def list_archives(spark, folder: str) -> DataFrame:
    """Paths of the archives below a folder, listed by Spark; their content isn't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true")
    return files.load(folder).select("path")


_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def read_archives(paths: DataFrame, path_col: str = "path", with_payload: bool = True) -> DataFrame:
    """The checked records of the archives that ``paths`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for path in batch.column(0).to_pylist():
                    system, name = _open(path)
                    with system.open_input_stream(name) as stream:
                        for data in read_archive(stream):
                            found = parse_record(data)
                            if not with_payload:
                                found["payload"] = None
                            yield len(found["payload"] or b"") + 200, tuple(found[f.name] for f in _RECORDS)

        return bounded_batches(rows(), _RECORDS)

    dealt = paths.select(F.col(path_col).alias("path")).repartition(parallelism(paths.sparkSession), "path")
    return dealt.mapInArrow(
        run,
        "page_id bigint, url string, record_type string, payload_bytes bigint, "
        "payload_digest string, refers_to bigint, payload binary",
    )
