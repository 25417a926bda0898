"""Exact deduplication by composable polynomial fingerprints (operator 8).

A chunk of bytes b0..b(n-1) has the hash ``sum((b[i] + 1) * B**(n-1-i))``
modulo a prime, for two primes. Hashes of neighbouring chunks combine without
the bytes: ``hash(xy) = hash(x) * B**len(y) + hash(y)``. Documents up to one
chunk are hashed where they are read; longer ones are cut into chunks that are
dealt out, hashed in parallel and combined. Documents whose length and
fingerprint agree are compared chunk by chunk: within a group, the least and
the greatest value of every chunk must be the same. This is an ordinary
aggregation, so copies collapse before they are shuffled and a group of any
size causes no skew. Texts of a group that fails the comparison (different
texts of one fingerprint) are grouped by their whole texts instead.

Defined results: a null text counts as empty, and all empty texts form one
group; texts are equal when their UTF-8 bytes are, without any normalisation;
of equal texts the row with the largest id stays, null ids come last; of
several rows with this same id and text exactly one is marked kept; an empty
table gives an empty result; other columns are not read by
``exact_duplicates`` and are passed through by ``drop_exact_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from ._common import bounded_batches, materialize, parallelism

CHUNK_BYTES = 1 << 20
BASE = 0x2545F49
PRIMES = (2**31 - 1, 2**31 - 19)
FINGERPRINT = ["n_bytes", "h1", "h2"]

# Bytes summed before a reduction: 2**9 * 2**31 * 2**16 stays below 2**63.
_PIECE = 1 << 16


def _powers(prime: int) -> np.ndarray:
    """BASE**k for k = _PIECE - 1 down to 0."""
    out = np.empty(_PIECE, dtype=np.uint64)
    value = 1
    for k in range(_PIECE - 1, -1, -1):
        out[k] = value
        value = value * BASE % prime
    return out


_POWERS: list[np.ndarray] = []


def chunk_hash(data: bytes | memoryview) -> tuple[int, int]:
    """Fingerprint of a byte string of any length."""
    if not _POWERS:
        _POWERS.extend(_powers(p) for p in PRIMES)
    values = np.frombuffer(data, dtype=np.uint8)
    out = [0, 0]
    for start in range(0, len(values), _PIECE):
        piece = values[start : start + _PIECE].astype(np.uint64) + np.uint64(1)
        for k, prime in enumerate(PRIMES):
            own = int(np.dot(piece, _POWERS[k][_PIECE - len(piece) :]) % np.uint64(prime))
            out[k] = combine(out[k], own, len(piece), prime)
    return out[0], out[1]


def combine(left: int, right: int, right_bytes: int, prime: int) -> int:
    """Hash of a text from the hashes of its two parts."""
    return (left * pow(BASE, right_bytes, prime) + right) % prime


_CHUNKS = pa.schema(
    [("row_no", pa.int64()), ("chunk_no", pa.int64()), ("n_bytes", pa.int64())]
    + [(c, pa.int64()) for c in ("h1", "h2", "shift1", "shift2")]
)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for row_no, chunk_no, chunk in zip(*batch.columns, strict=True):
                data = chunk.as_buffer()
                n = data.size
                h = chunk_hash(data)
                shifts = (pow(BASE, n, p) for p in PRIMES)
                yield 64, (row_no.as_py(), chunk_no.as_py(), n, *h, *shifts)

    return bounded_batches(rows(), _CHUNKS)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row_no, id, text_sha256, n_bytes, h1, h2)`` of every row of ``df``, written once.

    ``row_no`` tells the rows apart; it has no other meaning.
    """
    texts = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    small = texts.where(F.octet_length("data") <= CHUNK_BYTES)
    # One chunk: its hash is the fingerprint. The sums travel with the row's own columns.
    own = _with_fingerprint(small.withColumn("text_sha256", F.sha2("data", 256)), ["row_no", "id", "text_sha256"])
    large = texts.where(F.octet_length("data") > CHUNK_BYTES).withColumn("row_no", -F.col("row_no") - 1)
    heads = large.select("row_no", "id", F.sha2("data", 256).alias("text_sha256"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.octet_length("data") - 1) / CHUNK_BYTES))
    chunks = large.select("row_no", "data", F.explode(starts).alias("chunk_no")).select(
        "row_no", "chunk_no", F.expr(f"substring(data, cast(chunk_no * {CHUNK_BYTES} + 1 as int), {CHUNK_BYTES})").alias("data")
    )
    chunks = chunks.repartition(parallelism(df.sparkSession), "row_no", "chunk_no")
    hashed = chunks.mapInArrow(
        _hash_chunks, "row_no bigint, chunk_no bigint, n_bytes bigint, h1 bigint, h2 bigint, shift1 bigint, shift2 bigint"
    )
    parts = hashed.groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct(*[f.name for f in _CHUNKS][1:]))).alias("parts"))

    def folded(k: int):
        step = lambda acc, x: F.pmod(acc * x[f"shift{k}"] + x[f"h{k}"], F.lit(PRIMES[k - 1]))
        return F.aggregate("parts", F.lit(0).cast("bigint"), step).alias(f"h{k}")

    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n_bytes"]).alias("n_bytes")
    joined = parts.select("row_no", total, folded(1), folded(2)).join(heads, "row_no")
    columns = ["row_no", "id", "text_sha256", *FINGERPRINT]
    return materialize(own.select(*columns).unionByName(joined.select(*columns)), "fingerprints")


def _with_fingerprint(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the fingerprint of the binary column ``data``."""
    source = df.select(*keep, "data")
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffers = [x.as_buffer() for x in batch.column(n)]
            hashes = [chunk_hash(b) for b in buffers]
            added = [[b.size for b in buffers], [h[0] for h in hashes], [h[1] for h in hashes]]
            columns = [*batch.columns[:n], *(pa.array(a, type=pa.int64()) for a in added)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:n], *FINGERPRINT])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:n]]
    return source.mapInArrow(run, ", ".join([*fields, *(f"{c} bigint" for c in FINGERPRINT)]))


def _suspects(df: DataFrame, text_col: str, words: np.ndarray, emit: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    """What ``emit`` makes of the texts whose fingerprint may be in the filter."""
    shared = df.sparkSession.sparkContext.broadcast(words)
    source = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                buffers = [x.as_buffer() for x in batch.column(0)]
                hashes = np.array([chunk_hash(b) for b in buffers], dtype=np.int64).reshape(-1, 2)
                for k in np.flatnonzero(bloom.may_contain(shared.value, hashes[:, 0], hashes[:, 1])):
                    yield from emit(buffers[k], buffers[k].size, int(hashes[k, 0]), int(hashes[k, 1]))

        return bounded_batches(rows(), schema)

    return source.mapInArrow(run, ddl)


def _emit_chunks(data: pa.Buffer, n: int, h1: int, h2: int):
    for k, start in enumerate(range(0, max(n, 1), CHUNK_BYTES)):
        chunk = data[start : start + CHUNK_BYTES].to_pybytes()
        yield len(chunk), (n, h1, h2, k, chunk)


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)`` for every row of ``df``."""
    rows = fingerprints(df, id_col, text_col)
    groups = rows.groupBy(*FINGERPRINT).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row_no")).alias("keep")
    )
    repeated = materialize(groups.where("group_size > 1"), "repeated")
    words = bloom.build(repeated, F.col("h1"), F.col("h2"))
    long_fields = [(c, pa.int64()) for c in [*FINGERPRINT, "chunk_no"]]
    chunks = _suspects(
        df, text_col, words, _emit_chunks, pa.schema([*long_fields, ("chunk", pa.binary())]),
        "n_bytes bigint, h1 bigint, h2 bigint, chunk_no bigint, chunk binary",
    )
    compared = chunks.groupBy(*FINGERPRINT, "chunk_no").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    unequal = materialize(compared.where("least <> most").select(*FINGERPRINT).distinct(), "unequal")
    marked = rows.join(repeated, FINGERPRINT, "left").select(
        *FINGERPRINT,
        "row_no",
        "id",
        F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("row_no") == F.col("keep.row_no"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
    columns = ["id", "keep_id", "group_size", "kept", "text_sha256"]
    if unequal.isEmpty():
        return marked.select(*columns).withColumnRenamed("id", id_col)
    # Different texts share a fingerprint: these groups go by their whole texts.
    by_text = _by_whole_text(df, id_col, text_col, unequal)
    kept_as_is = marked.join(unequal, FINGERPRINT, "left_anti")
    return kept_as_is.select(*columns).unionByName(by_text.select(*columns)).withColumnRenamed("id", id_col)


def _by_whole_text(df: DataFrame, id_col: str, text_col: str, unequal: DataFrame) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("id"), text.cast("binary").alias("data"))
    texts = _with_fingerprint(source.withColumn("copy", F.col("data")), ["row_no", "id", "copy"])
    texts = materialize(texts.join(unequal, FINGERPRINT, "left_semi"), "unequal-texts")
    best = texts.groupBy("copy").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row_no")).alias("keep"))
    return texts.join(best, "copy").select(
        "id",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("keep.row_no")).alias("kept"),
        F.sha2("copy", 256).alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` (all columns) that stay: one for each different text."""
    found = exact_duplicates(df, id_col, text_col).where("kept").select(F.col(id_col).alias("keep_id"), F.col("text_sha256").alias("keep_sha"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"))
    joined = rows.join(found, (F.col("sha") == F.col("keep_sha")) & F.col("id").eqNullSafe(F.col("keep_id")))
    # Repeated rows (same id, same text): the join has put them side by side.
    first = F.row_number().over(Window.partitionBy("sha", "id").orderBy("sha"))
    return joined.withColumn("nth", first).where("nth = 1").select("row.*")
