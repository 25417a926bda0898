"""Best-fit packing of token sequences in bounded space (operator 11).

Documents become token ids, each with an end mark; a document longer than a
sequence is cut into whole sequences, what is left over coming first. Shorter
pieces are dealt to shards by a hash of their stored number, ``SHARD_PIECES`` on
average, and every shard is packed online: a fixed number of sequences
(``OPEN``) is open at a time, kept in lists by their free space, with a bitset
of the spaces that occur. A piece goes where the least space stays free (the
lowest set bit at or above its length); if it fits nowhere a sequence is opened,
and where that would be one too many the fullest is closed first. Pieces arrive
in waves of ``WAVE``, the longest of a wave first, which lets short ones fill
what long ones leave. Memory is ``OPEN`` sequences and a wave, however large the
shard.

Ids are those of the ``tokenizers`` library for the whole text, special tokens'
strings being ordinary text. A byte-level tokenizer works on each match of its
splitting pattern separately, so a worker keeps the ids of the matches it has met
(``MEMO_BYTES`` at most; the older half is forgotten first) and asks the library's
model for the others. Texts longer than ``CHUNK`` characters are split where a
letter, a blank and a letter meet, which is a border of matches anyway.

Defined results: a null text is empty and so holds the end mark alone; rows with
a null or repeated id are documents of their own; equal lengths are told apart
by the hash, so a rerun over the same stored pieces packs alike; an empty table
gives an empty result; other columns are not read. A run of letters without a
blank is one match and must fit in a worker.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from ._common import bounded_batches, materialize

SEQUENCE = 1024
SHARD_PIECES = 8192
OPEN = 1024
WAVE = 2048
CHUNK = 1 << 19
MEMO_BYTES = 64 << 20
# A longer match is encoded each time; its ids are not kept.
MEMO_CHARS = 64
# What an entry of the memo takes beside its characters and ids.
MEMO_ENTRY = 200


# A splitting pattern in the terms of Python's own, faster engine. Both split alike where no character
# beyond Latin letters, no number that is not a digit and no control character counted as blank occurs.
_LATIN = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+": re.compile(
        r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
    )
}
_NOT_LATIN = re.compile("[\x1c-\x1f\u00b2\u00b3\u00b9\u00bc-\u00be\u0250-\U0010ffff]")


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer_json: str, pattern: str) -> None:
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        self.latin = _LATIN.get(pattern, self.pattern)
        self.four_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.border = regex.compile(r"\p{L}(?= \p{L})")
        # Ids by match: of late, and before that. Half of MEMO_BYTES each at most.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def __call__(self, text: str) -> bytes:
        return b"".join(self._chunk(chunk) for chunk in self._chunks(text))

    def _chunks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > CHUNK:
            found = self.border.search(text, start + CHUNK)
            if not found:
                break
            yield text[start : found.end()]
            start = found.end()
        yield text[start:] if start else text

    def _chunk(self, text: str) -> bytes:
        if self.size > MEMO_BYTES // 2:
            self.older, self.memo, self.size = self.memo, {}, 0
        matches = (self.pattern if _NOT_LATIN.search(text) else self.latin).findall(text)
        found = list(map(self.memo.get, matches))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            learnt = self._learn({matches[i] for i in missing})
            for i in missing:
                found[i] = learnt[matches[i]]
        return b"".join(found)

    def _learn(self, matches: set[str]) -> dict[str, bytes]:
        """Ids of matches that the memo has not: the library's model works on each by itself."""
        learnt = {m: self.older[m] for m in matches if m in self.older}
        new = [m for m in matches if m not in learnt]
        # The library writes bytes as printable characters; a line break parts the matches that have none.
        flat = [m for m in new if "\n" not in m]
        written = self._written("\n".join(flat)).split(self._written("\n")) if flat else []
        for m, w in [*zip(flat, written, strict=True), *((m, self._written(m)) for m in new if "\n" in m)]:
            learnt[m] = b"".join([self.four_bytes[t.id] for t in self.model.tokenize(w)])
        for m, ids in learnt.items():
            if len(m) <= MEMO_CHARS:
                self.memo[m] = ids
                self.size += MEMO_ENTRY + len(ids) + 2 * len(m)
        return learnt

    def _written(self, text: str) -> str:
        return "".join(part for part, _ in self.as_bytes.pre_tokenize_str(text))


# One encoder for each worker process: its memo serves all its tasks.
_ENCODERS: dict[int, Encoder] = {}


def _encoder(tokenizer_json: str, pattern: str) -> Encoder:
    key = hash((tokenizer_json, pattern))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json, pattern)
    return _ENCODERS[key]


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens: what exceeds whole sequences comes first."""
    if n <= size:
        return [(0, n)]
    first = n % size
    pieces = [(0, first)] if first else []
    return pieces + [(start, size) for start in range(first, n, size)]


def document_pieces(
    df: DataFrame,
    tokenizer_json: str,
    pattern: str,
    end_id: int,
    size: int = SEQUENCE,
    with_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Stored ``(piece_no, id, piece, start, length, ids_crc32[, ids])`` of every document.

    ``tokenizer_json`` is the tokenizer's file as text (it travels with the
    tasks, as executors need not see the driver's files); ``ids`` holds
    little-endian unsigned 32-bit integers; ``piece_no`` is unique.
    """
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] if with_ids else []
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_json, pattern)
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field(0).type), *fields])

            def rows(batch=batch):
                for doc, text in zip(*batch.columns, strict=True):
                    data = encoder(text.as_py()) + end
                    for k, (start, n) in enumerate(cut(len(data) // 4, size)):
                        ids = data[4 * start : 4 * (start + n)]
                        yield 40 + with_ids * len(ids), (doc.as_py(), k, start, n, zlib.crc32(ids), *([ids] if with_ids else []))

            yield from bounded_batches(rows(), schema)

    id_sql = source.schema["id"].dataType.simpleString()
    out_sql = f"id {id_sql}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")
    pieces = source.mapInArrow(run, out_sql).withColumn("piece_no", F.monotonically_increasing_id())
    return materialize(pieces.withColumnRenamed("id", id_col), "pieces")


class OpenSequences:
    """At most ``most`` open sequences by free space; ``place`` puts a piece into one."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.by_space: list[list[int]] = [[] for _ in range(size + 1)]
        self.spaces = 0  # bit s is set where a sequence with s free places is open
        self.n_open = self.n_sequences = 0

    def place(self, n: int) -> tuple[int, int]:
        """Number of the sequence and offset that a piece of ``n`` tokens gets."""
        fitting = self.spaces >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            if self.n_open == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest is closed
            space, sequence = self.size, self.n_sequences
            self.n_sequences += 1
        left = space - n
        if left:
            self.by_space[left].append(sequence)
            self.spaces |= 1 << left
            self.n_open += 1
        return sequence, self.size - space

    def _take(self, space: int) -> int:
        found = self.by_space[space]
        sequence = found.pop()
        if not found:
            self.spaces &= ~(1 << space)
        self.n_open -= 1
        return sequence


def _waves(rows: Iterable[tuple[int, int, int]]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """``(shard, [(length, piece_no)])`` of at most ``WAVE`` rows of one shard each."""
    shard, wave = None, []
    for at, piece_no, length in rows:
        if wave and (at != shard or len(wave) == WAVE):
            yield shard, wave
            wave = []
        shard = at
        wave.append((length, piece_no))
    if wave:
        yield shard, wave


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs ``piece_no`` and ``length``.

    Only numbers and lengths are shuffled; a piece that fills a sequence gets one
    of its own without.
    """
    partial = pieces.where(F.col("length") < size).select("piece_no", F.col("length").cast("bigint").alias("length"))
    shards = max(1, -(-partial.count() // SHARD_PIECES))
    dealt = partial.withColumn("hash", F.xxhash64("piece_no")).withColumn("shard", F.pmod("hash", F.lit(shards)))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "hash", "piece_no").select("shard", "piece_no", "length")
    schema = pa.schema([("piece_no", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed():
            rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
            at, sequences = None, None
            for shard, wave in _waves(rows):
                if shard != at:
                    at, sequences = shard, OpenSequences(size, OPEN)
                for length, piece_no in sorted(wave, key=lambda x: -x[0]):
                    sequence, offset = sequences.place(length)
                    yield 24, (piece_no, (shard << 32) + sequence, offset)

        return bounded_batches(placed(), schema)

    packed = dealt.mapInArrow(run, "piece_no bigint, sequence_id bigint, offset bigint")
    whole = pieces.where(F.col("length") >= size).select("*", (-1 - F.col("piece_no")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return pieces.where(F.col("length") < size).join(packed, "piece_no").select(whole.columns).unionByName(whole)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids, pieces)``: the packed sequences themselves, one row each.

    A sequence is of bounded size, so is every group.
    """
    part = F.struct("offset", "piece_no", "length", "ids")
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["length"]).alias("n_tokens"),
            F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
            F.transform("parts", lambda p: F.struct(p["piece_no"], p["offset"], p["length"])).alias("pieces"),
        )
    )
