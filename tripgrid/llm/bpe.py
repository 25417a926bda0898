"""Byte-level BPE encoding and decoding (operator 1).

Encoding looks for the token sequence that the merge rules would leave, but
without merging: an Aho-Corasick automaton over the vocabulary (bytes mapped
to the Latin-1 characters of the same code) gives the longest token that
starts at each position; the encoder takes longest tokens from the left and
backtracks to the next shorter prefix token whenever two neighbours could not
stand beside each other in a merged sequence. Whether two tokens are
compatible depends on these two alone, so the answers are memoised; a position
from which no continuation exists is marked and never tried again. Each
position is left at most once per token that starts there, so the work is
linear in the text.

Defined results: a null text counts as empty and has no tokens; rows are
independent, so repeated rows, null ids and an empty table need no special
care; only the id and text columns are read, whatever other columns the table
has. A text is encoded whole, however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import BATCH_BYTES

# Entries a worker keeps of each memo; a full memo is emptied, which bounds its memory.
PIECE_MEMO = 150_000
PAIR_MEMO = 200_000


def read_ranks(path: str) -> bytes:
    """Content of a rank file (one base64 token and its rank per line)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


class _Memo(dict):
    """A dict that computes missing values and empties itself when full."""

    def __init__(self, compute, limit: int) -> None:
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._compute(key)
        return value


class Encoder:
    """Encodes with one vocabulary, exactly as rank-ordered merging does."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import ahocorasick
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs all 256 single bytes")
        self.ranks = ranks
        self.token_bytes = {i: t for t, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self._learn_merges()
        automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            if i in self.left:
                automaton.add_word(token.decode("latin-1"), (len(token), i))
        automaton.make_automaton()
        self.automaton = automaton
        self.sizes = {i: len(t) for i, t in self.token_bytes.items()}
        self.shorter = {i: self._longest_prefix(self.token_bytes[i]) for i in self.left}
        self.compatible = _Memo(self._compatible, PAIR_MEMO)
        self.pieces = _Memo(self._piece, PIECE_MEMO)

    def _learn_merges(self) -> None:
        """The last merge of every token that merging can make, in rank order."""
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        ranks = self.ranks
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.left[i] = self.right[i] = i
        for token, i in sorted(ranks.items(), key=lambda x: x[1]):
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k], i), ranks.get(token[k:], i)
                if a in self.left and b in self.left and a < i and b < i and self._compatible((a, b)):
                    self.left[i], self.right[i] = a, b
                    self.merged[a, b] = i
                    break

    def _longest_prefix(self, token: bytes) -> int:
        for k in range(len(token) - 1, 0, -1):
            i = self.ranks.get(token[:k], -1)
            if i in self.left:
                return i
        return -1

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Can the two tokens be neighbours in a merged sequence?

        Undo their merges, latest first, and see whether a merge across the
        border would have come before the one undone.
        """
        a, b = pair
        limit = 1 << 62
        while True:
            if self.merged.get((a, b), limit) < limit:
                return False
            if a > b:
                if self.left[a] == a:  # both are bytes: nothing left to undo
                    return True
                limit, a = a, self.right[a]
            else:
                if self.left[b] != b:
                    # of equal merges the left one comes first, hence + 1
                    limit, b = b + 1, self.left[b]
                elif self.left[a] != a:
                    limit, a = a, self.right[a]
                else:
                    return True

    def _piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self._backtrack(data)
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _backtrack(self, data: bytes) -> list[int]:
        n = len(data)
        longest = [0] * n
        for end, (size, i) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = i  # a later end is a longer token
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        sizes, shorter, compatible = self.sizes, self.shorter, self.compatible
        while True:
            end = at + sizes[token]
            if not dead[end] and (not out or compatible[out[-1], token]):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: step back, go on with the next shorter token
                dead[at] = 1
                previous = out.pop()
                at -= sizes[previous]
                token = shorter[previous]

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))


class Decoder:
    """Bytes of token ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.token_bytes = {i: t for t, i in ranks.items()}

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, memoryview(ids).cast("I")))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(content: bytes, pattern: str) -> Encoder:
    """The worker's encoder for this vocabulary; built once per Python process."""
    key = (hashlib.sha256(content).hexdigest(), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(content), pattern)
    return _ENCODERS[key]


def encode_documents(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
    decode: bool = False,
) -> DataFrame:
    """``(id, *keep, n_tokens, ids)``: ids as binary, little-endian unsigned 32-bit integers.

    With ``decode`` there is also ``decoded``, the bytes that the ids decode
    to, made by the same worker, which saves a second one for each task. The
    vocabulary (a file of fixed size, about 1 MB) is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.col(id_col).alias("id"), *keep, text.alias("to_encode"))
    n = 1 + len(keep)
    added = ["n_tokens", "ids", *["decoded"] * decode]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(shared.value, pattern)
        back = Decoder(enc.ranks).decode if decode else None
        for batch in batches:
            at = 0
            for ids in _groups(enc.encode(text.as_py()) for text in batch.column(n)):
                columns = [c.slice(at, len(ids)) for c in batch.columns[:n]]
                columns += [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if back:
                    columns.append(pa.array(map(back, ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:n], *added])
                at += len(ids)

    types = {"n_tokens": "bigint", "ids": "binary", "decoded": "binary"}
    out = source.mapInArrow(run, ", ".join([_fields(source, n), *(f"{c} {types[c]}" for c in added)]))
    return out.withColumnRenamed("id", id_col)


def decode_documents(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids`` replaced by the binary column ``decoded``; other columns stay.

    Null ids decode to an empty value.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = [F.col(c) for c in df.columns if c not in (ids_col, "decoded")]
    source = df.select(*kept, F.col(ids_col).alias("to_decode"))
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(parse_ranks(shared.value)).decode
        for batch in batches:
            at = 0
            for values in _groups(decode(ids.as_py() or b"") for ids in batch.column(n)):
                columns = [c.slice(at, len(values)) for c in batch.columns[:n]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary())], names=[*batch.schema.names[:n], "decoded"])
                at += len(values)

    return source.mapInArrow(run, ", ".join(x for x in (_fields(source, n), "decoded binary") if x))


def _fields(df: DataFrame, n: int) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:n])


def _groups(values: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Runs of values that together hold about BATCH_BYTES."""
    group, size = [], 0
    for value in values:
        group.append(value)
        size += len(value)
        if size >= BATCH_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group
