"""Ranked lexical search over posting lists in blocks of similar documents (operator 12).

A term's posting list is cut into blocks of similar documents (per-term
geometric blocking): every document has a sketch, a random projection of its
term weights, and the list's documents go to the nearest of as many centres as
the list needs blocks. A block stores a summary, for each term the largest
impact that any of its documents has (the coordinatewise maximum). The sum of
the item's weights times the summary bounds the score of every document of the
block, exactly, in integers; a block is skipped only if that bound is below the
k-th best score so far. Blocks with the largest bounds come first. Lists whose
terms together cannot reach that score are not visited: a document with nothing
but such terms cannot, either. The score of every other document is computed in
full, so the ranks are exact.

Documents are read twice as a table: once to count their terms (whole texts; the
rows stored hold the terms that items ask for), once to search. Each task reads
its rows in shards of ``SHARD_DOCS`` documents, indexes one shard at a time and
keeps the k best of each item over all its shards. A first search of one row in
``SAMPLE`` (by a hash) gives each item a score that k documents reach, a lower
bound that every task starts from; it never decides a result. Items are worked
off in packs of ``PACK_BYTES`` of text, so what a task is sent is bounded; more
items take more packs, each a pass over all documents.

Score: a term is a maximal run of letters, digits and characters above U+007F,
A-Z lower-cased. N documents have terms, L terms in all, n a document's own.
``w = floor(1000 * ln((2N + 2) / (2df + 1)))``, ``m = 50 + (50 * n * N) div L``;
the score sums ``w * ((10^9 * tf) div (1000 * tf + 20 * m))`` over the item's
terms, once each.

Defined results: a null or empty text has no terms, of an item as of a document,
and so is in no result; documents are told apart by row, so repeated and null
ids count as they stand; equal scores go by ascending doc_id (null last); every
row of the items is ranked for itself; an empty table gives an empty result;
other columns are not read. Ids are integers.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import bounded_batches, materialize
from .shingles import mix

K = 50
SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 20
BLOCK = 32
SKETCH = 16
SAMPLE = 64
PACK_BYTES = 4 << 20
CHUNK = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")


def text_terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of those of about ``CHUNK`` bytes."""
    data = data.translate(_LOWER)
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > CHUNK:
            found = _BREAK.search(data, start + CHUNK)
            end = found.start() if found else end
        yield _TERM.findall(data, start, end)
        start = end


@dataclass
class Pack:
    """Items of bounded size in all: numbers of their terms in the pack's vocabulary."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int, np.ndarray]]  # number of the row, terms


def _packs(rows: DataFrame) -> Iterator[Pack]:
    """The stored ``(item_no, text)`` rows as packs, one in memory at a time."""
    pack, size = Pack({}, []), 0
    for row in rows.toLocalIterator():
        terms = {t for part in text_terms((row.text or "").encode()) for t in part}
        if pack.items and size + sum(map(len, terms)) > PACK_BYTES:
            yield pack
            pack, size = Pack({}, []), 0
        size += sum(map(len, terms)) + 16
        numbers = [pack.vocabulary.setdefault(t, len(pack.vocabulary)) for t in sorted(terms)]
        if numbers:
            pack.items.append((row.item_no, np.array(numbers, dtype=np.int64)))
    if pack.items:
        yield pack


def _counted(df: DataFrame, pack: Pack, id_col: str, text_col: str) -> DataFrame:
    """Stored ``(row, doc_id, n, terms, counts)`` of the documents with terms; of the terms those of the pack."""
    vocabulary = df.sparkSession.sparkContext.broadcast(pack.vocabulary)
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = df.select(F.col(id_col).cast("bigint").alias("doc_id"), data.alias("data"))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value

        def rows():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    n, found = 0, []
                    for part in text_terms(text.as_py()):
                        n += len(part)
                        found.append(np.array([known[t] for t in part if t in known], dtype=np.int32))
                    if n:
                        terms, counts = np.unique(np.concatenate(found), return_counts=True)
                        yield 12 * len(terms), (doc, n, terms, counts)

        return bounded_batches(rows(), schema)

    out = source.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")
    stored = materialize(out.withColumn("row", F.monotonically_increasing_id()), "terms")
    vocabulary.destroy()
    return stored


class Shard:
    """Posting lists of some documents, cut into blocks when first asked for."""

    def __init__(self, weights: np.ndarray, ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        self.ids, self.nulls, self.starts = ids, nulls, starts  # starts has an end too
        self.terms, self.impacts = terms, impacts
        self.sizes = np.diff(starts)
        order = np.argsort(terms, kind="stable")
        self.listed = np.repeat(np.arange(len(ids)), self.sizes)[order]
        self.lists = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.largest = np.zeros(len(weights), dtype=np.int64)
        np.maximum.at(self.largest, terms, impacts)
        # One random sign for each term and direction.
        signs = mix(terms.astype(np.uint64) + np.uint64(12))
        strength = (weights[terms] * impacts).astype(np.float32)
        sketch = np.empty((len(ids), SKETCH), dtype=np.float32)
        for d in range(SKETCH):
            signed = np.where((signs >> np.uint64(d)) & np.uint64(1), strength, -strength)
            sketch[:, d] = np.add.reduceat(signed, starts[:-1]) if len(ids) else 0
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        self.blocks: dict[int, tuple[np.ndarray, ...]] = {}

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the documents' terms, one document after the other, and where each begins among them."""
        sizes = self.sizes[docs]
        heads = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.starts[docs] - heads, sizes), heads

    def blocked(self, term: int) -> tuple[np.ndarray, ...]:
        """Documents of the term's list by block, where each block begins, and the blocks' summaries."""
        if term not in self.blocks:
            docs = self.listed[self.lists[term] : self.lists[term + 1]]
            n_centres = -(-len(docs) // BLOCK)
            if n_centres > 1:
                centres = self.sketch[docs[np.arange(n_centres) * len(docs) // n_centres]]
                nearest = np.argmax(self.sketch[docs] @ centres.T, axis=1)
                order = np.argsort(nearest, kind="stable")
                docs, nearest = docs[order], nearest[order]
            else:
                nearest = np.zeros(len(docs), dtype=np.int64)
            new = np.append(True, nearest[1:] != nearest[:-1])
            # A crowded centre makes several blocks.
            place = np.arange(len(docs))
            place -= np.maximum.accumulate(np.where(new, place, 0))
            new |= place % (2 * BLOCK) == 0
            begins = np.flatnonzero(new)
            at, _ = self.entries(docs)
            block = np.repeat(np.cumsum(new) - 1, self.sizes[docs])
            width = np.int64(len(self.largest))
            key = block * width + self.terms[at]
            order = np.argsort(key, kind="stable")
            key, impacts = key[order], self.impacts[at][order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            summary = np.maximum.reduceat(impacts, first)
            summary_block, summary_term = key[first] // width, key[first] % width
            heads = np.searchsorted(summary_block, np.arange(len(begins)))
            self.blocks[term] = docs, np.append(begins, len(docs)), summary_term, summary, heads
        return self.blocks[term]

    def scores(self, docs: np.ndarray, asked: np.ndarray) -> np.ndarray:
        at, heads = self.entries(docs)
        return np.add.reduceat(asked[self.terms[at]] * self.impacts[at], heads)


class Best:
    """The k best documents of an item so far: more score, then the smaller id."""

    def __init__(self, k: int, reached: int) -> None:
        self.k, self.reached = k, reached
        self.scores, self.ids, self.nulls = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def least(self) -> int:
        """A document below this score is not among the k best."""
        own = int(self.scores[-1]) if len(self.scores) == self.k else 0
        return max(1, self.reached, own)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            scores, ids, nulls = (np.append(a, b[good]) for a, b in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
            order = np.lexsort((ids, nulls, -scores))[: self.k]
            self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]


def search_shard(shard: Shard, terms: np.ndarray, weights: np.ndarray, asked: np.ndarray, best: Best) -> int:
    """Add the shard's documents to the item's best; returns how many were scored. ``asked`` is zero elsewhere."""
    bounds = weights[terms] * shard.largest[terms]
    order = np.argsort(bounds, kind="stable")
    reach = np.cumsum(bounds[order])
    asked[terms] = weights[terms]
    seen = np.zeros(len(shard.ids), dtype=bool)
    n_scored = 0
    for i in range(len(order) - 1, -1, -1):
        if reach[i] < best.least():
            break  # what has only these terms or fewer cannot get in
        term = terms[order[i]]
        if shard.lists[term] == shard.lists[term + 1]:
            continue
        docs, begins, summary_term, summary, heads = shard.blocked(int(term))
        limits = np.add.reduceat(asked[summary_term] * summary, heads)
        blocks = np.argsort(-limits, kind="stable")
        done, step = 0, 4
        while done < len(blocks):
            some = blocks[done : done + step]
            some = some[limits[some] >= best.least()]
            if not len(some):
                break  # the bounds that follow are no larger
            sizes = begins[some + 1] - begins[some]
            at = np.arange(sizes.sum()) + np.repeat(begins[some] - (np.cumsum(sizes) - sizes), sizes)
            new = docs[at]
            new = new[~seen[new]]
            if len(new):
                seen[new] = True
                n_scored += len(new)
                best.add(shard.scores(new, asked), shard.ids[new], shard.nulls[new])
            done, step = done + step, 2 * step
    asked[terms] = 0
    return n_scored


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[Shard]:
    """Shards of the rows ``(doc_id, n, terms, counts)``, those without a term of the pack left out."""
    pending: list[tuple] = []
    size = 0

    def shard() -> Shard:
        ids, nulls, n, sizes, terms, counts = (np.concatenate(c) for c in zip(*pending, strict=True))
        m = np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
        impacts = 1_000_000_000 * counts // (1000 * counts + 20 * np.repeat(m, sizes))
        return Shard(weights, ids, nulls, np.append(0, np.cumsum(sizes)), terms.astype(np.int64), impacts)

    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, 1024)
            start += part.num_rows
            sizes = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = part.column(0)
            pending.append(
                (
                    ids.fill_null(0).to_numpy(),
                    np.asarray(ids.is_null().to_numpy(zero_copy_only=False), dtype=bool),
                    part.column(1).to_numpy(),
                    sizes,
                    part.column(2).flatten().to_numpy(),
                    part.column(3).flatten().to_numpy(),
                )
            )
            size += int(sizes.sum())
            if size >= SHARD_POSTINGS or sum(len(p[0]) for p in pending) >= SHARD_DOCS:
                yield shard()
                pending, size = [], 0
    if pending:
        yield shard()


_FOUND = pa.schema([("item_no", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _searched(rows: DataFrame, pack: Pack, weights: np.ndarray, n_docs: int, n_terms: int, reached: dict[int, int], k: int) -> DataFrame:
    """Stored ``(item_no, doc_id, score)``: of every task the k best of each item of the pack."""
    shared = rows.sparkSession.sparkContext.broadcast((pack.items, weights, reached))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, reached = shared.value
        best = [Best(k, reached.get(no, 0)) for no, _ in items]
        asked = np.zeros(len(weights), dtype=np.int64)
        for shard in _shards(batches, weights, n_docs, n_terms):
            for (_, terms), found in zip(items, best, strict=True):
                search_shard(shard, terms, weights, asked, found)
        for (no, _), found in zip(items, best, strict=True):
            if len(found.ids):
                ids = pa.array(found.ids, mask=found.nulls)
                numbers = pa.array(np.full(len(found.ids), no, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([numbers, ids, pa.array(found.scores)], schema=_FOUND)

    found = rows.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item_no bigint, doc_id bigint, score bigint")
    stored = materialize(found, "found")
    shared.destroy()
    return stored


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(
    df: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k highest-scoring documents of every row of ``items``."""
    asked = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    asked = materialize(asked.withColumn("item_no", F.monotonically_increasing_id()), "items")
    results = []
    for pack in _packs(asked.select("item_no", "text")):
        rows = _counted(df, pack, id_col, text_col)
        n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        held = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
        weights = np.zeros(len(pack.vocabulary), dtype=np.int64)
        for term, n in held.collect():  # a row for each term of the pack at most
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
        sample = rows.where(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0)
        first = _ranked(_searched(sample, pack, weights, n_docs, n_terms, {}, k), k).where(F.col("rank") == k)
        reached = {r.item_no: r.score for r in first.collect()}  # a row for each item of the pack at most
        results.append(_searched(rows, pack, weights, n_docs, n_terms, reached, k))
    spark = df.sparkSession
    found = spark.createDataFrame([], "item_no bigint, doc_id bigint, score bigint") if not results else results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    best = _ranked(found, k).join(asked.select("item_no", "item_id"), "item_no")
    return best.select(F.col("item_id").alias(item_id_col), "rank", F.col("doc_id").alias(id_col), "score")
