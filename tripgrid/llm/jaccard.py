"""N-gram Jaccard join with signature trees (operator 10).

Documents link when the Jaccard similarity of their sets of word 5-grams is at
least 80 %. The join is exact:

1. Documents with equal sets form one class; each class goes on once.
2. Tokens get one global order, rarely seen ones first (by a count sketch of
   fixed size; any order is right, this one is cheap). Two linked classes share
   a token among their first ``n - ceil(0.8 n) + 1``. Classes that share such a
   token form a bucket, sorted by size and cut where a gap in the sizes rules
   out links across; equal buckets are kept once. Buckets of more than
   ``UNIT`` classes are cut into blocks, and pairs of blocks whose sizes fit are
   units of their own, so no task holds more than two blocks.
3. In every unit a signature tree (see ``sigtree``) prunes node pairs by their
   greatest possible overlap. What is left links candidates; each connected
   cluster of candidates, cut into blocks in the same way, gets the full token
   sets once and is searched by the same trees, the remaining pairs of not yet
   connected classes being verified on the sets.
4. Components of the verified links carry over to all documents.

Defined results: a null text, or one without words, has no shingles, links
with nothing and is its own component; fewer than five words are one shingle;
rows with the same id are different documents, whose component is the least
id reachable (null ids are passed over unless all are null); an empty table
gives an empty result; other columns are not read by ``jaccard_components``
and are passed through by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bloom
from ._common import bounded_batches, materialize, parallelism
from .components import connected_components
from .shingles import WORDS, shingle_sets
from .sigtree import LEAF, Forest, Signatures, bitmap

PERCENT = 80
UNIT = 2048
SKETCH_CELLS = 1 << 18
# Rows worked off at once when sorted partitions are streamed.
SLAB_ROWS = 8_000


def _key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(46)).astype(np.int64)


def _texts(df: DataFrame, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


# --- 1: sizes and classes -------------------------------------------------


def _sized(df: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``(id, n, key)`` of every row, and ``(cell, seen)`` of often seen sketch cells."""
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SKETCH_CELLS, dtype=np.int64)
        id_type = None
        for batch in batches:
            sizes, keys = [], []
            for tokens in shingle_sets(batch.column(1), words):
                sizes.append(len(tokens))
                keys.append(_key(tokens) if len(tokens) else None)
                np.add.at(seen, _cells(tokens), 1)
            id_type = batch.schema.field(0).type
            yield _sized_batch(batch.column(0), sizes, keys, [None] * len(sizes), [None] * len(sizes))
        mean = seen.mean()
        often = np.flatnonzero(seen > mean + 6 * np.sqrt(mean) + 8)
        if len(often):
            none = [None] * len(often)
            yield _sized_batch(pa.nulls(len(often), id_type), none, none, often.tolist(), seen[often].tolist())

    def _sized_batch(ids, sizes, keys, cells, counts) -> pa.RecordBatch:
        arrays = [ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(cells, pa.int64()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "n", "key", "cell", "seen"])

    id_sql = source.schema["id"].dataType.simpleString()
    stored = materialize(source.mapInArrow(run, f"id {id_sql}, n bigint, key binary, cell bigint, seen bigint"), "sized")
    sketch = stored.where("cell is not null").groupBy("cell").agg(F.sum("seen").alias("seen"))
    return stored.where("cell is null").select("id", "n", "key"), sketch


def _heat(sketch: DataFrame) -> np.ndarray:
    """Order level of every sketch cell; at most SKETCH_CELLS rows reach the driver."""
    heat = np.zeros(SKETCH_CELLS, dtype=np.uint8)
    for cell, seen in sketch.toLocalIterator():
        heat[cell] = int(seen).bit_length()
    return heat


# --- 2: buckets -------------------------------------------------------------


def _classes(df: DataFrame, text_col: str, words: int, percent: int, heat: np.ndarray) -> DataFrame:
    """Stored ``(rid, key, n, prefix, bits)``, one row per different set."""
    shared = df.sparkSession.sparkContext.broadcast(heat)
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for tokens in shingle_sets(batch.column(0), words):
                    n = len(tokens)
                    if n:
                        order = np.argsort(shared.value[_cells(tokens)], kind="stable")  # ties: by hash
                        prefix = tokens[order[: n + percent * -n // 100 + 1]]
                        bits = bitmap(tokens).tobytes()
                        yield 8 * len(prefix) + len(bits), (_key(tokens), n, prefix.view(np.int64), bits)

        return bounded_batches(rows(), schema)

    each = _texts(df, text_col).mapInArrow(run, "key binary, n bigint, prefix array<bigint>, bits binary")
    classes = each.groupBy("key").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    return materialize(classes.withColumn("rid", F.monotonically_increasing_id()), "classes")


def _runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list]:
    """Slabs of a sorted partition that end where the first column changes."""
    rest: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        rows += batch.num_rows
        if rows < SLAB_ROWS:
            continue
        joined = pa.Table.from_batches(rest).combine_chunks()
        first = joined.column(0).to_numpy()
        border = int(np.searchsorted(first, first[-1], side="left"))
        if border:
            yield [joined.column(k).slice(0, border) for k in range(columns)]
        rest = joined.slice(border).to_batches()
        rows = sum(b.num_rows for b in rest)
    if rest:
        joined = pa.Table.from_batches(rest).combine_chunks()
        yield [joined.column(k) for k in range(columns)]


def _buckets(classes: DataFrame, percent: int) -> DataFrame:
    """Stored ``(gid, block, low, high, members)``: different buckets, cut into blocks."""
    tokens = classes.select(F.explode("prefix").alias("token"), "n", "rid")
    dealt = tokens.repartition(parallelism(classes.sparkSession), "token").sortWithinPartitions("token", "n", "rid")
    schema = pa.schema(
        [("gid", pa.binary()), ("block", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("members", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for columns in _runs(batches, 3):
                token, n, rid = (c.to_numpy() for c in columns)
                # a gap in the sizes: nothing before it links with anything after it
                opens = np.append(True, (token[1:] != token[:-1]) | (100 * n[:-1] < percent * n[1:]))
                starts = np.flatnonzero(opens)
                lengths = np.diff(np.append(starts, len(token)))
                for a, size in zip(starts[lengths > 1].tolist(), lengths[lengths > 1].tolist(), strict=True):
                    gid = xxhash.xxh3_128_digest(rid[a : a + size].tobytes())
                    for block, s in enumerate(range(a, a + size, UNIT)):
                        e = min(s + UNIT, a + size)
                        yield 8 * (e - s) + 40, (gid, block, int(n[s]), int(n[e - 1]), rid[s:e])

        return bounded_batches(rows(), schema)

    each = dealt.mapInArrow(run, "gid binary, block bigint, low bigint, high bigint, members array<bigint>")
    return materialize(each.dropDuplicates(["gid", "block"]), "buckets")


def _units(blocks: DataFrame, percent: int) -> DataFrame:
    """``(unit, rid)``: every block, and every pair of a group's blocks whose sizes fit."""
    left = blocks.select("gid", F.col("block").alias("i"), F.col("high").alias("high_i"), F.col("members").alias("members_i"))
    right = blocks.select("gid", F.col("block").alias("j"), F.col("low").alias("low_j"), F.col("members").alias("members_j"))
    several = blocks.where("block > 0").select("gid").distinct()
    pairs = (
        left.join(several, "gid")
        .join(right, "gid")
        .where((F.col("i") < F.col("j")) & (100 * F.col("high_i") >= percent * F.col("low_j")))
    )
    unit = F.xxhash64("gid", "i", "j")
    single = blocks.select(F.xxhash64("gid", "block").alias("unit"), F.explode("members").alias("rid"))
    return single.unionByName(pairs.select(unit.alias("unit"), F.explode(F.concat("members_i", "members_j")).alias("rid")))


# --- 3: candidates and verified links ------------------------------------------

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _candidates(units: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: links that connect what a unit's possible pairs connect."""
    rows = units.join(classes.select("rid", "n", "bits"), "rid").select("unit", "rid", "n", "bits")
    dealt = rows.repartition(parallelism(units.sparkSession), "unit").sortWithinPartitions("unit", "n", "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _runs(batches, 4):
            unit, rid, n = (c.to_numpy() for c in columns[:3])
            bits = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for chunk in columns[3].chunks for x in chunk]
            signatures = Signatures(n, bits, percent)
            yield _stars(unit, rid, signatures)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _join(forest: Forest, x: np.ndarray, y: np.ndarray, verify) -> None:
    """Connect the pairs that are still apart, each of them verified if asked for."""
    for start in range(0, len(x), 4096):
        a, b = x[start : start + 4096], y[start : start + 4096]
        apart = forest.apart(a, b)
        for p, q in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            if forest.label[p] != forest.label[q] and (verify is None or verify(p, q)):
                forest.join(p, q)


def _stars(unit: np.ndarray, rid: np.ndarray, signatures: Signatures, verify=None) -> pa.RecordBatch:
    """Edges from every row to the first of its component, for all units of a slab."""
    small = Forest(len(unit))
    _join(small, *signatures.small_pairs(unit), verify)
    starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else np.empty(0, dtype=np.int64)
    labels = small.label
    for s, e in zip(starts.tolist(), np.append(starts[1:], len(unit)).tolist(), strict=True):
        if e - s > LEAF:
            forest = Forest(e - s)
            of_rows = None if verify is None else (lambda p, q, s=s: verify(s + p, s + q))
            for x, y in signatures.tree_pairs(np.arange(s, e)):
                _join(forest, x - s, y - s, of_rows)
            labels[s:e] = s + forest.label
    moved = np.flatnonzero(labels != np.arange(len(unit)))
    return pa.RecordBatch.from_arrays([pa.array(rid[moved]), pa.array(rid[labels[moved]])], schema=_EDGES)


def _cluster_blocks(clusters: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``(unit, rid)`` of the candidate clusters, cut into blocks by size."""
    sized = clusters.join(classes.select("rid", "n"), "rid")
    nth = F.row_number().over(Window.partitionBy("cluster").orderBy("n", "rid")) - 1
    placed = materialize(sized.withColumn("block", F.floor(nth / UNIT)), "clusters")
    ranges = placed.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    one = ranges.select("cluster", F.col("block").alias("i"), F.col("high").alias("high_i"))
    two = ranges.select("cluster", F.col("block").alias("j"), F.col("low").alias("low_j"))
    # A block meets itself and the later blocks that fit; one block alone has one unit.
    fits = (F.col("i") <= F.col("j")) & (100 * F.col("high_i") >= percent * F.col("low_j"))
    pairs = one.join(two, "cluster").where(fits).select("cluster", "i", "j", F.xxhash64("cluster", "i", "j").alias("unit"))
    roles = pairs.select("cluster", "unit", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    return placed.join(roles, ["cluster", "block"]).select("unit", "rid", "n")


def _verified(df: DataFrame, text_col: str, words: int, members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: links that connect what a unit's links, verified on the token sets, connect."""
    keyed = members.join(classes.select("rid", "key"), "rid")
    halves = [F.conv(F.substring(F.hex("key"), k, 15), 16, 10).cast("bigint") for k in (1, 17)]
    filtered = df.sparkSession.sparkContext.broadcast(bloom.build(keyed, *halves))
    schema = pa.schema([("key", pa.binary()), ("tokens", pa.binary())])

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for tokens in shingle_sets(batch.column(0), words):
                    if len(tokens):
                        key = _key(tokens)
                        h = [np.array([int.from_bytes(key[k : k + 8], "big") >> 4]) for k in (0, 8)]
                        if bloom.may_contain(filtered.value, *h)[0]:
                            yield tokens.nbytes + 16, (key, tokens.tobytes())

        return bounded_batches(rows(), schema)

    sets = _texts(df, text_col).mapInArrow(needed, "key binary, tokens binary")
    sets = sets.groupBy("key").agg(F.first("tokens").alias("tokens"))
    rows = keyed.join(sets, "key").select("unit", "rid", "n", "tokens")
    dealt = rows.repartition(parallelism(df.sparkSession), "unit").sortWithinPartitions("unit", "n", "rid")

    def verify_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _runs(batches, 4):
            unit, rid, n = (c.to_numpy() for c in columns[:3])
            tokens = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for chunk in columns[3].chunks for x in chunk]

            def similar(p: int, q: int) -> bool:
                shared = len(np.intersect1d(tokens[p], tokens[q], assume_unique=True))
                return 100 * shared >= percent * (len(tokens[p]) + len(tokens[q]) - shared)

            signatures = Signatures(n, [bitmap(t) for t in tokens], percent)
            yield _stars(unit, rid, signatures, similar)

    return dealt.mapInArrow(verify_units, "a bigint, b bigint")


# --- 4: results -----------------------------------------------------------------


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``df``."""
    sized, sketch = _sized(df, id_col, text_col, words)
    classes = _classes(df, text_col, words, percent, _heat(sketch))
    units = _units(_buckets(classes, percent), percent)
    clusters = connected_components(_candidates(units, classes, percent))
    members = _cluster_blocks(clusters.select(F.col("node").alias("rid"), F.col("component").alias("cluster")), classes, percent)
    linked = connected_components(_verified(df, text_col, words, members, classes, percent))

    least = sized.where("n > 0").groupBy("key").agg(F.min("id").alias("least"))
    in_links = linked.join(classes.select(F.col("rid").alias("node"), "key"), "node").join(least, "key")
    roots = in_links.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = (
        least.join(in_links.select("key", "component"), "key", "left")
        .join(roots, "component", "left")
        .select(F.col("key").alias("of_key"), F.coalesce("component_id", "least").alias("component_id"))
    )
    return sized.join(by_key, F.col("key") == F.col("of_key"), "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``df`` (all columns) that stay: one of each component, that of its least id.

    Null ids come last, and of rows with the same id the one stored first
    stays. Rows are told apart by their number, so null and repeated ids
    are no reason to drop or keep another row.
    """
    number = "row_no"
    while number.lower() in (c.lower() for c in df.columns):
        number += "_"
    rows = materialize(df.withColumn(number, F.monotonically_increasing_id()), "numbered")
    who = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(number).alias("row_no"))
    found = jaccard_components(rows.select(who.alias("who"), F.col(text_col).alias("text")), "who", "text", words, percent)
    dropped = found.where("component_id.row_no != who.row_no").select(F.col("who.row_no").alias(number))
    return rows.join(dropped, number, "left_anti").drop(number)
