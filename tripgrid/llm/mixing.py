"""Mixing sources to target weights, with DataFrame expressions only (operator 2).

Every source's words, in a pseudorandom order of its documents, form one
stream that is packed into blocks of ``block_words``. Targets come from water
filling: sources share the total by weight, none above ``max_repeats`` times
its size. A target of E whole passes and R words over is met by E passes over
all blocks and the first blocks of one more pass, the last of them cut, so
the words taken equal the target rounded to a whole number. Output slots are
dealt to shards: each shard draws multinomial source counts in proportion to
the sources' slots; the n-th draw of a source, over all shards, is its slot n.
Sources drawn too often hand their surplus slots to those drawn too rarely,
in order. Slot n of a source is block ``permutation(n mod blocks)`` of pass
``n div blocks``: a swap-or-not shuffle keyed by source and pass, which is an
exact permutation of any number of blocks. Blocks and slots meet in a join on
(source, block). All draws are hashes, so reruns agree.

Prefix sums run in two levels (1,024 hash buckets of documents, groups of
1,024 shards), so a source with a third of all rows is never one window. The
source table has one row per source and is the only thing handled in one task.

Defined results: a null text has size 0, and documents of size 0 take part
with nothing taken; a null source is a source of its own, the last one; rows
with the same id are different documents; an empty table gives an empty
result; other columns are not read by ``mix_pieces`` and are passed through by
``mix_documents``. No document is taken more than ``max_repeats`` times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize, parallelism

BLOCK_WORDS = 256
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20130319

# Levels of the prefix sums, cells of the draw's guide table, rounds of the shuffle.
ORDER_BUCKETS = 1024
SHARD_GROUP = 1024
GUIDE_CELLS = 4096
ROUNDS = 40
# Slots that a task permutes, about.
TASK_SLOTS = 1 << 18

WORD = r"[^\x20\x09-\x0D]+"
WORD_AND_SPACE = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _shuffled(x: Column, n: Column, key: Sequence[Column], inverse: bool = False) -> Column:
    """Swap-or-not shuffle of ``0 .. n-1``: every round swaps some pairs ``(i, k - i mod n)``."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(i: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(*key, r), n) - i, n)
        coin = F.xxhash64(*key, r, F.greatest(i, partner)).bitwiseAND(1)
        return F.when(coin == 1, partner).otherwise(i)

    return F.aggregate(rounds, x, step)


def source_targets(
    rows: DataFrame, block_words: int, weights: Sequence[float], max_repeats: int, seed: int
) -> DataFrame:
    """One row per source: its size, target, blocks, passes and slots."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("sid", F.row_number().over(by_name).cast("bigint") - 1)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")
    )
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        numbered.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("left_words", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("share", F.col("left_words") / F.col("left_weight"))
        .withColumn("capped", F.col("share") * F.col("weight") >= F.col("cap"))
        .withColumn("level", F.max(F.when(~F.col("capped"), F.struct(-F.row_number().over(by_ratio), "share"))).over(everything))
    )
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level.share"))
    quota = F.least(F.floor(F.col("target") + 0.5), F.col("cap"))
    size, blocks = F.col("source_size"), F.col("n_blocks")
    planned = (
        filled.withColumn("target", target)
        .withColumn("n_blocks", F.ceil(size / block_words))
        .withColumn("passes", F.when(size > 0, F.floor(quota / size)).otherwise(0))
        .withColumn("rest", quota - F.col("passes") * size)
        .withColumn("short", F.lit(block_words) - (size - (blocks - 1) * block_words))
        # Where the last, shorter block stands in the pass that is cut.
        .withColumn(
            "short_at",
            F.when(blocks > 0, _shuffled(blocks - 1, blocks, _key(seed, F.col("sid"), F.col("passes")), inverse=True)),
        )
        .withColumn("full", F.ceil(F.col("rest") / block_words))
        .withColumn(
            "last_slots",
            F.col("full")
            + F.when(
                (F.col("short_at") < F.col("full")) & (F.col("full") * block_words - F.col("short") < F.col("rest")), 1
            ).otherwise(0),
        )
        .withColumn("n_slots", F.col("passes") * blocks + F.col("last_slots"))
    )
    through = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    return planned.withColumn("slots_end", F.sum("n_slots").over(through)).select(
        "sid", "source", "source_size", "target", "n_blocks", "passes", "rest", "short", "short_at", "n_slots", "slots_end"
    )


def _key(seed: int, *columns: Column) -> list[Column]:
    return [F.lit(seed), *columns]


def _in_cells(intervals: DataFrame, total: int) -> tuple[DataFrame, int]:
    """``intervals`` (lo, hi) once for each guide cell that they touch, and the cells' width."""
    width = max(1, -(-total // GUIDE_CELLS))
    cells = F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))
    return intervals.where("hi > lo").withColumn("cell", F.explode(cells)), width


def drawn_slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """``(sid, slot, shard)``: every slot of every source once, dealt to shards."""
    spark = sources.sparkSession
    total = sources.agg(F.max("slots_end")).head()[0] or 0
    spans = sources.select("sid", (F.col("slots_end") - F.col("n_slots")).alias("lo"), F.col("slots_end").alias("hi"))
    guide, width = _in_cells(spans, total)
    draws = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(max(1, total))).alias("x"),
    )
    hits = draws.withColumn("cell", F.floor(F.col("x") / width)).join(guide, "cell").where("x >= lo and x < hi")
    counts = materialize(hits.groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("n")), "shard-counts")

    grouped = counts.withColumn("shard_group", F.floor(F.col("shard") / SHARD_GROUP))
    totals = grouped.groupBy("sid", "shard_group").agg(F.sum("n").alias("group_n"))
    earlier = Window.partitionBy("sid").orderBy("shard_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "shard_group", F.coalesce(F.sum("group_n").over(earlier), F.lit(0)).alias("group_start"))
    within = Window.partitionBy("sid", "shard_group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("group_start") + F.coalesce(F.sum("n").over(within), F.lit(0))
    placed = grouped.join(totals, ["sid", "shard_group"]).withColumn("start", start)
    # A count is a small row that becomes many slots: deal by slots, not by bytes.
    placed = placed.repartition(max(parallelism(spark), total // TASK_SLOTS + 1), "sid", "shard")
    numbered = placed.select("shard", "sid", F.explode(F.expr("sequence(start, start + n - 1)")).alias("slot"))

    # Surplus draws of one source become the missing draws of another, both in order.
    drawn = sources.join(counts.groupBy("sid").agg(F.sum("n").alias("drawn")), "sid", "left").fillna(0, ["drawn"])
    through = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    over, under = F.greatest(F.col("drawn") - F.col("n_slots"), F.lit(0)), F.greatest(F.col("n_slots") - F.col("drawn"), F.lit(0))
    drawn = drawn.select(
        "sid",
        "n_slots",
        "drawn",
        F.coalesce(F.sum(over).over(through), F.lit(0)).alias("over_start"),
        F.coalesce(F.sum(under).over(through), F.lit(0)).alias("lo"),
        under.alias("under"),
    )
    missing, width = _in_cells(
        drawn.select(F.col("sid").alias("to_sid"), F.col("drawn").alias("to_start"), "lo", (F.col("lo") + F.col("under")).alias("hi")),
        total,
    )
    known = numbered.join(drawn.select("sid", "n_slots", "over_start"), "sid")
    kept = known.where("slot < n_slots").select("sid", "slot", "shard")
    surplus = known.where("slot >= n_slots").select("shard", (F.col("over_start") + F.col("slot") - F.col("n_slots")).alias("x"))
    moved = surplus.withColumn("cell", F.floor(F.col("x") / width)).join(missing, "cell").where("x >= lo and x < hi")
    return kept.unionByName(moved.select(F.col("to_sid").alias("sid"), (F.col("to_start") + F.col("x") - F.col("lo")).alias("slot"), "shard"))


def mix_pieces(
    rows: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``rows`` (row_no, id, source, size): pieces and sources.

    Pieces are ``(row_no, shard, sid, slot, pass_no, first, n_words)``: the
    document's words ``first .. first + n_words - 1`` stand in that slot of
    the shard. ``row_no`` must tell the rows apart and ``rows`` be stored.
    """
    sources = materialize(source_targets(rows, block_words, weights, max_repeats, seed), "sources")
    slots = drawn_slots(sources, shard_slots, seed).join(sources, "sid")
    passed = F.floor(F.col("slot") / F.col("n_blocks"))
    slots = slots.withColumn("pass_no", passed).withColumn("nth", F.col("slot") - F.col("pass_no") * F.col("n_blocks"))
    block = _shuffled(F.col("nth"), F.col("n_blocks"), _key(seed, F.col("sid"), F.col("pass_no")))
    taken_before = F.col("nth") * block_words - F.when(F.col("short_at") < F.col("nth"), F.col("short")).otherwise(0)
    length = F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words)
    slots = slots.withColumn("block", block).select(
        "sid", "block", "shard", "slot", "pass_no",
        F.when(F.col("pass_no") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - taken_before)).alias("words"),
    )

    # Where each document begins in its source's stream.
    placed = rows.join(sources.select("sid", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
    placed = placed.select("row_no", "id", "sid", "size", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(ORDER_BUCKETS)).alias("bucket"))
    totals = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"))
    within = Window.partitionBy("sid", "bucket").orderBy("id", "row_no").rowsBetween(Window.unboundedPreceding, -1)
    lo = F.col("bucket_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    placed = placed.join(totals, ["sid", "bucket"]).withColumn("lo", lo).where("size > 0").withColumn("hi", F.expr("lo + size"))
    blocks = F.sequence(F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words))
    parts = placed.select("row_no", "sid", "lo", "hi", F.explode(blocks).alias("block"))

    begin = F.greatest(F.col("lo"), F.col("block") * block_words)
    end = F.least(F.col("hi"), F.col("block") * block_words + F.col("words"))
    pieces = parts.join(slots, ["sid", "block"]).select(
        "row_no", "shard", "sid", "slot", "pass_no", (begin - F.col("lo")).alias("first"), (end - begin).alias("n_words")
    )
    return pieces.where("n_words > 0"), sources


def sized_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(row_no, id, source, size)`` of every document, stored."""
    rows = df.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    return materialize(rows, "sized")


def mixed_sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``(id, size, source_size, target, taken)`` for every document."""
    rows = sized_rows(df, id_col, text_col, source_col)
    pieces, sources = mix_pieces(rows, **options)
    taken = pieces.groupBy("row_no").agg(F.sum("n_words").alias("taken"))
    named = sources.select(F.col("source").alias("name"), "source_size", "target")
    return (
        rows.join(named, F.col("source").eqNullSafe(F.col("name")))
        .join(taken, "row_no", "left")
        .select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))
    )


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus with the columns of ``df``: a row per document and pass that takes any of it.

    A document that a pass takes whole keeps its text; of the others the row
    has the words taken, with the space after each. ``n_chars`` is renewed
    where ``df`` has it as an integer.
    """
    stored = materialize(df.select(F.monotonically_increasing_id().alias("row_no"), F.struct("*").alias("row")), "to-mix")
    rows = stored.select(
        "row_no",
        F.col("row")[id_col].alias("id"),
        F.col("row")[source_col].cast("string").alias("source"),
        word_count(F.col("row")[text_col]).alias("size"),
    )
    pieces, _ = mix_pieces(materialize(rows, "sized"), **options)
    passes = pieces.groupBy("row_no", "pass_no").agg(
        F.sum("n_words").alias("taken"), F.array_sort(F.collect_list(F.struct("first", "n_words"))).alias("pieces")
    )
    words = F.regexp_extract_all(F.col("row")[text_col], F.lit(WORD_AND_SPACE), F.lit(0))
    cut = F.array_join(
        F.flatten(F.transform("pieces", lambda p: F.slice("words", (p["first"] + 1).cast("int"), p["n_words"].cast("int")))), ""
    )
    joined = stored.join(passes, "row_no").withColumn("whole", F.col("taken") == word_count(F.col("row")[text_col]))
    # Words are cut out only where a pass takes part of the document.
    joined = joined.withColumn("words", F.when(~F.col("whole"), words)).withColumn(
        "new_text", F.when(F.col("whole"), F.col("row")[text_col]).otherwise(cut)
    )
    renewed = {text_col: F.col("new_text")}
    if dict(df.dtypes).get("n_chars") in ("bigint", "int"):
        renewed["n_chars"] = F.length("new_text").cast(dict(df.dtypes)["n_chars"])
    return joined.select(*[renewed.get(c, F.col("row")[c]).alias(c) for c in df.columns])
