"""URL filters by a temporal list join (operator 3).

Lists arrive as dated changes: at ``changed_at`` a list began or ceased to
hold a pattern. Changes become validity intervals ``[from, until)``. Every
capture has the keys that could match it (each domain suffix of its host, each
path prefix, the whole URL); an as-of join finds the entries that were active
at its fetch time. Intervals are cut at the borders of time slots and the join
is an equi-join on (kind, key, slot), so the captures of a host that holds a
third of all rows are spread over the slots, and a list entry meets only
captures of the slots in which it was active.

The most specific matching entry decides (URL over prefix over domain, then
the longer pattern); at equal specificity an allowing list wins.

Defined results: a null or unparsable URL, or a null fetch time, matches
nothing; of several changes of one pattern at one time a listing wins; changes
with null fields are ignored; repeated captures are judged each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize

SLOT_DAYS = 30
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"
REST = r"^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)"


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), HOST, 1)


def _spelled(url: Column, pattern: str) -> Column:
    """A part of the URL in its own spelling; scheme and host do not matter to it."""
    return F.regexp_extract(url, "(?i)" + pattern, 1)


def capture_keys(url: Column) -> Column:
    """``(kind, key)`` structs of everything that could match a URL."""
    host, path = host_of(url), _spelled(url, PATH)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("key")),
    )
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.transform(
        F.when(F.size(segments) > 0, F.sequence(F.lit(1), F.size(segments))).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")).alias("key")
        ),
    )
    whole = F.array(F.struct(F.lit("url").alias("kind"), F.concat(host, _spelled(url, REST)).alias("key")))
    return F.when(host != "", F.concat(suffixes, prefixes, whole))


def validity_intervals(changes: DataFrame) -> DataFrame:
    """``(list, allows, kind, key, valid_from, valid_until)`` from dated changes.

    ``changes`` has list, allows, kind, key, changed_at and listed; an open
    interval has a null end.
    """
    columns = ["list", "allows", "kind", "key"]
    known = changes.select(*columns, "changed_at", "listed").dropna()
    states = known.groupBy(*columns, "changed_at").agg(F.max("listed").alias("listed"))
    following = F.lead("changed_at").over(Window.partitionBy(*columns).orderBy("changed_at"))
    dated = states.select(*columns, "listed", F.col("changed_at").alias("valid_from"), following.alias("valid_until"))
    return dated.where("listed").drop("listed")


def judge_captures(
    captures: DataFrame, changes: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at"
) -> DataFrame:
    """``(id, fetched_at, blocked, n_matches, decided_by)`` of every capture."""
    rows = captures.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(time_col).cast("timestamp").alias("at"),
    )
    rows = materialize(rows, "captures")

    def slot(at: Column) -> Column:
        return F.floor(F.unix_timestamp(at) / (SLOT_DAYS * 86400))

    keys = rows.where("at is not null").select("row_no", "at", slot(F.col("at")).alias("slot"), F.explode(capture_keys(F.col("url"))).alias("k"))
    keys = keys.select("row_no", "at", "slot", F.col("k.kind").alias("kind"), F.col("k.key").alias("key"))
    # Open intervals reach as far as captures do.
    last = rows.agg(F.max(F.unix_micros("at"))).head()[0]
    last_at = F.timestamp_micros(F.lit(last).cast("bigint"))
    entries = validity_intervals(changes).where(F.col("valid_from") <= last_at)
    until = F.least(F.coalesce(F.col("valid_until"), last_at), last_at)
    entries = entries.withColumn("slot", F.explode(F.sequence(slot(F.col("valid_from")), slot(until))))
    entries = entries.select("list", "allows", F.col("kind").alias("e_kind"), F.col("key").alias("e_key"), "valid_from", "valid_until", F.col("slot").alias("e_slot"))
    active = (F.col("valid_from") <= F.col("at")) & (F.col("valid_until").isNull() | (F.col("at") < F.col("valid_until")))
    same = (F.col("kind") == F.col("e_kind")) & (F.col("key") == F.col("e_key")) & (F.col("slot") == F.col("e_slot"))
    level = F.when(F.col("kind") == "url", 2).when(F.col("kind") == "prefix", 1).otherwise(0)
    entry = F.struct(level.alias("level"), F.length("key").alias("chars"), "allows", "list", "kind", "key")
    matches = keys.join(entries, same & active).select("row_no", entry.alias("entry"))
    decided = matches.groupBy("row_no").agg(F.count(F.lit(1)).alias("n_matches"), F.max("entry").alias("entry"))
    return rows.join(decided, "row_no", "left").select(
        F.col("id").alias(id_col),
        F.col("at").alias("fetched_at"),
        F.coalesce(~F.col("entry.allows"), F.lit(False)).alias("blocked"),
        F.coalesce("n_matches", F.lit(0).cast("bigint")).alias("n_matches"),
        F.concat_ws(" ", "entry.list", "entry.kind", "entry.key").alias("decided_by"),
    )
