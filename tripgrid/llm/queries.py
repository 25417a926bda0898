"""The operators applied to the given tables, as the driver calls them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table
from .ann import nearest_neighbours
from .bpe import encode_documents
from .chat import digests, format_conversations
from .exact_dedup import exact_duplicates
from .jaccard import jaccard_components
from .lexical import ranked_search
from .licences import sample_paragraphs, scan_licences, train
from .mixing import mixed_sizes
from .packing import document_pieces, pack_pieces
from .phrases import collocations
from .quality import fit, grades
from .urlfilter import host_of, judge_captures
from .warc import read_archives, write_archives

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes they decode to."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    ids = encode_documents(table(spark, sf_dir, "documents"), path, pattern, decode=True)
    return ids.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; the row with the largest doc_id stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts are control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(rows.unionByName(extra)))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records into archives and read back."""
    manifest = write_archives(table(spark, sf_dir, "pages"))
    return read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents to the sources' target weights takes of each."""
    return mixed_sizes(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 5-word shingles, similarity 0.8."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors, by cosine, of every vector whose vec_id is divisible by 50."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


# Grades of the labels: 0 poor, 1 good but toxic, 2 good.
N_GRADES = 3


def rated() -> Column:
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)


def op4_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of all documents, and whether they are kept."""
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"), rated(), N_GRADES)
    return grades(documents, model).withColumn("kept", F.col("p_at_least_1") >= 0.5)


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Pages as captures: a fetch time within two years follows from the page id."""
    seconds = F.pmod(F.col("page_id") * 7919, F.lit(730 * 86400))
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + seconds).alias("fetched_at"))


def list_changes(pages: DataFrame) -> DataFrame:
    """Dated list changes derived from the hosts, parent domains and URLs of the pages."""

    def number(c: str) -> Column:
        return F.conv(F.substring(F.md5(F.col(c).cast("binary")), 1, 4), 16, 10).cast("bigint")

    def change(rows: DataFrame, name: str, allows: bool, kind: str, day: Column, listed: bool) -> DataFrame:
        at = F.timestamp_seconds(F.lit(1704067200) + day * 86400)
        return rows.select(
            F.lit(name).alias("list"), F.lit(allows).alias("allows"), F.lit(kind).alias("kind"), "key", at.alias("changed_at"), F.lit(listed).alias("listed")
        )

    x = F.col("x")
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    spam = hosts.select(F.col("host").alias("key"), number("host").alias("x")).where("x % 5 < 2")
    parents = hosts.select(F.substring_index("host", ".", -2).alias("key")).distinct().select("key", number("key").alias("x"))
    first = F.regexp_extract("url", r"^[^:]*://[^/?#]*/([^/?#]+)", 1)
    partners = pages.select(F.concat(host_of(F.col("url")), F.lit("/"), first).alias("key"), first.alias("first")).where("first <> ''")
    partners = partners.select("key").distinct().select("key", number("key").alias("x")).where("x % 7 = 0")
    whole = pages.select(F.concat(host_of(F.col("url")), F.regexp_extract("url", r"^[^:]*://[^/?#]*([^#]*)", 1)).alias("key"))
    whole = whole.where("key <> ''").distinct().select("key", number("key").alias("x")).where("x % 50 = 0")
    parts = [
        change(spam, "spam", False, "domain", x % 700, True),
        change(spam, "spam", False, "domain", x % 700 + 30 + x % 97, False),
        change(spam.where("x % 3 = 0"), "spam", False, "domain", x % 700 + 200, True),
        change(parents, "malware", False, "domain", x % 500, True),
        change(parents, "malware", False, "domain", x % 500 + 60, False),
        change(partners, "partners", True, "prefix", x % 300, True),
        change(whole, "malware", False, "url", x % 400, True),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries that were active when it was fetched."""
    pages = table(spark, sf_dir, "pages")
    return judge_captures(fetched_pages(pages), list_changes(pages))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents: paragraphs, notices found and confirmed, families."""
    documents = table(spark, sf_dir, "documents")
    found = scan_licences(documents, train(sample_paragraphs(documents)))
    return found.withColumn("families", F.array_join("families", ", "))


TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def tokenizer_json() -> str:
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return file.read()


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 1024 tokens."""
    pieces = document_pieces(table(spark, sf_dir, "documents"), tokenizer_json(), public_tokenizers.PATTERN, END_ID, with_ids=False)
    return pack_pieces(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to four words of each language, over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
