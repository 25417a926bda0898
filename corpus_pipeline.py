"""A training corpus from the documents, in five stages.

Poor documents go, exact copies go, one document of each group of near
duplicates stays, the sources are mixed to their target weights, and what is
left is encoded. Every stage works on all that the one before it kept. Stages
take and return the columns of ``documents``, the last one returns token ids.
Workers get the texts in batches of bounded bytes, however long a task's texts are.

Nulls in any column, empty and very long texts, repeated rows and empty tables
are handled as each operator's docstring defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgrid.llm._common import bound_sent_batches, materialize, table
from tripgrid.llm.bpe import encode_documents
from tripgrid.llm.exact_dedup import drop_exact_duplicates
from tripgrid.llm.jaccard import drop_near_duplicates
from tripgrid.llm.mixing import mix_documents
from tripgrid.llm.quality import fit, select_documents
from tripgrid.llm.queries import N_GRADES, VOCABULARY, rated


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are of grade 1 or better with a probability of at least one half."""
    bound_sent_batches(spark)
    model = fit(docs, table(spark, sf_dir, "labels"), rated(), N_GRADES)
    return select_documents(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    bound_sent_batches(spark)
    return drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the least doc_id."""
    bound_sent_batches(spark)
    return drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights; a row per document and pass over it."""
    return mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, checked by decoding: ``round_trip`` tells that the text came back."""
    bound_sent_batches(spark)
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    sized = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    ids = encode_documents(sized, path, pattern, keep=("text_sha256",), decode=True)
    return ids.select("doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE", encoded),
]

# The quality classifier is trained; SQL cannot express it. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
