"""Registered queries and DuckDB SQL of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import queries as q
from . import sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": q.op1_byte_bpe,
        "op2_source_mixing": q.op2_source_mixing,
        "op3_url_filter": q.op3_url_filter,
        "op4_quality_grades": q.op4_quality_grades,
        "op5_chat_formatting": q.op5_chat_formatting,
        "op6_warc": q.op6_warc,
        "op7_nearest_neighbours": q.op7_nearest_neighbours,
        "op8_exact_dedup": q.op8_exact_dedup,
        "op9_licences": q.op9_licences,
        "op10_ngram_jaccard": q.op10_ngram_jaccard,
        "op11_best_fit_packing": q.op11_best_fit_packing,
        "op12_lexical_search": q.op12_lexical_search,
        "op13_collocations": q.op13_collocations,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": sql.OP3,
        "op5_chat_formatting": sql.OP5,
        "op6_warc": sql.OP6,
        "op8_exact_dedup": sql.OP8,
        "op10_ngram_jaccard": sql.OP10,
        "op12_lexical_search": sql.OP12,
        "op13_collocations": sql.OP13,
    }
