"""The pipeline's stages against brute force on sf0.01, and the registered queries."""

import public_tokenizers as P
import pyarrow as pa
import tiktoken

import __spark_entry__
import corpus_pipeline
from .test_jaccard import brute_force
from .test_mixing import targets
from tripgrid.llm import bpe, registry
from tripgrid.llm._common import SENT_BYTES, materialize

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        seen.append(docs.collect())
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    good, unique, apart, mixed, encoded = seen
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert len({r.doc_id for r in good} & set(clean)) >= 0.99 * len(clean)
    best = {}
    for r in good:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in unique) == sorted(best.values())
    assert sorted(r.doc_id for r in apart) == sorted({c for _, _, c in brute_force_fast(unique)})
    spec, taken = {}, {}
    for r in apart:
        spec.setdefault(r.source, []).append(len(r.text.split()))
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    for source, target in targets(spec).items():
        assert abs(taken[source] - target) <= 0.5
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))), special_tokens={})
    want = sorted((r.doc_id, b"".join(i.to_bytes(4, "little") for i in known.encode_ordinary(r.text))) for r in mixed)
    assert sorted((r.doc_id, bytes(r.ids)) for r in encoded) == want
    assert all(r.round_trip for r in encoded)


def brute_force_fast(rows):
    """All pairs, but only those that share a shingle at all."""
    from .test_jaccard import shingles

    holders = {}
    for r in rows:
        for s in shingles(r.text):
            holders.setdefault(s, []).append(r.doc_id)
    near = {i for ids in holders.values() if len(ids) > 1 for i in ids}
    linked = [(r.doc_id, r.text) for r in rows if r.doc_id in near]
    alone = [(r.doc_id, 0, r.doc_id) for r in rows if r.doc_id not in near]
    return [*brute_force(linked), *alone]


def test_odd_documents(spark, monkeypatch):
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "some words are here to stay", "en", "a", 27), (2, "", None, None, 0)]
    rows += [(i, f"document {i} has its own words {i * 7} and {i * 13} more", "en", "b", 40) for i in range(3, 30)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, row string")
    for source in (df, df.where("false")):
        docs = source
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "test-odd")
        assert docs.count() >= (20 if source is df else 0)


def test_workers_get_batches_of_bounded_bytes(spark):
    """A task's texts are not one batch: the encoder's worker, and any after it, gets about SENT_BYTES at a time."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n_bytes": [batch.nbytes], "n_rows": [batch.num_rows]})

    text = "concat_ws(' ', 'words of text', id, repeat('and some more of them ', 200))"
    docs = spark.range(0, 4000, numPartitions=1).selectExpr("id as doc_id", f"{text} as text")
    for stage in (corpus_pipeline.encoded, corpus_pipeline.without_copies, corpus_pipeline.without_near_copies):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs.limit(20), SF)
        got = docs.mapInArrow(sizes, "n_bytes bigint, n_rows bigint").collect()
        assert sum(r.n_rows for r in got) == 4000 and len(got) > 4
        assert max(r.n_bytes for r in got) < 2 * SENT_BYTES


def test_registered_queries():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert names == [*(f"{n}" for n in registry.queries())] and len(names) == 14
    assert set(registry.oracle_sql()) <= set(names)
