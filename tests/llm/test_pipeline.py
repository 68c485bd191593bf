"""The pipeline and its stages, on the smallest tables and on awkward rows."""

from collections import Counter

import public_tokenizers
import pyarrow as pa
from test_exact import plain
from test_jaccard import brute
from test_langid import plain_predict

import __spark_entry__ as entry_point
import corpus_pipeline
from marketide.llm import pretokens, queries, tables

FOLDER = "/root/testdata/sf0.001"


def expected_documents(rows):
    """What the first three stages leave, in plain Python."""
    import zlib

    learn = [(r["text"], r["lang"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    found = plain_predict(learn, [r["text"] for r in rows])
    rows = [r for r, (lang, score) in zip(rows, found) if lang != "und" and score >= corpus_pipeline.LEAST_SCORE]
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(plain(r["text"]), r)
    groups = brute({r["doc_id"]: r["text"] for r in first.values()}, 5, 80)
    return {r["doc_id"]: r for r in first.values() if groups[r["doc_id"]][1] == r["doc_id"]}


def test_run(spark, documents):
    expected = expected_documents(list(documents.values()))
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == expected.keys()
    encoder = pretokens.Encoder(public_tokenizers.path(queries.RANKS), special=False)
    copies = Counter(r["doc_id"] for r in rows)
    assert set(copies.values()) <= {1, 2}
    for r in rows:
        _, lengths = encoder.encode([expected[r["doc_id"]]["text"]])
        assert r["n_tokens"] == lengths[0]


def test_stages(spark, awkward, nothing):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "ngram_jaccard", "source_mix", "byte_bpe",
    ]
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, FOLDER)
            if name != "byte_bpe":
                assert docs.columns == columns
            docs = docs.cache()
            docs.count()


def test_registered():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert "op4_exact_dedup" in entry_point.oracle_sql()


def test_texts_reach_python_in_small_batches(spark):
    """Batches of 10,000 long texts are what took the memory beside an executor's heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "64m")
        docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat(cast(id AS string), 2500) AS text")
        sizes = tables.texts(docs).mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"]) for b in batches),
            "rows long, bytes long",
        ).collect()
    finally:
        spark.conf.set(name, before)
    assert sum(r["rows"] for r in sizes) == 3000
    assert max(r["bytes"] for r in sizes) < tables.ARROW_BYTES + 100_000
