"""Exact duplicates against SQL and plain Python."""

import hashlib
import re

import duckdb

from marketide.llm import exact, queries

FOLDER = "/root/testdata/sf0.001"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_query_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    relation = duckdb.sql(queries.SQL["op4_exact_dedup"])
    df = queries.op4_exact_dedup(spark, FOLDER).select(relation.columns)
    assert sorted(map(tuple, df.collect())) == sorted(relation.fetchall())


def test_awkward_rows(awkward):
    rows = awkward.collect()
    ids, sizes = {}, {}
    for r in rows:
        key = plain(r["text"])
        ids.setdefault(key, []).append(r["doc_id"])
        sizes[key] = sizes.get(key, 0) + 1
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    expected = sorted(
        (str(r["doc_id"]), str(least[k := plain(r["text"])]), sizes[k], r["doc_id"] == least[k], hashlib.sha256(k.encode()).hexdigest())
        for r in rows
    )
    found = exact.exact_groups(awkward, hash_all=True).collect()
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in found) == expected


def test_full_hash_of_survivors_only(awkward):
    every = exact.exact_groups(awkward, hash_all=True).drop("text_sha256").collect()
    rows = exact.exact_groups(awkward).collect()
    assert sorted(tuple(map(str, r[:4])) for r in rows) == sorted(tuple(map(str, r)) for r in every)
    assert all(r["text_sha256"] is not None for r in rows if r["group_size"] > 1)
    assert any(r["text_sha256"] is None for r in rows)


def test_same_length_and_prefix_but_other_end(spark):
    start = "same " * 100
    docs = spark.createDataFrame([(1, start + "a"), (2, start + "b"), (3, start + "a")], "doc_id long, text string")
    for every in (True, False):
        found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_groups(docs, every).collect()}
        assert found == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False)}


def test_dropping_keeps_columns(awkward, nothing):
    left = exact.drop_exact(awkward)
    assert left.columns == awkward.columns
    # 2 equals 1; 4 equals 3 (empty), as does the null row without an id; 10 equals 7.
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 1, 3, 5, 6, 6, 7, 8, 9, 11]
    assert exact.drop_exact(nothing).count() == 0
    assert exact.exact_groups(nothing, hash_all=True).count() == 0


def test_hot_group(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same', concat('text ', id)) AS text")
    found = exact.exact_groups(docs).collect()
    assert sum(r["kept"] for r in found) == 2001
    assert {r["group_size"] for r in found if r["doc_id"] % 3 == 0} == {1000}
