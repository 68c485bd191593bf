"""Patched frame-of-reference blocks: exact round trips and document order."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketide.llm import packed, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
numbers = st.one_of(st.integers(0, 40), st.integers(0, 70_000), st.integers(0, 2**32 - 1))


@settings(max_examples=150, deadline=None)
@given(st.lists(numbers, max_size=1200))
def test_round_trip(values):
    payload = packed.pack(np.array(values, np.uint32))
    assert packed.unpack(payload).tolist() == values


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 9), st.integers(0, 9), st.integers(0, 2500))
def test_blocks_are_read_alone(first, count, size):
    values = np.random.default_rng(size).integers(0, 50_000, size).astype(np.uint32)
    taken = packed.unpack(packed.pack(values), first, first + count)
    assert taken.tolist() == values[first * packed.BLOCK:(first + count) * packed.BLOCK].tolist()


def test_few_large_values_do_not_widen_a_block():
    values = np.arange(256, dtype=np.uint32) % 16
    plain = len(packed.pack(values))
    values[[3, 200]] = 4_000_000_000
    assert len(packed.pack(values)) == plain + 2 * packed.PATCH.itemsize


def test_query_7(spark, documents):
    library = Tokenizer.from_file(VOCABULARY)
    rows = {r["doc_id"]: r for r in queries.op7_packed_ids(spark, "/root/testdata/sf0.001").collect()}
    assert rows.keys() == documents.keys()
    start = 0
    for i in sorted(documents):
        ids = [*library.encode(documents[i]["text"] or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_awkward_rows_and_ids_read_back(spark, awkward):
    library = Tokenizer.from_file(VOCABULARY)
    path = packed.scratch(spark, "ids")
    packed.write(awkward, path, VOCABULARY, tasks=4)
    found = sorted(((r["doc_id"] or -1), r["ids"]) for r in packed.read_ids(spark, path).collect())
    expected = sorted(
        ((r["doc_id"] or -1), [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0])
        for r in awkward.collect()
    )
    assert found == expected
    rows = packed.read_documents(spark, path).orderBy("start").collect()
    assert [r["doc_id"] or -1 for r in rows] == sorted((r["doc_id"] or -1) for r in rows)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))


def test_empty_table(spark, nothing):
    path = packed.scratch(spark, "ids")
    packed.write(nothing, path, VOCABULARY)
    assert packed.read_documents(spark, path).count() == 0
