"""Encoding against the tiktoken and tokenizers libraries, decoding, offsets and counts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from marketide.llm import bpe, counts, pretokens, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "aaabcxs '\"\n\t!.-_ éßñ1230<|>中€😀 　\x85\xa0\x1c'slltdrevem''"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def ranked():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz():
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(3000)]
    return texts + [
        "", "a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x ", "a" * 3000, " " * 500,
        "ᲉᲉ x", "͸ y", "it's we'll 'sabc ''s 's 'ta 'LL", "xx xxx xxxxx" * 9,
    ]


def parts(encoder, texts):
    flat, lengths = encoder.encode(texts)
    return [p.tolist() for p in np.split(flat, np.cumsum(lengths)[:-1])]


def test_ids_are_those_of_the_rank_library(ranked):
    texts = fuzz()
    assert parts(pretokens.Encoder(RANKS, special=False), texts) == [ranked.encode_ordinary(t) for t in texts]


def test_ids_are_those_of_the_tokenizer_file(library):
    texts = fuzz()
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert parts(pretokens.Encoder(VOCABULARY), texts) == expected


def test_every_assigned_code_point_has_the_library_class(library):
    texts = [
        f"a{c}a 1{c}1 {c} {c}{c}!{c}" for c in map(chr, range(0x20000))
        if pretokens.classes()[ord(c)] != pretokens.UNKNOWN
    ][::3]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert parts(pretokens.Encoder(VOCABULARY), texts) == expected


def test_forgetting_changes_nothing(ranked, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 50)
    texts = fuzz()[:200]
    encoder = pretokens.Encoder(RANKS, special=False)
    assert [parts(encoder, [t])[0] for t in texts] == [ranked.encode_ordinary(t) for t in texts]


def test_decoding_offsets_and_split_characters(spark, awkward):
    encoded = bpe.encode(awkward, RANKS).collect()
    assert len(encoded) == awkward.count()
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    for r in encoded:
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]]
        assert len(r["ids"]) == len(r["starts"]) == len(r["ends"])
        if r["ids"]:
            assert (r["starts"][0], r["ends"][-1]) == (0, len(text))
            assert all(b >= a for a, b in zip(r["starts"], r["starts"][1:]))
    decoded = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(awkward, RANKS), RANKS).collect()}
    assert all(decoded[i] == t for i, t in texts.items() if i is not None)
    # An emoji is several ids; each spans it whole, and half of it decodes to U+FFFD.
    [row] = bpe.encode(spark.createDataFrame([(1, "\U0001f9ff")], "doc_id long, text string"), RANKS).collect()
    assert len(row["ids"]) > 1 and set(zip(row["starts"], row["ends"])) == {(0, 1)}
    half = spark.createDataFrame([(1, row["ids"][:1]), (2, None)], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(half, RANKS).collect()} == {1: "�", 2: ""}


def test_query_5(spark, documents, ranked):
    rows = queries.op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]["text"] or ""
        ids = ranked.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_query_10(spark, documents, library):
    rows = queries.op10_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r["doc_id"]]["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


@pytest.mark.parametrize("travelling", [0, 20, 1 << 19])
def test_counts_whatever_travels(awkward, library, travelling):
    found = counts.token_counts(awkward, VOCABULARY, travelling=travelling).collect()
    expected = [
        (r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in awkward.collect()
    ]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)


def test_empty_tables(nothing):
    assert bpe.round_trip(nothing, RANKS).count() == 0
    assert bpe.encode(nothing, RANKS).count() == 0
    assert counts.token_counts(nothing, VOCABULARY).count() == 0


def test_hashes_do_not_depend_on_how_much_is_hashed_at_once(monkeypatch):
    rng = np.random.default_rng(6)
    points = rng.integers(0, 1000, 20_000).astype(np.uint32)
    starts = np.concatenate([[0], np.sort(rng.choice(np.arange(1, 9000), 500, replace=False))])
    whole = pretokens.piece_hashes(points, starts)
    monkeypatch.setattr(pretokens, "HASHED_AT_ONCE", 97)
    assert all((a == b).all() for a, b in zip(whole, pretokens.piece_hashes(points, starts)))
    shifted = pretokens.piece_hashes(points[starts[7]:], starts[7:] - starts[7], (1,))
    assert (shifted[0] == whole[1][7:]).all()
    # Pieces of one character have two different hashes, which tell them apart.
    one = pretokens.piece_hashes(np.arange(5000, dtype=np.uint32), np.arange(5000))
    assert len(np.unique(one[0] ^ one[1])) == len(np.unique(one[0])) == len(np.unique(one[1])) == 5000


def test_a_shared_hash_is_left_to_the_library(monkeypatch):
    """With hashes cut to a few bits, batches with a clash come out right all the same."""
    text = ["it's all here, and there; we'll see  what 42 things come<|endoftext|>x", "", "one\n\ntwo three"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    expected = pretokens.Encoder(path).encode(text)
    true = pretokens.piece_hashes
    monkeypatch.setattr(pretokens, "piece_hashes", lambda *a: [h & np.uint64(7) if i == 0 else h for i, h in enumerate(true(*a))])
    got = pretokens.Encoder(path).encode(text)
    assert got[0].tolist() == expected[0].tolist() and got[1].tolist() == expected[1].tolist()


def test_a_very_long_word():
    word = "a" * 3_000_000
    encoder = pretokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    batch = pretokens.split([word, "b " + word], encoder.specials)
    assert len(batch.starts) == 3 and batch.hashes[0] != batch.hashes[2]
