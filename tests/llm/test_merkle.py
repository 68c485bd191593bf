"""The manifest against a plain construction of the whole tree."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from marketide.llm import merkle
from marketide.llm.queries import op13_merkle_manifest

SMALL = "/root/testdata/sf0.001"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(nodes):
    """The levels of a tree, lowest first."""
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[i:i + 8]) for i in range(0, len(last), 8)])
    return out


def way(levels, at, node):
    """Digests beside the way up from place ``at``, and what ``node`` leads to."""
    beside = []
    for nodes in levels[:-1]:
        start = at - at % 8
        run = nodes[start:start + 8]
        beside += run[:at - start] + run[at - start + 1:]
        node = h(*run[:at - start], node, *run[at - start + 1:])
        at //= 8
    return beside, node


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded_root, verified as the contract has them, tampering included."""
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in langs:
        order = [(r, leaf(r, r["text"])) for r in trees[lang]]
        order.sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        made[lang] = order, tree([n for _, n in order])
    top = tree([made[lang][1][-1][0] for lang in langs])
    out = []
    for j, lang in enumerate(langs):
        order, levels = made[lang]
        for i, (r, node) in enumerate(order):
            told = node
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                told = leaf(r, lowered(r["text"]))
            one, sub = way(levels, i, told)
            two, root = way(top, j, sub)
            out.append((r["doc_id"], node, levels[-1][0], top[-1][0], "".join(one + two), root, root == top[-1][0]))
    return sorted(out, key=repr)


def found(docs, levels=merkle.LEVELS):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lower)
    return merkle.manifest(docs, tampered, levels)


def as_rows(df):
    columns = "doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_plain_tree(small, levels):
    # Small superblocks make several rounds of them.
    assert as_rows(found(small, levels)) == plain(small.collect())


def test_awkward(awkward):
    got = as_rows(found(awkward))
    assert got == plain(awkward.collect())
    assert len(got) == awkward.count()


def test_many_trees(spark):
    """Seventy langs, of which one has a third of all rows; ids shared by rows."""
    rows = [(i % 90, f"Text {i}", "é" if i % 3 else ["", None, f"l{i}"][i % 7 % 3], f"s{i % 2}", i) for i in range(210)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert as_rows(found(docs, 1)) == plain(docs.collect())


def test_one_leaf(spark):
    docs = spark.createDataFrame([(4, "Ab", "en", None, 2)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = merkle.manifest(docs).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == h("1:4", "-", "2:en", "1:2", "2:Ab")
    assert row["proof"] == "" and row["places"] == [] and row["verified"]


def test_nothing(nothing):
    assert found(nothing).collect() == []


def test_fold(small):
    """A proof stands for itself, and a changed leaf or digest breaks it."""
    for r in merkle.manifest(small).limit(20).collect():
        proof, places, widths = r["proof"], r["places"], r["widths"]
        assert merkle.fold(r["leaf"], proof, places, widths) == r["root"] == r["folded_root"]
        assert len(proof) == 64 * sum(w - 1 for w in widths)
        assert merkle.fold(h("x"), proof, places, widths) != r["root"]
        assert merkle.fold(r["leaf"], h("x") + proof[64:], places, widths) != r["root"]


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = op13_merkle_manifest(spark, SMALL).collect()
    expected = [(a, b, c, d, h(p), e, f) for a, b, c, d, p, e, f in plain(rows)]
    columns = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(expected, key=repr)
    assert 0 < sum(not r["verified"] for r in got) < len(got)
