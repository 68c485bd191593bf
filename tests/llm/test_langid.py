"""Rank-order profiles against a plain version, and held-out accuracy."""

import zlib
from collections import Counter

from marketide.llm import langid, queries

FOLDER = "/root/testdata/sf0.001"


def plain_ngrams(text):
    """Counts by the key that the operator uses."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    counts = Counter()
    for w in words:
        p = [0, *map(ord, w), 0]
        for i, c in enumerate(p):
            if c:
                counts[c << 42] += 1
            if i + 1 < len(p) and (c or p[i + 1]):
                counts[c << 42 | p[i + 1] << 21 | 1 << 20] += 1
            if 0 < i < len(p) - 1:
                counts[p[i - 1] << 42 | c << 21 | p[i + 1]] += 1
    return counts


def ranks(counts, size):
    order = sorted(counts, key=lambda k: (-counts[k], k))[:size]
    return {k: i for i, k in enumerate(order)}


def plain_predict(learn, texts, size=langid.PROFILE):
    totals = {}
    for text, lang in learn:
        if text is not None and lang is not None:
            totals.setdefault(lang, Counter()).update(plain_ngrams(text))
    profiles = {lang: ranks(c, size) for lang, c in sorted(totals.items()) if c}
    out = []
    for text in texts:
        own = ranks(plain_ngrams(text or ""), size)
        if not own or not profiles:
            out.append((langid.UNKNOWN, 0.0))
            continue
        distance = {
            lang: sum(abs(r - p[k]) if k in p else size for k, r in own.items()) for lang, p in profiles.items()
        }
        best = min(sorted(distance), key=distance.get)
        out.append((best, 1 - distance[best] / (len(own) * size)))
    return out


def test_query(spark, documents):
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in documents}
    expected = plain_predict(
        [(r["text"], r["lang"]) for i, r in documents.items() if not held[i]], [r["text"] for r in documents.values()]
    )
    rows = {r["doc_id"]: r for r in queries.op8_language_id(spark, FOLDER).collect()}
    assert rows.keys() == documents.keys()
    for i, (lang, score) in zip(documents, expected):
        assert (rows[i]["lang_pred"], rows[i]["held_out"]) == (lang, held[i])
        assert abs(rows[i]["score"] - score) < 1e-9
    right = [rows[i]["lang_pred"] == documents[i]["lang"] for i in documents if held[i]]
    assert sum(right) >= 0.97 * len(right)


def test_awkward_rows(awkward, nothing):
    learned = langid.profiles(awkward)
    rows = langid.predict(awkward, learned).collect()
    expected = plain_predict([(r["text"], r["lang"]) for r in awkward.collect()], [r["text"] for r in awkward.collect()])
    assert sorted((r["lang_pred"], round(r["score"], 9)) for r in rows) == sorted((a, round(b, 9)) for a, b in expected)
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5, 8))
    assert {r["lang_pred"] for r in langid.predict(awkward, langid.profiles(nothing)).collect()} == {"und"}
    assert langid.predict(nothing, learned).count() == 0
    found = langid.annotate(awkward, learned, ("a", "b"))
    assert found.columns == [*awkward.columns, "a", "b"] and found.count() == awkward.count()
