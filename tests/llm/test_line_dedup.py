"""Fuzzy line dedup against comparing all lines."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from marketide.llm import lines, linking, queries


def brute(texts, percent=80, size=8):
    """(doc_id, line) of every line that goes, by comparing all pairs."""
    known = []
    for i in sorted(texts):
        for j, line in enumerate((texts[i] or "").split("\n")):
            line = " ".join(line.lower().split())
            if line:
                grams = [line[x:x + size] for x in range(len(line) - size + 1)] if len(line) >= size else [line]
                known.append((i, j, frozenset(grams)))
    parent = list(range(len(known)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, (_, _, s) in enumerate(known):
        common = Counter(j for x in s for j in where[x])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(known[j][2]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            where[x].append(i)
    return {known[i][:2] for i in range(len(known)) if root(i) != i}


def test_query(spark, documents):
    expected = brute({i: r["text"] for i, r in documents.items()})
    rows = queries.op2_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["n_lines"] for r in rows} == {
        i: len(r["text"].split("\n")) if r["text"] else 0 for i, r in documents.items()
    }
    found = {(r["doc_id"], j) for r in rows for j in r["dropped"]}
    # Banding may miss a pair near the threshold, and never makes one up.
    assert found <= expected
    assert len(found) >= 0.99 * len(expected)


def test_signatures_meet_as_often_as_they_should():
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    met = total = strangers = 0
    for _ in range(150):
        a = rng.choice(letters, 200)
        b = a.copy()
        b[rng.integers(0, 200, 2)] = "#"
        values = [lines.shingles(["".join(x)])[0] for x in (a, b)]
        overlap = len(np.intersect1d(*values)) / len(np.union1d(*values))
        keys = [lines.band_keys(lines.minima(v, np.zeros(1, np.int64)))[:, 0] for v in values]
        if overlap >= 0.8:
            total += 1
            met += bool((keys[0] == keys[1]).any())
        other = lines.shingles(["".join(rng.choice(letters, 200))])[0]
        strangers += bool((keys[0] == lines.band_keys(lines.minima(other, np.zeros(1, np.int64)))[:, 0]).any())
    assert total > 100 and met >= 0.99 * total and not strangers


def test_awkward_rows(awkward, nothing):
    rows = lines.line_report(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[3]["n_lines"] == 0 and by_id[4]["n_lines"] == 0 and by_id[5]["n_lines"] == 2
    # The first of two equal lines stays, also within a document; the blank line stays.
    assert by_id[11]["dropped"] == [2, 4]
    assert by_id[1]["dropped"] == [] and by_id[2]["dropped"] == [0] and by_id[10]["dropped"] == [0]
    left = lines.dedup_lines(awkward)
    assert left.columns == awkward.columns and left.count() == awkward.count()
    text = {r["doc_id"]: r["text"] for r in left.collect()}
    assert text[11] == "one line\n\nanother line of words here" and text[2] == "" and text[3] is None
    assert lines.line_report(nothing).count() == 0
    assert lines.dedup_lines(nothing).count() == 0


def test_hot_line(spark):
    texts = {i: f"the line that all of them have in common\nown line {i * 7919} of {i ** 3} and {i ** 5}" for i in range(400)}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(5)
    gone = {(r["doc_id"], j) for r in lines.line_report(df).collect() for j in r["dropped"]}
    assert {(i, 0) for i in range(1, 400)} <= gone and (0, 0) not in gone


def test_two_texts_of_one_doc_id(spark):
    """A verdict on a line of one text says nothing of the other's line with that number."""
    own, shared = "a line which only this row has in all the table", "one line that is shared by several rows"
    rows = [(5, own), (5, shared), (3, shared), (5, shared), (None, shared), (None, own + " but for the end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in lines.dedup_lines(docs).collect()), key=repr)
    expected = [(5, own), (5, ""), (3, ""), (5, ""), (None, shared), (None, own + " but for the end")]
    assert got == sorted(expected, key=repr)
    dropped = sorted((r["doc_id"] or 0, r["dropped"]) for r in lines.line_report(docs).collect())
    assert dropped == [(0, []), (0, []), (3, [0]), (5, []), (5, [0]), (5, [0])]


def test_sets_of_many_lines_at_once():
    rng = np.random.default_rng(4)
    some = ["".join(rng.choice(list("abc \U0001f600"), n)) for n in [*rng.integers(1, 300, 400), 1, 7, 8, 9, 20_000]]
    values, starts = lines.shingles(some)
    sets = [np.unique(v) for v in np.split(values, starts[1:])]
    size, s0, s1 = lines.sizes_and_signatures(values, starts)
    assert size.tolist() == list(map(len, sets))
    assert [s0.tolist(), s1.tolist()] == [s.tolist() for s in linking.signatures(sets)]
    a, b, both = lines.overlaps(some, some[::-1])
    assert a.tolist() == size.tolist() and b.tolist() == size[::-1].tolist()
    assert both.tolist() == [len(np.intersect1d(x, y)) for x, y in zip(sets, sets[::-1])]


def test_documents_are_read_once(spark, small):
    """Once for their lines and once for the report, however many rounds the links take."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = small.select("doc_id", "text")
    counted = docs.mapInArrow(run, docs.schema)
    expected = sorted(map(repr, lines.line_report(docs).collect()))
    assert sorted(map(repr, lines.line_report(counted).collect())) == expected
    assert read.value <= 2 * docs.count()


def test_normal_form():
    rng = np.random.default_rng(6)
    letters = list("aB  \t\x1c\x85\u3000\u03a3\u03c3\u00e9\x00\x7f")
    for n in rng.integers(0, 9, 20_000):
        line = "".join(rng.choice(letters, n))
        assert lines.normal(line) == " ".join(line.lower().split())


def test_a_large_group_is_scanned_for_once(spark, monkeypatch):
    """Texts are read for the first links and for the large tiles, however many turns these take."""
    calls = []
    sets_of = lines.sets_of
    monkeypatch.setattr(lines, "sets_of", lambda *a: (calls.append(a), sets_of(*a))[1])
    # A chain whose neighbours are similar and whose ends are not, so that turns find what is still apart.
    rng = np.random.default_rng(8)
    line, texts = list(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 400)), []
    for i in range(300):
        line[i] = "#"
        texts.append((i, "".join(line)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    gone = {(r["doc_id"], j) for r in lines.line_report(docs).collect() for j in r["dropped"]}
    assert gone == brute(dict(texts))
    assert len(calls) <= 2


def test_tiles_are_ordered_and_single_rows_left_out():
    """Rows come by key alone, and a key may go over several batches."""
    rng = np.random.default_rng(9)
    key = np.sort(np.concatenate([rng.integers(0, 500, 300), np.full(700, 250), np.arange(1000, 1400)]))
    columns = [key, rng.integers(0, 400, len(key)), rng.integers(1, 9, len(key)).astype(np.int32), key.astype(np.int32), key, key]
    columns[2] = (columns[1] % 7).astype(np.int32)  # a set has one size
    names = ["key", "id", "size", "place", "s0", "s1"]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i:i + 90]) for c in columns], names) for i in range(0, len(key), 90)]
    got = [row for tile in linking._runs(iter(batches)) for row in zip(tile.key.tolist(), tile.size.tolist(), tile.id.tolist())]
    rows = sorted(set(zip(key.tolist(), columns[2].tolist(), columns[1].tolist())))
    counts = Counter(key.tolist())
    assert got == [r for r in rows if counts[r[0]] > 1]
