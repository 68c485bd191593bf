"""The similarity join against comparing all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketide.llm import jaccard, linking, queries


def sets(texts, words):
    out = {}
    for i, text in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        grams = [tuple(w[j:j + words]) for j in range(len(w) - words + 1)]
        out[i] = frozenset(grams if len(w) >= words else [tuple(w)] if w else [])
    return out


def brute(texts, words, percent):
    """n_shingles and component of every document."""
    all_sets, parent = sets(texts, words), {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i in sorted(all_sets):
        common = Counter(j for s in all_sets[i] for j in where[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(all_sets[i]) + len(all_sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in all_sets[i]:
            where[s].append(i)
    return {i: (len(s), root(i)) for i, s in all_sets.items()}


def brute_links(texts, words, percent):
    """All pairs of documents that link."""
    all_sets, where, out = sets(texts, words), defaultdict(list), set()
    for i in sorted(all_sets):
        for j, n in Counter(j for s in all_sets[i] for j in where[s]).items():
            if 100 * n >= percent * (len(all_sets[i]) + len(all_sets[j]) - n):
                out.add((j, i))
        for s in all_sets[i]:
            where[s].append(i)
    return out


def near_copies(count, seed=5, length=80, chain=False):
    """Texts that differ from a base, or from the one before, by a few words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    base = [word() for _ in range(length)]
    texts = {}
    for i in range(count):
        text = list(base)
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(length)] = word()
        if chain and i % 7 == 0:
            base = text
        texts[i * 3 + 1] = " ".join(text)
    return texts


def frame(spark, texts):
    return spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(4)


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query(spark, documents):
    expected = brute({i: r["text"] for i, r in documents.items()}, 4, 85)
    assert found(queries.op3_ngram_jaccard(spark, "/root/testdata/sf0.001")) == expected


@pytest.mark.parametrize("chain", [False, True])
def test_large_group_of_near_copies(spark, chain):
    texts = near_copies(150, chain=chain)
    texts |= {10_000 + i: t for i, t in near_copies(40, seed=9, length=12).items()}
    assert found(jaccard.similar_groups(frame(spark, texts))) == brute(texts, 5, 80)


def test_shared_passage_in_other_texts(spark):
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("klmnop", k=4)) for _ in range(60))
    texts = {
        i: " ".join("".join(rng.choices("abcdef", k=4)) for _ in range(rng.randint(0, 90))) + " " + passage
        for i in range(120)
    }
    assert found(jaccard.similar_groups(frame(spark, texts), 4, 85)) == brute(texts, 4, 85)


def test_cut_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", 10)
    texts = near_copies(60) | {1000 + i: t for i, t in near_copies(40, seed=2, length=30).items()}
    assert found(jaccard.similar_groups(frame(spark, texts))) == brute(texts, 5, 80)


def test_awkward_rows(awkward):
    rows = jaccard.similar_groups(awkward, 4, 85).collect()
    assert len(rows) == awkward.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by_id[3] == {(0, 3)} and by_id[4] == {(0, 4)} and by_id[5] == {(0, 5)}
    assert by_id[1] == by_id[2] and by_id[1] == {(9, 1)}
    assert by_id[10] == by_id[7] and len(by_id[6]) == 1
    assert {c for _, c in by_id[None]} == {None}
    assert {n for n, _ in by_id[8]} == {1}


def test_one_of_each(awkward, nothing):
    left = jaccard.one_of_each(awkward)
    assert left.columns == awkward.columns
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, -1, 1, 3, 4, 5, 6, 6, 7, 8, 9, 11]
    assert jaccard.one_of_each(nothing).count() == 0
    assert jaccard.similar_groups(nothing).count() == 0


def test_bounds_never_exclude_a_link():
    rng = np.random.default_rng(4)
    for _ in range(300):
        base = rng.integers(0, 1 << 62, rng.integers(1, 200)).astype(np.uint64)
        other = np.where(rng.random(len(base)) < 0.08, rng.integers(0, 1 << 62, len(base)).astype(np.uint64), base)
        a, b = np.unique(base), np.unique(other)
        overlap = len(np.intersect1d(a, b))
        if 100 * overlap < 80 * (len(a) + len(b) - overlap):
            continue
        first = np.intersect1d(a, b)[0]
        s0, s1 = linking.signatures([a, b])
        tile = linking.Tile([
            np.zeros(2, np.int64), np.arange(2), np.array([len(a), len(b)]),
            np.array([np.searchsorted(a, first), np.searchsorted(b, first)]),
            s0, s1,
        ])
        assert tile.may_link(0, np.array([1]), 80, 100).all()
        assert linking.differing_bits(*map(linking.wide_signature, (a, b))) <= len(np.setxor1d(a, b))
        assert tile.place[0] < linking.prefix_length(len(a), 80, 100)


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)] + [(-5, 7), (3000, 3000)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(8)
    got = {r["id"]: r["component"] for r in linking.components(df).collect()}
    assert all(got[i] == -5 for i in range(201)) and got[-5] == -5
    assert all(got[1000 + i] == 1000 for i in range(300))
    assert all(got[2000 + i] == 2000 for i in range(50))
    assert linking.components(df.limit(0)).count() == 0


def test_one_id_with_different_texts(spark):
    def text(stem, changed=()):
        return " ".join(f"other{i}" if i in changed else f"{stem}{i}" for i in range(200))

    rows = [
        (5, text("a")), (5, text("b")), (7, text("a", (199,))), (8, text("b", (0,))), (9, text("c")), (9, text("d")),
        (10, text("c", (199,))), (3, text("d", (0,))),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r["doc_id"], r["class_id"], r["component_id"]) for r in jaccard.similar_groups(docs).collect())
    assert found == [(3, 3, 3), (5, 5, 5), (5, 5, 5), (7, 7, 5), (8, 8, 5), (9, 9, 3), (9, 9, 9), (10, 10, 9)]
    left = sorted((r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect())
    assert left == sorted([rows[0], rows[1], rows[4], rows[7]])


@pytest.mark.parametrize("tile_rows", [10, 20_000])
@pytest.mark.parametrize("chain", [False, True])
def test_every_link_is_found(spark, monkeypatch, tile_rows, chain):
    """Large groups, chains, copies and cut tiles: links within a component too."""
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile_rows)
    texts = near_copies(90, chain=chain) | {1000 + i: t for i, t in near_copies(30, seed=2, length=30).items()}
    texts |= {2000 + i: texts[4] for i in range(3)} | {3000: "", 3001: None}
    expected, all_sets = brute_links(texts, 5, 80), sets(texts, 5)
    first = {i: min(j for j in texts if all_sets[j] == all_sets[i]) for i in texts}
    got = [tuple(r) for r in jaccard.links(frame(spark, texts)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {tuple(sorted((first[i], first[j]))) for i, j in expected if first[i] != first[j]}
    counts = {r["doc_id"]: r["n_links"] for r in jaccard.link_counts(frame(spark, texts)).collect()}
    assert counts == {i: sum(i in pair for pair in expected) for i in texts}


def test_links_of_awkward_rows(awkward, nothing):
    assert sorted(tuple(r) for r in jaccard.links(awkward, 4, 85).collect()) == []
    counts = defaultdict(set)
    for r in jaccard.link_counts(awkward, 4, 85).collect():
        counts[r["doc_id"]].add(r["n_links"])
    assert counts[1] == counts[2] == counts[7] == counts[10] == {1} and counts[6] == {1}
    assert counts[None] == counts[3] == counts[4] == counts[5] == {0}
    assert jaccard.links(nothing).count() == 0 and jaccard.link_counts(nothing).count() == 0


@pytest.mark.parametrize("one_task", [0, 200_000])
def test_components_in_one_task_and_in_passes(spark, monkeypatch, one_task):
    monkeypatch.setattr(linking, "ONE_TASK", one_task)
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2)) if a != b] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5000, 5000 + i) for i in range(1, 50)]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(6)
    parent = {x: x for pair in pairs for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = [tuple(r) for r in linking.components(links).collect()]
    assert sorted(got) == sorted((x, root(x)) for x in parent)
    assert linking.components(links.where("false")).collect() == []
