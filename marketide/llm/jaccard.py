"""Similarity join of documents by the Jaccard similarity of their word n-grams.

Equal sets are one class and only its smallest doc_id goes on. The elements of all
sets are ordered by a common measure (seldom ones first), and classes meet in tiles by
each of their first elements: two similar sets share one of them. Within a tile, sorted
by size, the sizes bound the band of partners, and the places of the shared element and
the bit counts of hashed bitmap signatures bound the overlap from above. What is left is
decided by intersecting the sorted arrays themselves.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketide.llm import linking, pretokens
from marketide.llm.bpe import text_batches
from marketide.llm.tables import free_names, kept, texts

WORDS, PERCENT = 5, 80

#: Counters for how many documents an element is in: their number fixes the size of the table.
COUNTERS = 1 << 20
CHUNK = 1 << 12
#: A tile that is expected to be larger is cut into blocks, which meet in pairs.
TILE_ROWS = 20_000

_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES[_WHITE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_PLACES = np.random.default_rng(8).integers(1, 1 << 62, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The text and a 64-bit hash of every word; ASCII letters count as lower case."""
    raw = [t.encode() for t in items]
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    white = _WHITE[data]
    start = ~white
    start[1:] &= white[:-1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(len(data) - starts[0])
    place -= np.repeat(starts - starts[0], lengths)
    values = _BYTES[data[starts[0]:]] * pretokens.power_of(place, 0, int(place.max()) + 1)
    hashes = pretokens.mix(np.add.reduceat(values, starts - starts[0]))
    return np.searchsorted(np.cumsum(sizes), starts, side="right"), hashes


def shingle_sets(items: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word n-grams; fewer words are one element."""
    owner, hashes = word_hashes(items)
    counts = np.bincount(owner, minlength=len(items))
    ends = np.cumsum(counts)
    grams = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        grams += hashes[i:i + len(grams)] * _PLACES[i]
    grams = pretokens.mix(grams)
    out = []
    for first, end in zip((ends - counts).tolist(), ends.tolist()):
        n = end - first
        if n >= words:
            out.append(linking.distinct(grams[first:end - words + 1]))
        elif n:
            few = (hashes[first:end] * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(pretokens.mix(np.array([few])))
        else:
            out.append(grams[:0])
    return out


def row_key() -> Column:
    """A 64-bit hash of doc_id and text, so that rows are told apart that share an id alone; null without an id."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.when(doc_id.isNotNull(), F.xxhash64(doc_id, text))


def by_row(docs: DataFrame) -> DataFrame:
    """doc_id is the row's key, doc its doc_id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"), row_key().alias("doc_id"), "text")


def describe(docs: DataFrame, words: int) -> DataFrame:
    """kind 0: id, doc, size and digest (d0, d1) of each text's set; kind 1: counters of a task (chunk, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        waiting: list[np.ndarray] = []
        names = ["kind", "id", "doc", "size", "d0", "d1", "counts"]
        for part, items in text_batches(batches):
            sets = shingle_sets(items, words)
            waiting += [(x >> np.uint64(44)).astype(np.uint32) for x in sets]
            if sum(map(len, waiting)) > COUNTERS:
                total += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                waiting.clear()
            digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(sets), np.int8)), part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(digests[0::2]), pa.array(digests[1::2]), pa.nulls(len(sets), pa.binary()),
                ],
                names,
            )
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        chunks = [zlib.compress(c.tobytes(), 1) for c in total.reshape(-1, CHUNK)]
        n = len(chunks)
        zero = np.zeros(n, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.ones(n, np.int8)), pa.array(np.arange(n)), pa.nulls(n, pa.int64()), pa.array(zero.astype(np.int32)),
                pa.array(zero), pa.array(zero), pa.array(chunks, pa.binary()),
            ],
            names,
        )

    return texts(docs, "doc").mapInArrow(run, "kind byte, id long, doc long, size int, d0 long, d1 long, counts binary")


def counters(described: DataFrame) -> np.ndarray:
    """All tasks' counters added up: COUNTERS numbers whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(zlib.decompress(counts.as_buffer()), np.int64)
                sums[chunk] = sums[chunk] + values if chunk in sums else values
        if sums:
            packed = [zlib.compress(v.tobytes(), 1) for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(packed, pa.binary())], ["chunk", "counts"])

    out = np.zeros(COUNTERS // CHUNK * CHUNK, np.int64).reshape(-1, CHUNK)
    parts = described.where("kind = 1").select(F.col("id").alias("chunk"), "counts").repartition("chunk")
    for r in parts.mapInArrow(add, "chunk long, counts binary").collect():
        out[r["chunk"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.ravel()


def ordered(elements: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The elements in the common order: seldom ones first, then by hash."""
    level = levels[(elements >> np.uint64(44)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(56)) | (elements >> np.uint64(8)))


def prefixes(docs: DataFrame, words: int, percent: int, levels: np.ndarray, wanted: np.ndarray) -> DataFrame:
    """id, size, signature and first elements of the texts whose id passes the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast((levels, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, wanted = shared.value
        for part, items, sets in _wanted_sets(batches, words, wanted):
            rows = [i for i, s in enumerate(sets) if len(s)]
            signs = linking.signatures([sets[i] for i in rows])
            firsts = [ordered(sets[i], levels)[: linking.prefix_length(len(sets[i]), percent, 100)] for i in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())), pa.array([len(sets[i]) for i in rows], pa.int32()),
                    *map(pa.array, signs),
                    pa.array([f.tobytes() for f in firsts], pa.binary()),
                ],
                ["id", "size", "s0", "s1", "firsts"],
            )

    return texts(docs).mapInArrow(run, "id long, size int, s0 long, s1 long, firsts binary")


def _wanted_sets(batches: Iterator[pa.RecordBatch], words: int, wanted: np.ndarray):
    for part, items in text_batches(batches):
        ids = part.column(0)
        hit = linking.passes(wanted, np.asarray(ids.fill_null(0))) & np.asarray(ids.is_valid())
        if hit.any():
            part = part.filter(pa.array(hit))
            items = [t for t, h in zip(items, hit.tolist()) if h]
            yield part, items, shingle_sets(items, words)


def sets_of(docs: DataFrame, words: int, wanted: np.ndarray) -> DataFrame:
    """The sets of the texts whose id passes the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, sets in _wanted_sets(batches, words, shared.value):
            yield linking.set_rows(part.column(0), sets)

    return texts(docs).mapInArrow(run, linking.SETS)


def tiles(firsts: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """A tile row for each first element. ``blocks``: into how many blocks the tiles of a counter are cut.

    A row of a cut tile goes to every pair of blocks that its own is in, so any two rows meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(f.as_buffer()) // 8 for f in batch.column(4)], np.int64)
            if not sizes.sum():
                continue
            keys = np.frombuffer(b"".join(f.as_buffer().to_pybytes() for f in batch.column(4)), np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids, n, s0, s1 = (batch.column(i).to_numpy(zero_copy_only=False)[row] for i in range(4))
            if blocks:
                counter = (keys >> 36) & (COUNTERS - 1)
                cut = np.flatnonzero(np.isin(counter, np.fromiter(blocks, np.int64)))
                copies, new = [np.delete(np.arange(len(keys)), cut)], [np.delete(keys, cut)]
                for i in cut.tolist():
                    count = blocks[int(counter[i])]
                    own = int(pretokens.mix(np.array([ids[i]]).view(np.uint64))[0] % np.uint64(count))
                    pair = [min(own, j) * count + max(own, j) + 1 for j in range(count)]
                    copies.append(np.full(count, i))
                    new.append(pretokens.mix(np.array([keys[i]]).view(np.uint64) + np.array(pair, np.uint64)).view(np.int64))
                at, keys = np.concatenate(copies), np.concatenate(new)
                ids, n, place, s0, s1 = ids[at], n[at], place[at], s0[at], s1[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (keys, ids, n, place.astype(np.int32), s0, s1)],
                ["key", "id", "size", "place", "s0", "s1"],
            )

    return firsts.select("id", "size", "s0", "s1", "firsts").mapInArrow(run, linking.TILE)


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, class_id and component_id of every row of ``docs``.

    Sets are the distinct ``words``-grams of the lower-cased text; two documents link when
    100 * intersection >= percent * union, and component_id is the smallest doc_id that
    links lead to. class_id is the smallest doc_id with the same set. Texts without words
    (null, empty, white space) have an empty set and link with nothing. Rows that repeat a
    doc_id are judged by their own texts; rows without one link with nothing and have no
    component.
    """
    return _grouped(docs, words, percent).select("doc_id", "n_shingles", "class_id", "component_id")


def _members(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their sets' digests; classes of equal sets; the tiles in which classes meet. ``docs`` are ``by_row``."""
    described = kept(describe(docs, words))
    members = described.where("kind = 0").select("id", "doc", "size", "d0", "d1")
    classes = kept(
        members.where("size > 0 AND id IS NOT NULL").groupBy("d0", "d1").agg(
            F.min("id").alias("class_key"), F.min(F.struct("doc", "id")).alias("first"), F.count("*").alias("copies")
        )
    )
    counts = counters(described)
    levels = np.minimum(np.floor(np.log2(counts + 1) * 4), 255).astype(np.uint8)
    # Counters far above the usual belong to frequent elements; the rest of a counter is chance.
    usual = 2 * counts.mean()
    hot = np.flatnonzero(counts - usual > TILE_ROWS)
    blocks = {int(c): int(np.ceil((counts[c] - usual) / TILE_ROWS)) for c in hot}
    named = classes.select(F.col("class_key").alias("id")).distinct()
    firsts = prefixes(docs, words, percent, levels, linking.id_filter(named)).join(named, "id", "left_semi")
    return members, classes, tiles(firsts, blocks)


def links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """class_id and other_id of every two classes of equal sets that link, each pair once, class_id the smaller.

    Classes are named by their smallest doc_id; ``similar_groups`` says which documents
    are in a class. There are as many rows as links, whose number may grow with the square
    of a group of near copies; copies themselves are not multiplied out.
    """
    rows = by_row(docs)
    _, classes, meeting = _members(rows, words, percent)
    found = linking.all_links(meeting, partial(sets_of, rows, words), percent, 100)
    for side in ("a", "b"):
        found = found.join(classes.select(F.col("class_key").alias(side), F.col("first.doc").alias(f"doc_{side}")), side)
    return found.select(F.least("doc_a", "doc_b").alias("class_id"), F.greatest("doc_a", "doc_b").alias("other_id"))


def link_counts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id and n_links (other documents that link with it, equal sets among them) of every row of ``docs``.

    Texts without words and rows without doc_id have no links.
    """
    rows = by_row(docs)
    members, classes, meeting = _members(rows, words, percent)
    found = kept(linking.all_links(meeting, partial(sets_of, rows, words), percent, 100))
    both = found.union(found.select("b", "a"))
    others = classes.select(F.col("class_key").alias("b"), "copies")
    linked = both.join(others, "b").groupBy(F.col("a").alias("class_key")).agg(F.sum("copies").alias("others"))
    per_class = classes.join(linked, "class_key", "left").select(
        "d0", "d1", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    named = F.when((F.col("size") > 0) & F.col("id").isNotNull(), F.col("n_links")).otherwise(0)
    return members.join(per_class, ["d0", "d1"], "left").select(F.col("doc").alias("doc_id"), named.cast("long").alias("n_links"))


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The columns of ``similar_groups``, each row's key, and first_key: that of its component's first row."""
    docs = by_row(docs)
    members, classes, meeting = _members(docs, words, percent)
    linked = linking.link(meeting, partial(sets_of, docs, words), percent, 100)
    joined = kept(classes.join(linked, classes["class_key"] == linked["id"], "left").select(
        "d0", "d1", "first", F.coalesce("component", "class_key").alias("component")
    ))
    firsts_of = joined.groupBy("component").agg(F.min("first").alias("leader"))
    found = joined.join(firsts_of, "component").select("d0", "d1", "first", "leader")
    alone = F.col("size") == 0
    named_row = F.col("id").isNotNull()
    return members.join(found, ["d0", "d1"], "left").select(
        F.col("doc").alias("doc_id"),
        F.col("size").cast("long").alias("n_shingles"),
        F.when(alone, F.col("doc")).when(named_row, F.col("first.doc")).alias("class_id"),
        F.when(alone, F.col("doc")).when(named_row, F.col("leader.doc")).alias("component_id"),
        F.col("id").alias("key"),
        F.when(alone, F.col("id")).when(named_row, F.col("leader.id")).alias("first_key"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are their component's first by doc_id, and rows without doc_id.

    Of different texts of one doc_id within a component one stays.
    """
    (gone_key,) = free_names(docs, "gone_key")
    gone = _grouped(docs, words, percent).where("key <> first_key").select(F.col("key").alias(gone_key)).distinct()
    return docs.join(gone, row_key() == F.col(gone_key), "left_anti")
