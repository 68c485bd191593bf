"""Fuzzy duplicate lines across documents, by MinHash.

A line is compared without case and with single spaces. Its character shingles give
BANDS x ROWS minima of hash functions; lines that agree in a whole band meet, and exact
Jaccard similarity of the shingle sets decides. Union-find joins the links, and of every
component the first line in (doc_id, line number) stays.

A line is known by a 64-bit hash of its normal form: among 1e9 distinct lines 0.03
pairs of different lines are expected to share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketide.llm import linking, pretokens
from marketide.llm.bpe import text_batches
from marketide.llm.packed import scratch
from marketide.llm.tables import BATCH_BYTES, free_names, kept, texts
from marketide.session import remove

SHINGLE = 8
PERCENT = 80
#: A pair of similarity 0.8 meets with probability 0.995, one of 0.2 with 0.016.
BANDS, ROWS = 10, 4
#: Shingles hashed at once, so that they stay in the cache.
AT_ONCE = 1 << 16
#: Lines a task remembers, to give each line's bands once.
SEEN = 1_000_000

_RNG = np.random.default_rng(11)
_FACTORS = _RNG.integers(1, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_PLACES = _RNG.integers(1, 1 << 62, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)


def normal(line: str) -> str:
    if line.isascii() and line.isprintable() and "  " not in line:
        # The only white space are single spaces.
        return line.lower().strip(" ")
    return " ".join(line.lower().split())


def line_ids(lines: list[str]) -> np.ndarray:
    """A 64-bit hash of every line."""
    return np.frombuffer(b"".join(hashlib.blake2b(x.encode(), digest_size=8).digest() for x in lines), np.int64)


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all SHINGLE characters in a row (fewer are one shingle), and where each line's begin."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    # Zeros after a line fill up what is short; they are no characters.
    filled = [t + "\0" * (SHINGLE - len(t)) if len(t) < SHINGLE else t for t in lines]
    points = pretokens.code_points("".join(filled))
    values = np.zeros(max(0, len(points) - SHINGLE + 1), np.uint64)
    for lo in range(0, len(values), AT_ONCE >> 2):
        own = values[lo:lo + (AT_ONCE >> 2)]
        near = points[lo:lo + len(own) + SHINGLE - 1].astype(np.uint64)
        term = np.empty_like(own)
        for i in range(SHINGLE):
            own += np.multiply(near[i:i + len(own)], _PLACES[i], out=term)
        own[:] = pretokens.mix(own)
    full = np.maximum(sizes, SHINGLE)
    counts = full - SHINGLE + 1
    starts = np.cumsum(full) - full
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return values[at], np.cumsum(counts) - counts


def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every line the least value under each hash function; lines are taken in cached blocks."""
    out = np.empty((len(_FACTORS), len(starts)), np.uint32)
    small = (values >> np.uint64(32)).astype(np.uint32)
    ends = np.append(starts[1:], len(values))
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + AT_ONCE, side="right")))
        part = small[starts[lo]:ends[hi - 1]]
        own = starts[lo:hi] - starts[lo]
        buffer = np.empty_like(part)
        for i, factor in enumerate(_FACTORS):
            np.multiply(part, factor, out=buffer)
            out[i, lo:hi] = np.minimum.reduceat(buffer, own)
        lo = hi
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and line."""
    keys = np.zeros((BANDS, least.shape[1]), np.uint64)
    for band in range(BANDS):
        for row in range(ROWS):
            keys[band] = pretokens.mix(keys[band] * np.uint64(31) + least[band * ROWS + row] + np.uint64(band + 1))
    return keys.view(np.int64)


def split_lines(items: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Text and number of every line that is not blank, and its normal form."""
    owner, number, lines = [], [], []
    for i, text in enumerate(items):
        for j, line in enumerate(text.split("\n")):
            if line := normal(line):
                owner.append(i)
                number.append(j)
                lines.append(line)
    return np.array(owner, np.int64), np.array(number, np.int32), lines


def text_key() -> Column:
    """With doc_id it tells rows apart whose texts differ; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key")


def known_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line (from 0), id and normal form of every line that is not blank.

    A task gives the normal form with a line's first row, as far as it remembers; null later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part, items in text_batches(batches):
            owner, number, lines = split_lines(items)
            if not lines:
                continue
            ids = line_ids(lines)
            distinct, first = np.unique(ids, return_index=True)
            old = np.ones(len(ids), bool)
            old[first] = [x in seen for x in distinct.tolist()]
            if len(seen) > SEEN:
                seen.clear()
            seen.update(distinct.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    *part.select([0, 2]).take(pa.array(owner)).columns, pa.array(number), pa.array(ids),
                    pa.array(lines, pa.string(), mask=old),
                ],
                ["doc_id", "text_key", "place", "id", "text"],
            )

    found = texts(docs, text_key()).mapInArrow(run, "doc_id long, text_key long, place int, id long, text string")
    return found.withColumnRenamed("place", "line")


def stored_lines(docs: DataFrame, path: str) -> DataFrame:
    """``known_lines``, found once; later plans read the columns they need of it."""
    known_lines(docs).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema("doc_id long, text_key long, line int, id long, text string").parquet(path)


def normal_forms(known: DataFrame) -> DataFrame:
    return known.where("text IS NOT NULL").select("id", "text")


def padded_sets(values: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which lines of ``shingles``, their shingles in the order of values and which of these are the first of their value.

    Lines of about one length come together, as rows of one table; rows are filled up with copies of their last shingle.
    """
    counts = np.diff(starts, append=len(values))
    order = np.argsort(counts, kind="stable")
    ordered = counts[order]
    lo = 0
    while lo < len(order):
        # Up to a quarter more shingles than the shortest, and a table that stays in the cache.
        most = int(ordered[lo]) * 5 // 4
        hi = int(np.searchsorted(ordered, most, side="right"))
        hi = min(hi, lo + max(1, AT_ONCE // max(1, most)))
        rows = order[lo:hi]
        width = int(ordered[hi - 1])
        at = starts[rows][:, None] + np.minimum(np.arange(width), counts[rows][:, None] - 1)
        table = np.sort(values[at], axis=1)
        first = np.ones(table.shape, bool)
        np.not_equal(table[:, 1:], table[:, :-1], out=first[:, 1:])
        yield rows, table, first
        lo = hi


def sizes_and_signatures(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and ``linking.signatures`` of the shingle set of every line of ``shingles``."""
    sizes, s0, s1 = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for rows, table, first in padded_sets(values, starts):
        sizes[rows] = np.count_nonzero(first, axis=1)
        bit = np.left_shift(first.view(np.uint8), table & np.uint64(63))
        both = np.bitwise_xor.reduce(bit, axis=1)
        bit *= (table >> np.uint64(6)) & np.uint64(1)
        s1[rows] = np.bitwise_xor.reduce(bit, axis=1)
        s0[rows] = both ^ s1[rows]
    return sizes, s0.view(np.int64), s1.view(np.int64)


def overlaps(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the shingle sets of each pair of lines, and how many shingles they share."""
    names = {line: i for i, line in enumerate(dict.fromkeys([*left, *right]))}
    sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(names)
    for rows, table, first in padded_sets(*shingles(list(names))):
        for i, values, stay in zip(rows.tolist(), table, first):
            sets[i] = values[stay]
    shared = []
    for a, b in zip(left, right):
        both = np.concatenate([sets[names[a]], sets[names[b]]])
        both.sort()
        shared.append(np.count_nonzero(both[1:] == both[:-1]))
    sizes = [np.fromiter((len(sets[names[x]]) for x in side), np.int64, len(side)) for side in (left, right)]
    return *sizes, np.array(shared, np.int64)


def similar(pairs: DataFrame, known: DataFrame, percent: int, there: DataFrame | None = None) -> DataFrame:
    """``linking.verify`` for lines: the sets of a batch are made together, each once.

    ``there``: rows of ``sets_of`` for all ids of the pairs, if there are any already; else ``known`` is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(sum(pc.binary_length(batch.column(i)).to_numpy().astype(np.int64) for i in (2, 3)))
            lo = 0
            while lo < len(ends):
                before = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")))
                part = batch.slice(lo, hi - lo)
                a, b, both = overlaps(part.column(2).to_pylist(), part.column(3).to_pylist())
                yield part.select([0, 1]).filter(pa.array(100 * both >= percent * (a + b - both)))
                lo = hi

    if there is None:
        found = sets_of(known, linking.ids_of(pairs), False)
    else:
        found = there.select("id", F.col("payload").cast("string").alias("text"))
    return linking.with_both(pairs, found, "text").mapInArrow(run, "a long, b long").distinct()


def tiles(known: DataFrame) -> DataFrame:
    """One tile row for every band of every line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lines in text_batches(batches):
            ids = part.column(0)
            values, starts = shingles(lines)
            keys = band_keys(minima(values, starts))
            size, s0, s1 = map(pa.array, sizes_and_signatures(values, starts))
            place = pa.array(np.zeros(len(lines), np.int32))
            for band in range(BANDS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[band]), ids, size, place, s0, s1], ["key", "id", "size", "place", "s0", "s1"]
                )

    return normal_forms(known).mapInArrow(run, linking.TILE)


def sets_of(known: DataFrame, wanted: np.ndarray, wide: bool = True) -> DataFrame:
    """The shingle sets of the lines whose id passes the bitmap, or (not ``wide``) their normal forms."""
    shared = known.sparkSession.sparkContext.broadcast(wanted)

    @F.arrow_udf("boolean")
    def passes(ids: pa.Array) -> pa.Array:
        return pa.array(linking.passes(shared.value, ids.to_numpy(zero_copy_only=False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lines in text_batches(batches):
            sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(lines)
            for rows, table, first in padded_sets(*shingles(lines)):
                for i, values, stay in zip(rows.tolist(), table, first):
                    sets[i] = values[stay]
            yield linking.set_rows(part.column(0), sets, [x.encode() for x in lines])

    # A line that many tasks have comes once from each.
    found = normal_forms(known.where(passes("id"))).groupBy("id").agg(F.min("text").alias("text"))
    return found.mapInArrow(run, linking.SETS) if wide else found


def line_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, line, component, keep_doc_id, keep_line and kept of every line that is not blank.

    Lines of a component are similar, directly or over others; keep_doc_id and keep_line
    name the first of them. Blank lines, null and empty texts have no row. Rows that
    repeat a doc_id with another text are told apart by their text_key; rows that repeat
    both share their verdicts. Rows without doc_id come first.
    """
    path = scratch(docs.sparkSession, "lines")
    lines = stored_lines(docs, path)
    found = linking.link(
        tiles(lines), partial(sets_of, lines), percent, 100, check=lambda pairs, there: similar(pairs, lines, percent, there)
    )
    place = ["doc_id", "line", "text_key"]
    named = kept(lines.join(found, "id", "left").select(*place, F.coalesce("component", "id").alias("component")))
    remove(docs.sparkSession, path)
    first = named.groupBy("component").agg(F.min(F.struct(*place)).alias("first"))
    return named.join(first, "component").select(
        "doc_id", "text_key", "line", "component",
        F.col("first.doc_id").alias("keep_doc_id"), F.col("first.line").alias("keep_line"),
        F.struct(*place).eqNullSafe(F.col("first")).alias("kept"),
    )


def dropped_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key and the numbers of a text's lines that do not stay, in order; only texts that lose some."""
    gone = line_components(docs, percent).where("NOT kept").select("doc_id", "text_key", "line").distinct()
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list("line")).alias("dropped"))


def _with_dropped(rows: DataFrame, docs: DataFrame, percent: int, doc_id: str, key: str, dropped: str) -> DataFrame:
    """``rows`` with the dropped lines of the text that ``doc_id`` and ``key`` name; null if there are none."""
    gone_id, gone_key = free_names(rows, "gone_id", "gone_key")
    gone = dropped_lines(docs, percent).toDF(gone_id, gone_key, dropped)
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key))
    return rows.join(gone, same, "left").drop(gone_id, gone_key)


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the dropped lines taken out of text; everything else stays, null texts too."""
    key, dropped = free_names(docs, "text_key", "dropped")
    joined = _with_dropped(docs.withColumn(key, text_key()), docs, percent, "doc_id", key, dropped)
    lines = F.split(F.col("text"), "\n", -1)
    rest = F.filter(lines, lambda x, i: ~F.array_contains(dropped, i))
    text = F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return joined.withColumn("text", text).select(docs.columns)


def line_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_lines (blank ones too; 0 for a null or empty text) and the dropped line numbers per row."""
    ends = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    count = F.when(F.coalesce(F.length("text"), F.lit(0)) > 0, ends + 1).otherwise(0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), count.cast("long").alias("n_lines"), text_key())
    joined = _with_dropped(rows, docs, percent, "doc_id", "text_key", "dropped")
    return joined.select("doc_id", "n_lines", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
