"""Token counts of documents without their ids.

Every distinct pre-token of the corpus is encoded once. Per-document pre-token
frequencies meet these counts in two ways: the most frequent pre-tokens are few and of
a fixed total size, so their counts travel to the documents; all others travel to
their counts in a join by pre-token. Only sums come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketide.llm import pretokens
from marketide.llm.bpe import ENCODED_BYTES, text_batches
from marketide.llm.tables import kept, texts

#: Pre-tokens whose counts go to every task: 18 bytes each, 9 MB in all.
TRAVELLING = 1 << 19
#: Distinct pre-tokens a task gathers before it hands them on.
GATHERED = 200_000


def pretoken_frequencies(docs: DataFrame, path: str, special: bool = True) -> DataFrame:
    """pretoken and how often it occurs in all texts together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials = pretokens.encoder(path, special).specials
        found: dict[int, list] = {}

        def flush() -> pa.RecordBatch:
            columns = [pa.array([v[0] for v in found.values()], pa.string()), pa.array([v[1] for v in found.values()], pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["pretoken", "n"])

        for _, items in text_batches(batches, ENCODED_BYTES):
            batch = pretokens.split(items, specials)
            keys, where, counts = np.unique(batch.hashes ^ batch.checks, return_index=True, return_counts=True)
            for key, i, n in zip(keys.tolist(), where.tolist(), counts.tolist()):
                if (entry := found.get(key)) is None:
                    found[key] = [batch.text(i), n]
                else:
                    entry[1] += n
            if len(found) > GATHERED:
                yield flush()
        if found:
            yield flush()

    pieces = texts(docs).select("text").mapInArrow(run, "pretoken string, n long")
    return pieces.groupBy("pretoken").agg(F.sum("n").alias("n"))


def pretoken_counts(frequencies: DataFrame, path: str, special: bool = True) -> DataFrame:
    """pretoken, n, h and c (its two hashes) and the number of its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.encoder(path, special)
        for batch in batches:
            names = batch.column(0).to_pylist()
            if not names:
                continue
            _, lengths = encoder.pieces(names)
            sizes = np.fromiter(map(len, names), np.int64, len(names))
            points, starts = pretokens.code_points("".join(names)), np.cumsum(sizes) - sizes
            hashes = [h.view(np.int64) for h in pretokens.piece_hashes(points, starts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, hashes), pa.array(lengths, pa.int64())],
                ["pretoken", "n", "h", "c", "pieces"],
            )

    return frequencies.mapInArrow(run, "pretoken string, n long, h long, c long, pieces long")


def token_counts(docs: DataFrame, path: str, special: bool = True, travelling: int = TRAVELLING) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every text; null counts as empty.

    Counts are those of the tokenizers library without added tokens; special strings
    inside texts are one token each unless ``special`` is off. A doc_id that occurs in
    several rows (or null) gets one row per such row.
    """
    counts = kept(pretoken_counts(pretoken_frequencies(docs, path, special), path, special))
    known = _most_frequent(counts, travelling).select("h", "c", F.col("pieces").cast("int").alias("pieces")).toArrow()
    h = known["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    shared = docs.sparkSession.sparkContext.broadcast(
        (h[order], known["c"].to_numpy().view(np.uint64)[order], known["pieces"].to_numpy().astype(np.uint16)[order])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.encoder(path, special)
        h, c, pieces = shared.value
        for part, items in text_batches(batches, ENCODED_BYTES):
            batch = pretokens.split(items, encoder.specials)
            segments = len(batch.segments)
            unique, where, which = np.unique(batch.hashes, return_index=True, return_inverse=True)
            if len(h):
                at = np.minimum(np.searchsorted(h, unique), len(h) - 1)
                hit = (h[at] == unique) & (c[at] == batch.checks[where])
                size = np.where(hit, pieces[at], 0).astype(np.int64)
            else:
                hit, size = np.zeros(len(unique), bool), np.zeros(len(unique), np.int64)
            running = np.concatenate([[0], np.cumsum(size[which])])
            sums = np.diff(running[batch.edges])
            odd = np.zeros(segments, bool)
            for r in batch.odd:
                odd[r], sums[r] = True, len(encoder.texts_whole(batch.segments[r]))
            known = np.bincount(batch.owners, weights=sums, minlength=len(items)).astype(np.int64)
            if batch.gaps:
                known += np.bincount(batch.owners[[i for i, _ in batch.gaps]], minlength=len(items))
            # What no travelling count covers, once per text and pre-token.
            rare = np.flatnonzero(~hit[which])
            segment = np.searchsorted(batch.edges, rare, side="right") - 1
            rare, segment = rare[~odd[segment]], segment[~odd[segment]]
            owner = batch.owners[segment].astype(np.int64)
            pairs, first, times = np.unique(owner * len(unique) + which[rare], return_index=True, return_counts=True)
            names = [batch.text(i) for i in rare[first].tolist()]
            rows = owner[first]
            ids = part.column(part.schema.get_field_index("doc_id"))
            row = part.column(part.schema.get_field_index("row"))
            bytes_ = np.fromiter((len(t.encode()) for t in items), np.int64, len(items))
            none = pa.nulls(len(items), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([ids, ids.take(pa.array(rows))]),
                    pa.concat_arrays([row, row.take(pa.array(rows))]),
                    pa.concat_arrays([none, pa.array(names, pa.string())]),
                    pa.array(np.concatenate([known, times]), pa.int64()),
                    pa.array(np.concatenate([bytes_, np.zeros(len(rows), np.int64)]), pa.int64()),
                ],
                ["doc_id", "row", "pretoken", "n", "n_bytes"],
            )

    # Rows of one document carry one number, so that repeated ids stay apart.
    numbered = texts(docs).withColumn("row", F.monotonically_increasing_id())
    found = numbered.mapInArrow(run, "doc_id long, row long, pretoken string, n long, n_bytes long")
    return _sum_up(found, counts)


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """All pre-tokens from some frequency on, so that they are ``most`` or fewer."""
    # Eighths of a doubling: a few hundred classes whatever the corpus.
    level = F.floor(F.log2("n") * 8)
    short = counts.where(F.col("pieces") < 65_536)
    sizes = {r["level"]: r["count"] for r in short.groupBy(level.alias("level")).count().collect()}
    total, least = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    return short.where(level >= least if least is not None else F.lit(False))


def _sum_up(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums of known tokens and of frequency times pieces."""
    # A sum of known tokens finds no partner; a key of its own keeps these rows apart.
    sums = F.col("pretoken").isNull()
    keyed = found.withColumn("key", F.when(sums, F.xxhash64("row")).otherwise(F.xxhash64("pretoken")))
    other = counts.select(F.xxhash64("pretoken").alias("key"), "pretoken", "pieces")
    joined = keyed.join(other, ["key", "pretoken"], "left")
    value = F.when(sums, F.col("n")).otherwise(F.col("n") * F.col("pieces"))
    return (
        joined.groupBy("row", "doc_id")
        .agg(F.max("n_bytes").alias("n_bytes"), F.sum(value).alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens")
    )
