"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are projected to a few dimensions and ordered along a Hilbert curve, several
times with other projections and shifts. Each ordering is range-partitioned; near
vectors are mostly near in some ordering. Around every query a window of neighbours in
each ordering is ranked by cosine, and the orderings' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketide.llm.pretokens import mix
from marketide.llm.tables import kept

#: Orderings, dimensions and bits per dimension of a curve; so many of the bits make one column of the key.
ORDERINGS, DIMENSIONS, BITS, LEVELS = 36, 6, 30, 10
#: Least and most rows in a block of an ordering, and the part of all vectors that a block holds in between.
BLOCK, MOST_BLOCK, SHARE = 512, 1 << 15, 100
KEYS = ["key", *(f"key{i}" for i in range(1, BITS // LEVELS)), "tie"]
#: Scores a task has in hand at once.
AT_ONCE = 1 << 22
EVERY, NEAREST = 50, 5


def hilbert_digits(at: np.ndarray, bits: int) -> np.ndarray:
    """Transposed index on the Hilbert curve of each row of cells (whole numbers below 2^bits).

    It is made by undoing excess rotations from the highest bit down and Gray-coding.
    """
    x = at.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip
    return x


def interleaved(digits: np.ndarray, high: int, low: int = 0) -> np.ndarray:
    """The bits from below ``high`` down to ``low`` of all dimensions as one number."""
    key = np.zeros(digits.shape[1], np.int64)
    for bit in range(high - 1, low - 1, -1):
        for row in digits:
            key = (key << 1) | ((row >> bit) & 1)
    return key


def hilbert_keys(at: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells, as one number."""
    return interleaved(hilbert_digits(at, bits), bits)


def curve_keys(x: np.ndarray, ids: np.ndarray, ordering: int) -> list[np.ndarray]:
    """KEYS of unit vectors: their place on the curve, coarse bits first, and a hash of id and ordering."""
    digits = hilbert_digits(cells(x, ordering), BITS)
    keys = [interleaved(digits, high, high - LEVELS) for high in range(BITS, 0, -LEVELS)]
    return [*keys, mix(ids.view(np.uint64) + np.uint64(ordering << 40)).view(np.int64)]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part.

    Left out: null ids, null or empty or all-zero vectors, and those with null or
    non-finite components. Of rows that repeat a vec_id, one vector stays: the least.
    Vectors of another length than most are compared with those of their own length only.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & finite & some)
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(v).alias("embedding"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, length)


def _units(column: pa.Array, length: int) -> np.ndarray:
    x = _matrix(column, length)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _projection(length: int, ordering: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((length, ordering))
    axes = np.linalg.qr(rng.normal(size=(length, DIMENSIONS)))[0].T if length >= DIMENSIONS else rng.normal(size=(DIMENSIONS, length))
    return axes, rng.uniform(0, 1, len(axes))


def cells(x: np.ndarray, ordering: int) -> np.ndarray:
    """Cells of unit vectors (rows) in an ordering's projection."""
    length = x.shape[1]
    axes, shift = _projection(length, ordering)
    # Projections of unit vectors mostly lie within three of 1 / sqrt(length); the
    # shift moves them by up to half of that range.
    across = (x @ axes.T) * np.sqrt(length) / 3
    return np.clip(np.floor((across + 1 + shift) / 3 * (1 << BITS)), 0, (1 << BITS) - 1)


CURVE = f"ordering long, {', '.join(f'{k} long' for k in KEYS)}, vec_id long"


def curves(rows: DataFrame, orderings: int) -> DataFrame:
    """A row for every vector and ordering: its key on the curve. The vectors stay behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == length))
                x = _units(part.column(1), length)
                ids = part.column(0).to_numpy()
                for ordering in range(orderings):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(x), length * 1000 + ordering)), *map(pa.array, curve_keys(x, ids, ordering)),
                            part.column(0),
                        ],
                        ["ordering", *KEYS, "vec_id"],
                    )

    return rows.select("vec_id", "embedding").mapInArrow(run, CURVE)


def window(vectors: int) -> tuple[int, int]:
    """Rows in a block, and how many blocks on either side of a query's own are searched.

    Neighbours of vectors without clusters are spread over a fixed share of every ordering,
    so the window grows with the number of vectors: by larger blocks, then by more of them.
    """
    wanted = -(-vectors // SHARE)
    block = min(max(BLOCK, wanted), MOST_BLOCK)
    return block, max(1, -(-wanted // block))


def numbered(keyed: DataFrame, tasks: int, size: int) -> DataFrame:
    """Each row's block: ``size`` neighbours along its ordering, numbered through.

    Rows are range-partitioned along all orderings; each task numbers its own rows, and
    the numbers of rows in earlier tasks (one figure per task) are added.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rank = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(rank, rank + n))],
                ["ordering", "vec_id", "part", "rank"],
            )
            rank += n

    order = ["ordering", *KEYS, "vec_id"]
    placed = keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop(*KEYS)
    ranked = kept(
        placed.mapInArrow(count, "ordering long, vec_id long, part int, rank long")
    )
    sizes = ranked.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return ranked.join(bases, "part").select(
        "ordering", "vec_id", F.floor((F.col("base") + F.col("rank")) / size).alias("block")
    )


def _best(queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """For each query its k nearest of the block by unit vectors, as (query, vec_id, score) arrays.

    ``ids`` ascend. More than k are given where scores tie with the k-th.
    """
    score = np.minimum(q @ x.T, 1)
    score[queries[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        row, top = np.nonzero(score >= np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k, None])
    else:
        row, top = np.nonzero(np.isfinite(score))
    # Ties go to the smaller id.
    order = np.lexsort((top, -score[row, top], row))
    row, top = row[order], top[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    good = (place < k) & np.isfinite(score[row, top])
    row, top = row[good], top[good]
    return queries[row], ids[top], score[row, top]


def directions(rows: DataFrame, every: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Vectors of one direction reduced to one, and the queries.

    The first: rep (its smallest vec_id), vec_id and unit of the k + 1 smallest vec_ids of
    each direction; a query and its k nearest are never answered by more. The second:
    query_id and rep of every ``every``-th vec_id.
    """
    v = F.col("embedding")
    largest = F.array_max(F.transform(v, F.abs))
    # Dividing by the largest component also keeps very large and small ones in range; adding 0.0 turns -0.0 into 0.0.
    turned = kept(rows.select("vec_id", F.transform(v, lambda x: x / largest + F.lit(0.0)).alias("unit")))
    own = Window.partitionBy("unit").orderBy("vec_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = turned.select("vec_id", "unit", F.row_number().over(own).alias("n"), F.min("vec_id").over(own).alias("rep"))
    members = kept(first.where(F.col("n") <= k + 1).select("rep", "vec_id", "unit"))
    reps = members.where("rep = vec_id").select("rep", "unit")
    asked = turned.where(F.col("vec_id") % every == 0).join(reps, "unit")
    return members, kept(asked.select(F.col("vec_id").alias("query_id"), "rep"))


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, orderings: int = ORDERINGS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest found for every ``every``-th vec_id.

    The score is the cosine of the vectors in double precision; ties go to the smaller
    vec_id. See ``usable`` for which rows take part; a query alone has no rows.
    """
    members, queries = directions(usable(vectors), every, k)
    asking = queries.select("rep", F.lit(True).alias("asks")).distinct()
    rows = kept(members.where("rep = vec_id").join(asking, "rep", "left").select(
        F.col("rep").alias("vec_id"), F.col("unit").alias("embedding"), F.coalesce("asks", F.lit(False)).alias("asks")
    ))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size, reach = window(rows.count())
    places = numbered(curves(rows, orderings), tasks, size).groupBy("vec_id").agg(
        F.collect_list(F.struct("ordering", "block")).alias("places")
    )
    # A vector meets all its places at once, so that it is copied by the last shuffle alone.
    blocks = rows.join(places, "vec_id").select("vec_id", "asks", "embedding", F.inline("places"))
    asked = blocks.where("asks").withColumn(
        "block", F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach))
    )
    there = blocks.withColumn("asks", F.lit(False))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        asks = table["asks"].to_numpy()
        queries, members = table.filter(pa.array(asks)).combine_chunks(), table.filter(pa.array(~asks)).combine_chunks()
        length = key[0].as_py() // 1000
        out = [[], [], []]
        if queries.num_rows and members.num_rows:
            q, x = (_units(t["embedding"].combine_chunks(), length) for t in (queries, members))
            asking, ids = queries["vec_id"].to_numpy(), members["vec_id"].to_numpy()
            step = max(1, AT_ONCE // len(ids))
            parts = [_best(asking[i:i + step], q[i:i + step], ids, x, k) for i in range(0, len(asking), step)]
            out = [np.concatenate(c) for c in zip(*parts)]
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    # A block has a bounded number of members, and the queries of the blocks within reach.
    found = asked.unionByName(there).groupBy("ordering", "block").applyInArrow(run, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _ranked(merged, members, queries, k)


def _ranked(found: DataFrame, members: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each query, every direction found standing for its vec_ids."""
    near = lambda of: F.row_number().over(Window.partitionBy(of).orderBy(F.desc("score"), "vec_id"))
    close = found.withColumn("n", near("query_id")).where(F.col("n") <= k)
    own = queries.select(F.col("rep").alias("asking")).distinct()
    both = close.select(F.col("query_id").alias("asking"), F.col("vec_id").alias("rep"), "score").unionByName(
        own.select("asking", F.col("asking").alias("rep"), F.lit(1.0).alias("score"))
    )
    each = both.join(members.select("rep", "vec_id"), "rep").withColumn("n", near("asking")).where(F.col("n") <= k + 1)
    answers = queries.withColumnRenamed("rep", "asking").join(each.select("asking", "vec_id", "score"), "asking")
    scored = answers.where("vec_id <> query_id").withColumn("rank", near("query_id"))
    return scored.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
