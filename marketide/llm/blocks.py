"""A stated set of queries against all vectors, in blocks of bounded size.

Vectors are numbered in some order and cut into blocks. A query is sent to the blocks
that it names; a task holds one block and lets its queries stream by. Blocks are dealt
over tasks in turn, and where there are fewer blocks than tasks each is copied for
several parts of its queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketide.llm.ordering import positions
from marketide.llm.tables import kept

#: Vectors in a block, and scores that a task has in hand at once.
BLOCK_ROWS, AT_ONCE = 4_096, 1 << 21
#: Queries below which a block is not copied for another part of them.
PART_QUERIES = 64
#: Whole numbers up to here are exact in double precision; scores up to there fit in 64 bits.
EXACT, FITS = 2.0**52, 2.0**62


def whole_vectors(vectors: DataFrame, scale: int, *more: Column) -> DataFrame:
    """vec_id, v (components times ``scale``, rounded down, as longs) and ``more`` of the rows that take part.

    Left out: null ids, null vectors, and those with null or non-finite components; rows
    where one of ``more`` is null. Of rows that repeat a vec_id, one stays: the least.
    Components beyond 64 bits count as the nearest number of 64 bits.
    """
    given = F.col("embedding").cast("array<double>")
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & given.isNotNull() & finite)
    for value in more:
        rows = rows.where(value.isNotNull())
    v = F.transform(given, lambda x: F.floor(x * scale).cast("long"))
    one = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(v.alias("v"), *more).alias("row"))
    return one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def squares() -> Column:
    """The squared length of v."""
    return F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def blocked(rows: DataFrame, *order: str, size: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with block: runs of ``size`` rows along ``order``, from 0."""
    placed = positions(kept(rows.withColumn("table", F.lit(0))), "table", *order)
    return kept(placed.withColumn("block", F.floor(F.col("position") / size)).drop("table", "position", "size"))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of each length in the batch: the length, their rows in the batch, and a matrix."""
    column = batch.column(batch.schema.get_field_index("v"))
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield length, at, flat.reshape(len(at), length)


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def lengths_of(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths of the rows, never too small."""
    wide = x.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", wide, wide)) * (1 + 1e-12)


def unbounded_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors of any size; those beyond 64 bits become the nearest number of 64 bits."""
    limits = np.iinfo(np.int64)
    exact = a.astype(object) @ b.T.astype(object) if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(exact, limits.min, limits.max).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray, reach: float) -> np.ndarray:
    """Exact inner products of whole vectors; ``reach`` bounds the product of their lengths."""
    if reach < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T if reach < FITS else unbounded_products(a, b)


def first(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of each row, best first, ties to smaller ids."""
    order = np.lexsort((ids, ~scores, row))  # ~x falls as x rises, and has no overflow
    found = row[order]
    return order[np.arange(len(found)) - np.searchsorted(found, found) < k]


def likely(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest scores and their ties."""
    n = scores.shape[1]
    if n <= k:
        return tuple(c.ravel() for c in np.indices(scores.shape))
    return np.nonzero(scores >= np.partition(scores, n - k, axis=1)[:, n - k, None])


def steps(rows: int, columns: int) -> Iterator[slice]:
    """Slices of rows whose scores against so many columns are in hand at once."""
    step = max(1, AT_ONCE // max(1, columns))
    return (slice(i, i + step) for i in range(0, rows, step))


def parts_for(queries: int, blocks: int, tasks: int) -> int:
    """Into how many parts the queries of each block are dealt, so that all tasks have work."""
    return max(1, min(-(-tasks // max(1, blocks)), queries // PART_QUERIES))


def meet(
    members: DataFrame, asked: DataFrame, parts: int, order: list[str],
    prepare: Callable[[pa.RecordBatch], object],
    answer: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """What ``answer`` gives for each block of ``members`` and the rows of ``asked`` that name it.

    ``prepare`` gets a whole block in ``order``; ``answer`` what it made of it and some of
    the block's queries, again and again.
    """
    there = members.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "asks": F.lit(False)})
    come = asked.withColumns({"part": F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"), "asks": F.lit(True)})
    both = there.unionByName(come, allowMissingColumns=True)
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["block", "part", "asks"]
    task = F.pmod(F.col("block") * parts + F.col("part"), F.lit(tasks)).cast("int")
    placed = both.repartitionById(tasks, task).sortWithinPartitions(*key, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, gathered, block = None, [], None
        for batch in batches:
            columns = [numbers(batch, name).astype(np.int64) for name in key]
            new = np.zeros(batch.num_rows, bool)
            new[:1] = True
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new).tolist()
            for lo, hi in zip(starts, [*starts[1:], batch.num_rows]):
                *name, asks = (int(c[lo]) for c in columns)
                if name != own:
                    own, gathered, block = name, [], None
                if not asks:
                    gathered.append(batch.slice(lo, hi - lo))
                elif gathered or block is not None:
                    if block is None:
                        block, gathered = prepare(pa.Table.from_batches(gathered).combine_chunks().to_batches()[0]), []
                    yield from answer(block, batch.slice(lo, hi - lo))

    return placed.mapInArrow(run, schema)
