"""Hard negatives by exact scores: the best of other labels within a window below each positive.

All scores are inner products of whole vectors, computed in single precision: the
components are reduced modulo several small primes, and the residue matrices are
multiplied one prime after the other. Products of residues stay below 2^24, so they are
exact; Chinese remaindering (in mixed radix, with signed digits) puts the signed score
together. There are as many primes as the lengths of the vectors ask for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketide.llm import blocks
from marketide.llm.tables import kept

EVERY, POSITIVES, NEGATIVES, SCALE = 50, 5, 3, 256
#: Components multiplied at once: so many products of two residues of half a prime stay below 2^24.
CHUNK = 64
LARGEST = 2 * int((2**24 / CHUNK) ** 0.5)


def primes() -> Iterator[int]:
    """Odd primes below LARGEST, largest first."""
    return (p for p in range(LARGEST - 1, 2, -1) if all(p % d for d in range(2, int(p**0.5) + 1)))


def moduli(reach: float) -> list[int]:
    """So many primes that every whole number up to ``reach`` in size has residues of its own."""
    out, product = [], 1
    for p in primes():
        out.append(p)
        product *= p
        if product > 2 * reach + 1:
            break
    return out


def signed(x: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo an odd p from -(p-1)/2 to (p-1)/2."""
    half = p // 2
    return np.remainder(x + half, p) - half


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, of matrices of signed residues in single precision."""
    out = None
    for i in range(0, a.shape[1], CHUNK):
        part = signed((a[:, i:i + CHUNK] @ b[:, i:i + CHUNK].T).astype(np.int32), p)
        out = part if out is None else signed(out + part, p)
    return np.zeros((len(a), len(b)), np.int32) if out is None else out


def remaindered(residues: list[np.ndarray], of: list[int]) -> np.ndarray:
    """The signed numbers with these residues.

    The digits of a mixed radix are found one after the other; a sum that needs more than
    64 bits on the way wraps around and comes out right, as the number itself fits.
    """
    digits: list[np.ndarray] = []
    total = np.zeros(residues[0].shape, np.int64)
    weight = 1
    for r, p in zip(residues, of):
        rest, step = r.astype(np.int64), 1
        for digit, q in zip(digits, of):
            rest = rest - digit * step
            step = step * q % p
        digit = signed(signed(rest, p) * pow(step, -1, p), p)
        digits.append(digit)
        wrapped = weight & (1 << 64) - 1
        total = total + digit * np.array(wrapped, np.uint64).astype(np.int64)
        weight *= p
    return total


class Residues:
    """Whole vectors (rows) and their residue matrices, each made when it is first asked for."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.longest = float(blocks.lengths_of(x).max(initial=0.0))
        self.by_prime: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.by_prime:
            # The remainder comes first, so that large components do not overflow.
            self.by_prime[p] = signed(np.remainder(self.x, p), p).astype(np.float32)
        return self.by_prime[p]

    def scores(self, other: Residues, rows: slice = slice(None), columns: slice = slice(None)) -> np.ndarray:
        """Inner products of ``rows`` here and ``columns`` there."""
        reach = self.longest * other.longest
        if reach >= blocks.FITS:
            return blocks.unbounded_products(self.x[rows], other.x[columns])
        of = moduli(reach)
        found = [residue_product(self.modulo(p)[rows], other.modulo(p)[columns], p) for p in of]
        return remaindered(found, of)


class Block:
    """Vectors of one dimension in a block, by label and vec_id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.vectors = ids[order], labels[order], Residues(x[order])


def _prepare(batch: pa.RecordBatch) -> dict[int, Block]:
    ids, labels = blocks.numbers(batch, "vec_id"), blocks.numbers(batch, "label")
    return {n: Block(ids[at], labels[at], x) for n, at, x in blocks.matrices(batch)}


def _same_label(k: int):
    """anchor_id, vec_id, score: the ``k`` best of each anchor's label."""

    def answer(there: dict[int, Block], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels = blocks.numbers(batch, "vec_id"), blocks.numbers(batch, "label")
        for n, at, q in blocks.matrices(batch):
            if n not in there:
                continue
            block, asking = there[n], Residues(q)
            for label in np.unique(labels[at]).tolist():
                same = slice(*np.searchsorted(block.labels, [label, label + 1]).tolist())
                own = np.flatnonzero(labels[at] == label)
                if same.start == same.stop:
                    continue
                members = block.ids[same]
                for part in blocks.steps(len(own), len(members)):
                    rows = own[part]
                    scores = asking.scores(block.vectors, rows, same)
                    # The anchor itself may be among the best, so one more is taken.
                    row, column = blocks.likely(scores, k + 1)
                    score = scores[row, column]
                    other = ids[at[rows[row]]] != members[column]
                    row, column, score = row[other], column[other], score[other]
                    best = blocks.first(row, members[column], score, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at[rows[row[best]]]]), pa.array(members[column[best]]), pa.array(score[best])],
                        ["anchor_id", "vec_id", "score"],
                    )

    return answer


def windows(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative: low * positive <= 100 * score <= high * positive.

    ``low`` and ``high`` are per cent; divisions come first, so nothing overflows.
    """
    whole, rest = positive // 100, positive % 100
    return whole * low - (-(rest * low) // 100), whole * high + rest * high // 100


def _other_labels(k: int, low: int, high: int):
    """anchor_id, nth (of the positives), vec_id, score: the ``k`` best within each positive's window."""

    def answer(there: dict[int, Block], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels = blocks.numbers(batch, "vec_id"), blocks.numbers(batch, "label")
        column = batch.column(batch.schema.get_field_index("positive_scores"))
        counts = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(counts)
        least, most = windows(flat, low, high)
        for n, at, q in blocks.matrices(batch):
            if n not in there:
                continue
            block, asking = there[n], Residues(q)
            for part in blocks.steps(len(at), len(block.ids)):
                own = at[part]
                scores = asking.scores(block.vectors, part)
                foreign = labels[own][:, None] != block.labels[None, :]
                for nth in range(int(counts[own].max(initial=0))):
                    some = np.flatnonzero(counts[own] > nth)
                    place = (ends - counts)[own[some]] + nth
                    inside = foreign[some] & (scores[some] >= least[place][:, None]) & (scores[some] <= most[place][:, None])
                    row, at_block = np.nonzero(inside)
                    score = scores[some[row], at_block]
                    best = blocks.first(row, block.ids[at_block], score, k)
                    m = len(best)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[own[some[row[best]]]]), pa.array(np.full(m, nth, np.int32)),
                            pa.array(block.ids[at_block[best]]), pa.array(score[best]),
                        ],
                        ["anchor_id", "nth", "vec_id", "score"],
                    )

    return answer


def best(found: DataFrame, k: int, *of: str) -> DataFrame:
    """``found`` with rank: the ``k`` highest scores of each ``of``, ties to the smaller vec_id."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, label: Column | None = None, every: int = EVERY, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = 50, high: int = 95, scale: int = SCALE, block_rows: int = blocks.BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Anchors are the rows with every ``every``-th vec_id; an anchor's positives are the
    ``positives`` other rows of its label with the highest scores, and for each of them
    come the ``negatives`` best rows of other labels whose score is from ``low`` to
    ``high`` per cent of the positive's. Scores are inner products of components times
    ``scale``, rounded down; ties go to the smaller vec_id. Anchors without positives, and
    positives with nothing in their window (so all with a score below 0), have no rows.

    ``label`` stands for the column label. Rows with a null label take no part, nor those
    that ``whole_vectors`` leaves out; vectors of another length have no score.
    """
    named = (F.col("label") if label is None else label).cast("long").alias("label")
    rows = blocks.whole_vectors(vectors, scale, named)
    members = blocks.blocked(rows, "label", "vec_id", size=block_rows).select("block", "vec_id", "label", "v")
    anchors = kept(members.where(F.col("vec_id") % every == 0).select("vec_id", "label", "v"))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count, (last,) = anchors.count(), members.agg(F.max("block")).first()
    parts = blocks.parts_for(count, (last or 0) + 1, tasks)
    # A label's rows stand in consecutive blocks.
    spans = members.groupBy("label").agg(F.min("block").alias("from"), F.max("block").alias("to"))
    same = anchors.join(spans, "label").select("vec_id", "label", "v", F.explode(F.sequence("from", "to")).alias("block"))
    order = ["label", "vec_id"]
    found = blocks.meet(members, same, parts, order, _prepare, _same_label(positives), "anchor_id long, vec_id long, score long")
    near = kept(best(found, positives, "anchor_id"))
    lists = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))
    asking = kept(anchors.join(lists, anchors["vec_id"] == lists["anchor_id"]).select(
        "vec_id", "label", "v", F.col("near.score").alias("positive_scores")
    ))
    everywhere = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last or 0).cast("long"))))
    hard = blocks.meet(
        members, everywhere, parts, order, _prepare, _other_labels(negatives, low, high),
        "anchor_id long, nth int, vec_id long, score long",
    )
    chosen = best(hard, negatives, "anchor_id", "nth")
    of = near.select("anchor_id", (F.col("rank") - 1).alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(of, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
