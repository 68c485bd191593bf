"""Exact top-k search by inner product, in buckets of vectors of like length.

Vectors are ordered by length, longest first, and cut into buckets. The queries search
the first bucket, then ever longer runs of further ones; after each round a query's k-th
best score so far is its threshold. Divided by the lengths of the query and of the
bucket's longest vector it is a threshold for cosines, local to the bucket. Above 1 the
bucket is passed over. Where it is high, coordinates prune: a vector within that angle of
the query differs little from it in any coordinate, so only an interval of the bucket,
sorted by a coordinate, is looked at. Where it is low, lengths prune: only vectors long
enough to reach the threshold at all. What is left is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketide.llm import blocks
from marketide.llm.tables import kept

EVERY, NEAREST, SCALE = 100, 10, 1024
#: Cosine thresholds from here on are met by coordinates, lower ones by lengths.
COORDINATES_FROM = 0.8
#: Coordinates of a query (its largest) whose intervals are looked at.
FOCUS = 4
#: Each round searches so many times the buckets of all rounds before.
GROWTH = 16
#: Steps of the ladder of bucket lengths that queries are held against: a fixed size.
LADDER = 1_024
#: What rounding may add to a cosine.
SLACK = 1e-9

FOUND = "query_id long, vec_id long, score long"


class Bucket:
    """Vectors of one dimension in a bucket, longest first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        self.lengths = blocks.lengths_of(x)
        order = np.argsort(-self.lengths, kind="stable")
        self.ids, self.x, self.lengths = ids[order], x[order], self.lengths[order]
        self.longest = float(self.lengths[0])
        self.units = x[order] / np.maximum(self.lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The vectors in the order of a coordinate of their directions, and that coordinate."""
        if f not in self.lists:
            order = np.argsort(self.units[:, f], kind="stable")
            self.lists[f] = order, self.units[order, f]
        return self.lists[f]

    def within(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors that may be within this cosine of a direction: each focus coordinate lies in its interval."""
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        own = unit[focus]
        around = np.sqrt(max(0.0, 1 - cosine * cosine) * np.maximum(0.0, 1 - own * own))
        low = np.where(own <= -cosine, -2.0, own * cosine - around) - SLACK
        high = np.where(own >= cosine, 2.0, own * cosine + around) + SLACK
        spans = []
        for f, a, b in zip(focus.tolist(), low, high):
            values = self.by_coordinate(f)[1]
            spans.append((int(np.searchsorted(values, a)), int(np.searchsorted(values, b, side="right"))))
        least = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        found = self.by_coordinate(int(focus[least]))[0][slice(*spans[least])]
        near = self.units[found][:, focus]
        return found[((near >= low) & (near <= high)).all(axis=1)]

    def search(self, asking: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """Query, vec_id and score of at least all that may be among a query's ``k`` best and reach ``least``."""
        lengths = blocks.lengths_of(q)
        reach = np.maximum(lengths * self.longest, 1e-300)
        cosine = np.where(least > 0, least / reach, -1.0)
        out: list[tuple[np.ndarray, ...]] = []
        by_angle = (cosine >= COORDINATES_FROM) & (cosine <= 1 + SLACK)
        for i in np.flatnonzero(by_angle).tolist():
            at = self.within(q[i] / lengths[i], min(1.0, float(cosine[i])))
            if len(at):
                score = blocks.products(q[i:i + 1], self.x[at], float(reach[i]))[0]
                good = score >= least[i]
                out.append((np.full(int(good.sum()), i), at[good], score[good]))
        by_length = np.flatnonzero(cosine < COORDINATES_FROM)
        # Longer vectors first: those that can reach the threshold are the first so many.
        enough = np.where(least > 0, least / np.maximum(lengths, 1e-300) * (1 - SLACK), -1.0)
        counts = np.searchsorted(-self.lengths, -enough[by_length], side="right")
        by_length = by_length[np.argsort(-counts, kind="stable")]
        counts = np.sort(counts)[::-1]
        for part in blocks.steps(len(by_length), int(counts[0]) if len(counts) else 1):
            rows, some = by_length[part], int(counts[part][0])
            if not some:
                break
            score = blocks.products(q[rows], self.x[:some], float(reach[rows].max()))
            own = asking[rows][:, None] == self.ids[None, :some]
            # The query's own row may be among the best, so one more is taken.
            row, at = blocks.likely(score, k + 1)
            good = (score[row, at] >= least[rows][row]) & ~own[row, at]
            row, at = row[good], at[good]
            out.append((rows[row], at, score[row, at]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, at, score = (np.concatenate(c) for c in zip(*out))
        good = asking[row] != self.ids[at]
        row, at, score = row[good], at[good], score[good]
        best = blocks.first(row, self.ids[at], score, k)
        return asking[row[best]], self.ids[at[best]], score[best]


def _prepare(batch: pa.RecordBatch) -> dict[int, Bucket]:
    ids = blocks.numbers(batch, "vec_id")
    return {length: Bucket(ids[at], x) for length, at, x in blocks.matrices(batch)}


def _answer(k: int):
    def answer(buckets: dict[int, Bucket], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, least = blocks.numbers(batch, "vec_id"), blocks.numbers(batch, "least")
        for length, at, q in blocks.matrices(batch):
            if length in buckets:
                # No threshold yet: anything goes.
                known = np.nan_to_num(least[at].astype(np.float64), nan=-np.inf)
                found = buckets[length].search(ids[at], q, known, k)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["query_id", "vec_id", "score"])

    return answer


def best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` highest scores."""
    near = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(near).cast("int")).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, every: int = EVERY, k: int = NEAREST, scale: int = SCALE,
    bucket_rows: int = blocks.BLOCK_ROWS, growth: int = GROWTH,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` highest inner products of every ``every``-th vec_id.

    Components are multiplied by ``scale`` and rounded down, so scores are whole numbers
    (the nearest number of 64 bits, if beyond); ties go to the smaller vec_id. All other
    rows are candidates. See ``whole_vectors`` for the rows that take part; vectors of
    another length than the query's have no product with it. A query without candidates
    has no rows.
    """
    rows = blocks.whole_vectors(vectors, scale).withColumn("shortness", -blocks.squares())
    members = blocks.blocked(rows, "shortness", "vec_id", size=bucket_rows).withColumn("length", F.sqrt(-F.col("shortness")))
    queries = kept(members.where(F.col("vec_id") % every == 0).select("vec_id", "v", "length"))
    members = members.select("block", "vec_id", "v", "length")
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asking = queries.count()
    last = members.agg(F.max("block")).first()[0]
    buckets = 0 if last is None else last + 1
    found, lo, hi = None, 0, 1
    while lo < buckets or found is None:
        hi = min(hi, buckets)
        asked = queries.withColumn("least", F.lit(None).cast("long"))
        if found is not None:
            known = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
            asked = queries.join(known.select(F.col("query_id").alias("vec_id"), "least"), "vec_id", "left")
        visits = asked.withColumn("visits", _visits(members, lo, hi)).where("visits > 0")
        sent = visits.select("vec_id", "v", "least", F.explode(F.sequence(F.lit(lo), F.col("visits") + (lo - 1))).alias("block"))
        now = blocks.meet(
            members.where(F.col("block").between(lo, hi - 1)).drop("length"), sent, blocks.parts_for(asking, hi - lo, tasks),
            ["vec_id"], _prepare, _answer(k), FOUND,
        )
        found = kept(best(now if found is None else found.select("query_id", "vec_id", "score").union(now), k))
        lo, hi = hi, hi * (1 + growth)
    return found.select("query_id", "rank", "vec_id", "score")


def _visits(members: DataFrame, lo: int, hi: int):
    """How many of the buckets from ``lo`` to ``hi`` (excluded) a query must search.

    Buckets are in the order of their lengths, so these are the first so many. Lengths of
    at most LADDER of them are looked at, in equal steps.
    """
    step = max(1, -(-(hi - lo) // LADDER))
    some = members.where(F.col("block").between(lo, hi - 1) & ((F.col("block") - lo) % step == 0))
    longest = sorted((r[0] for r in some.groupBy("block").agg(F.max("length")).select("max(length)").collect()), reverse=True)
    if not longest:
        return F.lit(0)
    reachable = F.size(F.filter(F.lit(longest), lambda x: x * F.col("length") * (1 + SLACK) >= F.col("least")))
    return F.least(F.when(F.col("least").isNull(), hi - lo).otherwise(reachable * step), F.lit(hi - lo))
