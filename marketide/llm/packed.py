"""Token ids in patched frame-of-reference blocks.

A file holds records in document order. A record has whole documents: their doc_ids,
how many ids each has, how many ids stand before the record in its file, and a payload:

    magic "PFR1", blocks (u32), ids (u32), exceptions (u32)
    per block: start of its bits in the payload (u32), minimum (u32), width (u8), exceptions before it (u32)
    bits: BLOCK values of (id - minimum) modulo 2^width, width bits each, highest bit first
    per exception: place in the block (u8), id - minimum (u32)

The width of a block is that of the PERCENTILE-th of its BLOCK differences; larger ones
are exceptions. The last block repeats its last id. Blocks can be decoded one by one.
Records travel in Parquet, so that Spark's committer keeps files whole when tasks are
lost or run twice, and any file system that Spark writes will do.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketide.llm import pretokens
from marketide.llm.bpe import ENCODED_BYTES, text_batches
from marketide.llm.tables import texts
from marketide.session import shared_dir

BLOCK = 256
PERCENTILE = 0.9
MAGIC = b"PFR1"
INDEX = np.dtype([("start", "<u4"), ("least", "<u4"), ("width", "u1"), ("patched", "<u4")])
PATCH = np.dtype([("place", "u1"), ("value", "<u4")])

RECORD = "part int, record int, before long, doc_ids array<long>, lengths array<int>, payload binary"


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The payload for these ids."""
    ids = np.asarray(ids, np.uint32)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if n % BLOCK:
        ids = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1], np.uint32)])
    values = ids.reshape(blocks, BLOCK)
    index = np.zeros(blocks, INDEX)
    least = values.min(axis=1) if blocks else np.zeros(0, np.uint32)
    values = values - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = bit_lengths(np.partition(values, rank, axis=1)[:, rank]) if blocks else np.zeros(0, np.int64)
    over = (values >> np.minimum(width, 31)[:, None].astype(np.uint32) > 0) & (width < 32)[:, None]
    row, place = np.nonzero(over)
    patches = np.zeros(len(row), PATCH)
    patches["place"], patches["value"] = place, values[row, place]
    sizes = width * (BLOCK // 8)
    ends = np.cumsum(sizes)
    index["start"], index["least"], index["width"] = ends - sizes, least, width
    counts = np.bincount(row, minlength=blocks)
    index["patched"] = np.cumsum(counts) - counts
    bits = np.zeros(int(ends[-1]) if blocks else 0, np.uint8)
    for w in np.unique(width).tolist():
        if w:
            at = np.flatnonzero(width == w)
            bits[(index["start"][at].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)).ravel()] = _to_bits(values[at], w)
    head = np.array([blocks, n, len(patches)], "<u4")
    return MAGIC + head.tobytes() + index.tobytes() + bits.tobytes() + patches.tobytes()


def _to_bits(values: np.ndarray, width: int) -> np.ndarray:
    kind, size = (">u2", 16) if width <= 16 else (">u4", 32)
    low = (values & np.uint32((1 << width) - 1)).astype(kind)
    bits = np.unpackbits(low.view(np.uint8).reshape(-1, size // 8), axis=1)[:, size - width:]
    return np.packbits(bits)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks ``first`` to ``last`` (excluded; all if None)."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block payload")
    blocks, n, patched = np.frombuffer(payload, "<u4", 3, 4).tolist()
    index = np.frombuffer(payload, INDEX, blocks, 16)
    at = 16 + blocks * INDEX.itemsize
    bits = np.frombuffer(payload, np.uint8, len(payload) - at - patched * PATCH.itemsize, at)
    patches = np.frombuffer(payload, PATCH, patched, len(payload) - patched * PATCH.itemsize)
    last = blocks if last is None else min(last, blocks)
    index_ = index[first:last]
    values = np.zeros((len(index_), BLOCK), np.uint32)
    for w in np.unique(index_["width"]).tolist():
        if w:
            rows = np.flatnonzero(index_["width"] == w)
            taken = bits[index_["start"][rows].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)]
            values[rows] = _from_bits(taken, w)
    bounds = np.append(index["patched"], patched).astype(np.int64)
    counts = np.diff(bounds[first:last + 1])
    own = patches[bounds[first]:bounds[last]] if len(index_) else patches[:0]
    values[np.repeat(np.arange(len(index_)), counts), own["place"]] = own["value"]
    values += index_["least"][:, None]
    return values.ravel()[: min(n, last * BLOCK) - first * BLOCK] if len(index_) else values.ravel()


def _from_bits(taken: np.ndarray, width: int) -> np.ndarray:
    kind, size = (">u2", 16) if width <= 16 else (">u4", 32)
    bits = np.unpackbits(taken, axis=1).reshape(-1, width)
    full = np.zeros((len(bits), size), np.uint8)
    full[:, size - width:] = bits
    return np.packbits(full, axis=1).view(kind).reshape(len(taken), BLOCK)


def write(docs: DataFrame, path: str, vocab: str, end_id: int = 0, special: bool = True, tasks: int | None = None) -> None:
    """Encode all texts, append ``end_id`` to each, and write records in ascending doc_id order.

    Null texts count as empty and have the end id alone. Rows with one doc_id stay apart,
    in input order; rows without a doc_id come first.
    """
    tasks = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pretokens.encoder(vocab, special)
        part, record, before = TaskContext.get().partitionId(), 0, 0
        for rows, items in text_batches(batches, ENCODED_BYTES):
            flat, lengths = encoder.encode(items)
            flat = np.insert(flat, np.cumsum(lengths), np.uint32(end_id))
            lengths = lengths + 1
            edges = np.array([0, len(items)], np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([record], pa.int32()), pa.array([before], pa.int64()),
                    pa.ListArray.from_arrays(edges, rows.column(0)),
                    pa.ListArray.from_arrays(edges, pa.array(lengths.astype(np.int32))),
                    pa.array([pack(flat)], pa.binary()),
                ],
                ["part", "record", "before", "doc_ids", "lengths", "payload"],
            )
            record, before = record + 1, before + len(flat)

    # The place in the input parts rows of one doc_id, so that no range grows without bound.
    placed = texts(docs).withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(tasks, "doc_id", "place").sortWithinPartitions("doc_id", "place")
    ordered.select("doc_id", "text").mapInArrow(run, RECORD).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the files, per document: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, before, ids, lengths, payload = (batch.column(k)[i] for k in range(5))
                counts = np.array(lengths.as_py(), np.int64)
                raw = memoryview(unpack(payload.as_buffer().to_pybytes()).astype("<u4").tobytes())
                ends = np.cumsum(counts)
                spans = zip((4 * (ends - counts)).tolist(), (4 * ends).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values, pa.array(np.full(len(counts), part.as_py()), pa.int32()),
                        pa.array(before.as_py() + ends - counts), pa.array(counts),
                        pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    ],
                    ["doc_id", "part", "place", "n_tokens", "ids_crc32"],
                )

    records = spark.read.schema(RECORD).parquet(path)
    found = records.select("part", "before", "doc_ids", "lengths", "payload").mapInArrow(
        run, "doc_id long, part int, place long, n_tokens long, ids_crc32 long"
    )
    # One row per file, so the running sum is over as many rows as there are files.
    sizes = records.groupBy("part").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("size")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    return found.join(starts, "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (with the end id) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, payload = (batch.column(k)[i] for k in range(3))
                edges = np.concatenate([[0], np.cumsum(np.array(lengths.as_py(), np.int64))])
                flat = unpack(payload.as_buffer().to_pybytes())
                lists = pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([ids.values, lists], ["doc_id", "ids"])

    return spark.read.schema(RECORD).parquet(path).select("doc_ids", "lengths", "payload").mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
