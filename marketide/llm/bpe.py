"""Byte-level BPE encoding and decoding over Arrow batches.

Encoding maps bytes to printable characters and lets the tokenizers library merge them;
offsets are code points of the text, and an id that holds only part of a character gets
the span of the whole character. Decoding reverses the byte table; characters that are
split between ids come out whole, and bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketide.llm import pretokens
from marketide.llm.tables import BATCH_BYTES, texts


class Bytes:
    """The bytes of every id."""

    def __init__(self, vocab: dict[str, int]) -> None:
        back = {c: b for b, c in enumerate(pretokens.byte_characters())}
        pieces = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            # An added token is plain text, not mapped bytes.
            pieces[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.flat[at].tobytes()

    def offsets(self, ids: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last code point of each id."""
        ends = np.cumsum(self.sizes[ids])
        begins = ends - self.sizes[ids]
        # Code point of each byte: continuation bytes belong to the one before.
        point = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
        return point[begins], point[ends - 1] + 1


@lru_cache(maxsize=4)
def byte_table(path: str, special: bool) -> Bytes:
    encoder = pretokens.encoder(path, special)
    return Bytes(encoder.vocab | encoder.specials)


#: Text that is encoded at once: more of it repeats more pre-tokens.
ENCODED_BYTES = 1_000_000


def text_batches(batches: Iterable[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about ``most`` bytes of text, with their texts."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        for lo, hi in pretokens.batches(column, most):
            part = batch.slice(lo, hi - lo)
            yield part, column.slice(lo, hi - lo).to_pylist()


def encode(docs: DataFrame, path: str, special: bool = False) -> DataFrame:
    """doc_id, ids, and for each id its first (starts) and one past its last (ends) code point.

    A null text counts as empty and has no ids. Rows with equal or null doc_id each get
    a row. With ``special``, special strings of the vocabulary inside texts are one id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = pretokens.encoder(path, special), byte_table(path, special)
        for part, items in text_batches(batches, ENCODED_BYTES):
            flat, lengths = encoder.encode(items)
            edges = np.concatenate([[0], np.cumsum(lengths)])
            starts, ends = np.empty(len(flat), np.int32), np.empty(len(flat), np.int32)
            for i, text in enumerate(items):
                span = slice(edges[i], edges[i + 1])
                if edges[i] < edges[i + 1]:
                    starts[span], ends[span] = table.offsets(flat[span], text.encode())
            lists = [pa.ListArray.from_arrays(edges.astype(np.int32), pa.array(v.astype(np.int32))) for v in (flat, starts, ends)]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists], ["doc_id", "ids", "starts", "ends"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, path: str, special: bool = False) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids count as none.

    Ids outside the vocabulary raise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path, special)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            out = [table.decode(np.array(r or [], np.int64)).decode("utf-8", "replace") for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, special: bool = False) -> DataFrame:
    """Per document what encoding and decoding give, in one pass and as digests.

    doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers)
    and decoded_sha256 (of the decoded bytes), both as lowercase hex.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = pretokens.encoder(path, special), byte_table(path, special)
        for part, items in text_batches(batches, ENCODED_BYTES):
            flat, lengths = encoder.encode(items)
            raw = memoryview(flat.astype("<u4").tobytes())
            plain = memoryview(table.decode(flat))
            ends = np.concatenate([[0], np.cumsum(lengths)])
            cuts = np.concatenate([[0], np.cumsum(table.sizes[flat])])[ends].tolist()
            ends = (ends * 4).tolist()
            ids = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
            decoded = [hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lengths, pa.int64()), pa.array(ids), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
