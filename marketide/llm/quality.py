"""Text quality by a generalised additive model with pairwise interactions.

Shallow trees are boosted in turns, one feature after another, on a table of bins per
feature; then on tables of bin pairs for the pairs that explain most of what is left.
A text's score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketide.llm import pretokens
from marketide.llm.bpe import text_batches
from marketide.llm.tables import texts

#: Labelled rows to learn from: those with the smallest hash of their doc_id.
LEARNED_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 10
RATE = 0.1

FEATURES = (
    "log_chars", "log_words", "word_length", "longest_word", "letters", "digits", "white", "others",
    "capitals", "exclamations", "symbols", "bars", "distinct_words", "commonest_word", "short_words",
    "repeated_pairs", "log_line", "distinct_lines", "stops", "doubled_marks",
)


def features(items: list[str]) -> np.ndarray:
    """One row per text, one column per name in FEATURES; all zeros for an empty text."""
    n = len(items)
    out = np.zeros((n, len(FEATURES)))
    joined = "\n".join(items) + "\n"
    points = pretokens.code_points(joined)
    sizes = np.fromiter(map(len, items), np.int64, n)
    begins = np.cumsum(sizes + 1) - sizes - 1
    edges = np.append(begins, len(points))
    kind = pretokens.classes()[points]

    def per_text(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[edges])

    white = kind == pretokens.SPACE
    chars = np.maximum(sizes, 1)
    letters = per_text(kind == pretokens.LETTER)
    some = np.maximum(letters, 1)
    other = kind == pretokens.OTHER
    common = np.isin(points, np.array([ord(c) for c in ".,;:!?'\"()-"], np.uint32))
    upper = np.array([c.isupper() for c in map(chr, range(0x250))])
    small = points < 0x250
    capital = np.zeros(len(points), bool)
    capital[small] = upper[points[small]]
    doubled = np.zeros(len(points), bool)
    doubled[1:] = other[1:] & (points[1:] == points[:-1])
    # Words are runs without white space; every text ends in one.
    start = ~white
    start[1:] &= white[:-1]
    word_starts = np.flatnonzero(start)
    gone = white.copy()
    gone[0] = False
    gone[1:] &= ~white[:-1]
    lengths = np.flatnonzero(gone)[: len(word_starts)] - word_starts
    owner = np.searchsorted(begins, word_starts, side="right") - 1
    words = np.bincount(owner, minlength=n)
    counted = np.maximum(words, 1)
    if len(word_starts):
        hashes = _span_hashes(points, word_starts, lengths)
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, owner, lengths)
        distinct, most = _distinct(owner, hashes, n)
        same = owner[1:] == owner[:-1]
        pairs, _ = _distinct(owner[1:][same], pretokens.mix(hashes[1:] * np.uint64(3) + hashes[:-1])[same], n)
        out[:, 2] = np.bincount(owner, weights=lengths, minlength=n) / counted
        out[:, 3] = np.log1p(longest)
        out[:, 12], out[:, 13] = distinct / counted, most / counted
        out[:, 14] = np.bincount(owner, weights=lengths <= 3, minlength=n) / counted
        out[:, 15] = 1 - np.where(words > 1, pairs / np.maximum(words - 1, 1), 1)
    breaks = points == 0x0A
    lines = per_text(breaks)  # the one at the end makes it the number of lines
    line_starts = np.concatenate([[0], np.flatnonzero(breaks)[:-1] + 1])
    line_lengths = np.flatnonzero(breaks) - line_starts
    full = line_lengths > 0
    line_owner = np.searchsorted(begins, line_starts[full], side="right") - 1
    if full.any():
        different, _ = _distinct(line_owner, _span_hashes(points, line_starts[full], line_lengths[full]), n)
        out[:, 17] = different / np.maximum(np.bincount(line_owner, minlength=n), 1)
    out[:, 0], out[:, 1] = np.log1p(sizes), np.log1p(words)
    out[:, 4], out[:, 5] = letters / chars, per_text(kind == pretokens.NUMBER) / chars
    out[:, 6], out[:, 7] = (per_text(white) - 1) / chars, per_text(other) / chars
    out[:, 8] = per_text(capital) / some
    out[:, 9] = per_text(points == ord("!")) / counted
    out[:, 10] = per_text(other & ~common) / counted
    out[:, 11] = per_text(points == ord("|")) / counted
    out[:, 16] = np.log1p(sizes / np.maximum(lines, 1))
    out[:, 18] = per_text((points == ord(".")) | (points == ord("?"))) / counted
    out[:, 19] = per_text(doubled) / counted
    out[sizes == 0] = 0
    return out


def _span_hashes(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    return pretokens.piece_hashes(points[at], np.cumsum(lengths) - lengths, (0,))[0]


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each owner, and how often its commonest one occurs."""
    if not len(owner):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(first, append=len(owner))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[first], counts)
    return np.bincount(owner[first], minlength=n), most


@dataclass
class Model:
    """Bin edges and tables; ``pairs`` holds (feature, feature, table)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for i, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, i], side="right")]
        bins = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.pair_edges)]
        for i, j, table in self.pairs:
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-total))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values per bin of a tree of ``depth`` over gradient and curvature sums per bin."""
    value = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return value
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gains[(left_h < 1) | (h.sum() - left_h < 1)] = -1
    cut = int(np.argmax(gains)) + 1
    if gains[cut - 1] <= 1e-9:
        return value
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over a table of bin pairs: one cut along rows, then one along columns in each half."""
    best, value = 0.0, np.zeros_like(g)
    whole = float(_gain(g.sum(), h.sum()))
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        for cut in range(1, len(a)):
            out, gain = np.zeros_like(a), -whole
            for part in (slice(0, cut), slice(cut, None)):
                out[part] = _tree(a[part].sum(axis=0), b[part].sum(axis=0), 1)
                for v in np.unique(out[part][0]):
                    at = out[part][0] == v
                    gain += float(_gain(a[part][:, at].sum(), b[part][:, at].sum()))
            if gain > best:
                best, value = gain, out if axis == 0 else out.T
    return value, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learn tables from features and labels 0 and 1; without rows every score is one half."""
    n, width = x.shape
    rate = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate / (1 - rate)))
    edges = [quantile_edges(x[:, i], BINS) for i in range(width)]
    bins = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(n, base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS if n else 0):
        for i in range(width):
            g, h = slopes()
            step = RATE * _tree(
                np.bincount(bins[i], g, len(tables[i])), np.bincount(bins[i], h, len(tables[i]))
            )
            tables[i] += step
            total += step[bins[i]]

    pair_edges = [quantile_edges(x[:, i], PAIR_BINS) for i in range(width)]
    small = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(pair_edges)]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        shape = len(pair_edges[i]) + 1, len(pair_edges[j]) + 1
        at = small[i] * shape[1] + small[j]
        size = shape[0] * shape[1]
        return np.bincount(at, g, size).reshape(shape), np.bincount(at, h, size).reshape(shape)

    pairs: list[tuple[int, int, np.ndarray]] = []
    if n:
        found = sorted(
            ((_pair_tree(*sums(i, j))[1], i, j) for i in range(width) for j in range(i)), reverse=True
        )[:PAIRS]
        pairs = [(i, j, np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1))) for _, i, j in found]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in pairs:
                step = RATE * _pair_tree(*sums(i, j))[0]
                table += step
                total += step[small[i], small[j]]
    return Model(base, edges, tables, pair_edges, pairs)


def learn(docs: DataFrame, labels: DataFrame, rows: int = LEARNED_ROWS) -> Model:
    """A model from ``labels`` (doc_id, quality); at most ``rows`` labelled rows are used.

    They are those with the smallest hash of their doc_id. Null labels, ids or texts teach nothing.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, items in text_batches(batches):
            label = part.column(part.schema.get_field_index("label"))
            values = pa.array(list(features(items)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), label, values], ["doc_id", "label", "x"])

    # The size of the broadcast is bounded by ``rows``.
    known = texts(docs.where("text IS NOT NULL")).join(F.broadcast(chosen), "doc_id")
    taught = known.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x array<double>").toArrow()
    taught = taught.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    x = np.array(taught["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, taught["label"].to_numpy().astype(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, items in text_batches(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(features(items)))], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")
