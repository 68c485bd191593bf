"""Links between similar sets, and the components they make.

Sets meet in tiles: rows with one key. Within a tile bounds from sizes, places and bit
counts of the signatures say which pairs may be similar; those pairs are then verified
on the sets themselves. Small tiles give all such pairs. In large tiles every set first
meets only a few pivots, so that a large group of near copies costs as many pairs as it
has members; what these links do not already join is compared in a second round, so no
link between two components is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketide.llm.pretokens import mix
from marketide.llm.tables import kept

TILE = "key long, id long, size int, place int, s0 long, s1 long"
#: Rows of a tile that are compared each with each at once.
SMALL_TILE = 32
#: Rounds in which members of large tiles meet a few others, and how many others each.
TURNS, LAGS = 1, 16
#: Bits of the filter that tells a scan whose sets are needed: 1 MB.
FILTER_BITS = 1 << 23


def needed(size_a: np.ndarray, size_b: np.ndarray, p: int, q: int) -> np.ndarray:
    """Least overlap of two sets with q * overlap >= p * union."""
    return -(-p * (size_a + size_b) // (p + q))


def prefix_length(size: int, p: int, q: int) -> int:
    """So many first elements of two similar sets, in one order of all elements, share one."""
    return size - -(-p * size // q) + 1


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting; short arrays are faster that way than by hashing."""
    out = np.sort(values)
    stay = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=stay[1:])
    return out[stay]


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each (non-empty) set, as two columns: the parity of how many values hash to each bit.

    Bits that differ need values that differ.
    """
    if not sets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets)
    bit = np.left_shift(np.uint64(1), flat & np.uint64(63))
    second = (flat & np.uint64(64)) > 0
    halves = (np.where(second, np.uint64(0), bit), np.where(second, bit, np.uint64(0)))
    return tuple(np.bitwise_xor.reduceat(h, starts).view(np.int64) for h in halves)


def wide_signature(values: np.ndarray) -> bytes:
    """Parities of about twice as many hash values as there are elements; a power of two of bits."""
    bits = 1 << max(6, (2 * len(values) - 1).bit_length())
    counts = np.bincount((values >> np.uint64(7)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two wide signatures differ, the wider one folded to the other's width."""
    x, y = (np.frombuffer(v, np.uint8) for v in sorted((a, b), key=len))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


SETS = "id long, size int, wide binary, payload binary"


def set_rows(ids: pa.Array, sets: list[np.ndarray], payloads: list[bytes] | None = None) -> pa.RecordBatch:
    """Rows of SETS. The payload is what a set can be made from again; the elements themselves if none is given."""
    payloads = [s.tobytes() for s in sets] if payloads is None else payloads
    return pa.RecordBatch.from_arrays(
        [
            ids, pa.array([len(s) for s in sets], pa.int32()),
            pa.array([wide_signature(s) for s in sets], pa.binary()), pa.array(payloads, pa.binary()),
        ],
        ["id", "size", "wide", "payload"],
    )


def elements(payload: bytes) -> np.ndarray:
    """The set whose payload is its elements."""
    return np.frombuffer(payload, np.uint64)


class Tile:
    """Columns of tile rows in the order key, size, id; a key has two rows or more, or one that came repeatedly."""

    def __init__(self, columns: list[np.ndarray]) -> None:
        self.columns = columns
        self.key, self.id, size, place, s0, s1, *rest = columns
        self.size, self.place = size.astype(np.int64), place.astype(np.int64)
        self.s0, self.s1 = s0.view(np.uint64), s1.view(np.uint64)
        if rest:
            self.component, wide = rest
            self._fold([np.frombuffer(w, np.uint64) for w in wide])

    def near(self, a: np.ndarray | int, b: np.ndarray, p: int, q: int) -> np.ndarray:
        """Whether rows a and b may be similar by their sizes and bit counts."""
        need = needed(self.size[a], self.size[b], p, q)
        differ = np.bitwise_count(self.s0[a] ^ self.s0[b]).astype(np.int64)
        differ += np.bitwise_count(self.s1[a] ^ self.s1[b])
        most = np.minimum(np.minimum(self.size[a], self.size[b]), (self.size[a] + self.size[b] - differ) // 2)
        return most >= need

    def _fold(self, wide: list[np.ndarray]) -> None:
        """Wide signatures at every width that occurs, of the rows that are that wide or wider.

        All widths together hold about twice what the rows bring.
        """
        self.words = np.array([len(w) for w in wide])
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for words in np.unique(self.words)[::-1].tolist():
            at = np.flatnonzero(self.words >= words)
            for i in at.tolist():
                if len(wide[i]) > words:
                    wide[i] = np.bitwise_xor.reduce(wide[i].reshape(-1, words))
            row = np.full(len(wide), -1)
            row[at] = np.arange(len(at))
            self.folded[words] = row, np.stack([wide[i] for i in at.tolist()])

    def close(self, a: np.ndarray, b: np.ndarray, p: int, q: int) -> np.ndarray:
        """Whether rows a and b may be similar by the bit counts of their wide signatures."""
        words = np.minimum(self.words[a], self.words[b])
        differ = np.zeros(len(words), np.int64)
        for n in np.unique(words).tolist():
            at = np.flatnonzero(words == n)
            row, bits = self.folded[n]
            differ[at] = np.bitwise_count(bits[row[a[at]]] ^ bits[row[b[at]]]).sum(axis=1)
        return (self.size[a] + self.size[b] - differ) // 2 >= needed(self.size[a], self.size[b], p, q)

    def may_link(self, a: np.ndarray | int, b: np.ndarray, p: int, q: int) -> np.ndarray:
        """Whether rows a and b may be similar, if this is the first element they share."""
        need = needed(self.size[a], self.size[b], p, q)
        most = 1 + np.minimum(self.size[a] - self.place[a] - 1, self.size[b] - self.place[b] - 1)
        return (most >= need) & self.near(a, b, p, q)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Tile]:
    """Batches in the order of keys, cut between keys, each id once per key. Keys of a single row are left out."""
    carried: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        last = columns[0][-1]
        if carried and carried[0][0][0] == last:
            carried.append(columns)
            continue
        cut = int(np.searchsorted(columns[0], last))
        yield from _once([*carried, [c[:cut] for c in columns]])
        carried = [[c[cut:] for c in columns]]
    if carried:
        yield from _once(carried)


def _once(parts: list[list[np.ndarray]]) -> Iterator[Tile]:
    columns = [np.concatenate(c) for c in zip(*parts)]
    same = columns[0][1:] == columns[0][:-1]
    company = np.zeros(len(columns[0]), bool)
    company[1:] = same
    company[:-1] |= same
    if not company.any():
        return
    # Most keys have one row, so few rows are left to be ordered.
    columns = [c[company] for c in columns]
    order = np.lexsort((columns[1], columns[2], columns[0]))
    columns = [c[order] for c in columns]
    stay = np.ones(len(order), bool)
    stay[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    yield Tile([c[stay] for c in columns])


def _pairs_batch(a: list[np.ndarray], b: list[np.ndarray], tile: Tile, big: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    left = tile.id[np.concatenate(a)] if a else np.zeros(0, np.int64)
    right = tile.id[np.concatenate(b)] if b else np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
    rows = np.concatenate(big) if big else np.zeros(0, np.int64)
    n, m = len(pairs), len(rows)
    none = np.zeros(n, np.int64)
    columns = [np.concatenate([np.zeros(n, np.int8), np.ones(m, np.int8)])]
    columns.append(np.concatenate([pairs[:, 1], np.zeros(m, np.int64)]))
    for i, c in enumerate(tile.columns[:6]):
        columns.append(np.concatenate([(pairs[:, 0] if i == 1 else none).astype(c.dtype), c[rows]]))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def compare_tiles(tiles: DataFrame, p: int, q: int) -> DataFrame:
    """kind 0: pairs (id, other) that may be similar; kind 1: the rows of large tiles."""
    names = ["kind", "other", "key", "id", "size", "place", "s0", "s1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _runs(batches):
            starts = np.flatnonzero(np.concatenate([[True], tile.key[1:] != tile.key[:-1]]))
            lengths = np.diff(starts, append=len(tile.key))
            left, right, big = [], [], []
            small = np.where(lengths <= SMALL_TILE, lengths, 1)
            # How many rows of its small tile follow each row.
            following = np.repeat(starts + small, lengths) - np.arange(len(tile.key)) - 1
            for lag in range(1, int(small.max())):
                a = np.flatnonzero(following >= lag)
                a = a[tile.may_link(a, a + lag, p, q)]
                if len(a):
                    left.append(a)
                    right.append(a + lag)
            for start, length in zip(starts[lengths > SMALL_TILE].tolist(), lengths[lengths > SMALL_TILE].tolist()):
                rest = np.arange(start, start + length)
                some = False
                while len(rest) > 1:
                    pivot, rest = rest[0], rest[1:]
                    hit = tile.may_link(pivot, rest, p, q)
                    if hit.any():
                        left.append(np.full(int(hit.sum()), pivot))
                        right.append(rest[hit])
                    # What is near the pivot meets it in the tile of their first shared element.
                    near = tile.near(pivot, rest, p, q)
                    some |= bool(near.any())
                    rest = rest[~near]
                if some:
                    big.append(np.arange(start, start + length))
            if left or big:
                yield _pairs_batch(left, right, tile, big, names)

    placed = tiles.repartition("key").sortWithinPartitions("key")
    schema = "kind byte, other long, key long, id long, size int, place int, s0 long, s1 long"
    return placed.mapInArrow(run, schema)


#: Pairs that a task hands on at once.
PAIRS_AT_ONCE = 1 << 20


def compare_all(tiles: DataFrame, p: int, q: int) -> DataFrame:
    """All pairs (a, b) of a tile that may be similar, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _runs(batches):
            starts = np.flatnonzero(np.concatenate([[True], tile.key[1:] != tile.key[:-1]]))
            lengths = np.diff(starts, append=len(tile.key))
            following = np.repeat(starts + lengths, lengths) - np.arange(len(tile.key)) - 1
            active, left, right, waiting = np.arange(len(tile.key)), [], [], 0
            for lag in range(1, int(lengths.max(initial=1))):
                active = active[following[active] >= lag]
                hit = active[tile.may_link(active, active + lag, p, q)]
                left.append(tile.id[hit])
                right.append(tile.id[hit + lag])
                waiting += len(hit)
                if waiting > PAIRS_AT_ONCE:
                    yield _ordered_pairs(left, right)
                    left, right, waiting = [], [], 0
            if waiting:
                yield _ordered_pairs(left, right)

    placed = tiles.repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(run, "a long, b long").distinct()


def _ordered_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(left), np.concatenate(right)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def all_links(
    tiles: DataFrame, sets: Callable[[np.ndarray], DataFrame], p: int, q: int,
    decode: Callable[[bytes], np.ndarray] = elements,
) -> DataFrame:
    """Every link (a, b), also within what other links already join: as many rows as there are links."""
    tried = kept(compare_all(tiles, p, q))
    return verify(kept(bounded(tried, sets, p, q)), sets, decode, p, q)


def compare_components(rows: DataFrame, p: int, q: int, turn: int | None = None) -> DataFrame:
    """Pairs (a, b) of large tiles that may be similar and are of different components.

    All of them, or with ``turn`` each row and its next few in an order of that turn.
    """

    def partners(tile: Tile, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if turn is None:
            for i in range(start, end - 1):
                rest = np.arange(i + 1, end)
                yield np.full(len(rest), i), rest
        else:
            # One order of all ids, so that tiles with the same rows give the same pairs.
            order = start + np.argsort(mix(tile.id[start:end].view(np.uint64) + np.uint64(turn)))
            for lag in range(1, min(LAGS, end - start - 1) + 1):
                yield order[:-lag], order[lag:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _runs(batches):
            starts = np.flatnonzero(np.concatenate([[True], tile.key[1:] != tile.key[:-1]])).tolist()
            for start, end in zip(starts, [*starts[1:], len(tile.key)]):
                own = tile.component[start:end]
                if (own == own[0]).all():
                    continue
                for a, b in partners(tile, start, end):
                    apart = tile.component[a] != tile.component[b]
                    a, b = a[apart], b[apart]
                    hit = tile.may_link(a, b, p, q)
                    a, b = a[hit], b[hit]
                    hit = tile.close(a, b, p, q)
                    if hit.any():
                        a, b = tile.id[a[hit]], tile.id[b[hit]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    placed = rows.repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(run, "a long, b long").distinct()


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS with the hashed ids; ``passes`` looks one up. Stray hits are possible."""
    bit = F.pmod(F.col("id"), F.lit(FILTER_BITS)) + 1  # Spark's bitmaps count from 1
    rows = (
        ids.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()  # FILTER_BITS / 32768 rows of 4 KB at most
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        first = (r["bucket"] - 1) * 4096
        out[first:first + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def passes(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = np.mod(ids, FILTER_BITS)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def with_both(pairs: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """a, b and these columns of both. Sets may be long, so they are never broadcast."""
    for side in ("a", "b"):
        named = found.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.hint("merge").join(named, side)
    return pairs.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])


def ids_of(pairs: DataFrame) -> np.ndarray:
    return id_filter(pairs.select(F.explode(F.array("a", "b")).alias("id")))


def bounded(pairs: DataFrame, sets: Callable[[np.ndarray], DataFrame], p: int, q: int) -> DataFrame:
    """Pairs that may be similar by their wide signatures, which are a thirtieth of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy().astype(np.int64)
            differ = np.array(
                [differing_bits(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())], np.int64
            )
            stay = (size[0] + size[1] - differ) // 2 >= needed(*size, p, q)
            yield batch.select([0, 1]).filter(pa.array(stay))

    return with_both(pairs, sets(ids_of(pairs)), "size", "wide").mapInArrow(run, "a long, b long")


def verify(
    pairs: DataFrame, sets: Callable[[np.ndarray], DataFrame], decode: Callable[[bytes], np.ndarray], p: int, q: int
) -> DataFrame:
    """Pairs (a, b) with q * overlap >= p * union.

    ``sets`` gives SETS of at least the ids that pass the bitmap it is handed, ``decode``
    the sorted distinct elements of a payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = []
            for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = decode(one), decode(other)
                both = np.sort(np.concatenate([x, y]))
                overlap = int(np.count_nonzero(both[1:] == both[:-1]))
                stay.append(q * overlap >= p * (len(x) + len(y) - overlap))
            yield batch.select([0, 1]).filter(pa.array(stay, pa.bool_()))

    return with_both(pairs, sets(ids_of(pairs)), "payload").mapInArrow(run, "a long, b long").distinct()


def link(
    tiles: DataFrame, sets: Callable[[np.ndarray], DataFrame], p: int, q: int,
    decode: Callable[[bytes], np.ndarray] = elements, check: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
) -> DataFrame:
    """id and component (smallest id reachable by links) of every id that has a link.

    ``check`` gives the similar ones of some pairs, where payloads are hardly larger than
    wide signatures, so that these are not worth a scan of their own. Next to the pairs it
    gets SETS of all their ids, if these are there already.
    """
    compared = kept(compare_tiles(tiles, p, q))
    tried = kept(compared.where("kind = 0").select(F.col("id").alias("a"), F.col("other").alias("b")).distinct())
    if check is None:
        links = kept(verify(kept(bounded(tried, sets, p, q)), sets, decode, p, q))
    else:
        links = kept(check(tried, None))
    found = components(links)
    large = compared.where("kind = 1").select("key", "id", "size", "place", "s0", "s1")
    if large.isEmpty():
        return found
    # A few partners in turn join most of a large group; then all that is still apart is compared.
    of_large = None
    for turn in (*range(TURNS), None):
        labelled = kept(large.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")))
        # Tiles that hang together are done; only rows of the others bring their wide signatures.
        apart = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        open_keys = apart.where("low <> high").select("key")
        rows = kept(labelled.join(open_keys, "key", "left_semi"))
        if rows.isEmpty():
            break
        if of_large is None:
            # Tiles that are open in a later turn were so in the first: its sets are all that is needed.
            of_large = kept(sets(id_filter(rows)).join(rows.select("id").distinct(), "id", "left_semi"))
        wide = rows.join(of_large.select("id", "wide"), "id").select(*large.columns, "component", "wide")
        pairs = kept(compare_components(wide, p, q, turn).join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            continue
        more = verify(pairs, lambda _, known=of_large: known, decode, p, q) if check is None else check(pairs, of_large)
        links = kept(links.union(more))
        tried = tried.union(pairs)
        found = components(links)
    return found


def forest(links: DataFrame) -> DataFrame:
    """Links with the same components, at most one per id and task: each task joins what it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        rows = [(x, r) for x in list(parent) if (r := root(x)) != x]
        if rows:
            u, v = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return links.select("a", "b").mapInArrow(run, "u long, v long")


#: Edges that are joined by one task, some 50 MB there; more of them are joined in passes.
ONE_TASK = 200_000


def components(links: DataFrame) -> DataFrame:
    """id and component of every id in ``links`` (a, b).

    Distributed union-find: each task joins what it holds. What is left, if it is more
    than one task can take, is turned into stars around smaller and smaller ids, in
    alternating passes over neighbours above and below each id, until nothing changes.
    """
    edges = kept(forest(links).distinct())
    state = _state(edges)
    if state[0] <= ONE_TASK:
        # So few that one task joins them all.
        return _stars(kept(forest(edges.select(F.col("u").alias("a"), F.col("v").alias("b")).coalesce(1))))
    while True:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    return _stars(edges)


def _stars(edges: DataFrame) -> DataFrame:
    """id and component from edges that all lead to the smallest id of a component, which has no edge of its own."""
    tops = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(tops)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
