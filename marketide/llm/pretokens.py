"""Byte-level BPE over whole batches of texts.

A batch is split into pre-tokens by array operations on its code points, equal
pre-tokens are encoded once by the tokenizers library, and ids are put together by
indexing. The split follows the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Texts with code points that Python's Unicode tables do not know yet are handed to the
library whole, so its own tables decide.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)

#: Code points with the Unicode property White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
#: What may follow an apostrophe as one pre-token.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")

#: Pre-tokens a worker remembers; the memory starts anew when it is full.
REMEMBERED = 600_000
#: Pre-tokens given to the library at once.
AT_ONCE = 20_000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (
            UNKNOWN if (c := unicodedata.category(chr(i))) in ("Cn", "Cs") else kinds.get(c[0], OTHER)
            for i in range(sys.maxunicode + 1)
        ),
        np.uint8,
        sys.maxunicode + 1,
    )
    table[list(WHITE_SPACE)] = SPACE
    return table


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def boundaries(points: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each pre-token in ``points``, and the classes. ``text_starts``: where texts begin."""
    n = len(points)
    kind = classes()[points]
    if not n:
        return np.zeros(0, np.int64), kind
    first = np.zeros(n + 1, bool)  # a text begins here; the end counts as one
    first[text_starts] = True
    first[n] = True
    white = kind == SPACE
    run = np.empty(n, bool)  # a run of one class begins here
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run |= first[:n]
    start = run
    # The last white space before something else stands apart; a space goes with what follows.
    last = white & ~first[1:]
    last[:-1] &= ~white[1:]
    last[-1] = False
    at = np.flatnonzero(last)
    start[at] = True
    joins = at[points[at] == 0x20] + 1
    start[joins] = False
    # An apostrophe that begins a pre-token takes certain letters with it.
    marks = np.flatnonzero((points == 0x27) & start)
    if len(marks):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        ends = np.concatenate([first, np.ones(3, bool)])
        done = np.zeros(len(marks), bool)
        for letters in CONTRACTIONS:
            hit = ~done
            for i, letter in enumerate(letters, 1):
                hit &= (padded[marks + i] == ord(letter)) & ~ends[marks + i]
            done |= hit
            here = marks[hit]
            start[here + 1] = False
            after = here + 1 + len(letters)
            after = after[~ends[after]]
            # What is left of the letters begins anew; anything else began there anyway,
            # but for white space joined to what follows it.
            start[after[kind[after] == LETTER]] = True
    return np.flatnonzero(start), kind


_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value, in place where possible."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


#: Characters hashed at once, and the powers of a multiplier that are kept ready.
HASHED_AT_ONCE, READY = 1 << 20, 1 << 12


@lru_cache(maxsize=4)
def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first READY powers of a multiplier, and powers of the one that comes next."""
    # The first differs between the two as well, so that hashes of single characters do.
    low = np.multiply.accumulate(np.full(READY, _MULTIPLIERS[which] | np.uint64(1)))
    high = np.full(READY, low[-1])
    high[0] = 1
    return low, np.multiply.accumulate(high)


def power_of(place: np.ndarray, which: int, longest: int) -> np.ndarray:
    """An odd number for every place; they repeat after READY squared."""
    low, high = _powers(which)
    if longest <= READY:
        return low[place]
    return low[place & (READY - 1)] * high[(place >> 12) & (READY - 1)]


def piece_hashes(points: np.ndarray, starts: np.ndarray, kinds: tuple[int, ...] = (0, 1)) -> list[np.ndarray]:
    """64-bit hashes, one of each kind, of each piece points[start:next start], from one pass over the points."""
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in kinds]
    lengths = np.diff(starts, append=len(points))
    longest = int(lengths.max())
    sums = np.zeros((len(kinds), len(starts)), np.uint64)
    first = int(starts[0])
    for lo in range(first, len(points), HASHED_AT_ONCE):
        part = points[lo:lo + HASHED_AT_ONCE]
        # Pieces that begin here, and the one that goes on from before.
        piece = int(np.searchsorted(starts, lo, side="right")) - 1
        end = int(np.searchsorted(starts, lo + len(part)))
        cuts = np.maximum(starts[piece:end] - lo, 0)
        place = np.arange(lo, lo + len(part), dtype=np.int64)
        place -= np.repeat(starts[piece:end], np.diff(cuts, append=len(part)))
        values = part.astype(np.uint64)
        values += np.uint64(1)
        values *= _MULTIPLIERS[1]
        values ^= values >> np.uint64(29)
        for row, which in enumerate(kinds):
            sums[row, piece:end] += np.add.reduceat(values * power_of(place, which, longest), cuts)
    sums += lengths.astype(np.uint64)
    return [mix(s) for s in sums]


@dataclass
class Split:
    """A batch of texts cut into pre-tokens."""

    joined: str
    points: np.ndarray
    starts: np.ndarray  # where each pre-token begins
    hashes: np.ndarray
    checks: np.ndarray
    edges: np.ndarray  # pieces of segment i: edges[i] to edges[i + 1]
    owners: np.ndarray  # the text of each segment
    gaps: list[tuple[int, int]]  # (segment, special id that follows it)
    odd: list[int]  # segments with code points unknown here
    segments: list[str]

    def text(self, piece: int) -> str:
        end = self.starts[piece + 1] if piece + 1 < len(self.starts) else len(self.points)
        return self.joined[self.starts[piece]:end]


def split(texts: list[str], specials: dict[str, int]) -> Split:
    segments, owners, gaps = cut_at_specials(texts, specials)
    joined = "".join(segments)
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    points = code_points(joined)
    begins = np.cumsum(sizes) - sizes
    starts, kind = boundaries(points, begins[sizes > 0])
    edges = np.searchsorted(starts, np.append(begins, len(points)))
    odd = np.flatnonzero(kind == UNKNOWN)
    if len(odd):
        odd = np.unique(np.searchsorted(begins, odd, side="right") - 1)
    hashes, checks = piece_hashes(points, starts)
    return Split(joined, points, starts, hashes, checks, edges, owners, gaps, odd.tolist(), segments)


def cut_at_specials(texts: list[str], specials: dict[str, int]) -> tuple[list[str], np.ndarray, list[tuple[int, int]]]:
    """Texts cut at special strings; the text of each segment; (segment before it, special id)."""
    if not any(s in t for s in specials for t in texts):
        return texts, np.arange(len(texts)), []
    segments: list[str] = []
    owners: list[int] = []
    gaps: list[tuple[int, int]] = []
    for i, text in enumerate(texts):
        rest = text
        while True:
            at = [(p, -len(s), s) for s in specials if (p := rest.find(s)) >= 0]
            if not at:
                break
            place, _, s = min(at)
            gaps.append((len(segments), specials[s]))
            segments.append(rest[:place])
            owners.append(i)
            rest = rest[place + len(s):]
        segments.append(rest)
        owners.append(i)
    return segments, np.array(owners), gaps


@dataclass
class Encoder:
    """Encodes batches with one vocabulary; ``special`` strings inside texts are single ids if given.

    Ids of pre-tokens met before are remembered by a 64-bit hash, and a second hash
    guards against two pre-tokens with the same one.
    """

    path: str
    special: bool = True

    def __post_init__(self) -> None:
        import tokenizers

        self.specials: dict[str, int] = {}
        if self.path.endswith(".tiktoken"):
            vocab, merges = ranks_as_merges(self.path)
        else:
            with open(self.path, encoding="utf-8") as f:
                described = json.load(f)
            vocab = described["model"]["vocab"]
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in described["model"]["merges"]]
            if self.special:
                self.specials = {a["content"]: a["id"] for a in described["added_tokens"]}
        self.vocab = vocab
        self.words = tokenizers.Tokenizer(tokenizers.models.BPE(vocab, merges))
        self.splitter = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.characters = dict(enumerate(byte_characters()))
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.flat = np.empty(1 << 18, np.uint32)
        self.offsets = np.zeros(1 << 16, np.int64)
        self.check = np.zeros(1 << 16, np.uint64)
        self.used = 0

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens one after another, and how many each has."""
        part = [p.encode().decode("latin-1").translate(self.characters) for p in pieces]
        encoding = self.words.encode(part, is_pretokenized=True, add_special_tokens=False)
        owners = np.array(encoding.word_ids, np.int64)
        return np.array(encoding.ids, np.uint32), np.bincount(owners, minlength=len(part))

    def texts_whole(self, text: str) -> np.ndarray:
        """Ids of a text by the library alone."""
        # Rare enough to be done by the one tokenizer, which usually gets text that is split already.
        self.words.pre_tokenizer = self.splitter
        try:
            return np.array(self.words.encode(text, add_special_tokens=False).ids, np.uint32)
        finally:
            self.words.pre_tokenizer = None

    def _remember(self, hashes: np.ndarray, checks: np.ndarray, pieces: list[str]) -> None:
        count = len(self.slots)
        need = count + len(pieces) + 1
        if need > len(self.offsets):
            self.offsets = np.resize(self.offsets, 2 * need)
            self.check = np.resize(self.check, 2 * need)
        for lo in range(0, len(pieces), AT_ONCE):
            ids, lengths = self.pieces(pieces[lo:lo + AT_ONCE])
            if self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
            self.flat[self.used:self.used + len(ids)] = ids
            first = count + lo
            self.offsets[first + 1:first + 1 + len(lengths)] = self.used + np.cumsum(lengths)
            self.used += len(ids)
        self.check[count:count + len(pieces)] = checks
        self.slots.update(zip(hashes.tolist(), range(count, count + len(pieces))))

    def _slots(self, batch: Split) -> np.ndarray | None:
        """Where the ids of each pre-token are; None if two of them share a hash."""
        unique, where, which = np.unique(batch.hashes, return_index=True, return_inverse=True)
        if len(self.slots) + len(unique) > REMEMBERED:
            self.forget()
        get = self.slots.get
        found = np.fromiter((get(h, -1) for h in unique.tolist()), np.int64, len(unique))
        new = np.flatnonzero(found < 0)
        if len(new):
            count = len(self.slots)
            self._remember(unique[new], batch.checks[where[new]], [batch.text(i) for i in where[new].tolist()])
            found[new] = np.arange(count, count + len(new))
        slots = found[which]
        return slots if np.array_equal(self.check[slots], batch.checks) else None

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each text has."""
        batch = split(texts, self.specials)
        slots = self._slots(batch) if len(batch.starts) else np.zeros(0, np.int64)
        if slots is None:
            # The library encodes such a batch, segment by segment.
            parts = [self.texts_whole(t) for t in batch.segments]
            return self._with_specials(batch, len(texts), np.concatenate(parts), np.array([len(p) for p in parts], np.int64))
        first = self.offsets[slots]
        counts = self.offsets[slots + 1] - first
        ends = np.cumsum(counts)
        flat = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - counts), counts)]
        lengths = np.diff(np.concatenate([[0], ends])[batch.edges])
        if batch.odd:
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            for r in batch.odd:
                parts[r] = self.texts_whole(batch.segments[r])
            lengths = np.array([len(p) for p in parts], np.int64)
            flat = np.concatenate(parts)
        return self._with_specials(batch, len(texts), flat, lengths)

    @staticmethod
    def _with_specials(batch: Split, texts: int, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments with the special ids between them, and how many each text has."""
        if batch.gaps:
            ends = np.cumsum(lengths)
            flat = np.insert(flat, ends[[i for i, _ in batch.gaps]], np.array([v for _, v in batch.gaps], np.uint32))
            lengths = np.bincount(batch.owners, weights=lengths, minlength=texts).astype(np.int64)
            lengths += np.bincount(batch.owners[[i for i, _ in batch.gaps]], minlength=texts)
        return flat, lengths


def ranks_as_merges(path: str) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """A rank file as vocabulary and merges.

    Joining by rank takes any two neighbours whose joint bytes have a rank, so every
    cut of a token into two tokens is a merge, in the order of the token's rank.
    """
    import base64

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    characters = byte_characters()
    vocab = {"".join([characters[b] for b in token]): rank for token, rank in ranks.items()}
    merges = []
    for token in sorted(vocab, key=vocab.get):
        for cut in range(1, len(token)):
            if token[:cut] in vocab and token[cut:] in vocab:
                merges.append((token[:cut], token[cut:]))
    return vocab, merges


@lru_cache(maxsize=4)
def encoder(path: str, special: bool = True) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path, special)


def batches(column, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of an Arrow string array of about ``most`` bytes each, one row at least."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.binary_length(column).fill_null(0))
    ends = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lo, hi
        lo = hi
