"""Vectorised scans over Arrow string batches: code points, words, BPE pre-tokens.

Everything here works on one bounded slice of a batch at a time (``SLICE_CHARS``
code points, or one document if that is longer), so memory does not depend on how
many rows Spark puts into a batch.  Nulls are read as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_CHARS = 2_000_000
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = 0, 1, 2, 3, 255
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C55)


@dataclass
class TextSlice:
    """Some consecutive documents: their UTF-8 bytes, code points and bounds."""

    first: int  # row of the batch that the first document is
    data: bytes
    points: np.ndarray  # uint32 code points
    bounds: np.ndarray  # document i has points[bounds[i]:bounds[i + 1]]
    byte_bounds: np.ndarray  # and data[byte_bounds[i]:byte_bounds[i + 1]]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def byte_positions(self) -> np.ndarray | None:
        """Byte offset of each code point and of the end; None if they are equal."""
        if len(self.data) == len(self.points):
            return None
        p = self.points
        width = 1 + (p >= 0x80).astype(np.uint8) + (p >= 0x800) + (p >= 0x10000)
        out = np.zeros(len(p) + 1, np.int64)
        np.cumsum(width, out=out[1:])
        return out

    def text(self, i: int) -> str:
        return self.data[self.byte_bounds[i] : self.byte_bounds[i + 1]].decode()


def text_slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_CHARS) -> Iterator[TextSlice]:
    """Cut a string column into slices of whole documents."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = memoryview(data) if data is not None else memoryview(b"")
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1)
        own = bytes(data[offsets[begin] : offsets[end]])
        byte_bounds = offsets[begin : end + 1] - offsets[begin]
        points = np.frombuffer(own.decode().encode("utf-32-le"), np.uint32)
        if len(points) == len(own):
            bounds = byte_bounds
        else:
            raw = np.frombuffer(own, np.uint8)
            seen = np.zeros(len(own) + 1, np.int64)
            np.cumsum((raw & 0xC0) != 0x80, out=seen[1:])
            bounds = seen[byte_bounds]
        yield TextSlice(begin, own, points, bounds, byte_bounds)
        begin = end


def releasing(f: Callable) -> Callable:
    """A function of batches that gives back the memory it has freed when a task ends: a worker waits for other tasks, and what
    the allocators keep for it (200 MB after tokens of 30,000 texts) is missing to all stages that follow on its executor."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
            if trim:
                trim(0)

    return run


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points; the spans ascend and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    within = np.arange(total, dtype=np.int64) - np.repeat(first, lengths)
    values = points if total == len(points) else points[np.repeat(starts, lengths) + within]
    with np.errstate(over="ignore"):
        powers = np.full(int(lengths.max()), _MULTIPLIER, np.uint64).cumprod(dtype=np.uint64)
        sums = np.add.reduceat((values.astype(np.uint64) + np.uint64(1)) * powers[within], first)
        return mixed(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BLANK = np.zeros(0x21, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def blanks(points: np.ndarray) -> np.ndarray:
    """Marks space and the controls 9 to 13, which separate words."""
    return _BLANK[np.minimum(points, 0x1F + (points == 0x20))] if len(points) else np.zeros(0, bool)


def words(piece: TextSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (code points of the slice) and document of each maximal run without blanks."""
    solid = ~blanks(piece.points)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = piece.bounds[1:-1]
    inner = inner[inner < len(solid)]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    closes[inner[inner > 0] - 1] = solid[inner[inner > 0] - 1]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(piece.bounds, starts, "right") - 1


PROBES = ((LETTER, "a"), (NUMBER, "1"), (SPACE, "\n"))  # one pre-token with a character of the same kind


class PreTokenizer:
    """Cuts texts as the byte-level BPE pattern of ``public_tokenizers`` does.

    The kinds of code points are asked of ``classify`` (which asks the tokenizer library)
    the first time that they occur, so it is the library's notion of letters, numbers
    and white space that counts.
    """

    def __init__(self, classify: Callable[[list[str]], list[int]]):
        self.classify, self.kinds = classify, np.full(0x110000, UNKNOWN, np.uint8)

    def classes(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if (kinds == UNKNOWN).any():
            new = np.unique(points[kinds == UNKNOWN])
            self.kinds[new] = self.classify([chr(p) for p in new.tolist()])
            kinds = self.kinds[points]
        return kinds

    def spans(self, piece: TextSlice) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the pre-tokens (code points of the slice, gapless) and their documents."""
        points, n = piece.points, len(piece.points)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        kinds = self.classes(points)
        fresh = np.zeros(n + 1, bool)  # first of a document
        fresh[piece.bounds] = True
        begins = fresh[:n].copy()
        begins[1:] |= kinds[1:] != kinds[:-1]
        # The last blank before a solid character stands alone, or, if a space, joins it.
        last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~fresh[1:n])
        begins[last] = True
        begins[last[points[last] == 0x20] + 1] = False
        quotes = np.flatnonzero((points == 0x27) & begins)
        if len(quotes):
            padded = np.append(points, [0, 0])
            one, two = padded[quotes + 1], padded[quotes + 2]
            inside1, inside2 = ~fresh[np.minimum(quotes + 1, n)], ~fresh[np.minimum(quotes + 2, n)]
            short = inside1 & np.isin(one, [ord(c) for c in "stmd"])
            long = inside1 & inside2 & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
            for at, width in ((quotes[short], 2), (quotes[long], 3)):
                begins[at + 1] = False
                after = at + width
                begins[after[after < n]] = True
        starts = np.flatnonzero(begins)
        return starts, np.searchsorted(piece.bounds, starts, "right") - 1


class Ragged:
    """Rows of numbers of differing lengths that grow at the end."""

    def __init__(self, kind: type):
        self.flat, self.at, self.rows = np.zeros(1 << 16, kind), np.zeros((1 << 14) + 1, np.int64), 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.at[self.rows])
        need, rows = used + len(values), self.rows + len(lengths)
        if need > len(self.flat):
            self.flat = np.resize(self.flat, max(need, 2 * len(self.flat)))
        if rows + 1 > len(self.at):
            self.at = np.resize(self.at, max(rows + 1, 2 * len(self.at)))
        self.flat[used:need] = values
        self.at[self.rows + 1 : rows + 1] = used + np.cumsum(lengths)
        self.rows = rows

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.at[rows + 1] - self.at[rows]

    def gather(self, rows: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.at[rows], self.lengths(rows))]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of lengths[0] numbers, then those of the next range."""
    before = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=before[1:])
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class WordCodes:
    """Encodes texts by way of their distinct pre-tokens, which the library encodes once each.

    ``encode`` gets a list of distinct pre-tokens (str) and returns a list of id lists.
    Words are found again by hash and confirmed by their bytes.  What is remembered is
    bounded by ``limit`` words; then it starts anew.
    """

    def __init__(self, pre: PreTokenizer, encode: Callable[[list[str]], list[list[int]]], limit: int = 2_000_000):
        self.pre, self.encode, self.limit = pre, encode, limit
        self.clear()

    def clear(self) -> None:
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.bytes = Ragged(np.uint32), Ragged(np.uint8)

    def _add(self, data: bytes, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        coded = self.encode([data[i:j].decode() for i, j in zip(starts.tolist(), ends.tolist())])
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        first = self.ids.rows
        self.ids.extend(np.fromiter((x for c in coded for x in c), np.uint32, int(lengths.sum())), lengths)
        self.bytes.extend(raw[ranges(starts, ends - starts)], ends - starts)
        return np.arange(first, first + len(coded))

    def numbers(self, hashes: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of ``ids`` for distinct words: their hashes in ascending order, their bytes in data."""
        if self.ids.rows > self.limit:
            self.clear()
        raw = np.frombuffer(data, np.uint8)
        at = np.searchsorted(self.hashes, hashes)
        there = np.zeros(len(hashes), bool)
        if len(self.hashes):
            there = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes
        out = np.full(len(hashes), -1, np.int64)
        old = np.flatnonzero(there)
        if len(old):
            rows, lengths = self.number[at[old]], (ends - starts)[old]
            same = self.bytes.lengths(rows) == lengths
            old, rows, lengths = old[same], rows[same], lengths[same]
            if len(old):
                differ = self.bytes.gather(rows) != raw[ranges(starts[old], lengths)]
                first = np.zeros(len(lengths), np.int64)
                np.cumsum(lengths[:-1], out=first[1:])
                same = ~np.logical_or.reduceat(differ, first)
                out[old[same]] = rows[same]
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = self._add(data, raw, starts[new], ends[new])
            keep = new[~there[new]]
            self.hashes = np.insert(self.hashes, at[keep], hashes[keep])
            self.number = np.insert(self.number, at[keep], out[keep])
        return out

    def distinct(self, piece: TextSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a slice: rows of its distinct words, which of them each pre-token is, each one's document."""
        starts, docs = self.pre.spans(piece)
        ends = np.append(starts[1:], len(piece.points))
        hashes, some, inverse = np.unique(span_hashes(piece.points, starts, ends), return_index=True, return_inverse=True)
        where = piece.byte_positions()
        a, b = (starts[some], ends[some]) if where is None else (where[starts[some]], where[ends[some]])
        return self.numbers(hashes, piece.data, a, b), inverse, docs

    def slice_ids(self, piece: TextSlice, ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """All ids of a slice and the number of ids of each of its documents."""
        if not len(piece.points):
            return np.zeros(0, np.uint32), np.zeros(len(piece), np.int64)
        rows, inverse, docs = self.distinct(piece)
        widths = self.ids.lengths(rows)[inverse]
        counts = np.bincount(docs, widths, len(piece)).astype(np.int64)
        return self.ids.flat[ranges(self.ids.at[rows][inverse], widths)] if ids else None, counts


def byte_symbols() -> dict[int, str]:
    """The printable character by which byte-level BPE names each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_made: dict[tuple, WordCodes] = {}


def library_codes(path: str) -> WordCodes:
    """Word codes of a ``tokenizers`` file of byte-level BPE; one for each worker process."""
    if ("json", path) not in _made:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        names, model = byte_symbols(), tokenizer.model
        cut = tokenizer.pre_tokenizer.pre_tokenize_str

        def classify(chars: list[str]) -> list[int]:
            return [next((kind for kind, probe in PROBES if len(cut(probe + c)) == 1), OTHER) for c in chars]

        def encode(found: list[str]) -> list[list[int]]:
            return [[t.id for t in model.tokenize(w.encode().decode("latin-1").translate(names))] for w in found]

        _made["json", path] = WordCodes(PreTokenizer(classify), encode)
    return _made["json", path]


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken file: base64 of the token's bytes and its rank in each line."""
    import base64

    with open(path, "rb") as source:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in source if line.strip())}


def rank_codes(path: str, pattern: str) -> WordCodes:
    """Word codes of a ``tiktoken`` rank file; one for each worker process."""
    if ("ranks", path, pattern) not in _made:
        import tiktoken

        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})

        def classify(chars: list[str]) -> list[int]:
            # An encoding that can merge each probe string to one token, and does so if the pattern doesn't cut it.
            tokens = [bytes([b]) for b in range(256)]
            for c in chars:
                for _, probe in PROBES:
                    whole = (probe + c).encode()
                    tokens += [whole[:k] for k in range(2, len(whole) + 1)]
            probes = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(dict.fromkeys(tokens))}, special_tokens={})
            return [next((kind for kind, probe in PROBES if len(probes.encode_ordinary(probe + c)) == 1), OTHER) for c in chars]

        def encode(found: list[str]) -> list[list[int]]:
            return [encoding.encode_ordinary(w) for w in found]

        _made["ranks", path, pattern] = WordCodes(PreTokenizer(classify), encode)
    return _made["ranks", path, pattern]
