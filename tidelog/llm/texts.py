"""Words and shingles of whole Arrow batches of texts as numpy arrays.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return;
A-Z count as a-z. Words and shingles are 64-bit hashes of their bytes. Texts are hashed in blocks of a few
megabytes, cut between words, so that a very long text needs little more memory than its word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
BLOCK_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_PLACES = _rng.integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OF_LENGTH = _rng.integers(0, 2**63, WIDTH + 1, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_of(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; only block-sized tables are kept."""
    size = max(n, BLOCK_BYTES * 2)
    if base in _powers and len(_powers[base]) >= size:
        return _powers[base]
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    table = np.multiply.accumulate(factors)
    if size == BLOCK_BYTES * 2:
        _powers[base] = table
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the places between them; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


_IN_WORD = ~is_space(np.arange(256))


def run_bounds(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one place of every run of set flags; no run goes over a place in `bounds`."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate(([False], inside[:-1]))
    before[bounds[:-1][bounds[:-1] < len(inside)]] = False
    after = np.concatenate((inside[1:], [False]))
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


class Spans:
    """Gives the 64-bit hash of the bytes of any span of `data`."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _powers_of(_BASE, len(data))[: len(data)], out=self.sums[1:])
        self.inverse = _powers_of(_INVERSE, len(data) + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def blocks(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about a block each, cut between texts or at white space."""
    start, total = 0, len(data)
    while start < total:
        end = min(start + BLOCK_BYTES, total)
        if end < total:
            text_end = bounds[np.searchsorted(bounds, end, "right") - 1]
            if text_end > start:
                end = int(text_end)
            else:
                step = 1 << 16
                while end < total and not is_space(data[end : end + 1])[0]:
                    gaps = np.flatnonzero(is_space(data[end : end + step]))
                    end = end + int(gaps[0]) if len(gaps) else min(end + step, total)
                end = min(end, int(bounds[np.searchsorted(bounds, start, "right")]))
        yield start, end
        start = end


def runs(column: pa.Array, member: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """All runs of member bytes (a table of 256 flags without white space), a block of bytes at a time: the
    block's place, its bytes, the runs' starts and ends in it."""
    data, bounds = text_bytes(column)
    for start, end in blocks(data, bounds):
        inner = bounds[(bounds > start) & (bounds < end)] - start
        part = data[start:end]
        yield start, part, *run_bounds(member[part], np.concatenate(([0], inner, [end - start])))


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the place of every text's first word (one more at the end)."""
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for start, part, s, e in runs(column, _IN_WORD):
        hashes.append(Spans(part).hash(s, e))
        places.append(s + start)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), text_bytes(column)[1])


def hash_words(words: list[str]) -> np.ndarray:
    """The hashes of these words, sorted."""
    data = "".join(words).encode()
    sizes = np.array([len(w.encode()) for w in words])
    ends = np.cumsum(sizes)
    return np.unique(Spans(np.frombuffer(data, np.uint8)).hash(ends - sizes, ends))


def counts_by_code(data: np.ndarray, bounds: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) numbers of bytes by the code of each byte; `codes` is as long as `data`."""
    out = np.zeros((len(bounds) - 1) * n, np.int64)
    for start in range(0, len(data), BLOCK_BYTES):
        end = min(start + BLOCK_BYTES, len(data))
        low, high = np.searchsorted(bounds, start, "right") - 1, np.searchsorted(bounds, end, "left")
        cuts = np.clip(bounds[low : high + 1], start, end)
        owner = np.repeat(np.arange(high - low) * n, np.diff(cuts))
        out[low * n : high * n] += np.bincount(owner + codes[start:end], minlength=(high - low) * n)
    return out.reshape(-1, n)


def between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set from each start up to its end."""
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[ends] - sums[starts]


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word windows of every text in text order, and each text's first place.

    A text of one to four words is one shingle of all its words; without words it has none.
    """
    return windows(*words(column))


def windows(hashes: np.ndarray, first: np.ndarray, width: int = WIDTH, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The same of texts given by their words' hashes and first places, with windows of up to five words; with
    `whole`, a text of fewer words is one window."""
    counts = np.diff(first)
    out_counts = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1) if whole else 0)
    out_first = np.concatenate(([0], np.cumsum(out_counts)))
    out = np.zeros(out_first[-1], np.uint64)
    long = counts >= width
    if long.any():
        n = out_counts[long]
        at = np.repeat(first[:-1][long] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        value = np.full(len(at), _OF_LENGTH[width])
        for place in range(width):
            value += hashes[at + place] * _PLACES[place]
        out[np.repeat(out_first[:-1][long] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())] = mix(value)
    for row in np.flatnonzero((counts > 0) & ~long) if whole else ():
        own = hashes[first[row] : first[row + 1]]
        out[out_first[row]] = mix((own * _PLACES[: len(own)]).sum(keepdims=True) + _OF_LENGTH[len(own)])[0]
    return out, out_first


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of every text, sorted."""
    values, first = shingles(column)
    return [np.unique(values[first[i] : first[i + 1]]) for i in range(len(first) - 1)]


def pieces(batch: pa.RecordBatch, text: str, most_bytes: int = 2 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of bounded text size, at least one row each."""
    _, bounds = text_bytes(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < len(batch):
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + most_bytes, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end
