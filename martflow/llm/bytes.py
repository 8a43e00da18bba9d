"""Whole texts as byte arrays: blocks of documents, words, and rolling hashes.

Tasks work on blocks of whole documents, about a megabyte each, so that their
memory doesn't depend on the size of a partition. A single longer document is a
block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# Fixed value: the white space that ends a word.
SPACES = b" \t\n\x0b\x0c\r"

MASK = (1 << 64) - 1
LONG_WORD = 512


def _random_words(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, MASK, count, np.uint64, endpoint=True)


_BYTE_CODES = _random_words(256, 11)
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power_table(base: int, count: int) -> np.ndarray:
    """Powers modulo 2**64, kept between calls."""
    if len(_powers[base]) < count:
        table = np.full(max(count, BLOCK_BYTES + 4096), base, np.uint64)
        table[0] = 1
        _powers[base] = np.cumprod(table, dtype=np.uint64)
    return _powers[base][:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Sums of weighted codes up to each position, for :func:`range_hashes`."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _power_table(_BASE, len(codes)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the codes in each range; equal ranges have equal hashes."""
    shift = _power_table(_INVERSE, len(sums))[starts]
    return mix((sums[ends] - sums[starts]) * shift)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range, mixed after every eight of them.

    Unlike sums of weighted codes, which some regular texts share whatever the
    weights, it has no structure that different words could follow.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(_BASE))
    long = size > LONG_WORD
    for i in np.flatnonzero(long).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    rest = np.flatnonzero(~long & (size > 0))
    at = starts[rest]
    while len(rest):
        left = ends[rest] - at
        unused = np.maximum(8 - left, 0).astype(np.uint64) << np.uint64(3)
        chunk = (eight[at] << unused) >> unused
        out[rest] = mix(out[rest] ^ chunk) + np.uint64(_BASE)
        more = left > 8
        rest, at = rest[more], at[more] + 8
    return out


def gram_hashes(codes: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` codes from each place on, mixed after every one of them."""
    out = np.full(len(place), n, np.uint64)
    for k in range(n):
        out = mix(out ^ codes[place + k]) + np.uint64(_BASE)
    return out


def byte_hashes(data: np.ndarray) -> np.ndarray:
    return prefix_hashes(_BYTE_CODES[data])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows, with their bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            own = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
            first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, all other bytes unchanged."""
    return data + (((data >= 65) & (data <= 90)).view(np.uint8) << 5)


def runs(member: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of members that don't cross a cut."""
    before = np.zeros(len(member) + 1, bool)
    before[1:] = member
    after = np.zeros(len(member) + 1, bool)
    after[:-1] = member
    cuts = cuts[cuts <= len(member)]
    begins = after & ~before
    begins[cuts] = after[cuts]
    ends = before & ~after
    ends[cuts] = before[cuts]
    return np.flatnonzero(begins), np.flatnonzero(ends)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where the words of each row begin."""
    starts, ends = runs(~_IS_SPACE[data], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def windowed_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by minima within aligned pieces."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    if width == 1:
        return values
    padded = -(-len(values) // width) * width
    rows = np.full(padded, np.iinfo(values.dtype).max, values.dtype)
    rows[: len(values)] = values
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
