"""Word hashing inside tasks: bytes in, one 64-bit hash per word out, no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20  # bytes hashed at once; longer texts are cut between words
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _table(separators: bytes) -> np.ndarray:
    """Byte to value: 0 for a separator, else the byte with A-Z lower-cased, plus 1."""
    values = np.arange(1, 257, dtype=np.uint64)
    values[0x41:0x5B] += np.uint64(0x20)
    values[np.frombuffer(separators, dtype=np.uint8)] = 0
    return values


SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Words of anything but white space.
SPACED = _table(SPACES)
#: Words of ASCII letters and digits and everything beyond ASCII.
ALPHANUMERIC = _table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_CACHE: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > SEGMENT + 1:
        return _powers(_BASE, n), _powers(_INVERSE, n)
    if not _CACHE:
        _CACHE["p"], _CACHE["i"] = _powers(_BASE, SEGMENT + 1), _powers(_INVERSE, SEGMENT + 1)
    return _CACHE["p"], _CACHE["i"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def _segment(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of one segment."""
    if not data:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = table[np.frombuffer(data, dtype=np.uint8)]
    inside = np.zeros(len(codes) + 2, dtype=bool)
    inside[1:-1] = codes != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _tables(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    codes *= power[: len(codes)]
    np.cumsum(codes, out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(h), starts


def _cut(data: bytes, table: np.ndarray) -> Iterator[bytes]:
    """A long text in segments that end between words; a longer word is never cut."""
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        if end < len(data):
            gaps = np.flatnonzero(table[np.frombuffer(data, np.uint8, end - at, at)] == 0)
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                while end < len(data) and table[data[end]]:
                    end += 1
        yield data[at:end]
        at = end


def hash_words(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text begins and ends among them."""
    found, counts, at = [], np.zeros(len(texts), np.int64), 0
    while at < len(texts):
        if len(texts[at]) > SEGMENT:
            for part in _cut(texts[at], table):
                h, _ = _segment(part, table)
                found.append(h)
                counts[at] += len(h)
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) + 1 <= SEGMENT + 1:
            size += len(texts[end]) + 1
            end += 1
        h, starts = _segment(b" ".join(texts[at:end]), table)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[at:end]])
        counts[at:end] = np.diff(np.searchsorted(starts, begins))
        found.append(h)
        at = end
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return (np.concatenate(found) if found else np.empty(0, np.uint64)), bounds


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, by the first one's position."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:count] * np.uint64(1)
    for k in range(1, n):
        out *= _BASE
        out += hashes[k : k + count]
    return mixed(out + np.uint64(n))


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of consecutive items of at most ``most`` bytes in all; at least one item each."""
    at = 0
    while at < len(sizes):
        end, size = at + 1, int(sizes[at])
        while end < len(sizes) and size + sizes[end] <= most:
            size += int(sizes[end])
            end += 1
        yield at, end
        at = end


def byte_sizes(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text; 0 for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; empty for null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]
