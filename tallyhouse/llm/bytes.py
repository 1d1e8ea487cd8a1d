"""Arrow text columns as flat byte arrays, and vectorised word and hash helpers on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are gathered up to this many bytes before a vectorised step; one longer text is a block of its own.
BLOCK_BYTES = 2 << 20

# An odd multiplier for polynomial hashes modulo 2^64 and the constants of the 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
FINAL_1 = 0xFF51AFD7ED558CCD
FINAL_2 = 0xC4CEB9FE1A85EC53

_U64 = np.uint64


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts or binary values (null: empty) and the offsets of each, starting at 0."""
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if binary else "")
    wide = column.cast(pa.large_binary() if binary else pa.large_string())
    _, offsets, data = wide.buffers()
    starts = np.frombuffer(offsets, np.int64, len(wide) + 1, wide.offset * 8)
    if data is None or starts[-1] == starts[0]:
        return np.empty(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most ``most`` bytes of text (or one row), with their bytes and offsets."""
    data, offsets = text_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield batch.slice(row, stop - row), data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, _U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=_U64)[:n]


_POWER_CACHE: dict[int, np.ndarray] = {}


def cached_powers(n: int, base: int = BASE) -> np.ndarray:
    """Powers for any block length; the table grows to the longest block seen."""
    have = _POWER_CACHE.get(base)
    if have is None or len(have) < n:
        have = _POWER_CACHE[base] = powers(max(n, 2 * len(have) if have is not None else 0), base)
    return have[:n]


INVERSE = pow(BASE, -1, 1 << 64)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H[i] = sum of (byte_j + 1) * BASE^j over j < i; equal substrings have equal shifted differences."""
    out = np.zeros(len(data) + 1, _U64)
    if len(data):
        np.cumsum((data.astype(_U64) + _U64(1)) * cached_powers(len(data)), out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Position-free hash of data[start:stop] for each pair."""
    return (prefix[stops] - prefix[starts]) * cached_powers(len(prefix), INVERSE)[starts]


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser, so that low and high bits of hashes are usable alone."""
    x = values ^ _U64(seed * BASE % (1 << 64))
    x = (x ^ (x >> _U64(33))) * _U64(FINAL_1)
    x = (x ^ (x >> _U64(33))) * _U64(FINAL_2)
    return x ^ (x >> _U64(33))


def byte_table(members: str, *, wide: bool) -> np.ndarray:
    """Truth value per byte: the listed ASCII characters, and the bytes of other characters if ``wide``."""
    out = np.zeros(256, bool)
    out[[ord(c) for c in members]] = True
    out[128:] = wide
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and stops of all words; no word crosses the end of a text."""
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, stops
