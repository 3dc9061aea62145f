"""Texts of an Arrow batch as flat arrays: bytes, runs of them (words), hashes of runs."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from weir.llm.common import SEPARATORS

_LONGEST_TABLE = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of a splittable generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    powers = np.cumprod(np.full(_LONGEST_TABLE, 0x9E3779B97F4A7C15, np.uint64))
    return values, powers


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, each text followed by a separator, and where each text begins (one more at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return data, offsets


def separator_table(more: bytes = b"") -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SEPARATORS + more)] = True
    return table


def runs(is_separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between separators; the last byte is a separator."""
    edge = np.flatnonzero(np.diff(is_separator.view(np.int8), prepend=np.int8(1)))
    return edge[::2], edge[1::2]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each run of bytes; ``fold`` maps bytes before hashing."""
    if not len(starts):
        return np.empty(0, np.uint64)
    values, powers = _tables()
    if fold is not None:
        values = values[fold]
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(first, sizes)
    flat = values[data[place + np.repeat(starts, sizes)]] * powers[place % _LONGEST_TABLE]
    # Runs longer than the table repeat its powers; their place must still count.
    long = place >= _LONGEST_TABLE
    if long.any():
        flat[long] = mixed(flat[long] + place[long].astype(np.uint64))
    return mixed(np.add.reduceat(flat, first) + sizes.astype(np.uint64))


@lru_cache(maxsize=1)
def lower_ascii() -> np.ndarray:
    table = np.arange(256)
    table[ord("A") : ord("Z") + 1] += 32
    return table
