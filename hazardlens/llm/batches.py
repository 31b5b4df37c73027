"""Arrow batches cut into pieces of bounded size, and words of many texts at once as arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices that hold about ``size`` bytes of ``column``; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(column).cast(pa.large_binary()).fill_null(b"")
        ends = np.cumsum(np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset :][: len(lengths) + 1]))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of several texts: place in ``data``, number of their text, hash of their bytes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    n_texts: int

    def first(self) -> np.ndarray:
        """Where each text's words begin in the word arrays, with the total at the end."""
        return np.searchsorted(self.text, np.arange(self.n_texts + 1))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other with a line break behind each, and where each begins."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    return data, np.concatenate([[0], np.cumsum(sizes)])


def encoded(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8, null as empty."""
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


def words(texts: list[bytes], fold: bool = True) -> Words:
    """Words (runs without white space) of all texts; ``fold`` reads A-Z as a-z."""
    data, offsets = joined(texts)
    word = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    text = np.searchsorted(offsets, starts, side="right") - 1
    lengths = ends - starts
    if len(starts):
        inside = np.flatnonzero(word)
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(len(inside)) - np.repeat(first, lengths)
        letters = data[inside]
        if fold:
            letters = _LOWER[letters]
        hashes = np.add.reduceat(_BYTE[letters] * _PLACE[place & 4095], first)
        hashes = mix(hashes + lengths.astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, starts, ends, text, hashes, len(texts))
