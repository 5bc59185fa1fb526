"""Words of a batch of texts and their hashes, as numpy arrays over one byte buffer.

A word is a run of bytes other than space and 0x09 to 0x0D. Hashes are polynomial, modulo 2**64, taken from
prefix sums: the hash of any run of words costs one subtraction and one product, whatever its length. They
only propose; whoever needs certainty compares words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


@dataclass
class Words:
    """``starts`` and ``ends`` are byte positions in ``data``; text ``t`` has words ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def text_of(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut by bytes of ``column``, so that memory follows the longest text and not the batch size."""
    for batch in batches:
        part = np.cumsum(bytes_of(batch, column)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def grouped(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of about ``size`` bytes of ``column`` each, whatever they come in; a longer text has its own."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in chunks(batches, column, size):
        more = int(bytes_of(batch, column).sum())
        if held and n + more > size:
            yield pa.concat_batches(held)
            held, n = [], 0
        held.append(batch)
        n += more
    if held:
        yield pa.concat_batches(held)


def bytes_of(batch: pa.RecordBatch, column: str) -> np.ndarray:
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    return sizes.to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and where each begins; null reads as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def split(data: np.ndarray, at: np.ndarray, space: np.ndarray = IS_SPACE) -> Words:
    inner = ~space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.ones(len(data), dtype=bool)
    before[1:] = ~inner[:-1]
    after = np.ones(len(data), dtype=bool)
    after[:-1] = ~inner[1:]
    starts = np.flatnonzero(inner & (before | edge[:-1]))
    ends = np.flatnonzero(inner & (after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2**64."""
    if base not in _powers or len(_powers[base]) <= n:
        out = np.full(max(n, CHUNK_BYTES) + 1, base, dtype=np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][: n + 1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Runs:
    """Hashes of runs ``values[a:b]``, equal for equal runs wherever they are."""

    def __init__(self, values: np.ndarray, base: int):
        self.inverse = powers(_inverse(base), len(values))
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values.astype(np.uint64) * powers(base, len(values))[:-1], out=self.sums[1:])

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.inverse[a] + (b - a).astype(np.uint64))


def word_hashes(words: Words) -> np.ndarray:
    return Runs(words.data.astype(np.uint64) + np.uint64(1), BYTE_BASE).hashes(words.starts, words.ends)


def joined(words: Words) -> Words:
    """The same words with one space after each, on end in a buffer of their own."""
    sizes = words.ends - words.starts + 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.starts - starts, sizes)
    data = words.data[np.minimum(source, max(len(words.data) - 1, 0))]
    data[ends - 1] = 32
    return Words(data, starts, ends - 1, words.first)
