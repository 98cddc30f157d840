"""Words, hashes and classes of text, computed over the UTF-8 bytes of whole Arrow batches.

A batch of texts becomes one byte array with a line feed after every text, so that numpy works on
all of its texts at once. Sub-batches are limited by bytes, which bounds the memory of a task
whatever the length of the texts; a text longer than the limit is a sub-batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LINE_FEED = 10
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for k, base in enumerate((BASE, BASE_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def spans_hash(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``symbols[start:end]`` for every span, the same wherever the span lies."""
    up, down = powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up[: len(symbols)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: A random 64-bit symbol for each byte value, so that hashes don't inherit the order of bytes.
SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words once A-Z are lower-cased: digits, a-z and every byte beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: The white space of the contracts: blank and the codes 9 to 13.
BLANK = np.zeros(256, bool)
BLANK[9:14] = BLANK[32] = True


@dataclass
class Texts:
    """Some texts as one byte array; text i is data[starts[i]:ends[i]], a line feed follows it."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def text_blocks(column: pa.Array, limit: int = 1 << 19) -> Iterator[Texts]:
    """The texts of an Arrow column in blocks of about ``limit`` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        bounds = offsets[at : to + 1]
        ends = bounds[1:] - bounds[0]
        joined = np.insert(data[bounds[0] : bounds[-1]], ends, LINE_FEED)
        order = np.arange(to - at)
        yield Texts(at, joined, bounds[:-1] - bounds[0] + order, ends + order)
        at = to


@dataclass
class Words:
    """Words of some texts: word w is lower[starts[w]:ends[w]]; text i has words bounds[i]:bounds[i + 1]."""

    lower: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def text(self, a: int, b: int) -> bytes:
        """Words a to b - 1, joined by blanks."""
        return b" ".join(self.lower[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    steps = np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def words_of(texts: Texts) -> Words:
    """Maximal runs of word bytes after lower-casing A-Z, with a hash of each."""
    lower = LOWER[texts.data]
    starts, ends = runs(WORD[lower])
    bounds = np.append(np.searchsorted(starts, texts.starts), len(starts))
    return Words(lower, starts, ends, bounds, spans_hash(SYMBOL[lower], starts, ends))


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` consecutive words of one text, and their first words."""
    last = np.repeat(words.bounds[1:], np.diff(words.bounds))
    at = np.arange(len(words.hashes))
    at = at[at + size <= last]
    return spans_hash(words.hashes, at, at + size), at
