"""Words of whole texts as 64-bit hashes, computed for many rows at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tradewind.llm.common import utf8

#: Separators become 0, A-Z lower case where asked; bytes of other characters stay.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
LETTERS = bytes(range(0x61, 0x7B))


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """What each byte of a text counts as: 0 separates words. A zero byte that is no separator counts as 255 (not in UTF-8)."""
    table = np.arange(256, dtype=np.uint8)
    table[0] = 255
    if lower:
        table[0x41:0x5B] += 0x20
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


#: Words `[^\x20\x09-\x0D]+`, unchanged or with A-Z in lower case.
AS_IS = byte_table(WHITE, lower=False)
FOLDED = byte_table(WHITE, lower=True)
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z went to lower case.
PLAIN = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)

_random = np.random.Generator(np.random.PCG64(20240229))
_OF_BYTE = _random.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP | 1, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hashed_words(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and per row where its words begin (one more entry than rows)."""
    data, starts, ends = utf8(texts)
    rows = len(starts)
    if not rows or ends[-1] == starts[0]:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    origin = starts[0]
    kept = table[data[origin : ends[-1]]]
    inside = kept != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = (starts - origin)[ends > starts]
    first[heads] = inside[heads]
    begins = np.flatnonzero(first)
    borders = np.searchsorted(begins, np.append(starts - origin, ends[-1] - origin))
    if not len(begins):
        return np.zeros(0, np.uint64), borders
    letters = kept[inside]
    word_starts = np.flatnonzero(first[inside])
    sizes = np.diff(np.append(word_starts, len(letters)))
    place = np.arange(len(letters)) - np.repeat(word_starts, sizes)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_OF_BYTE[letters] * powers(int(sizes.max()))[place], word_starts)
    return mixed(sums ^ sizes.astype(np.uint64)), borders


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            total = total * np.uint64(_STEP | 1) + words[k : len(words) - n + 1 + k]
    return mixed(total)


def row_of(borders: np.ndarray) -> np.ndarray:
    """The row that each word belongs to."""
    return np.repeat(np.arange(len(borders) - 1), np.diff(borders))
