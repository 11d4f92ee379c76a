"""Word shingles of texts as 64-bit numbers, computed over whole batches of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Odd constants: a polynomial base, its inverse modulo 2**64, and mixing factors.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
WORDS = len(PLACES)
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
# Bytes of text that are looked at together.
PIECE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of a number modulo 2**64, extended as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            size = 1 << max(16, (n - 1).bit_length())
            factors = np.full(size, self.base)
            factors[0] = 1
            self.known = np.cumprod(factors)
        return self.known[:n]


POWERS, INVERSES = Powers(BASE), Powers(INVERSE)


def word_numbers(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of the joined texts, and each text's first word.

    ``starts`` are the texts' first bytes and the end of the last. Equal words get
    equal numbers: a word's bytes as a polynomial, moved to power zero.
    """
    blank = BLANK[data]
    edge = np.ones(len(data), bool)
    edge[1:] = blank[:-1]
    edge[starts[:-1][starts[:-1] < len(data)]] = True
    first = np.flatnonzero(edge & ~blank)
    last = np.ones(len(data), bool)
    last[:-1] = edge[1:] | blank[1:]
    end = np.flatnonzero(last & ~blank) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    # Bytes count from 1, so that a zero byte makes a difference.
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POWERS.upto(len(data)), out=sums[1:])
    numbers = (sums[end] - sums[first]) * INVERSES.upto(len(data) + 1)[first]
    return mix(numbers + (end - first).astype(np.uint64)), np.searchsorted(first, starts)


def sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted different shingles of each text of a string array without nulls.

    A shingle is five words in a row; a text of one to four words has one, of all
    its words; one without words has none.
    """
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1] if n else []
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + PIECE, "right")) - 1)
        part = data[offsets[at] : offsets[stop]]
        words, bounds = word_numbers(part, offsets[at : stop + 1].astype(np.int64) - int(offsets[at]))
        shingled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            shingled += words[k : k + len(shingled)] * PLACES[k]
        shingled = mix(shingled)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if high - low >= WORDS:
                yield np.unique(shingled[low : high - WORDS + 1])
            elif high > low:
                few = (words[low:high] * PLACES[: high - low]).sum(dtype=np.uint64)
                yield mix(np.array([few], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
        at = stop
