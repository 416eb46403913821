"""Vectorised scanning of UTF-8 text: word bounds and 64-bit word and shingle hashes.

Texts of a batch are laid end to end, a space after each, and handled in slices of
about a megabyte of whole texts, so that memory follows the slice and not the batch.
Hashes are 64 bits wide and act as identities of words and shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE = 1 << 20
_SPACES = bytes([0x20, *range(0x09, 0x0E)])


def word_table(separators: bytes) -> np.ndarray:
    """True for each byte that belongs to a word."""
    out = np.ones(256, bool)
    out[list(separators)] = False
    return out


#: Words are runs of anything but ASCII white space.
NOT_SPACE = word_table(_SPACES)
#: Words are runs of digits, lower-case letters and anything beyond ASCII.
ALNUM = word_table(bytes(x for x in range(0x80) if not (0x30 <= x <= 0x39 or 0x41 <= x <= 0x5A or 0x61 <= x <= 0x7A)))


#: A-Z as a-z, everything else as it is.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
#: Bytes of a word up to which numpy hashes it, eight at a time; a library hashes longer ones.
_LONGEST = 256
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Whole texts of rows ``first`` to ``first + len(lengths) - 1`` of a batch."""

    first: int
    data: np.ndarray  # the bytes, a space after each text
    begins: np.ndarray  # of each text, and the end of the last
    lengths: np.ndarray

    def __len__(self) -> int:
        return len(self.lengths)


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE) -> Iterator[Slice]:
    first = size = 0
    for i, text in enumerate([*texts, None]):
        if text is None or size and size + len(text) > limit:
            if i > first:
                part = texts[first:i]
                lengths = np.fromiter(map(len, part), np.int64, len(part))
                begins = np.concatenate(([0], np.cumsum(lengths + 1)))
                yield Slice(first, np.frombuffer(b" ".join(part) + b" ", np.uint8), begins, lengths)
            first, size = i, 0
        size += len(text or b"")


def bounds(part: Slice, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (and the total)."""
    inside = in_word[part.data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, np.searchsorted(starts, part.begins)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number; zeros follow the data."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))


def hashed_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end: eight bytes at a time, each mixed into what came before.

    Runs of up to eight bytes and of one length never share a hash. Longer ones than ``_LONGEST``
    are hashed by a library, so that one long word takes no loop over all words.
    """
    eight, size = eights(data), ends - starts
    with np.errstate(over="ignore"):
        out = mix(mix(size.astype(np.uint64) * _STEP) ^ (eight[starts] & _MASKS[np.minimum(size, 8)]))
        more = np.flatnonzero((size > 8) & (size <= _LONGEST))
        done = 8
        while len(more):
            out[more] = mix(out[more] * _STEP ^ (eight[starts[more] + done] & _MASKS[np.minimum(size[more] - done, 8)]))
            done += 8
            more = more[size[more] > done]
    for i in np.flatnonzero(size > _LONGEST).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return out


def word_hashes(part: Slice, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of the bytes from each start to its end, letters A-Z as a-z."""
    return hashed_runs(FOLD[part.data], starts, ends)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Of each run of k words; of the whole sequence if it is shorter; none without words."""
    k = min(k, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    with np.errstate(over="ignore"):
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = mix(out * np.uint64(0x100000001B3) + words[i : i + n])
    return out


def shingle_sets(texts: list[bytes], k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of each text."""
    for part in slices(texts):
        starts, ends, firsts = bounds(part, NOT_SPACE)
        words = word_hashes(part, starts, ends)
        for i in range(len(part)):
            yield part.first + i, np.unique(shingle_hashes(words[firsts[i] : firsts[i + 1]], k))
