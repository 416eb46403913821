"""Cutting texts where the public splitting pattern cuts them, by numpy over whole slices.

The pattern's matches are runs of letters, of numbers and of other characters, each with one space
before it, contractions, and white space; a run of white space leaves its last character to
what follows. All of that is seen from where the class of characters changes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

from isoforge.llm.bytescan import Slice

OTHER, LETTER, NUMBER, SPACE, BETWEEN = range(5)
#: What may follow an apostrophe as a contraction.
CONTRACTED = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of each code point; surrogates stand in no text."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = (x + 0x800 * (x > 0xD7FF) for x in (m.start(), m.end() - 1))
            out[a : b + 1] = kind
    return out


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of the character that each byte of valid UTF-8 belongs to."""
    classes = character_classes()
    out = classes[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        size = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
        code = (data[lead] & (0xFF >> (size + 1)).astype(np.uint8)).astype(np.int64)
        for i in (1, 2, 3):
            there = size > i
            code[there] = code[there] << 6 | data[lead[there] + i] & 0x3F
        kind = classes[code]
        out[lead] = kind
        for i in (1, 2, 3):
            there = size > i
            out[lead[there] + i] = kind[there]
    return out


def pieces(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all matches of the pattern in the texts of a slice of valid UTF-8."""
    data = part.data
    kind = byte_classes(data)
    kind[part.begins[1:] - 1] = BETWEEN
    begins = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
    ends = np.concatenate((begins[1:], [len(data)]))
    of = kind[begins]
    follows = np.concatenate((of[1:], [BETWEEN]))
    cut = np.zeros(len(data) + 1, bool)
    cut[begins] = True
    # White space before something: its last character stands alone or joins, if it is a space.
    open_ = np.flatnonzero((of == SPACE) & (follows != BETWEEN))
    last = ends[open_] - 1
    for _ in range(2):
        last -= (data[last] & 0xC0) == 0x80
    cut[last] = True
    joins = open_[data[last] == 0x20]
    cut[begins[joins + 1]] = False
    # Contractions: an apostrophe that no space has joined, and letters.
    alone = (of == OTHER) & (ends - begins == 1) & (data[begins] == 0x27) & (follows == LETTER)
    alone[joins + 1] = False
    for i in np.flatnonzero(alone).tolist():
        a, b = int(ends[i]), int(ends[i + 1])
        after = data[a : min(a + 2, b)].tobytes()
        size = next((len(c) for c in CONTRACTED if after.startswith(c)), 0)
        if size:
            cut[a] = False
            cut[a + size] = True  # where the letters end something starts anyway
    starts = np.flatnonzero(cut[:-1])
    full = kind[starts] != BETWEEN
    return starts[full], np.concatenate((starts[1:], [len(data)]))[full]
