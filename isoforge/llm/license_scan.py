"""License scans: exact phrases, and short notices with a bounded number of edits.

A notice that may differ in ``e`` edits is split into ``e + 1`` pieces; one of them must
stand in the text unchanged (pigeonhole), so an Aho-Corasick pass over those seeds finds
all candidate places. The ``regex`` library's bounded-error matching then verifies each
place and reports its span and edits.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from isoforge.llm import bytescan
from isoforge.llm.common import per_text, table

#: Fixed phrases and the labels of their places.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Short notices, lower case, words parted by one space, and their labels.
NOTICES = {
    "licensed under the apache license": "apache",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "gnu general public license": "gpl",
    "dedicated to the public domain": "public-domain",
    "released under the mit license": "mit",
    "all rights reserved": "reserved",
}
#: Letters of a notice for each edit that it may hold.
LETTERS_PER_EDIT = 10
_GAP = b"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, notices array<struct<label:string,start:int,end:int,edits:int>>"
)


def edits_allowed(notice: str) -> int:
    return len(notice) // LETTERS_PER_EDIT


def seeds(notice: str) -> list[tuple[int, str]]:
    """Offset and text of edits + 1 pieces of about equal length."""
    cuts = np.linspace(0, len(notice), edits_allowed(notice) + 2).astype(int)
    return [(int(a), notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(1)
def _compiled():
    phrases = [(re.compile(_GAP.join(map(re.escape, p.encode().split()))), label, p.encode().split()[-1]) for p, label in PHRASES.items()]
    automaton = ahocorasick.Automaton()
    found: dict[str, list[tuple[str, int]]] = {}
    for notice in NOTICES:
        for offset, piece in seeds(notice):
            found.setdefault(piece, []).append((notice, offset))
    for piece, places in found.items():
        automaton.add_word(piece, (len(piece), places))
    automaton.make_automaton()
    fuzzy = {n: [regex.compile(rf"{how}(?:{regex.escape(n)}){{e<={edits_allowed(n)}}}") for how in ("", "(?b)")] for n in NOTICES}
    return phrases, automaton, fuzzy


def _matches(first, best, text: str, a: int, b: int, notice: str):
    """Matches from left to right that don't overlap: where one begins, the best one around it.

    Searches see some notices' length at a time, so that a long window takes time in proportion to its length.
    """
    edits = edits_allowed(notice)
    step = 2 * len(notice)
    while b - a >= len(notice) - edits:
        m = first.search(text, a, min(b, a + step + len(notice) + edits))
        if m is None:
            a += step  # what begins before ends within what was searched
            continue
        near = best.search(text, m.start(), min(b, m.end() + 2 * edits)) or m
        yield near
        a = near.end()


def fuzzy_notices(lowered: str) -> list[tuple[int, int, int, str]]:
    """Start, end, edits and label of each notice's places in a lower-cased text.

    White space counts as one space. Overlapping windows of seed hits are joined, and each joined window is
    searched for all its non-overlapping matches, each the best around where it begins. Spans are code points.
    """
    _, automaton, fuzzy = _compiled()
    windows: dict[str, list[list[int]]] = {}
    flat = lowered.translate(_FLAT)
    for last, (length, places) in automaton.iter(flat):
        for notice, offset in places:
            e = edits_allowed(notice)
            begin = last - length + 1 - offset
            a, b = max(0, begin - e), min(len(flat), begin + len(notice) + e)
            own = windows.setdefault(notice, [])
            if own and a <= own[-1][1]:
                own[-1] = [min(own[-1][0], a), max(own[-1][1], b)]
            else:
                own.append([a, b])
    out = []
    for notice, own in windows.items():
        for a, b in own:
            for m in _matches(*fuzzy[notice], flat, a, b, notice):
                out.append((m.start(), m.end(), sum(m.fuzzy_counts), NOTICES[notice]))
    return sorted(out)


_FLAT = {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}


def _columns(texts: list[bytes]) -> list[list]:
    phrases, _, _ = _compiled()
    rows = []
    for part in bytescan.slices(texts):
        starts, _, firsts = bytescan.bounds(part, bytescan.ALNUM)
        for i in range(len(part)):
            lowered = texts[part.first + i].lower()  # ASCII letters only
            hits, base = [], set()
            for pattern, label, last in phrases:
                if last in lowered:
                    for m in pattern.finditer(lowered):
                        a, b = m.span()
                        if not (a and _inside(lowered[a - 1]) or b < len(lowered) and _inside(lowered[b])):
                            hits.append(a)
                            base.add(label)
            at = np.searchsorted(starts, part.begins[i] + np.array(sorted(hits), np.int64)) - firsts[i]
            notices = fuzzy_notices(lowered.decode("utf-8", "replace"))
            best = max((1 - e / max(1, b - a) for a, b, e, _ in notices), default=0.0)
            rows.append(
                (
                    int(firsts[i + 1] - firsts[i]), len(hits), int(at[0]) if hits else None, int(at[-1]) if hits else None,
                    ",".join(sorted(base)), ",".join(sorted(base | {x[3] for x in notices})), 1.0 if base else best,
                    [{"label": n, "start": a, "end": b, "edits": e} for a, b, e, n in notices],
                )
            )
    return list(zip(*rows, strict=True))


def _inside(byte: int) -> bool:
    return 48 <= byte <= 57 or 97 <= byte <= 122 or byte > 127


def scan_licenses(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """License words of each text: one row per document, in one pass without a shuffle.

    Null and empty texts have no words, no places, empty labels, score 0. Repeated rows
    give repeated results. Only the columns ``keep`` go along, so clashing names do no harm.
    ``notices`` has label, start, end (code points of the text) and edits of each match.
    ``score`` is 1 with a base phrase, else the best notice's share of unedited letters.
    """
    return per_text(docs, keep, text, SCHEMA, _columns)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("notices")
