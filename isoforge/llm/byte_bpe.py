"""Byte-level BPE: the tokenizers library over Arrow batches.

numpy cuts some megabytes of text at the splitting pattern's matches and finds the distinct ones.
Each worker keeps the ids of those it has met, in arrays, and hands only new ones, byte by byte spelt as
characters, to the library's model; numpy lays the ids out again. A match is known by its bytes:
hashes only sort them, and equal hashes are compared byte by byte.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from isoforge.llm import bytescan, pretokens
from isoforge.llm.common import per_text, table, worker_cache

#: Vocabulary files, in the folder of the public tokenizers.
PACKING_FILE = "byte_bpe_50k.json"
RANKS_FILE = "byte_bpe_multi_50k.tiktoken"
#: Bytes of whole texts that are handled together.
PART = 4 << 20
#: Matches that a worker remembers, about; beyond that it forgets those not met for longest. Longer ones, in bytes, are coded each time.
REMEMBERED, LONGEST = 800_000, 64
#: Stands between spelt matches; no byte is spelt so.
_APART = "\uffff"


@lru_cache(1)
def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: printable Latin-1 for itself, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def tokenizer_of_ranks(ranks: dict[bytes, int]):
    """A tokenizers model that merges as the ranks say.

    A rank file gives no merges, only the rank of each result: every cut of a token into two
    known tokens is a merge, in the order of the results' ranks.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    to = byte_characters()
    spelt = {t: "".join(to[b] for b in t) for t in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        merges += [(spelt[token[:i]], spelt[token[i:]]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    out = Tokenizer(models.BPE(vocab={spelt[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    out.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return out


def distinct_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each kind of equal runs of bytes, and the kind of each run."""
    coded = pa.array(bytescan.hashed_runs(data, starts, ends)).dictionary_encode()
    which = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    if not _equal_runs(data, starts, ends, first[which]):
        raw, kinds = data.tobytes(), {}
        which = np.array([kinds.setdefault(raw[a:b], len(kinds)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        first = np.empty(len(kinds), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
    return first, which


def _equal_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether each run has the same bytes as the run ``other`` says."""
    size, twin = ends - starts, starts[other]
    if not np.array_equal(size, size[other]):
        return False
    eight, at, done = bytescan.eights(data), np.arange(len(starts)), 0
    while len(at):
        rest = np.minimum(size[at] - done, 8)
        shift = (8 * (8 - rest)).astype(np.uint64)
        if ((eight[starts[at] + done] ^ eight[twin[at] + done]) << shift).any():
            return False
        done += 8
        at = at[size[at] > done]
        if done == 256:  # few are longer
            raw = data.tobytes()
            return all(raw[a : a + n] == raw[b : b + n] for a, b, n in zip(starts[at].tolist(), twin[at].tolist(), size[at].tolist(), strict=True))
    return True


class Remembered:
    """Ids of runs of bytes in some forty bytes each: arrays by the order of arrival, and sorted hashes that lead to them."""

    def __init__(self):
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.text, self.ids = np.zeros(0, np.uint8), np.zeros(0, "<u4")
        self.text_ends, self.id_ends, self.used = (np.zeros(1, np.int32) for _ in range(3))  # a zero before the first
        self.turn = 0

    def __len__(self) -> int:
        return len(self.rows)

    def found(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of each run, -1 where it is not there. Where one hash stands for two runs, all are forgotten."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self):
            return out
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        met = np.flatnonzero(self.hashes[at] == hashes)
        rows = self.rows[at[met]].astype(np.int64)
        both = np.concatenate((self.text, data))
        mine, own = self.text_ends[rows].astype(np.int64), starts[met] + len(self.text)
        runs = np.concatenate((own, mine)), np.concatenate((own + ends[met] - starts[met], self.text_ends[rows + 1].astype(np.int64)))
        if not _equal_runs(both, *runs, np.tile(len(met) + np.arange(len(met)), 2)):
            self.__init__()
            return out
        out[met] = rows
        self.turn += 1
        self.used[rows + 1] = self.turn
        return out

    def add(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Runs that are not there, with their ids one after another."""
        order = np.argsort(hashes, kind="stable")
        place = np.searchsorted(self.hashes, hashes[order])
        self.rows = np.insert(self.rows, place, (len(self) + order).astype(np.int32))
        self.hashes = np.insert(self.hashes, place, hashes[order])
        self.text = np.concatenate((self.text, data[_spread(starts, ends - starts)]))
        self.ids = np.concatenate((self.ids, ids))
        self.text_ends = np.concatenate((self.text_ends, self.text_ends[-1] + np.cumsum(ends - starts, dtype=np.int32)))
        self.id_ends = np.concatenate((self.id_ends, self.id_ends[-1] + np.cumsum(sizes, dtype=np.int32)))
        self.used = np.concatenate((self.used, np.full(len(starts), self.turn, np.int32)))
        if len(self) > REMEMBERED:
            self._forget()

    def _forget(self) -> None:
        """The half that was not met for longest."""
        kept = np.sort(np.argsort(self.used[1:], kind="stable")[len(self) // 2 :])
        place = np.full(len(self), -1, np.int32)
        place[kept] = np.arange(len(kept), dtype=np.int32)
        there = place[self.rows] >= 0
        self.hashes, self.rows = self.hashes[there], place[self.rows[there]]
        for name in ("text", "id"):
            ends = getattr(self, f"{name}_ends")
            size = np.diff(ends)[kept]
            pool = "ids" if name == "id" else name
            setattr(self, pool, getattr(self, pool)[_spread(ends[kept], size)])
            setattr(self, f"{name}_ends", np.concatenate((np.zeros(1, np.int32), np.cumsum(size, dtype=np.int32))))
        self.used = np.concatenate((np.zeros(1, np.int32), self.used[kept + 1]))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all members of runs, one run after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Coder:
    """Ids of texts, and bytes of ids, of one vocabulary file. Special tokens' strings in a text are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        if path.endswith(".tiktoken"):
            ranks = read_ranks(path)
            self.model = tokenizer_of_ranks(ranks)
            vocabulary = {i: t for t, i in ranks.items()}
        else:
            self.model = Tokenizer.from_file(path)
            self.model.encode_special_tokens = True
            back = {c: b for b, c in byte_characters().items()}
            added = {i: t.content.encode() for i, t in self.model.get_added_tokens_decoder().items()}
            vocabulary = {i: added[i] if i in added else bytes(back[c] for c in t) for t, i in self.model.get_vocab().items()}
        self.bytes_of = [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]
        self.merges = self.model.model
        self.spelling = byte_characters()
        self.known = Remembered()

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, unsigned 32-bit. Bytes that are no UTF-8 count as U+FFFD."""
        return [ids for part in bytescan.slices([_valid(t) for t in texts], PART) for ids in self._of_slice(part)]

    def _of_slice(self, part: bytescan.Slice) -> Iterator[np.ndarray]:
        starts, ends = pretokens.pieces(part)
        first, which = distinct_runs(part.data, starts, ends)
        starts_of, ends_of = starts[first], ends[first]
        hashes = bytescan.hashed_runs(part.data, starts_of, ends_of)
        rows = self.known.found(hashes, part.data, starts_of, ends_of)
        met, new = np.flatnonzero(rows >= 0), np.flatnonzero(rows < 0)
        learnt, counts = self._learnt(part.data, starts_of[new], ends_of[new])
        sizes, begins = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        sizes[met], begins[met] = np.diff(self.known.id_ends)[rows[met]], self.known.id_ends[rows[met]]
        sizes[new], begins[new] = counts, len(self.known.ids) + np.cumsum(counts) - counts
        own = sizes[which]
        all_ids = np.concatenate((self.known.ids, learnt))[_spread(begins[which], own)]
        at = np.concatenate(([0], np.cumsum(own)))[np.searchsorted(starts, part.begins)]
        short = ends_of[new] - starts_of[new] <= LONGEST
        kept = new[short]
        self.known.add(hashes[kept], part.data, starts_of[kept], ends_of[kept], learnt[np.repeat(short, counts)], counts[short])
        for i in range(len(part)):
            yield all_ids[at[i] : at[i + 1]]

    def _learnt(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs, one run after another, and the number of each run's."""
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        raw, tokenize = data.tobytes().decode("latin-1"), self.merges.tokenize
        ids, counts = array("I"), []
        spelt = _APART.join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]).translate(self.spelling).split(_APART)
        for word in spelt:
            own = [t.id for t in tokenize(word)]
            ids.extend(own)
            counts.append(len(own))
        return np.frombuffer(ids, np.uint32).astype("<u4"), np.array(counts, np.int64)

    def with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids, and the characters of the text that each covers; a split character's tokens share it."""
        e = self.model.encode(text, add_special_tokens=False)
        return e.ids, e.offsets

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """Characters split over tokens are whole again; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _valid(text: bytes) -> bytes:
    try:
        text.decode()
        return text
    except UnicodeDecodeError:
        return text.decode("utf-8", "replace").encode()


@worker_cache(4)
def coder(path: str) -> Coder:
    return Coder(path)


def encode_texts(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``ids`` and ``offsets`` (start and end character of each id) of each whole text.

    Null and empty texts have no ids.
    """

    def columns(texts):
        got = [coder(path).with_offsets(t.decode("utf-8", "replace")) for t in texts]
        return [[x[0] for x in got], [[{"start": a, "end": b} for a, b in x[1]] for x in got]]

    return per_text(docs, keep, text, "ids array<int>, offsets array<struct<start:int,end:int>>", columns)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``text`` of each array of ids; null and empty arrays give the empty text."""
    from pyspark.sql import functions as F
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def decoded(column):
        return column.map(lambda x: "" if x is None else coder(path).decode(np.asarray(x, np.int64)))

    return df.select(*keep, decoded(F.col(ids)).alias("text"))


def code_digests(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number and digest of each text's ids, and the digest of the bytes decoded from them."""

    def columns(texts):
        own = coder(path)
        rows = []
        for ids in own.ids(texts):
            rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(own.decode_bytes(ids)).hexdigest()))
        return list(zip(*rows, strict=True))

    return per_text(docs, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS_FILE))
