"""N-gram Jaccard join by token-combination prefixes.

A document is its set of word shingles, each a 64-bit hash; equal sets are one item, named by
a fingerprint. Tokens are ordered by frequency class, then by hash. Similar sets share the
first tokens of that order: if sets x and y have a Jaccard similarity of t or more, their
first common token lies in the first ``|x| - ceil(t|x|) + 1`` tokens of x, and likewise of y.

- Rare class: each rare token of that prefix is indexed by itself.
- Frequent class c, with combinations of k tokens: if the first common token is of class c,
  all common tokens are of class c or above, and at most D = floor(|x| (1 - t) / t) tokens of
  the two sets are not common. These part the first (k - 1)(D + 1) + 1 common tokens into at
  most D + 1 runs, one of which has k tokens that follow each other in both sets. So every k
  neighbouring tokens of class c or above are indexed, in the prefix extended by that many
  tokens. Their number grows with the prefix, not with its k-th power.
- Long sets have so many tokens that even rare ones meet by chance, in passages that documents
  share. There the rare class has combinations too, of two tokens. A set a little shorter than a long
  one, which may be similar to one, has both kinds of keys.

Frequency classes come from a count sketch over all documents: a bucket's count is never less
than its tokens' frequencies, and any fixed classes give right results.

Texts are read once: sets and sketch go to the shared folder. Sets that share a key are candidates.
Signatures of 512 parities bound each pair: the bits in which two signatures differ are at most the
tokens that are not common, so too many of them rule the pair out, without error. Keys are counted
first, and the rows of one that many sets hold are dealt into blocks of about UNIT_ROWS:

- Twice, with other blocks each time, each set is verified against the one of its block with the
  nearest signature, outside its component so far. That takes time in proportion to the rows.
- Then pairs of different components are verified. Of a key's rows, those of its largest component stay
  in their block each, and others visit every block; so a key of a large group and a few strangers
  takes time in proportion, too. Of a pair one set at least has the key early, behind few tokens of its own;
  a key that no set has early has no pairs, so that sets of one pattern with too many words of their own
  take time in proportion.

Pairs within a component need no proof to find it. So few parities say nothing of a set of thousands
of tokens: such pairs are bounded once more, by signatures as wide as the smaller set, before the sets
themselves travel. Links are counted component by component, block by block of its sets, from products
of their token matrices; only counts leave a task, and a group's copies are counted by their number.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from isoforge.llm import bytescan
from isoforge.llm.common import beside_groups, runs, save, small_batches, table
from isoforge.llm.components import components

SKETCH_BITS = 21
SKETCH_BLOCK_BITS = 15
#: Least count of a bucket, and times the mean count, of each frequent class, and its tokens to a combination.
CLASSES = ((64, 4, 3), (1024, 64, 5))
#: Tokens of a long set, and tokens to a combination of its rare class.
LONG, LONG_K = 2048, 2
#: Bits of the filter that picks the sets of candidates, at least and at most (32 MB), and for each mark.
FILTER_BITS, MARK_BITS = (20, 28), 8
SIGNATURE_BITS = 512
PAIRS_AT_ONCE = 50_000
#: Pairs of a key that are compared at once.
CELLS = 1 << 16
#: Rows of a key, and sets of a component and their tokens, that are compared in one unit.
UNIT_ROWS, UNIT_SETS, UNIT_TOKENS = 512, 256, 1 << 19
#: Columns of a token matrix at once.
MATRIX_COLUMNS = 1 << 13
#: Bytes of tokens that are handled together.
FEW_BYTES = 4 << 20

#: The 64-bit words of a signature, a column each, so that aggregates keep them in place.
SIGNS = [f"sign{i}" for i in range(SIGNATURE_BITS // 64)]
_SETS = [("n_shingles", pa.int64()), ("name", pa.int64()), *((s, pa.int64()) for s in SIGNS), ("tokens", pa.binary())]
_SKETCH = [("block", pa.int32()), ("counts", pa.binary())]
READ = pa.schema([("id", pa.int64()), ("row", pa.int64()), *_SETS, *_SKETCH])


def _read(batches, k: int) -> Iterator[pa.RecordBatch]:
    """Name, size, signature and tokens of each text's set; of equal sets in a batch one alone has tokens. Then the sketch."""
    counts, waiting, size = np.zeros(1 << SKETCH_BITS, np.int64), [], 0

    def count():
        if waiting:
            np.add(counts, np.bincount(np.concatenate(waiting), minlength=len(counts)), out=counts)
            waiting.clear()

    for batch in batches:
        texts, seen = batch.column(2), set()
        for a, b in runs(texts):
            rows = []
            for _, own in bytescan.shingle_sets(bytescan.encoded(texts.slice(a, b - a)), k):
                name = set_name(own)
                rows.append((len(own), name, *np.frombuffer(signature(own), "<i8").tolist(), own.tobytes() if len(own) and name not in seen else None))
                seen.add(name)
                waiting.append((own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                size += len(own)
            made = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _SETS, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in (0, 1)), *made, *(pa.nulls(b - a, t) for _, t in _SKETCH)], schema=READ)
            if size >= 1 << 19:
                count()
                size = 0
    count()
    for block in _as_blocks({b: x for b, x in enumerate(counts.reshape(-1, 1 << SKETCH_BLOCK_BITS)) if x.any()}):
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(block), f.type) for f in list(READ)[: -len(_SKETCH)]), *block.columns], schema=READ)


def _as_blocks(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if blocks:
        yield pa.RecordBatch.from_arrays([pa.array([*blocks], pa.int32()), pa.array([zlib.compress(x.astype("<i8").tobytes(), 1) for x in blocks.values()], pa.binary())], names=["block", "counts"])


def _sum_blocks(batches) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(zlib.decompress(raw), "<i8")
            blocks[b] = blocks[b] + own if b in blocks else own
    yield from _as_blocks(blocks)


def token_classes(read: DataFrame) -> np.ndarray:
    """Class of each bucket of hashes: 0 rare, then as in CLASSES. 2 MB, whatever the input.

    Each task has counted all its documents; the counts are summed by block in a shuffle.
    """
    blocks = 1 << (SKETCH_BITS - SKETCH_BLOCK_BITS)
    own = read.filter("block IS NOT NULL").select("block", "counts")
    summed = own.repartition(blocks, "block").mapInArrow(_sum_blocks, own.schema)
    counts = np.zeros((blocks, 1 << SKETCH_BLOCK_BITS), np.int64)
    for row in summed.collect():
        counts[row["block"]] = np.frombuffer(zlib.decompress(bytes(row["counts"])), "<i8")
    mean = counts.mean()
    return sum((counts.ravel() >= max(least, times * mean)).astype(np.uint8) for least, times, _ in CLASSES)


def set_name(own: np.ndarray) -> int:
    """Fingerprint of a sorted set; 0 is the empty set's."""
    with np.errstate(over="ignore"):
        total = bytescan.mix(own ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
        return int(bytescan.mix(np.array([total + np.uint64(len(own))]))[0].astype(np.int64)) if len(own) else 0


def signature(own: np.ndarray) -> bytes:
    """Parity of the number of tokens in each of 512 classes."""
    counts = np.bincount((bytescan.mix(own) & np.uint64(SIGNATURE_BITS - 1)).astype(np.int64), minlength=SIGNATURE_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def wide_signature(own: np.ndarray) -> bytes:
    """As many parities as the set has tokens, rounded up to a power of two; none where ``signature`` has as many."""
    width = 1 << (len(own) - 1).bit_length()
    if width <= SIGNATURE_BITS:
        return b""
    counts = np.bincount((bytescan.mix(own) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def wide_difference(x: bytes, y: bytes) -> int:
    """Bits in which two wide signatures differ, the wider one folded: halves of a signature add up to one half as wide."""
    if not x or not y:
        return 0
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    return int(np.bitwise_count(np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0) ^ a).sum())


def keys_of(own: np.ndarray, classes: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a sorted set under which each similar set that isn't equal has one too, and which are early. share: similarity as a fraction.

    Tokens that come before the first common one are of one set alone. Two similar sets of m and n tokens have
    at most (m + n)(1 - t)/(1 + t) such tokens, so that of the key of their first common token one set at
    least has no more than its part before it: there the key is early.
    """
    n, (p, q) = len(own), share
    if n * (q - p) < p:
        return own[:0], np.zeros(0, bool)  # no other set is that similar: one token more or less is too many
    kind = classes[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.argsort(kind, kind="stable")  # hashes are in order already
    tokens, kind = own[order], kind[order]
    apart = n - -(-p * n // q)
    most = n * (q - p) // p
    prefix = apart + 1
    out, early = ([tokens[:prefix][kind[:prefix] == 0]], [np.arange(int((kind[:prefix] == 0).sum())) * (p + q) <= n * (q - p)]) if n < LONG else ([], [])
    for c in np.unique(kind[:prefix]):
        if c or n * q >= LONG * p:
            k = CLASSES[c - 1][2] if c else LONG_K
            first = int(np.searchsorted(kind, c))
            window = tokens[first : min(n, apart + (k - 1) * (most + 1) + 1)]
            count = len(window) - k + 1
            if count > 0:
                with np.errstate(over="ignore"):
                    key = np.full(count, int(c), np.uint64)
                    for i in range(k):
                        key = bytescan.mix(key * np.uint64(0x100000001B3) + window[i : i + count])
                out.append(key)
                early.append(np.full(count, first * (p + q) <= n * (q - p)))
    return (np.concatenate(out), np.concatenate(early)) if out else (own[:0], np.zeros(0, bool))


def _token_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted tokens of each row."""
    for raw in column.to_pylist():
        yield np.frombuffer(raw, "<u8")


def _few(batches, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of about FEW_BYTES in one column, so that memory follows them and not the batch."""
    for batch in batches:
        for a, b in runs(batch.column(column), FEW_BYTES):
            yield batch.slice(a, b - a)


def _postings(batches, classes, share) -> Iterator[pa.RecordBatch]:
    """Keys of each set: key, name, size, early."""
    for batch in _few(batches, 1):
        keys = [keys_of(own, classes.value, share) for own in _token_sets(batch.column(1))]
        counts, names = [len(x) for x, _ in keys], batch.column(0).to_numpy()
        sizes = pc.divide(pc.binary_length(batch.column(1)), 8).to_numpy().astype(np.int32)
        if sum(counts):
            own, early = np.concatenate([x for x, _ in keys]).astype(np.int64), np.concatenate([x for _, x in keys])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.repeat(names, counts)), pa.array(np.repeat(sizes, counts)), pa.array(early)], names=["key", "name", "size", "early"])


def _lists(batches, keys: int = 1) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Columns of whole units and where each begins, from batches sorted by the first ``keys`` columns."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            rest = columns if rest is None else [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        if rest is None or not len(rest[0]):
            continue
        differ = np.any([x[1:] != x[:-1] for x in rest[:keys]], axis=0)
        begins = np.concatenate(([0], np.flatnonzero(differ) + 1))
        end = begins[-1] if batch is not None else len(rest[0])
        if end:
            yield [x[:end] for x in rest], begins[begins < end]
            rest = [x[end:] for x in rest]


def _pairs(batches, share, nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of sets of the same unit that are of different components and that sizes and signatures don't rule out.

    For each set only the one whose signature is nearest; or all such pairs of a row at home and a visitor.
    """
    p, q = share
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for (key, name, size, group, early, home, visits, *words), starts in _lists(batches):
        signs, size = np.stack(words, 1).view(np.uint64), size.astype(np.int64)
        early, home, visits = early.astype(bool), home.astype(bool), visits.astype(bool)
        counts = np.diff(np.concatenate((starts, [len(key)])))
        mixed = np.maximum.reduceat(group, starts) != np.minimum.reduceat(group, starts)
        # Units with the same sets have the same pairs.
        with np.errstate(over="ignore"):
            same = np.add.reduceat(bytescan.mix(name.astype(np.uint64) + (home + 2 * visits + 4 * early).astype(np.uint64)), starts)
        once = np.zeros(len(starts), bool)
        once[np.unique(same, return_index=True)[1]] = True
        starts, counts = starts[mixed & once], counts[mixed & once]
        two = starts[counts == 2]
        if len(two):
            differ = np.bitwise_count(signs[two] ^ signs[two + 1]).sum(1, dtype=np.int64)
            fits = _fits(differ, size[two], size[two + 1], p, q) & (early[two] | early[two + 1])
            two, differ = two[fits], differ[fits]
            waiting.append((name[two], name[two + 1], differ))
            if nearest:
                waiting.append((name[two + 1], name[two], differ))
        for a, n in zip(starts[counts > 2].tolist(), counts[counts > 2].tolist(), strict=True):
            rows, others = np.flatnonzero(home[a : a + n]) + a, np.flatnonzero(visits[a : a + n]) + a
            step = max(1, CELLS // max(1, len(others)))
            for i in range(0, len(rows) if len(others) else 0, step):
                part = rows[i : i + step]
                differ = np.bitwise_count(signs[part, None, :] ^ signs[None, others, :]).sum(2, dtype=np.int64)
                fits = _fits(differ, size[part, None], size[None, others], p, q) & (group[part, None] != group[None, others]) & (early[part, None] | early[None, others])
                if nearest:
                    x = np.flatnonzero(fits.any(1))
                    y = np.where(fits, differ, 1 << 30)[x].argmin(1)
                else:
                    x, y = np.nonzero(fits)
                if len(x):
                    waiting.append((name[part[x]], name[others[y]], differ[x, y]))
                if sum(len(x[0]) for x in waiting) >= PAIRS_AT_ONCE:
                    yield _distinct(waiting)
    if waiting:
        yield _distinct(waiting)


def _fits(differ, size, other, p: int, q: int):
    """Neither the sizes nor the bits that differ rule out a similarity of p / q."""
    return (differ * (p + q) <= (size + other) * (q - p)) & (np.minimum(size, other) * q >= np.maximum(size, other) * p)


def _distinct(waiting) -> pa.RecordBatch:
    """Distinct rows of a, b and the bits that differ."""
    rows = np.unique(np.stack([np.concatenate(x) for x in zip(*waiting, strict=True)], 1), axis=0)
    waiting.clear()
    return pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names=["a", "b", "differ"])


def in_filter(bits: bytes, at: np.ndarray) -> np.ndarray:
    at = at & (8 * len(bits) - 1)
    return np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7) & 1 == 1


def _id_mark(name: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Bits that stand for a set and one of its documents."""
    return bytescan.mix(name.astype(np.uint64) ^ bytescan.mix(ids.astype(np.uint64))).astype(np.int64)


def _wanted_sets(batches, wanted) -> Iterator[pa.RecordBatch]:
    """Name, row, size, wide signature and tokens of the sets that the filter lets through."""
    for batch in _few(batches, 2):
        there = in_filter(wanted.value, _id_mark(batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        own = batch.filter(pa.array(there))
        sets = list(_token_sets(own.column(2)))
        sizes, signs = [len(x) for x in sets], [wide_signature(x) for x in sets]
        yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(sizes, pa.int32()), pa.array(signs, pa.binary()), own.column(2)], names=["name", "row", "size", "wide", "tokens"])


def _verified(batches, share) -> Iterator[pa.RecordBatch]:
    p, q = share
    for batch in _few(batches, 2):
        keep = []
        for x, y in zip(_token_sets(batch.column(2)), _token_sets(batch.column(3)), strict=True):
            total = len(x) + len(y)
            if len(x) > len(y):
                x, y = y, x
            common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            keep.append(q * common >= p * (total - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def common_tokens(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Number of tokens that each of ``sets`` has in common with each of ``others``: a product of token matrices."""
    tokens, at = np.unique(np.concatenate([*sets, *others]), return_inverse=True)
    several = np.flatnonzero(np.bincount(at) > 1)
    column = np.full(len(tokens), -1)
    column[several] = np.arange(len(several))
    row, at = np.repeat(np.arange(len(sets) + len(others)), [len(x) for x in (*sets, *others)]), column[at]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(sets), len(others)), np.float32)
    for first in range(0, len(several), MATRIX_COLUMNS):
        a, b = np.searchsorted(at, (first, first + MATRIX_COLUMNS))
        part = np.zeros((len(sets) + len(others), min(MATRIX_COLUMNS, len(several) - first)), np.float32)
        part[row[a:b], at[a:b] - first] = 1
        out += part[: len(sets)] @ part[len(sets) :].T
    return out.astype(np.int64)


def _link_counts(batches, share) -> Iterator[pa.RecordBatch]:
    """name, n_links: documents of other sets that each set of a unit is linked with there."""
    p, q = share
    for (_, i, j, side, name, copies, tokens), starts in _lists(_few(batches, 6), 3):
        names, found = [], []
        for a, b in zip(starts, [*starts[1:], len(name)], strict=True):
            sets = [np.frombuffer(t, "<u8") for t in tokens[a:b]]
            sizes, same = np.array([len(x) for x in sets]), i[a] == j[a]
            one = np.arange(b - a) if same else np.flatnonzero(side[a:b] == i[a])
            two = one if same else np.flatnonzero(side[a:b] == j[a])
            if not len(one) or not len(two):
                continue
            common = common_tokens([sets[x] for x in one], [sets[x] for x in two])
            linked = q * common >= p * (sizes[one][:, None] + sizes[two][None] - common)
            if same:
                np.fill_diagonal(linked, False)
            names.append(name[a:b][one])
            found.append(linked @ copies[a:b][two])
            if not same:
                names.append(name[a:b][two])
                found.append(linked.T @ copies[a:b][one])
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names)), pa.array(np.concatenate(found).astype(np.int64))], names=["name", "n_links"])


def _near(batches, share) -> Iterator[pa.RecordBatch]:
    """Pairs that the wide signatures don't rule out."""
    p, q = share
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
        keep = [wide_difference(x, y) * (p + q) <= (m + n) * (q - p) for x, y, m, n in rows]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _beside(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """a, b, the column and the size of both sets."""
    one = pairs.select("a", "b").join(sets.select(F.col("name").alias("a"), F.col(column).alias("x"), F.col("size").alias("m")), "a")
    return one.join(sets.select(F.col("name").alias("b"), F.col(column).alias("y"), F.col("size").alias("n")), "b").select("a", "b", "x", "y", "m", "n")


def filter_of(spark: SparkSession, marks: DataFrame, count: int):
    """A bit for each of about ``count`` marks. Others may pass too; joins drop them."""
    width = min(max((MARK_BITS * count).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    bit = F.col("mark").bitwiseAND(F.lit((1 << width) - 1)) + 1  # bucket 1 starts with 1
    own = marks.groupBy(F.bitmap_bucket_number(bit).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bits = bytearray((1 << width) // 8)
    for row in own.collect():
        begin = (row["n"] - 1) * 4096
        bits[begin : begin + len(row["bits"])] = row["bits"]
    return spark.sparkContext.broadcast(bytes(bits))


def _sets_of(spark: SparkSession, sets: DataFrame, items: DataFrame, names: DataFrame) -> DataFrame:
    """The sets of ``names``, saved, each from the one row that stands for it.

    The filter lets other rows through, too, more of them as it fills up. Where it did, a join by name and row drops them.
    """

    def marks(batches):
        for batch in batches:
            own = _id_mark(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(own)], names=["mark"])

    first = save(spark, items.join(names, "name", "left_semi").select("name", F.col("holder").alias("row")), "holders")
    wanted = filter_of(spark, first.mapInArrow(marks, "mark long"), first.count())
    found = save(spark, sets.select("name", "row", "tokens").mapInArrow(lambda b: _wanted_sets(b, wanted), "name long, row long, size int, wide binary, tokens binary"), "sets")
    if not found.select("name", "row").join(first, ["name", "row"], "left_anti").isEmpty():
        found = save(spark, found.join(first, ["name", "row"], "left_semi"), "sets")
    return found.drop("row")


def verify(spark: SparkSession, sets: DataFrame, pairs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their whole sets; only sets that have a pair are shuffled."""
    near = save(spark, _beside(pairs, sets, "wide").mapInArrow(lambda b: _near(b, share), "a long, b long"), "near")
    wanted = filter_of(spark, near.select(F.explode(F.array("a", "b")).alias("mark")), 2 * near.count())

    def there(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_filter(wanted.value, batch.column(0).to_numpy())))

    own = sets.select("name", "size", "tokens")
    both = _beside(near, own.mapInArrow(there, own.schema), "tokens")
    return save(spark, both.mapInArrow(lambda b: _verified(b, share), "a long, b long").distinct(), "links")


def _units(blocks: Column, block: Column) -> Column:
    """The key, if it has one block; else a hash of both, which may add candidates but loses none."""
    return F.when(blocks == 1, F.col("key")).otherwise(F.xxhash64("key", block))


def _near_rows(rows: DataFrame, turn: int) -> DataFrame:
    """Rows in the one block of their key that ``turn`` deals them into."""
    blocks = F.ceil(F.col("n") / UNIT_ROWS)
    unit = _units(blocks, F.pmod(F.xxhash64("name", F.lit(turn)), blocks))
    return rows.select(unit.alias("unit"), "name", "size", "group", "early", F.lit(True).alias("home"), F.lit(True).alias("visits"), *SIGNS)


def _mixed_rows(rows: DataFrame) -> DataFrame:
    """Rows of keys with several components, and an early one: all at home in a block, some visit every block.

    A pair needs an early row. Those outside the largest component visit all blocks; rows that aren't
    early do so only where the largest component has early ones, which would else not meet them. So sets of one
    pattern that are a little too different for a link, all of them late in their pattern's keys, are not even dealt.
    """
    each = rows.groupBy("key", "group").agg(F.count("*").alias("own"), F.max("early").alias("early"))
    top = F.max_by(F.struct("group", "early"), F.struct("own", "group"))
    mixed = each.groupBy("key").agg(top.alias("top"), F.count("*").alias("groups"), F.sum("own").alias("n"), F.max("early").alias("any")).filter("groups > 1 AND any")
    rows = rows.drop("n").join(mixed.select("key", "top", "n"), "key")
    blocks = F.ceil(F.col("n") / UNIT_ROWS)
    visits = (F.col("group") != F.col("top.group")) & (F.col("early") | F.col("top.early"))
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("name"), blocks)).withColumn("visits", visits)
    rows = rows.withColumn("block", F.explode(F.when(F.col("visits"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("own"))))
    return rows.select(_units(F.col("blocks"), F.col("block")).alias("unit"), "name", "size", "group", "early", (F.col("block") == F.col("own")).alias("home"), "visits", *SIGNS)


def jaccard_links(spark: SparkSession, sets: DataFrame, items: DataFrame, classes, share: tuple[int, int] = (9, 10)) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between names of different sets that join all sets which any links join, and the sets of candidates.

    ``sets`` has name, row and tokens; ``items`` name, the signature's words and the row that holds the tokens. Two
    sets are linked with Jaccard similarity of ``share`` or more. Links within a component that others
    already join may be left out.
    """
    postings = sets.select("name", "tokens").mapInArrow(lambda b: _postings(b, classes, share), "key long, name long, size int, early boolean")
    many = postings.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = save(spark, postings.join(many, "key"), "shared")  # a set may be there once for each batch of its copies
    links = tried = groups = names = found_sets = None
    for turn, nearest in enumerate((True, True, False)):
        own = shared
        if names is not None:
            own = own.join(names, "name", "left_semi").join(groups.withColumnRenamed("node", "name"), "name", "left")
        own = own.withColumn("group", F.col("name") if groups is None else F.coalesce("component", "name")).join(items.select("name", *SIGNS), "name")
        rows = _near_rows(own, turn) if nearest else _mixed_rows(own)
        dealt = rows.repartition("unit").sortWithinPartitions("unit", "name")
        found = dealt.mapInArrow(lambda b, n=nearest: _pairs(b, share, n), "a long, b long, differ long")
        if nearest:  # of all keys, the nearest one
            found = save(spark, found.groupBy("a").agg(F.min_by("b", F.struct("differ", "b")).alias("b")), "nearest")
        if names is None:
            # Sets of keys of one block have met all candidates; those of larger keys may have some left.
            later = shared.filter(F.col("n") > UNIT_ROWS).select("name")
            names = save(spark, found.select(F.explode(F.array("a", "b")).alias("name")).unionByName(later).distinct(), "names")
            found_sets = _sets_of(spark, sets, items, names)
        pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = save(spark, pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        right = verify(spark, found_sets, pairs, share)
        links, tried = (right, pairs) if links is None else (links.unionByName(right), tried.unionByName(pairs))
        if nearest:
            groups = components(spark, links)
    return links, found_sets


def link_counts(spark: SparkSession, sets: DataFrame, groups: DataFrame, items: DataFrame, share: tuple[int, int]) -> DataFrame:
    """name, n_links: documents of other sets linked with each set of a component of several sets.

    All pairs of a component's sets are compared, in units of two blocks, and none is sent on: that is
    quadratic in the different texts of a group, as the number of its links is.
    """
    sized = groups.join(sets.select(F.col("name").alias("node"), F.col("size").cast("long").alias("size")), "node")
    several = sized.groupBy("component").agg(F.count("*").alias("m"), F.sum("size").alias("tokens")).filter("m > 1")
    own = groups.join(several, "component").join(items.select(F.col("name").alias("node"), "copies"), "node")
    blocks = F.ceil(F.greatest(F.col("m") / UNIT_SETS, F.col("tokens") / UNIT_TOKENS))
    own = own.withColumn("blocks", blocks).drop("tokens").withColumn("side", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    own = own.join(sets.select(F.col("name").alias("node"), "tokens"), "node")
    rows = own.select("component", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", F.col("node").alias("name"), "copies", "tokens")
    dealt = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "name")
    return dealt.mapInArrow(lambda b: _link_counts(b, share), "name long, n_links long").groupBy("name").agg(F.sum("n_links").alias("n_links"))


def jaccard_components(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, share: tuple[int, int] = (9, 10), counts: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id (a whole number), n_shingles, component_id, and n_links with ``counts``.

    ``component_id`` is the smallest doc_id reachable over links. Null and empty texts, and
    those without words, have no shingles and are components of their own, each by its own id.
    A text of fewer than k words is one shingle of all of them. Repeated rows are linked with
    each other. A null doc_id counts for its group only if no other is there. ``n_links`` is the
    number of other rows that a row is linked with, its copies included. Long texts are read
    whole; an empty table gives no rows; other columns may have any name.
    """
    with small_batches(spark):
        return _jaccard_components(spark, docs, doc_id, text, k, share, counts)


def _jaccard_components(spark: SparkSession, docs: DataFrame, doc_id: str, text: str, k: int, share: tuple[int, int], counts: bool) -> DataFrame:
    own = docs.select(F.col(doc_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    read = save(spark, own.mapInArrow(lambda b: _read(b, k), from_arrow_schema(READ)), "read")
    classes = spark.sparkContext.broadcast(token_classes(read))
    named = read.filter("block IS NULL")
    full = named.filter("n_shingles > 0")
    items = full.groupBy("name").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), *(F.first(s).alias(s) for s in SIGNS), F.min(F.when(F.col("tokens").isNotNull(), F.col("row"))).alias("holder")
    )
    items = save(spark, items, "items")
    links, sets = jaccard_links(spark, full.filter("tokens IS NOT NULL").select("name", "row", "tokens"), items, classes, share)
    groups = components(spark, links)
    by_name = items.select("name", "least", "copies").join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn("component", F.coalesce("component", "name"))
    ids = by_name.groupBy("component").agg(F.min("least").alias("component_id"))
    columns = ["name", "component_id"]
    by_name = by_name.join(ids, "component")
    if counts:
        others = link_counts(spark, sets, groups, items, share)
        by_name = by_name.join(others, "name", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1)
        columns.append("n_links")
    by_name = save(spark, by_name.select(*columns, "copies"), "components")
    empty = named.filter("n_shingles = 0").withColumn("component_id", F.col("id")).withColumn("n_links", F.lit(0).cast("long"))
    out = [F.col("id").alias(doc_id), "n_shingles", *columns[1:]]
    return beside_groups(full.select("id", "n_shingles", "name"), by_name, "name", "copies").select(out).unionByName(empty.select(out))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"), counts=True)
