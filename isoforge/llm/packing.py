"""Mixture-controlled packing: deficit round-robin over source queues.

Each source's documents, in the order of a hash, are dealt in proportion over shards of about
``SHARD_TOKENS`` tokens, so that each shard has about the corpus's mixture. In a shard each source
has a queue; each window of 1024 tokens adds a source's target share to its deficit, the source
with the largest deficit sends as many tokens of its next document as the deficit asks for, and
deficits are carried to the next window. Documents are cut wherever that ends. What dealing
leaves between shards, at most about a document of a source, is spread over the next shard's windows.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.llm.byte_bpe import PACKING_FILE, PART, coder
from isoforge.llm.common import per_text, save, table

WINDOW = 1024
#: Tokens that a source sends at once, at least, if its document and the window have them.
LEAST = 32
SHARD_TOKENS = 1 << 18
#: Shards over which running sums are taken at once.
BLOCK = 1024
END_ID = 0

CODED = "doc_tokens long, ids_crc32 long, width int, ids binary"
PLANNED = "row long, pieces array<struct<start:long,length:long,sequence_id:long,offset:long>>"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def coded_texts(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """Each whole text's ids and a final id 0, in two bytes each if they fit; null counts as empty and has that id alone.

    All first bytes stand before all second ones, and so on, and are compressed.
    """

    def columns(texts):
        rows = []
        for ids in coder(path).ids(texts):
            own = np.append(ids, END_ID)
            width = 2 if own.max() < 1 << 16 else 4
            raw = own.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
            rows.append((len(own), zlib.crc32(raw), width, pa.compress(raw, "zstd", asbytes=True)))
        return list(zip(*rows, strict=True))

    return per_text(docs, keep, text, CODED, columns, PART)


def windows(queues: dict[str, deque], shares: dict[str, float], starts: dict[str, float]) -> Iterator[list]:
    """Lists of (document, start, length) that fill a window each, from queues of (document, tokens) by source.

    The source with the largest deficit sends, as much as its deficit is, and LEAST at least.
    The deficits of waiting sources sum up to the window's room: shares of empty queues go to the
    others in proportion. Only the last tokens, less than a window, make windows of a power of two each.
    """
    left = sum(n for own in queues.values() for _, n in own)
    each = {s: starts.get(s, 0.0) * WINDOW / max(left, WINDOW) for s in queues}
    deficits = dict.fromkeys(queues, 0.0)
    names = sorted(deficits)
    sent = dict.fromkeys(queues, 0)

    def fill(room):
        gap, total = room - sum(deficits.values()), sum(shares.get(s, 0.0) for s in deficits)
        for s in deficits:
            deficits[s] += gap * (shares.get(s, 0.0) / total if total else 1 / len(deficits))

    while left:
        room, own = min(WINDOW, 1 << left.bit_length() - 1), []
        left -= room
        for s in deficits:
            deficits[s] += each[s]
        fill(room)
        while room:
            s = max(names, key=deficits.__getitem__)  # of equal ones the first by name
            document, tokens = queues[s][0]
            n = max(LEAST, math.ceil(deficits[s]))
            n = min(room if room - n < LEAST else n, tokens - sent[s])
            own.append((document, sent[s], n))
            deficits[s] -= n
            sent[s] += n
            room -= n
            if sent[s] == tokens:
                queues[s].popleft()
                sent[s] = 0
                if not queues[s]:
                    del deficits[s]
                    names.remove(s)
                    if deficits:
                        fill(room)
        yield own


def pack(spark: SparkSession, docs: DataFrame, path: str, shares: dict[str, float] | None = None, text: str = "text", source: str = "source") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``shares`` are target token proportions by source; by default those of the corpus, and a
    source without one is sent when the others' queues are empty. Null sources are one source
    of their own. Repeated rows are packed each. What all of a shard's queues leave for the last
    window is cut into sequences of powers of two. Sequences are numbered shard x 2**32 + n. Null and
    empty texts are a final id alone; long ones are coded whole; an empty table gives no rows; other
    columns may have any name. Windows are planned from token counts; ids travel once, to their pieces.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))
    own = docs.select("doc_id", name.alias("queue"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    coded = save(spark, coded_texts(own, path, "text", ("doc_id", "queue", "row")), "ids")
    cut = coded.select("doc_id", "queue", "row", "doc_tokens", "ids_crc32")
    total = cut.agg(F.sum("doc_tokens")).first()[0] or 0
    by_queue = cut.groupBy("queue").agg(F.sum("doc_tokens").alias("all")).withColumn("part", F.col("all") / F.lit(max(total, 1)))
    if shares is None:
        target = by_queue.withColumn("share", F.col("part"))
    else:
        whole = sum(shares.values())
        given = spark.createDataFrame([(f"={k}", v / whole) for k, v in shares.items()], "queue string, share double")
        target = by_queue.join(given, "queue", "left").na.fill(0.0)
    target = save(spark, target, "targets")
    cut = save(spark, _dealt(spark, cut, target, max(1, -(-total // SHARD_TOKENS))), "dealt")
    sent = save(spark, cut.groupBy("shard", "queue").agg(F.sum("doc_tokens").alias("tokens")), "sent")
    starts = save(spark, _carried(sent.join(target, "queue")), "deficits")
    pieces = save(spark, cut.groupBy("shard").cogroup(starts.groupBy("shard")).applyInArrow(_plan_shard, PLANNED), "pieces")
    return coded.select("row", "doc_id", "doc_tokens", "width", "ids").join(pieces, "row").drop("row").mapInArrow(_cut_out, PACKED)


def _dealt(spark: SparkSession, cut: DataFrame, target: DataFrame, shards: int) -> DataFrame:
    """``shard`` beside each document: its source's tokens before it, in the order of hashes, as a part of all of them."""
    place = F.xxhash64("doc_id", "ids_crc32", "row")
    cut = cut.withColumn("place", place).withColumn("bucket", F.pmod(F.col("place"), F.lit(shards)))
    sums = cut.groupBy("queue", F.col("bucket").alias("shard")).agg(F.sum("doc_tokens").alias("tokens"))
    lower = save(spark, _before(sums, ["queue"], "tokens", "lower").withColumnRenamed("shard", "bucket").join(target.select("queue", "all"), "queue"), "lower")
    inside = W.partitionBy("queue", "bucket").orderBy("place", "row").rowsBetween(W.unboundedPreceding, -1)
    own = cut.join(lower, ["queue", "bucket"]).withColumn("inside", F.coalesce(F.sum("doc_tokens").over(inside), F.lit(0)))
    shard = F.floor((F.col("lower") + F.col("inside")) / F.col("all") * shards)
    return own.select("row", "doc_id", "queue", "doc_tokens", "ids_crc32", F.least(shard, F.lit(shards - 1)).cast("long").alias("shard"))


def _before(sums: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over all lower shards with the same ``keys``.

    Running sums of blocks of shards, then within each block, so that no window grows with all shards.
    """
    blocks = sums.withColumn("block", F.floor(F.col("shard") / BLOCK))
    whole = blocks.groupBy(*keys, "block").agg(F.sum(value).alias("whole"))
    over_blocks = W.partitionBy(*keys).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*keys, "block").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    lower = whole.withColumn("lower", F.coalesce(F.sum("whole").over(over_blocks), F.lit(0))).drop("whole")
    out = blocks.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(lower, [*keys, "block"])
    return out.select(*keys, "shard", (F.col("lower") + F.col("inside")).alias(name))


def _carried(sent: DataFrame) -> DataFrame:
    """Shard, queue, share, and the deficit that the lower shards leave: its part of the corpus less what they sent."""
    totals = sent.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    all_before = _before(totals, [], "tokens", "all_before")
    own_before = _before(sent.select("queue", "shard", "tokens"), ["queue"], "tokens", "own_before")
    joined = sent.join(own_before, ["queue", "shard"]).join(all_before, "shard")
    deficit = F.when(F.col("share") > 0, F.col("part") * F.col("all_before") - F.col("own_before")).otherwise(0.0)
    return joined.select("shard", "queue", "share", deficit.alias("deficit"))


def _plan_shard(docs: pa.Table, starts: pa.Table) -> pa.Table:
    """The pieces of each of a shard's documents."""
    shares = dict(zip(starts["queue"].to_pylist(), starts["share"].to_pylist(), strict=True))
    deficits = dict(zip(starts["queue"].to_pylist(), starts["deficit"].to_pylist(), strict=True))
    names = ("doc_id", "queue", "doc_tokens", "ids_crc32", "row", "shard")
    rows = sorted(zip(*(docs[c].to_pylist() for c in names), strict=True), key=lambda r: (r[0] is None, r[0] or 0, *r[1:5]))
    queues: dict[str, deque] = {}
    for i, r in enumerate(rows):
        queues.setdefault(r[1], deque()).append((i, r[2]))
    pieces = [array("q") for _ in range(5)]  # document, start, length, sequence, offset
    for sequence, own in enumerate(windows(queues, shares, deficits), rows[0][5] << 32 if rows else 0):
        offset = 0
        for piece in own:
            for column, value in zip(pieces, (*piece, sequence, offset), strict=True):
                column.append(value)
            offset += piece[2]
    document, *values = (np.array(c, np.int64) for c in pieces)
    order = np.argsort(document, kind="stable")
    fields = pa.StructArray.from_arrays([pa.array(c[order]) for c in values], names=["start", "length", "sequence_id", "offset"])
    ends = np.concatenate(([0], np.cumsum(np.bincount(document, minlength=len(rows)))))
    return pa.table([pa.array([r[4] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)], names=["row", "pieces"])


def _cut_out(batches) -> Iterator[pa.RecordBatch]:
    """A row for each piece, with the digest of its ids."""
    for batch in batches:
        doc_id, tokens, width, raw, pieces = (batch.column(c) for c in ("doc_id", "doc_tokens", "width", "ids", "pieces"))
        sizes = np.diff(pieces.offsets.to_numpy())
        if not sizes.sum():
            continue
        start, length, sequence, offset = pieces.flatten().flatten()
        digests, ends = array("q"), np.cumsum(sizes).tolist()
        begins = (4 * start.to_numpy()).tolist()
        stops = (4 * (start.to_numpy() + length.to_numpy())).tolist()
        for i, (n, w) in enumerate(zip(tokens.to_pylist(), width.to_pylist(), strict=True)):
            planes = np.frombuffer(pa.decompress(raw[i].as_buffer(), n * w, "zstd"), np.uint8).reshape(w, -1)
            ids = memoryview(np.ascontiguousarray(planes.T).view(f"<u{w}").ravel().astype("<u4").tobytes())
            a, b = ends[i] - int(sizes[i]), ends[i]
            digests.extend([zlib.crc32(ids[x:y]) for x, y in zip(begins[a:b], stops[a:b], strict=True)])
        row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        yield pa.RecordBatch.from_arrays(
            [doc_id.take(row).cast(pa.int64()), start, length, pa.array(np.array(digests, np.int64)), tokens.take(row), sequence, offset], names=[f.split()[0] for f in PACKED.split(", ")]
        )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_FILE))
