"""Approximate nearest neighbours from randomly rotated one-bit codes.

Vectors are centred, rotated at random and kept as signs (packed bits) with two correction
scalars: the norm of the centred vector, and the inner product of its direction with its
code. They give an estimate of any inner product with an error bound, hence bounds of the
distance. Vectors whose lower bound is within the k-th best distance are reranked with the
original vectors.

Equal vectors are one item, named by two hashes, with its k + 1 smallest ids. Queries are a stated
set and go against all items in blocks: items stay where they are, each task codes blocks of its own
and reads the queries' blocks from the shared folder one after the other. So no vector is shuffled to
be compared, no task holds more than a block of either, and only each block's nearest are sent on.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.llm.common import save, table

#: Vectors, by the smallest hashes of their ids, whose mean is the centre of all codes.
CENTRE_ROWS = 4096
#: Standard errors that the bounds allow for.
SPREAD = 2.0
ITEM_BLOCK, QUERY_BLOCK = 1 << 16, 1 << 11
#: Products of codes and queries that are held at once.
CELLS = 1 << 22
SEED = 11


@lru_cache(4)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, norms of the centred vectors, and inner products of their directions with the codes."""
    own = (vectors - centre) @ rotation(vectors.shape[1]).T
    norms = np.linalg.norm(own, axis=1)
    fit = np.abs(own).sum(1) / np.sqrt(own.shape[1]) / np.where(norms > 0, norms, 1)
    return np.packbits(own > 0, axis=1), norms, np.where(norms > 0, fit, 1)


def distance_bounds(codes: np.ndarray, norms: np.ndarray, fit: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of coded vectors (rows) to rotated, centred queries (columns)."""
    dims = queries.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=dims).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dims))
    length = np.linalg.norm(queries, axis=1).astype(np.float32)
    norms, fit = norms.astype(np.float32)[:, None], fit.astype(np.float32)[:, None]
    products = signs @ queries.astype(np.float32).T
    error = norms * np.sqrt(np.maximum(1 - fit**2, 0)) / fit * np.float32(SPREAD / np.sqrt(max(1, dims - 1)))
    scale = norms**2 + length**2
    middle, slack = scale - 2 * norms * products / fit, 2 * error * length + np.float32(1e-5) * scale
    return middle - slack, middle + slack


def usable(vector: Column) -> Column:
    """Not null, all components finite, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _centre(items: DataFrame) -> np.ndarray:
    """Mean of CENTRE_ROWS vectors of the commonest length; other lengths are centred at zero. Any centre gives right bounds."""
    usual = items.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    sample = items.filter(F.col("d") == usual["d"]).orderBy("h", "g").limit(CENTRE_ROWS).select("v").toArrow()
    return _matrix(sample["v"].combine_chunks()).mean(0)


def _centred(centre: np.ndarray, dims: int) -> np.ndarray:
    return centre if len(centre) == dims else np.zeros(dims)


#: A block of queries: length, hashes, rotated and original vectors.
QUERIES = "d int, asked binary, turned binary, original binary"
FOUND = "qh long, qg long, h long, g long, first long, score double"


def _turned(batches, centre):
    """Rotated queries, a block in a row, from blocks in rows."""
    for batch in batches:
        for i in range(len(batch)):
            own = batch.column(1)[i].values
            v = _matrix(own.field(2))
            names = np.stack([own.field(j).to_numpy() for j in (0, 1)], 1).astype("<i8")
            turned = (v - _centred(centre.value, v.shape[1])) @ rotation(v.shape[1]).T
            made = (pa.array([x.tobytes()], pa.binary()) for x in (names, turned.astype("<f4"), v.astype("<f8")))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *made], names=[c.split()[0] for c in QUERIES.split(", ")])


def _item_blocks(batches):
    """Names, smallest ids and vectors of up to ITEM_BLOCK items of one length."""
    waiting: dict[int, list] = {}

    def block(d):
        return tuple(np.concatenate(x) for x in zip(*waiting.pop(d), strict=True))

    for batch in batches:
        lengths = batch.column(3).to_numpy()
        for d in np.unique(lengths).tolist():
            part = batch.filter(pa.array(lengths == d))
            names = np.stack([part.column(i).to_numpy() for i in (0, 1)], 1)
            waiting.setdefault(d, []).append((names, part.column(2).to_numpy(), _matrix(part.column(4))))
            if sum(len(x[0]) for x in waiting[d]) >= ITEM_BLOCK:
                yield block(d)
    for d in [*waiting]:
        yield block(d)


def nearest_in_block(items: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact distances of a query's k nearest items, by bounds and reranking; ties to the smaller ``first``."""
    near = np.flatnonzero(low <= (np.partition(high, k - 1)[k - 1] if len(high) > k else np.inf))
    near = near[np.argsort(low[near], kind="stable")]
    head, tail = near[: 4 * k], near[4 * k :]
    score = np.sqrt(((items[head] - query) ** 2).sum(1))
    if len(tail):
        tail = tail[low[tail] <= np.partition(score, k - 1)[k - 1] ** 2]
        head, score = np.concatenate((head, tail)), np.concatenate((score, np.sqrt(((items[tail] - query) ** 2).sum(1))))
    best = np.lexsort((first[head], score))[:k]
    return head[best], score[best]


def _found(batches, folder: str, centre, k: int):
    """Of each block of items, the k nearest of each query."""
    store, base = fs.FileSystem.from_uri(folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(base)) if f.path.endswith(".parquet"))
    for names, first, items in _item_blocks(batches):
        dims = items.shape[1]
        codes, norms, fit = encode(items, _centred(centre.value, dims))
        for file in files:
            with store.open_input_file(file) as f:
                for row in pq.ParquetFile(f).iter_batches(batch_size=1):
                    if row.column(0)[0].as_py() != dims:
                        continue
                    asked, turned, original = (np.frombuffer(row.column(c)[0].as_buffer(), t) for c, t in ((1, "<i8"), (2, "<f4"), (3, "<f8")))
                    asked, turned, original = asked.reshape(-1, 2), turned.reshape(-1, dims), original.reshape(-1, dims)
                    step = max(1, CELLS // len(items))
                    out = []
                    for a in range(0, len(asked), step):
                        low, high = distance_bounds(codes, norms, fit, turned[a : a + step])
                        for j in range(low.shape[1]):
                            at, score = nearest_in_block(items, first, low[:, j], high[:, j], original[a + j], k)
                            out.append((np.repeat(asked[a + j][None], len(at), 0), names[at], first[at], score))
                    q, item, least, score = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (*q.T, *item.T, least, score)], names=[c.split()[0] for c in FOUND.split(", ")])


def _least(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest others of each query, in one row each.

    Vectors that are null, zero or not finite, and rows without an id, take no part; vectors of
    another length than a query's have no distance to it. With fewer than k candidates all are
    returned; ties go to the smaller id. Rows that repeat an id and a vector are one; a repeated
    id counts once for each different vector, as a query and as a candidate. An empty table gives
    no rows; other columns may have any name.
    """
    own = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    v = F.transform("v", lambda x: x + F.lit(0.0))  # no negative zeros, which hash otherwise
    own = own.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("v", v)
    own = save(spark, own.withColumn("h", F.xxhash64("v")).withColumn("g", F.xxhash64("v", F.lit(1))), "vectors")
    ids = _least(own.select("h", "g", "id").distinct(), ["h", "g"], ["id"], k + 1)
    ids = ids.groupBy("h", "g").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    items = own.groupBy("h", "g").agg(F.first("v").alias("v")).join(ids, ["h", "g"])
    items = save(spark, items.select("h", "g", F.size("v").alias("d"), "v", "ids"), "items")
    schema = "query_id long, rank int, vec_id long, score double"
    if items.isEmpty():
        return spark.createDataFrame([], schema)
    centre = spark.sparkContext.broadcast(_centre(items))
    asked = save(spark, own.filter("asks").select("id", F.col("h").alias("qh"), F.col("g").alias("qg")).distinct(), "asked")
    kinds = asked.select(F.col("qh").alias("h"), F.col("qg").alias("g")).distinct().join(items, ["h", "g"])
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    query_blocks = kinds.groupBy("d", F.pmod("h", F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("h", "g", "v")).alias("queries"))
    query_blocks = save(spark, query_blocks.select("d", "queries").mapInArrow(lambda b: _turned(b, centre), QUERIES), "queries")
    folder = query_blocks.inputFiles()[0].rsplit("/", 1)[0]
    own = items.select("h", "g", F.col("ids")[0].alias("first"), "d", "v")
    found = own.mapInArrow(lambda b: _found(b, folder, centre, k + 1), FOUND)
    found = save(spark, _least(found, ["qh", "qg"], ["score", "first"], k + 1).drop("rank"), "found")
    best = found.join(items.select("h", "g", "ids"), ["h", "g"])
    each = _least(best.select("qh", "qg", "h", "g", "score", F.explode("ids").alias("other")), ["qh", "qg"], ["score", "other"], k + 1)
    out = asked.join(each, ["qh", "qg"]).filter("NOT (other = id AND h = qh AND g = qg)")
    out = _least(out, ["id", "qh", "qg"], ["score", "other"], k)
    return out.select(F.col("id").alias("query_id"), F.col("rank").cast("int"), F.col("other").alias("vec_id"), "score")


def op5_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
