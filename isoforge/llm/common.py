"""Reading, saving and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache, wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isoforge.llm.bytescan import encoded


#: Bytes of a row group of saved tables, which writers and readers hold in memory.
ROW_GROUP = 16 << 20
#: Groups that are broadcast, at most: each has one row in so many.
HOT_GROUPS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests) gets a folder of its own; on a cluster that
    is an error, since no folder of one machine would do.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def save(spark: SparkSession, df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor.
    """
    path = reserved(spark, tag)
    df.write.option("compression", compression).option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def reserved(spark: SparkSession, tag: str) -> str:
    """A new folder's name in the shared folder, for files that tasks write themselves."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    for names in _records:
        names.append(path)
    return path


#: Lists that get the names of folders as ``save`` writes them.
_records: list[list[str]] = []


@contextmanager
def recorded(names: list[str]) -> Iterator[None]:
    """Folders that ``save`` writes inside go into ``names``, so that they can be deleted when nothing reads them."""
    _records.append(names)
    try:
        yield
    finally:
        _records.pop()


#: Bytes that are handed to Python at a time, and the setting that says so.
BATCH_BYTES, _BATCH = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands Python about BATCH_BYTES at a time, so that a worker's memory follows that and not the rows' sizes."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def keep_batches_small(spark: SparkSession) -> None:
    """The same from now on: for results that are computed later, when they are written. A smaller limit of the session stays."""
    now = int(spark.conf.get(_BATCH).rstrip("bB") or -1) if re.fullmatch(r"-?\d+[bB]?", spark.conf.get(_BATCH)) else -1
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def give_back() -> None:
    """Memory that this process has freed goes back to the machine; its allocators would keep it, worker by worker, for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim:
        trim(0)


def giving_back(task: Callable) -> Callable:
    """A task's function of batches, after which its worker keeps no freed memory."""

    @wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            give_back()

    return run


def worker_cache(size: int) -> Callable:
    """``lru_cache`` for what workers keep between tasks; what other functions keep so is dropped when one makes something new.

    Workers serve one operator after another, and would hold vocabularies and tables of all of them.
    """

    def wrap(make: Callable) -> Callable:
        @lru_cache(size)
        @wraps(make)
        def kept(*args):
            for other in _kept:
                if other is not kept and other.cache_info().currsize:
                    other.cache_clear()
                    give_back()
            return make(*args)

        _kept.append(kept)
        return kept

    return wrap


#: Caches of this process.
_kept: list = []


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more, on whatever file system they are."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Rows whose crc32(doc_id as text) leaves ``remainder``; null ids count as text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == remainder


def labelled(labels: DataFrame, label: str, held: Column, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of all documents that aren't held out, once each; labels 0 and 1 alone."""
    own = labels.filter(~held & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    return own.groupBy(doc_id).agg(F.max(label).alias(label))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def beside_groups(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of their group; null keys are equal. ``groups``, saved, has a row for each key and its number of rows in ``count``.

    Groups of a thousandth of all rows or more, a thousand at most, are broadcast, so that their rows stay
    where they are; all others are shuffled by key.
    """
    groups = groups.withColumnRenamed(key, "__key")
    least = (groups.agg(F.sum(count)).first()[0] or 0) / HOT_GROUPS
    hot = groups.filter(F.col(count) >= least).withColumn("__hot", F.lit(True))
    met = rows.join(F.broadcast(hot), rows[key].eqNullSafe(hot["__key"]), "left")
    other = rows.join(F.broadcast(hot.select(F.col("__key").alias("__known"))), rows[key].eqNullSafe(F.col("__known")), "left_anti")
    cold = groups.filter(F.col(count) < least)
    out = other.join(cold, other[key].eqNullSafe(cold["__key"]), "left").drop("__key")
    return met.filter("__hot").drop("__key", "__hot").unionByName(out)


def text_udf(ddl: str, columns: Callable[[list[bytes]], list], limit: int = 1 << 20) -> Callable[[Column], Column]:
    """A struct of columns computed from whole texts; only the text goes to Python.

    ``columns`` gets the UTF-8 bytes of some rows (null: empty) and returns a list of values
    for each column of ``ddl``. An Arrow batch is handled in runs of about ``limit`` bytes of whole
    texts.
    """
    fields = list(to_arrow_schema(T.StructType.fromDDL(ddl)))

    def made(texts: pa.Array) -> list[pa.Array]:
        values = columns(encoded(texts))
        return [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(values, fields, strict=True)]

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                parts = [made(texts.slice(a, b - a)) for a, b in runs(texts, limit)]
                whole = [pa.concat_arrays(p) for p in zip(*parts, strict=True)] if parts else [pa.array([], f.type) for f in fields]
                yield pa.StructArray.from_arrays(whole, fields=fields)
        finally:
            give_back()

    return run.asNondeterministic()  # so that no filter on its fields makes it run twice


def per_text(df: DataFrame, keep: tuple[str, ...], text: str, ddl: str, columns: Callable[[list[bytes]], list], limit: int = 1 << 20) -> DataFrame:
    """Columns computed from the whole texts beside those in ``keep``, without a shuffle.

    Only ``keep`` goes along, so that other columns may have any name.
    """
    names = [f.name for f in T.StructType.fromDDL(ddl).fields]
    made = df.select(*keep, text_udf(ddl, columns, limit)(df[text]).alias("__made"))
    return made.select(*keep, *(F.col("__made")[n].alias(n) for n in names))


def runs(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows with about ``limit`` bytes; a longer text is a run of its own."""
    first = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n
    if len(texts):
        yield first, len(texts)
