"""Tables of keys and values in sorted files of the shared folder, looked up where rows are: neither broadcast nor shuffled to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import discard, giving_back, recorded, reserved, save, worker_cache

#: Rows of a file.
TABLE_ROWS = 1 << 22


@dataclass(frozen=True)
class Table:
    """Sorted keys and their values in files of the shared folder, each with a range of keys; ``default`` is all other keys' value."""

    folder: str
    names: tuple[str, ...]
    lasts: tuple[int, ...]
    default: float

    def look_up(self, keys: np.ndarray, column: str = "ratio") -> np.ndarray:
        """Values of ``keys``; of a further ``column`` of the table, NaN for other keys."""
        keys = keys.view(np.int64)
        out = np.full(len(keys), self.default if column == "ratio" else np.nan)
        part = np.searchsorted(np.array(self.lasts, np.int64), keys)
        for i in np.unique(part[part < len(self.names)]).tolist():
            rows = np.flatnonzero(part == i)
            columns = _columns(self.folder, self.names[i])
            known, values = columns["key"], columns[column]
            at = np.minimum(np.searchsorted(known, keys[rows]), len(known) - 1)
            there = known[at] == keys[rows]
            out[rows[there]] = values[at[there]]
        return out


@worker_cache(256)
def _columns(folder: str, name: str) -> dict[str, np.ndarray]:
    """Keys and values of a file by column: mapped where the folder is a mounted one, so that a machine's workers share its pages; else read."""
    store, base = fs.FileSystem.from_uri(folder)
    path = f"{base}/{name}"
    own = pa.ipc.open_file(pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)).read_all()
    return {c: own[c].to_numpy() for c in own.column_names}


def _mapped(folder: str, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A file's keys and values."""
    columns = _columns(folder, name)
    return columns["key"], columns["ratio"]


@giving_back
def _files(batches, folder: str) -> Iterator[pa.RecordBatch]:
    """Writes a task's sorted rows as one file under a name of its own; only files that a finished task has named count."""
    store, base = fs.FileSystem.from_uri(folder)
    name, sink, last = f"{uuid.uuid4().hex}.arrow", None, 0
    parts = [b for b in batches if b.num_rows]
    if parts:
        whole = pa.Table.from_batches(parts).combine_chunks()  # one chunk, so that its columns can be mapped as arrays
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{name}") as sink, pa.ipc.new_file(sink, whole.schema) as out:
            out.write_table(whole)
        last = whole["key"][-1].as_py()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([last])], names=["name", "last"])


def saved_table(spark: SparkSession, df: DataFrame, key: str, value: str, default: float, more: tuple[str, ...] = ()) -> Table:
    """A table of keys and values, and of ``more`` columns as doubles, that workers look up; it never passes through the driver, which gets the files' names."""
    folder, kept = reserved(spark, "model"), []
    with recorded(kept):
        own = save(spark, df.select(F.col(key).alias("key"), F.col(value).cast("float").alias("ratio"), *(F.col(c).cast("double").alias(c) for c in more)), "ratios")
    parts = -(-own.count() // TABLE_ROWS)
    dealt = own.repartitionByRange(max(parts, 1), "key").sortWithinPartitions("key")
    files = sorted((r["last"], r["name"]) for r in dealt.mapInArrow(lambda b: _files(b, folder), "name string, last long").collect())
    discard(spark, *kept)
    return Table(folder, tuple(n for _, n in files), tuple(k for k, _ in files), default)


def looked_up(ids: pa.Array, known: Table) -> np.ndarray:
    """Whole numbers of ``known`` for a column of keys; its default for nulls."""
    found = known.look_up(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    return np.where(ids.is_valid().to_numpy(zero_copy_only=False), found, known.default).astype(np.int64)


def label_table(spark: SparkSession, rows: DataFrame) -> Table:
    """Of all labelled ``rows`` (doc_id, place): whole numbers from 0 on by document, -1 for any other."""
    own = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "place").filter("doc_id IS NOT NULL")
    return saved_table(spark, own, "doc_id", "place", -1.0)
