"""Tagged reads of BAM files as a Spark data source, in splits of any size.

A BAM file is a row of small compressed blocks, and its records run on from block to block. A split reads
the records that start in its own blocks: it looks for the first block header at or after its first
byte, then for the first record, which is one whose fields, name and tags are sound and whose
followers' are, too. A record belongs to the split that holds the start of its block, so that
any splits give each record once. The last record of a split may be read on beyond its end.
"""

from __future__ import annotations

import bisect
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SPLIT_BYTES = 64 << 20
BATCH_ROWS = 8192
#: Tags of reads: cell, molecules by two names, gene.
TAGS = ("CB", "XM", "UB", "GE")
#: Records in a row that must be sound where a split's first one is looked for.
CHAIN = 4
#: Fixed values of the format: a block's magic, largest size and field, the file's magic, a record's fields, sizes of tag values.
_BLOCK_MAGIC, _BLOCK_MOST, _BLOCK_FIELD, _FILE_MAGIC = b"\x1f\x8b\x08\x04", 1 << 16, b"BC", b"BAM\x01"
_RECORD = struct.Struct("<iiiBBHHHiiii")
_VALUES = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
#: A record's largest size: what claims more isn't one.
_RECORD_MOST = 1 << 28


def block_size(head: bytes) -> int | None:
    """Bytes of the block that begins with ``head``, or None if that is no block header."""
    if len(head) < 18 or head[:4] != _BLOCK_MAGIC:
        return None
    fields, at = head[12 : 12 + int.from_bytes(head[10:12], "little")], 0
    while at + 4 <= len(fields):
        n = int.from_bytes(fields[at + 2 : at + 4], "little")
        if fields[at : at + 2] == _BLOCK_FIELD and n == 2 and at + 6 <= len(fields):
            return int.from_bytes(fields[at + 4 : at + 6], "little") + 1
        at += 4 + n
    return None


class Blocks:
    """The uncompressed bytes of a file from one block on, read as far as they are asked for."""

    def __init__(self, file, offset: int):
        self.file, self.size, self.next = file, file.size(), offset
        self.data, self.starts, self.offsets = bytearray(), [], []

    def _head(self, at: int) -> bytes:
        return self.file.read_at(min(512, self.size - at), at) if at < self.size else b""

    def seek_block(self) -> None:
        """Go to the first block at or after the offset: a header that another one, or the file's end, follows."""
        at = self.next
        while at < self.size:
            window = self.file.read_at(min(2 * _BLOCK_MOST, self.size - at), at)
            i = window.find(_BLOCK_MAGIC)
            while i >= 0:
                n = block_size(self._head(at + i))
                if n and (at + i + n == self.size or block_size(self._head(at + i + n))):
                    self.next = at + i
                    return
                i = window.find(_BLOCK_MAGIC, i + 1)
            at += max(1, len(window) - 3)
        self.next = self.size

    def ensure(self, n: int) -> bool:
        """Have ``n`` bytes at least; False if the file ends before."""
        while len(self.data) < n:
            if self.next >= self.size:
                return False
            size = block_size(head := self._head(self.next))
            raw = self.file.read_at(size, self.next) if size else b""
            if not size or len(raw) < size:
                raise ValueError(f"no whole block at byte {self.next}")
            begin = 12 + int.from_bytes(head[10:12], "little")
            own = zlib.decompress(raw[begin:-8], -15)
            if zlib.crc32(own) != int.from_bytes(raw[-8:-4], "little"):
                raise ValueError(f"the block at byte {self.next} is damaged")
            self.starts.append(len(self.data))
            self.offsets.append(self.next)
            self.data += own
            self.next += size
        return True

    def place(self, at: int) -> tuple[int, int]:
        """Block's offset in the file, and byte in that block."""
        i = bisect.bisect_right(self.starts, at) - 1
        return self.offsets[i], at - self.starts[i]

    def forget(self, at: int) -> None:
        """Drop the bytes before ``at``, but for its own block's."""
        i = bisect.bisect_right(self.starts, at) - 1
        drop = self.starts[i]
        del self.data[:drop]
        self.starts, self.offsets = [s - drop for s in self.starts[i:]], self.offsets[i:]


def tags_of(data: bytes, wanted: tuple[str, ...]) -> dict[str, str] | None:
    """The wanted tags of a record's last part, of repeated ones the first; None if that part isn't sound."""
    out, at, end = {}, 0, len(data)
    while at < end:
        if at + 4 > end or not (0x40 < data[at] < 0x7B and 0x2F < data[at + 1] < 0x7B):
            return None
        name, kind = data[at : at + 2].decode("ascii"), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            stop = data.find(b"\0", at)
            if stop < 0:
                return None
            value, at = data[at:stop].decode("utf-8", "replace"), stop + 1
        elif kind == "B":
            if at + 5 > end or (sub := _VALUES.get(chr(data[at]))) is None or sub == "c":
                return None
            n = int.from_bytes(data[at + 1 : at + 5], "little")
            stop = at + 5 + n * struct.calcsize(sub)
            if stop > end:
                return None
            value = ",".join(map(str, struct.unpack_from(f"<{n}{sub}", data, at + 5))) if name in wanted else ""
            at = stop
        elif (sub := _VALUES.get(kind)) is not None:
            if at + struct.calcsize(sub) > end:
                return None
            (value,) = struct.unpack_from("<" + sub, data, at)
            value, at = value.decode("latin-1") if kind == "A" else str(value), at + struct.calcsize(sub)
        else:
            return None
        if name in wanted:
            out.setdefault(name, value)
    return out


def record_at(blocks: Blocks, at: int, n_ref: int | None, wanted: tuple[str, ...]):
    """(end, name, flag, tags) of the record at ``at``; None if none is there that is sound. Without ``n_ref`` references aren't checked."""
    if not blocks.ensure(at + 36):
        return None
    size, ref, pos, n_name, _, _, n_cigar, flag, n_seq, next_ref, next_pos, _ = _RECORD.unpack_from(blocks.data, at)
    least = 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq
    if n_name < 1 or n_seq < 0 or not least <= size < _RECORD_MOST or min(ref, next_ref, pos, next_pos) < -1:
        return None
    if n_ref is not None and max(ref, next_ref) >= n_ref or not blocks.ensure(at + 36 + n_name):
        return None
    name = bytes(blocks.data[at + 36 : at + 36 + n_name])
    if name[-1] or any(not 0x21 <= c <= 0x7E for c in name[:-1]) or not blocks.ensure(at + 4 + size):
        return None
    tags = tags_of(bytes(blocks.data[at + 4 + least : at + 4 + size]), wanted)
    return None if tags is None else (at + 4 + size, name[:-1].decode("ascii"), flag, tags)


def header(file) -> tuple[tuple[int, int], int]:
    """Where the first record starts (block and byte), and the number of references."""
    blocks = Blocks(file, 0)
    if not blocks.ensure(12) or bytes(blocks.data[:4]) != _FILE_MAGIC:
        raise ValueError("no BAM file")
    at = 8 + int.from_bytes(blocks.data[4:8], "little")
    blocks.ensure(at + 4)
    n_ref = int.from_bytes(blocks.data[at : at + 4], "little")
    at += 4
    for _ in range(n_ref):
        if not blocks.ensure(at + 4):
            raise ValueError("the BAM header is cut off")
        at += 8 + int.from_bytes(blocks.data[at : at + 4], "little")
    return (blocks.place(at) if blocks.ensure(at + 1) else (blocks.size, 0)), n_ref


def _first_record(blocks: Blocks, n_ref: int) -> int | None:
    """The first place from which CHAIN sound records follow, or fewer up to the end of the file."""
    at = 0
    while blocks.ensure(at + 36):
        place = at
        for i in range(CHAIN):
            found = record_at(blocks, place, n_ref, ())
            if found is None:
                break
            place = found[0]
            if not blocks.ensure(place + 1):
                i = CHAIN - 1
                break
        if found is not None and i == CHAIN - 1:
            return at
        at += 1
    return None


def records(file, start: int, end: int, wanted: tuple[str, ...]) -> Iterator[tuple[int, str, int, dict[str, str]]]:
    """(place, name, flag, tags) of the records that start in blocks at ``start`` up to ``end``."""
    (first_block, first_byte), n_ref = header(file)
    if start <= first_block:
        blocks, at = Blocks(file, first_block), first_byte
    else:
        blocks = Blocks(file, start)
        blocks.seek_block()
        if blocks.next >= end:
            return
        at = _first_record(blocks, n_ref)
        if at is None:
            return
    while blocks.ensure(at + 1):
        block, byte = blocks.place(at)
        if block >= end:
            return
        found = record_at(blocks, at, None, wanted)
        if found is None:
            raise ValueError(f"no whole record in the block at byte {block}")
        yield block << 16 | byte, *found[1:]
        at = found[0]
        if at > 1 << 20 and len(blocks.starts) > 1 and blocks.ensure(at + 1):
            kept = len(blocks.data)
            blocks.forget(at)
            at -= kept - len(blocks.data)


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int


def _opened(path: str):
    where, name = fs.FileSystem.from_uri(path)
    return where, name


class TaggedReads(DataSource):
    """Format ``tagged_bam``. Options: ``paths`` (a JSON list; or ``path``), ``tags`` (comma list), ``splitBytes``.

    Columns: path, at (place in the file, growing), read_name, flag, and a text column for each tag.
    """

    @classmethod
    def name(cls) -> str:
        return "tagged_bam"

    def schema(self) -> str:
        return "path string, at long, read_name string, flag int, " + ", ".join(f"`{t}` string" for t in self.tags())

    def tags(self) -> tuple[str, ...]:
        return tuple(self.options.get("tags", ",".join(TAGS)).split(","))

    def reader(self, schema: StructType) -> DataSourceReader:
        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        return TaggedReadsReader(paths, self.tags(), int(self.options.get("splitbytes", self.options.get("splitBytes", SPLIT_BYTES))))


class TaggedReadsReader(DataSourceReader):
    def __init__(self, paths: list[str], tags: tuple[str, ...], split_bytes: int):
        self.paths, self.tags, self.split_bytes = paths, tags, split_bytes

    def partitions(self) -> list[Split]:
        out = []
        for path in self.paths:
            where, name = _opened(path)
            size = where.get_file_info(name).size
            if size is None:
                raise ValueError(f"{path} is no file")
            out += [Split(path, a, min(a + self.split_bytes, size)) for a in range(0, size, self.split_bytes)]
        return out

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        where, name = _opened(split.path)
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.string()] * len(self.tags)]
        names = ["path", "at", "read_name", "flag", *self.tags]
        rows: list[tuple] = []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        with where.open_input_file(name) as file:
            for at, read, flag, tags in records(file, split.start, split.end, self.tags):
                rows.append((split.path, at, read, flag, *map(tags.get, self.tags)))
                if len(rows) == BATCH_ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


def read_tagged_bam(spark: SparkSession, paths: str | list[str], tags: tuple[str, ...] = TAGS, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, at, read_name, flag and the tags of all records of BAM files; records without a tag have null there.

    Paths are local or of a store that Arrow's file systems open. A file cut off in a record raises an error.
    """
    spark.dataSource.register(TaggedReads)
    own = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("tagged_bam").option("paths", json.dumps(own)).option("tags", ",".join(tags)).option("splitBytes", split_bytes).load()


def bam_association(spark: SparkSession, paths: str | list[str], manifest: DataFrame | None = None, umi_tags: tuple[str, ...] = ("XM",)) -> DataFrame:
    """sampleID, isoform, CB, UMI of reads that have a UMI and a cell; a repeated name takes its last record."""
    from isoforge.sources.text import manifest_join, read_tagged_reads, sample_id_from_path

    reads = read_tagged_bam(spark, paths, ("CB", *umi_tags))
    own = reads.withColumn("sampleID", sample_id_from_path(F.col("path"))) if manifest is None else manifest_join(reads, manifest, "cell_association", "path")
    return read_tagged_reads(own.withColumn("__place", F.struct("path", "at")), umi_tags, "__place")
