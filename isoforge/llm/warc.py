"""WARC archives compressed record by record with an embedded Zstandard dictionary.

Each archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary,
built from the archive's own records; each record is a frame of its own, so that one can
be read by its offset. Tasks write archives of bounded size to the shared folder under a
name of their own and report them in a manifest; only archives in the manifest count, so
a repeated task does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import beside_groups, save, shared_dir, table
from isoforge.llm.ngram_join import filter_of, in_filter

#: Payloads of at least this many bytes are stored once.
LEAST_SHARED = 1000
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: Record bytes of an archive, and of those from which its dictionary is built: every n-th record up to this.
ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 2 << 20
LEVEL = 3
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_name(page_id: int | None) -> str:
    """A record's id: a UUID that holds the page's number; a random one without a number."""
    own = uuid.uuid4() if page_id is None else uuid.UUID(bytes=b"isoforge" + struct.pack(">q", page_id))
    return f"<urn:uuid:{own}>"


def page_of(name: str | None) -> int | None:
    own = uuid.UUID(name.strip("<>").removeprefix("urn:uuid:")).bytes if name else b""
    return struct.unpack(">q", own[8:])[0] if own[:8] == b"isoforge" else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone if it refers to another."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_name(page_id)}", f"WARC-Date: {_DATE}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 33 else c for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
        payload = b""
    body = http + payload
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def dictionary_of(records: list[bytes]) -> bytes:
    """Trained on every n-th record; where they are too few or too alike for the trainer, the records themselves serve."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[: SAMPLE_BYTES // 8] for r in records[::step]]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def archive_of(records: list[bytes]) -> bytes:
    own = dictionary_of(records)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(own), write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(own)), own, *map(packer.compress, records)])


def records_of(archive: bytes) -> Iterator[bytes]:
    magic, size = struct.unpack("<II", archive[:8])
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    own, at = archive[8 : 8 + size], 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(own))
    view = memoryview(archive)
    while at < len(archive):
        frame = unpacker.decompressobj()
        yield frame.decompress(view[at:])
        at = len(archive) - len(frame.unused_data)


def parsed(raw: bytes) -> tuple:
    """page_id, url, payload bytes, digest, type and page referred to, of one record."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = body[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    return page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], page_of(fields.get("WARC-Refers-To"))


def plan_records(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with ``digest`` and ``refers_to``.

    Of equal payloads of at least 1000 bytes the one with the largest page_id is the response.
    Rows that repeat that page_id and payload are responses too; a null page_id is never
    referred to, and its row is a response if no other holds the payload. Only digests are
    aggregated, with partial sums. Payloads are shuffled only where they may have equals and are no
    hot ones: small ones, and those whose digest a filter of the shared ones doesn't let through, stay where
    they are, and of a payload with a thousandth of these rows the digest is broadcast. Null html
    counts as empty; an empty table gives no rows.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select("page_id", "url", html.alias("html")).withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    own = own.withColumn("large", F.col("size") >= LEAST_SHARED)
    large = own.filter("large")
    shared = large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1")
    shared = save(spark, shared, "shared")
    wanted = filter_of(spark, shared.select(F.xxhash64("digest").alias("mark")), shared.count())

    @F.arrow_udf("boolean")
    def perhaps(marks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in marks:
            yield pa.array(in_filter(wanted.value, batch.to_numpy()))

    perhaps = perhaps.asNondeterministic()  # so that it runs once
    made = own.withColumn("again", F.col("large") & perhaps(F.xxhash64("digest")))
    met = beside_groups(made.filter("again").select("page_id", "url", "html", "digest"), shared, "digest", "n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    alone = made.filter("NOT again").select("page_id", "url", "html", "digest", F.lit(None).cast("long").alias("refers_to"))
    return met.select("page_id", "url", "html", "digest", refers.alias("refers_to")).unionByName(alone)


def write_archives(planned: DataFrame, folder: str) -> DataFrame:
    """Write all records and return the manifest, a row for each archive."""

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        waiting, size = [], 0

        def flush():
            name = f"{uuid.uuid4().hex}.warc.zst"
            body = archive_of(waiting)
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(body)
            return name, len(waiting), len(body)

        for batch in batches:
            made = []
            for page_id, url, html, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                waiting.append(record(page_id, url, html.encode(), bytes.fromhex(digest), refers_to))
                size += len(waiting[-1])
                if size >= ARCHIVE_BYTES:
                    made.append(flush())
                    waiting, size = [], 0
            yield from _rows(made)
        if waiting:
            yield from _rows([flush()])

    def _rows(made):
        if made:
            yield pa.RecordBatch.from_pydict(dict(zip(("archive", "records", "bytes"), map(list, zip(*made, strict=True)), strict=True)))

    return planned.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, MANIFEST)


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the archives in ``manifest``, dealt out by archive."""

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{name}") as f:
                    rows = [parsed(r) for r in records_of(f.read())]
                names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    return manifest.select("archive").mapInArrow(run, RECORDS)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write ``pages`` as archives below ``folder`` (default: the shared folder); its name and the manifest.

    The manifest is written too, so that the archives are made once.
    """
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return folder, save(spark, write_archives(plan_records(spark, pages), folder), "manifest")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = archive_pages(spark, table(spark, sf_dir, "pages"))
    parts = spark.sparkContext.defaultParallelism * 4
    return read_archives(manifest.repartition(parts, "archive"), folder).drop("url")


SQL = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN g.last IS NOT NULL AND g.last IS DISTINCT FROM p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.last IS DISTINCT FROM p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND p.payload_bytes >= 1000
"""
