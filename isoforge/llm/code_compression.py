"""Vector code compression by Lloyd rounds over active entries.

A vector is cut into equal parts, and each part is stored as the index of the nearest entry of its
position's codebook. Rows keep the exact squared distance to their entry. After an update only some
entries have moved. A part whose entry stayed where it was compares its stored distance with the moved
entries alone: all others are as far as before, when they lost. Any other part compares all entries
again. Of equally near entries the lowest index wins, in both cases.

All arithmetic is on whole numbers. A round is one pass: tasks read the saved rows, assign them and
write them again with their sums by entry, of which there is a row for each entry and task; only sums
over all tasks, and codebooks, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.common import beside_groups, discard, recorded, save, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Whole components are cut to this size, so that sums of squares of any vector fit into 64 bits.
MOST = 1 << 24
#: Rows that are compared with a codebook at once.
ROWS = 1 << 12
#: Rows of a pass: codes have a byte for each part, distances 64 bits; sums by entry are rows of their own.
PASS = "codes binary, distances binary, error long, part int, entry int, n long, sums array<long>"
NAMES = ["id", "label", "x", *(c.split()[0] for c in PASS.split(", "))]


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Of each row of ``x`` to each entry, in 64-bit whole numbers."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - entries[None, :, i]) ** 2
    return out


def assign(x: np.ndarray, book: np.ndarray, moved: np.ndarray | None = None, codes: np.ndarray | None = None, distances: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part of one position, and the squared distance.

    ``codes`` and ``distances`` are those of the round before and ``moved`` marks the entries that
    have changed since; without them all entries are compared.
    """
    if codes is None:
        codes, distances = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        again = np.arange(len(x))
    else:
        codes, distances = codes.astype(np.int64), distances.copy()
        active, still = np.flatnonzero(moved), np.flatnonzero(~moved[codes])
        again = np.flatnonzero(moved[codes])
        if len(active) and len(still):
            d = squared_distances(x[still], book[active])
            first = d.argmin(1)
            least, index = d[np.arange(len(d)), first], active[first]
            better = (least < distances[still]) | ((least == distances[still]) & (index < codes[still]))
            codes[still[better]], distances[still[better]] = index[better], least[better]
    if len(again):
        d = squared_distances(x[again], book)
        codes[again] = d.argmin(1)
        distances[again] = d[np.arange(len(d)), codes[again]]
    return codes, distances


def _pass(batches, books, moved, sums: bool) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, x) with new codes and distances, then the sums by entry of all rows of the task."""
    parts, entries, width = books.shape
    total, count, kinds = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64), None
    for batch in batches:
        kinds = [f.type for f in batch.schema][:3]
        for a in range(0, batch.num_rows, ROWS):
            own = batch.slice(a, ROWS)
            n = own.num_rows
            x = own.column(2).flatten().to_numpy().astype(np.int64).reshape(n, parts, width)
            codes, distances = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.int64)
            if moved is not None:
                codes = np.frombuffer(b"".join(own.column(3).to_pylist()), np.uint8).reshape(n, parts).copy()
                distances = np.frombuffer(b"".join(own.column(4).to_pylist()), "<i8").reshape(n, parts).copy()
            for p in range(parts):
                old = () if moved is None else (moved[p], codes[:, p], distances[:, p])
                code, distances[:, p] = assign(x[:, p], books[p], *old)
                codes[:, p] = code
                if sums:
                    count[p] += np.bincount(code, minlength=entries)
                    np.add.at(total[p], code, x[:, p])
            made = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([d.tobytes() for d in distances], pa.binary()), pa.array(distances.sum(1))]
            yield pa.RecordBatch.from_arrays([*own.columns[:3], *made, *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=NAMES)
    if count.any():
        used = np.argwhere(count)
        nothing = [pa.nulls(len(used), t) for t in (*kinds, pa.binary(), pa.binary(), pa.int64())]
        own = [*(pa.array(used[:, i].astype(np.int32)) for i in (0, 1)), pa.array(count[count > 0]), pa.array([total[p, e] for p, e in used], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*nothing, *own], names=NAMES)


def whole_parts(vectors: DataFrame, key: str, vector: str, label: str, parts: int, scale: int) -> DataFrame:
    """id, label, x: floors of the scaled components of the vectors that take part."""
    own = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    own = own.filter(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & finite)
    floor = F.transform("v", lambda e: F.floor(F.greatest(F.least(e * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int"))
    return own.select("id", "label", floor.alias("x"))


def compress(
    spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, label, x, codes, error), and the codebooks: an array of position, entry and component.

    Codebooks start as the parts of the vectors with the smallest keys; of equal keys that with the
    smaller components comes first, null keys come last. With fewer vectors than ``entries`` codebooks
    are smaller. Vectors that are null, empty or hold null or non-finite components take no part, nor do
    those of another length than the first one's or whose length ``parts`` doesn't divide. Scaled components
    beyond 2^24 are cut to that. Repeated rows count each; an empty table gives no rows and
    codebooks without entries; other columns may have any name.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    rows = save(spark, whole_parts(vectors, key, vector, label, parts, scale), "whole")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()
    if not first:
        return rows.select("*", F.lit(b"").alias("codes"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    rows = rows.filter(F.size("x") == len(first[0]["x"]))
    start = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    books = np.array([r["x"] for r in start], np.int64).reshape(len(start), parts, -1).swapaxes(0, 1).copy()
    kind = next(f.dataType.simpleString() for f in rows.schema if f.name == "label")
    state, moved, before = rows.select("id", "label", "x"), None, []
    for turn in range(rounds + 1):
        written: list[str] = []
        with recorded(written):
            run = lambda b, o=books, m=moved, s=turn < rounds: _pass(b, o, m, s)
            made = save(spark, state.mapInArrow(run, f"id long, label {kind}, x array<int>, {PASS}"), "codes")
        discard(spark, *before)  # none reads the pass before any more
        before, state = written, made.filter("part IS NULL").select("id", "label", "x", "codes", "distances")
        if turn < rounds:
            books, moved = _updated(made, books)
    return made.filter("part IS NULL").select("id", "label", "x", "codes", "error"), books


def _updated(made: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each used entry as the floor of its parts' mean, and which entries have changed."""
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(books.shape[2])]
    out = books.copy()
    for r in made.filter("part IS NOT NULL").groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():  # a row for each entry
        out[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(len(each))]
    return out, (out != books).any(2)


def decoded(codes: bytes, books: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vector that codes stand for: the middle of each component's step."""
    return (np.concatenate([books[p, c] for p, c in enumerate(codes)]) + 0.5) / scale


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = compress(spark, table(spark, sf_dir, "embeddings"))
    errors = save(spark, rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "errors")
    own = beside_groups(rows.select("id", "label", "codes", "error"), errors, "label", "n")
    code = F.lower(F.hex("codes"))
    return own.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The query's rows for vectors of one length, every part compared with every entry each time."""
    steps = [f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS r, vec_id, label, x FROM (
      SELECT vec_id, label, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {scale}) AS BIGINT)) AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)),
    cut AS (SELECT r, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v FROM kept, range({parts}) AS t(p)),
    book0 AS (SELECT p, r - 1 AS e, v FROM cut WHERE r <= {entries})"""]  # fmt: skip
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS (SELECT r, p, min(d * {entries} + e) AS m FROM (
      SELECT r, c.p, e, CAST(list_sum(list_transform(range(1, len(c.v) + 1), lambda j: (c.v[j] - b.v[j]) * (c.v[j] - b.v[j]))) AS BIGINT) AS d
      FROM cut AS c JOIN book{i} AS b ON c.p = b.p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""sum{i} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM (
      SELECT c.p, n.m % {entries} AS e, j, sum(c.v[j]) AS s, count(*) AS n FROM near{i} AS n JOIN cut AS c ON n.r = c.r AND n.p = c.p, unnest(range(1, len(c.v) + 1)) AS t(j)
      GROUP BY c.p, n.m % {entries}, j) GROUP BY p, e),
    book{i + 1} AS (SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM book{i} AS b LEFT JOIN sum{i} AS s ON b.p = s.p AND b.e = s.e)""")
    return f"""WITH {", ".join(steps)},
    digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
    coded AS (SELECT r, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (r), digest"""


SQL = sql()
