"""Phrase collocations from weighted acyclic automata of n-grams.

Each word begins one window of up to ``longest`` words of its piece, so that a phrase's frequency is the sum
over all windows that begin with it. Tasks read whole texts, some megabytes at a time, sort and count the
windows and build an automaton for each shard and language. Shards are saved with a few of their windows;
from these come ranges of about as many windows each, in the order of words, which may part the phrases of
one word too. Each range unites its parts of all shards, sums their weights and gives the phrases'
frequencies. Beginnings that a border may part are summed once more.

Only phrases that are frequent enough are needed from there on, as parts of a phrase are never rarer than
it. They become automata by range again, and the parts of all candidates are looked up by composing
these with the parts' acceptor. A range that very many candidates ask for is dealt out to several tasks.
"""

from __future__ import annotations

import bisect
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.llm import bytescan
from isoforge.llm.common import save, small_batches, table
from isoforge.llm.count_automata import END, Automaton, built, distinct_rows, prefix_starts, union



@dataclass(frozen=True)
class Sizes:
    """How work is parted; results don't depend on it."""

    shard: int = 4 << 20  #: bytes of texts in a shard; a longer text is a shard of its own
    every: int = 1 << 12  #: windows for each sampled one
    windows: int = 1 << 19  #: windows of a range
    fold: int = 1 << 20  #: windows that wait in a range before they are summed up
    requests: int = 1 << 18  #: requests for a range's weights that one task answers


#: Samples from which borders are chosen, and ranges, at most.
SAMPLES, RANGES = 1 << 18, 1 << 16
#: Parts over which a language's phrases are ranked first.
RANK_PARTS = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_WORD = bytescan.word_table(b" \t" + _ENDS)
_PIECE_END = ~bytescan.word_table(_ENDS)

SHARDS = "lang string, words long, windows long, automaton binary, samples array<array<binary>>"
RANGED = "range int, lang string, automaton binary"
COUNTS = "lang string, n int, phrase string, f long, border boolean"
ASKED = "range int, salt int, kind int, lang string, part string, f long, phrase string, k int, side string"
ANSWERS = "lang string, phrase string, k int, side string, f long"


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different words in the order of their bytes, and each one's code from 1 on.

    Words are told apart by 64-bit hashes; each is then compared with the one that stands for its hash.
    """
    hashes = bytescan.hashed_runs(data, starts, ends)
    _, first, at = np.unique(hashes, return_index=True, return_inverse=True)
    same, sizes, eight = True, ends - starts, bytescan.eights(data)
    other = first[at]
    more, done = np.flatnonzero((sizes > 8) | (sizes[other] > 8)), 0
    if len(more):
        same = bool((sizes[more] == sizes[other[more]]).all())
        while same and len(more):
            left = sizes[more] - done
            mask = bytescan._MASKS[np.minimum(left, 8)]
            same = bool(((eight[starts[more] + done] ^ eight[starts[other[more]] + done]) & mask == 0).all())
            done += 8
            more = more[(left > 8) & (sizes[more] <= 1 << 12)]
    raw = data.tobytes()
    long = np.flatnonzero(sizes > 1 << 12)
    same = same and all(raw[starts[i] : ends[i]] == raw[starts[j] : ends[j]] for i, j in zip(long.tolist(), other[long].tolist(), strict=True))
    if not same:
        found = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        words = sorted(set(found))
        code = {w: i for i, w in enumerate(words, 1)}
        return words, np.array([code[w] for w in found], np.int64)
    words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    order = sorted(range(len(words)), key=words.__getitem__)
    code = np.zeros(len(words), np.int64)
    code[order] = np.arange(1, len(words) + 1)
    return [words[i] for i in order], code[at]


def windows(texts: list[bytes], longest: int) -> tuple[list[bytes], np.ndarray]:
    """Words, and a row of codes for each word with those that follow it in its piece."""
    words, found = [], []
    data = bytescan.FOLD[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return words, np.zeros((0, longest), np.int64)
    words, codes = word_codes(data, starts, ends)
    piece = np.cumsum(_PIECE_END[data], dtype=np.int64)[starts]
    found.append(codes)
    for i in range(1, longest):
        follows = np.full(len(codes), END, np.int64)
        follows[: len(codes) - i] = np.where(piece[i:] == piece[: len(codes) - i], codes[i:], END)
        found.append(follows)
    return words, np.stack(found, 1)


def _shards(batches, longest: int, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[bytes]] = {}
    size = 0

    def flush():
        for lang, texts in waiting.items():
            words, rows = windows(texts, longest)
            if len(rows):
                paths, weights = distinct_rows(rows, np.ones(len(rows), np.int64), len(words) + 1)
                offset = int(bytescan.mix(np.array([len(rows) + 31 * int(rows[0, 0])], np.uint64))[0] % np.uint64(sizes.every))
                samples = [[words[c - 1] if c else b"" for c in row] for row in paths[offset :: sizes.every].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([len(rows)]), pa.array([len(paths)]), pa.array([built(words, paths, weights).encoded()], pa.binary()), pa.array([samples], pa.list_(pa.list_(pa.binary())))],
                    names=["lang", "words", "windows", "automaton", "samples"],
                )
        waiting.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), bytescan.encoded(batch.column(1)), strict=True):
            if size and size + len(text) > sizes.shard:
                yield from flush()
                size = 0
            waiting.setdefault(lang, []).append(text)
            size += len(text) + 1
    yield from flush()


def range_borders(shards: DataFrame, sizes: Sizes) -> list[tuple]:
    """(lang, words) where ranges begin, but for the first: quantiles of the sampled windows. Any borders give right results."""
    total = shards.agg(F.sum("windows")).first()[0] or 0
    own = shards.select(F.encode("lang", "UTF-8").alias("lang"), F.explode("samples").alias("w"))
    rows = own.orderBy(F.xxhash64("lang", "w")).limit(SAMPLES).collect() if total > sizes.windows else []
    keys = sorted({(bytes(r["lang"]), *map(bytes, r["w"])) for r in rows})
    n = min(RANGES, -(-total // sizes.windows), len(keys) + 1)
    return [keys[len(keys) * i // n] for i in range(1, n)]


def _cuts(words: list[bytes], paths: np.ndarray, borders: list[tuple]) -> list[int]:
    """Where each border's words would stand in the sorted rows."""
    out = []
    for border in borders:
        low, high = 0, len(paths)
        for i, word in enumerate(border):
            at = bisect.bisect_left(words, word) + 1 if word else END
            there = not word or at <= len(words) and words[at - 1] == word
            column = paths[low:high, i]
            low, high = low + int(np.searchsorted(column, at)), low + int(np.searchsorted(column, at, "right")) if there else -1
            if high < 0:
                break
        out.append(low)
    return out


def _ranged(batches, borders) -> Iterator[pa.RecordBatch]:
    """Each shard's automaton, parted at the ranges' borders."""
    borders = borders.value
    for batch in batches:
        for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = Automaton.decoded(raw)
            paths, weights = own.paths()
            key = lang.encode()
            first, last = bisect.bisect_left(borders, (key,)), bisect.bisect_left(borders, (key + b"\0",))
            cuts = [0, *_cuts(own.words, paths, [b[1:] for b in borders[first:last]]), len(paths)]
            parts = [(first + i, built(own.words, paths[a:b], weights[a:b]).encoded()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            for a in range(0, len(parts), 64):
                some = parts[a : a + 64]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in some], pa.int32()), pa.array([lang] * len(some)), pa.array([p[1] for p in some], pa.binary())], names=["range", "lang", "automaton"])


def _frequencies(lang: str, words: list[bytes], paths: np.ndarray, weights: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """Phrases of all lengths; those that the range's borders may part are marked, others have ``least`` or more."""
    for n in range(1, paths.shape[1] + 1):
        starts = prefix_starts(paths, n)
        f, border = np.add.reduceat(weights, starts), np.zeros(len(starts), bool)
        border[[0, -1]] = n < paths.shape[1]
        own = np.flatnonzero((paths[starts, n - 1] != END) & (border | (f >= least)))
        for a in range(0, len(own), 1 << 16):
            some = own[a : a + (1 << 16)]
            texts = [b" ".join([words[c - 1] for c in row]).decode() for row in paths[starts[some], :n].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(np.full(len(some), n, np.int32)), pa.array(texts, pa.string()), pa.array(f[some]), pa.array(border[some])], names=["lang", "n", "phrase", "f", "border"]
            )


def _united(batches, least: int, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """Frequencies of each range and language from its automata, which come one after the other."""
    at, parts, waiting = None, [], 0
    for batch in batches:
        for r, lang, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (r, lang) != at:
                if parts:
                    yield from _frequencies(at[1], *union(parts), least)
                at, parts, waiting = (r, lang), [], 0
            own = Automaton.decoded(raw)
            parts.append((own.words, *own.paths()))
            waiting += len(parts[-1][1])
            if len(parts) > 1 and waiting > max(sizes.fold, 2 * len(parts[0][1])):
                parts, waiting = [union(parts)], 0
    if parts:
        yield from _frequencies(at[1], *union(parts), least)


def phrase_counts(spark: SparkSession, docs: DataFrame, lang: str, text: str, longest: int, least: int, sizes: Sizes) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """(lang, n, phrase, f) of all phrases of up to ``longest`` words with f of ``least`` or more; (lang, n) of all words; the ranges' borders."""
    own = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    shards = save(spark, own.mapInArrow(lambda b: _shards(b, longest, sizes), SHARDS), "shards")
    found = range_borders(shards, sizes)
    borders = spark.sparkContext.broadcast(found)
    ranged = shards.select("lang", "automaton").mapInArrow(lambda b: _ranged(b, borders), RANGED)
    dealt = ranged.repartition("range").sortWithinPartitions("range", "lang")
    counts = save(spark, dealt.mapInArrow(lambda b: _united(b, least, sizes), COUNTS), "frequencies")
    parted = counts.filter("border").groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    whole = counts.filter("NOT border").select("lang", "n", "phrase", "f").unionByName(parted)
    return save(spark, whole, "counts"), shards.groupBy("lang").agg(F.sum("words").alias("n")), found


def _with_range(batches, borders, depth: int) -> Iterator[pa.RecordBatch]:
    """The range that each row's ``part`` is looked up in."""
    borders = borders.value
    for batch in batches:
        keys = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        at = [bisect.bisect_right(borders, (lang.encode(), *part.encode().split(b" "), *[b""] * (depth - 1 - part.count(" ")))) for lang, part in keys]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], names=["range", *batch.schema.names])


def _composed(batches, depth: int) -> Iterator[pa.RecordBatch]:
    """Weights of the parts that are asked for: rows of a range and salt are its phrases, then the requests."""

    def rows_of(words: dict[bytes, int], parts: list[str]) -> np.ndarray:
        other = len(words) + 1  # a word that the range doesn't have
        own = [[words.get(w, other) for w in p.encode().split(b" ")] for p in parts]
        return np.array([row + [END] * (depth - len(row)) for row in own], np.int64).reshape(-1, depth)

    def automata(table: pa.Table) -> dict[str, tuple[dict[bytes, int], Automaton]]:
        out = {}
        langs = np.array(table["lang"].to_pylist(), object)
        for lang in set(langs.tolist()):
            own = table.filter(pa.array(langs == lang))
            parts = own["part"].to_pylist()
            words = sorted({w for p in parts for w in p.encode().split(b" ")})
            code = {w: i for i, w in enumerate(words, 1)}
            out[lang] = code, built(words, *distinct_rows(rows_of(code, parts), own["f"].to_numpy(), len(words) + 1))
        return out

    at, phrases, known = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
        for a, b in zip(starts := prefix_starts(keys, 3).tolist(), [*starts[1:], len(keys)], strict=True):
            own = batch.slice(a, b - a)
            if at != keys[a, :2].tolist():
                at, phrases, known = keys[a, :2].tolist(), [], None
            if keys[a, 2] == 0:
                phrases.append(own)
                continue
            if known is None:
                known = automata(pa.Table.from_batches(phrases)) if phrases else {}
            langs = np.array(own.column(3).to_pylist(), object)
            for lang in set(langs.tolist()):
                some = own.filter(pa.array(langs == lang))
                code, automaton = known[lang]
                weights = automaton.weights(rows_of(code, some.column(4).to_pylist()))
                yield pa.RecordBatch.from_arrays([some.column(3), *(some.column(i) for i in (6, 7, 8)), pa.array(weights)], names=["lang", "phrase", "k", "side", "f"])
                # A part of all words but one, which is a candidate itself, learns of the longer phrase.
                longer = pa.array([len(p.split(" ")) == len(q.split(" ")) - 1 and " " in p for p, q in zip(some.column(4).to_pylist(), some.column(6).to_pylist(), strict=True)])
                inside = some.filter(longer)
                if len(inside):
                    yield pa.RecordBatch.from_arrays([inside.column(3), inside.column(4), pa.nulls(len(inside), pa.int32()), pa.array(["longer"] * len(inside)), inside.column(5)], names=["lang", "phrase", "k", "side", "f"])


def part_weights(spark: SparkSession, counts: DataFrame, borders: list[tuple], longest: int, sizes: Sizes) -> DataFrame:
    """(lang, phrase, k, side, f): frequencies of the parts before and after each cut of each phrase, and as ``longer`` those of phrases with one word more."""
    known = spark.sparkContext.broadcast(borders)
    rows = counts.select(F.lit(0).alias("kind"), "lang", F.col("phrase").alias("part"), "f", *(F.lit(None).cast(t).alias(c) for c, t in (("phrase", "string"), ("k", "int"), ("side", "string"))))
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k")
    cuts = counts.filter("n > 1").select("lang", "phrase", "f", words.alias("w"), "n", cut)
    left, right = F.array_join(F.slice("w", 1, F.col("k")), " "), F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ")
    both = F.explode(F.array(F.struct(F.lit("left").alias("side"), left.alias("part")), F.struct(F.lit("right").alias("side"), right.alias("part")))).alias("x")
    asked = cuts.select("lang", "phrase", "f", "k", both).select(F.lit(1).alias("kind"), "lang", F.col("x.part").alias("part"), "f", "phrase", "k", F.col("x.side").alias("side"))
    at = rows.unionByName(asked).mapInArrow(lambda b: _with_range(b, known, longest), ASKED.replace("salt int, ", ""))
    at = save(spark, at, "asked")
    many = at.filter("kind = 1").groupBy("range").agg(F.ceil(F.count("*") / sizes.requests).cast("int").alias("salts"))  # a row for each of at most RANGES
    own = at.join(F.broadcast(many), "range")  # a range that none asks isn't needed
    salts = F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("phrase", "k", "side"), F.col("salts")).cast("int")))
    dealt = own.select("range", F.explode(salts).alias("salt"), "kind", "lang", "part", "f", "phrase", "k", "side").repartition("range", "salt").sortWithinPartitions("range", "salt", "kind")
    return dealt.mapInArrow(lambda b: _composed(b, longest), ANSWERS)


def mine_phrases(
    spark: SparkSession, docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, least: int = 10, share: int = 50, most: int = 2000, sizes: Sizes = Sizes()
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to ``longest`` words of each language.

    A phrase occurs ``a`` times, its parts at the cut with the lowest score ``l`` and ``r`` times (of equal
    cuts the first counts), and all words ``n`` times. Phrases inside a longer one that occurs at least
    ``share`` percent as often are dropped. Ranks follow score, a and the phrase's bytes, up to ``most``. Null
    languages are ``und``, null and empty texts have no words. Repeated rows count each; ids are not
    used. Long texts are read whole, an empty table gives no rows, and other columns may have any name.
    """
    with small_batches(spark):
        counts, totals, borders = phrase_counts(spark, docs, lang, text, longest, least, sizes)
        answers = part_weights(spark, counts, borders, longest, sizes)
    at = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("f")))
    cuts = range(1, longest)
    sides = [at(s, k).alias(f"{s}{k}") for k in cuts for s in ("left", "right")]
    # A cut's phrase has its own frequency, so that the two tables meet in one grouping.
    own = counts.filter("n > 1").select("lang", "phrase", F.lit(None).cast("int").alias("k"), F.lit("own").alias("side"), "f")
    grouped = answers.unionByName(own).groupBy("lang", "phrase").agg(
        F.max(F.when(F.col("side") == "own", F.col("f"))).alias("a"), F.max(F.when(F.col("side") == "longer", F.col("f"))).alias("longer"), *sides
    )
    kept = grouped.filter(f"a IS NOT NULL AND (longer IS NULL OR 100 * longer < {share} * a)")
    wide = "CAST({} AS DECIMAL(15,0))".format
    scored = [
        F.when(F.col(f"left{k}").isNotNull(), F.struct(F.expr(f"({wide(1000000)} * {wide('a')} * {wide('a')}) div ({wide(f'left{k}')} * {wide(f'right{k}')})").alias("score"), F.lit(k).alias("k"), F.col(f"left{k}").alias("l"), F.col(f"right{k}").alias("r")))
        for k in cuts
    ]
    best = kept.select("lang", "phrase", "a", F.array_min(F.array_compact(F.array(*scored))).alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = first.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= most).drop("part", "rank")
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(spark, table(spark, sf_dir, "documents"))


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM starts, (VALUES (1), (2), (3)) AS t(k) WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) AS c
  JOIN counts AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : j], ' ') AND l.k = j
  JOIN counts AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1 : c.k], ' ') AND r.k = c.k - j),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT lang, phrase, max(a) AS longer FROM (
  SELECT lang, a, array_to_string(w[1 : 2], ' ') AS phrase FROM candidates WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(w[2 : 3], ' ') FROM candidates WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best AS b LEFT JOIN inside AS i ON b.lang = i.lang AND b.phrase = i.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang) WHERE rank <= 2000
"""
