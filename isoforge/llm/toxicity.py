"""Toxicity: class-conditional bigram models with modified Kneser-Ney smoothing.

The toxic and the ordinary model back off from bigrams to continuation counts of words, and
from these to word frequencies of the whole corpus, which both share. A word that neither
class knows thus weighs the same in both, and the log-likelihood ratio of a bigram is

    context(v) + word(w) + bigram(v, w)

with tables only of what the classes have seen; all else takes fixed defaults. Log-likelihoods
are normalised by length, and a logistic curve over their difference, its peak, its sum over telling
expressions and the length, fitted on labelled rows apart from the counted ones, gives the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm import bytescan
from isoforge.llm.common import discard, giving_back, held_out, labelled, recorded, runs, save, table, text_udf
from isoforge.llm.lookup import Table, _mapped, label_table, looked_up, saved_table  # noqa: F401

#: Of all labelled rows one in so many serves for the curve, the others for counts.
CURVE_ROWS = 3
THRESHOLD = 0.3
#: A ratio from which on an expression is telling.
TELLING = 4.0
#: Words that are counted together.
_FLUSH = 1 << 19


def bigram_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return bytescan.mix(v * np.uint64(0x100000001B3) + w)


def _word_lists(texts: pa.Array):
    """Row, and hashes of the words, of each text, about a megabyte of texts at a time."""
    for a, b in runs(texts):
        for part in bytescan.slices(bytescan.encoded(texts.slice(a, b - a))):
            starts, ends, firsts = bytescan.bounds(part, bytescan.ALNUM)
            words = bytescan.word_hashes(part, starts, ends)
            for i in range(len(part)):
                yield a + part.first + i, words[firsts[i] : firsts[i + 1]]


@giving_back
def _counts(batches, fit):
    """Word counts of all texts and bigram counts of the labelled ones: kind, v, w, t, o, n."""
    words, pairs, size = [], [], 0

    def flush():
        if words:
            w, n = np.unique(np.concatenate(words), return_counts=True)
            zero = np.zeros(len(w), np.int64)
            yield _rows(np.zeros(len(w), np.int8), zero, w.view(np.int64), zero, zero, n)
        if pairs:
            v, w, label = (np.concatenate(x) for x in zip(*pairs, strict=True))
            with np.errstate(over="ignore"):
                _, first, n = np.unique(bytescan.mix(bigram_hash(v, w) + label), return_index=True, return_counts=True)
            toxic = label[first] == 1
            yield _rows(np.ones(len(n), np.int8), v[first].view(np.int64), w[first].view(np.int64), n * toxic, n * ~toxic, n)
        words.clear()
        pairs.clear()

    for batch in batches:
        places = looked_up(batch.column(0), fit)
        for i, own in _word_lists(batch.column(1)):
            words.append(own)
            size += len(own)
            if places[i] in (0, 1) and len(own) > 1:
                pairs.append((own[:-1], own[1:], np.full(len(own) - 1, places[i], np.uint64)))
            if size >= _FLUSH:
                yield from flush()
                size = 0
    yield from flush()


def _rows(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "v", "w", "t", "o", "n"])


def count_corpus(spark: SparkSession, docs: DataFrame, fit: Table | dict[int, int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Counts over all documents, saved: words (kind 0; n) and bigrams of those that ``fit`` gives a label of 0 or 1 (kind 1; t, o)."""
    if isinstance(fit, dict):
        fit = label_table(spark, spark.createDataFrame(list(fit.items()), "doc_id long, place int"))
    raw = docs.select(F.col(doc_id).cast("long"), text).mapInArrow(lambda b: _counts(b, fit), "kind byte, v long, w long, t long, o long, n long")
    return save(spark, raw.groupBy("kind", "v", "w").agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum("n").alias("n")), "counts")


def _discounts(counts: DataFrame, column: str) -> list[float]:
    """Of counts 1, 2 and more, from the counts of counts (modified Kneser-Ney)."""
    found = {r[0]: r[1] for r in counts.filter(F.col(column).between(1, 4)).groupBy(column).count().collect()}
    n = [found.get(i, 0) + 0.5 for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1), i - 0.02) for i in (1, 2, 3)]


def _discount(column: str, d: list[float]) -> Column:
    c = F.col(column)
    return F.when(c <= 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _freed(n: np.ndarray, d: list[float]) -> np.ndarray:
    return np.select([n <= 0, n == 1, n == 2], [0.0, d[0], d[1]], d[2])


@giving_back
def _bigram_ratios(batches, word: Table, context: Table, d2: dict[str, list[float]]) -> Iterator[pa.RecordBatch]:
    """Hash and ratio of bigrams (v, w, t, o), with what their words and contexts have looked up in place, neither shuffled nor joined."""
    for batch in batches:
        v, w, *counts = (c.to_numpy() for c in batch.columns)
        p = []
        for c, n in zip("to", counts, strict=True):
            seen, share = context.look_up(v, f"c{c}"), context.look_up(v, f"l{c}")
            p.append((n - _freed(n, d2[c])) / np.maximum(seen, 1) + share * word.look_up(w, f"p{c}"))
        ratio = np.log(p[0] / p[1]) - np.log(word.look_up(w, "pt") / word.look_up(w, "po")) - np.log(context.look_up(v, "lt") / context.look_up(v, "lo"))
        key = bigram_hash(v.astype(np.uint64), w.astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ratio.astype(np.float32))], names=["key", "ratio"])


def build_model(spark: SparkSession, counts: DataFrame) -> dict[str, Table]:
    """Tables of log-likelihood ratios by hash, each with the default of all other hashes.

    They hold all that the counted rows have, so that rare expressions are smoothed and never left out.
    """
    pairs = counts.filter("kind = 1 AND (t > 0 OR o > 0)")
    corpus = counts.filter("kind = 0").select("w", F.col("n").alias("all"))
    total, kinds = corpus.agg(F.sum("all"), F.count("*")).first()
    total, kinds = total or 0, kinds + 1
    words = pairs.groupBy("w").agg(*(F.sum((F.col(c) > 0).cast("long")).alias(f"n{c}") for c in "to"), F.sum("n").alias("n"))
    words = save(spark, words, "words")
    contexts = pairs.groupBy("v").agg(
        *(F.sum(c).alias(f"c{c}") for c in "to"), F.sum("n").alias("n"),
        *(F.sum((F.when(F.col(c) >= 3, 3).otherwise(F.col(c)) == i).cast("long")).alias(f"k{i}{c}") for c in "to" for i in (1, 2, 3)),
    )
    d2 = {c: _discounts(pairs, c) for c in "to"}
    d1 = {c: _discounts(words, f"n{c}") for c in "to"}
    freed, types = {}, {}
    for c in "to":
        s = words.agg(F.sum(f"n{c}"), F.sum(_discount(f"n{c}", d1[c]))).first()
        types[c] = max(s[0] or 0, 1)
        freed[c] = (s[1] or 0.0) / types[c] if s[0] else 1.0
    shared = (F.coalesce("all", F.lit(0)) + 1) / F.lit(float(total + kinds))
    word = words.join(corpus, "w", "left")
    for c in "to":
        word = word.withColumn(f"p{c}", (F.col(f"n{c}") - _discount(f"n{c}", d1[c])) / types[c] + freed[c] * shared)
        # What discounts free in a context; 1 where the class has not seen it.
        share = sum(F.col(f"k{i}{c}") * d2[c][i - 1] for i in (1, 2, 3)) / F.greatest(F.col(f"c{c}"), F.lit(1))
        contexts = contexts.withColumn(f"l{c}", F.when(F.col(f"c{c}") > 0, share).otherwise(1.0))
    word = save(spark, word.select("w", "n", "pt", "po", F.log(F.col("pt") / F.col("po")).alias("ratio")), "word-ratios")
    contexts = save(spark, contexts.select("v", "n", "ct", "co", "lt", "lo", F.log(F.col("lt") / F.col("lo")).alias("ratio")), "contexts")
    words_of = saved_table(spark, word, "w", "ratio", float(np.log(freed["t"] / freed["o"])), ("pt", "po"))
    contexts_of = saved_table(spark, contexts, "v", "ratio", 0.0, ("ct", "co", "lt", "lo"))
    both = pairs.select("v", "w", "t", "o").mapInArrow(lambda b: _bigram_ratios(b, words_of, contexts_of, d2), "key long, ratio float")
    return {"word": words_of, "context": contexts_of, "bigram": saved_table(spark, both, "key", "ratio", 0.0)}


def _features(texts: list[bytes], model: dict) -> np.ndarray:
    """Of each text: difference of the normalised log-likelihoods, its peak, the sum over telling expressions, and length."""
    out = np.zeros((len(texts), 4))
    for part in bytescan.slices(texts):
        starts, ends, firsts = bytescan.bounds(part, bytescan.ALNUM)
        words = bytescan.word_hashes(part, starts, ends)
        if not len(words):
            continue
        single = model["word"].look_up(words)
        ratios = single.copy()
        follows = np.ones(len(words), bool)
        follows[firsts[:-1][firsts[:-1] < len(words)]] = False
        at = np.flatnonzero(follows)
        ratios[at] += model["context"].look_up(words[at - 1]) + model["bigram"].look_up(bigram_hash(words[at - 1], words[at]))
        full = np.flatnonzero(firsts[1:] > firsts[:-1])
        begins, sizes = firsts[:-1][full], np.diff(firsts)[full]
        out[part.first + full, 0] = np.add.reduceat(ratios, begins) / sizes
        out[part.first + full, 1] = np.maximum.reduceat(single, begins)
        out[part.first + full, 2] = np.log1p(np.add.reduceat(np.where(single > TELLING, single, 0.0), begins))
        out[part.first + full, 3] = np.log1p(sizes)
    return out


def _slopes(batches, weights: np.ndarray):
    """A task's sums for a step of Newton's method: the slope, then the curvature, as one list."""
    slope, curvature = np.zeros(len(weights)), np.zeros((len(weights), len(weights)))
    for batch in batches:
        *f, y = (c.to_numpy() for c in batch.columns)
        x = np.column_stack((np.ones(len(y)), *f))
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope += x.T @ (y - p)
        curvature += (x * (p * (1 - p))[:, None]).T @ x
    yield pa.RecordBatch.from_arrays([pa.array([[*slope.tolist(), *curvature.ravel().tolist()]], pa.list_(pa.float64()))], names=["s"])


def _curve(rows: DataFrame) -> np.ndarray:
    """Logistic weights of the columns before the last, which is the label, by Newton's method with a small ridge; the first is the constant."""
    n = len(rows.columns)
    w = np.zeros(n)
    for _ in range(50):
        sums = rows.mapInArrow(lambda b, w=w: _slopes(b, w), "s array<double>")
        s = np.array(sums.agg(*(F.sum(F.col("s")[i]) for i in range(n + n * n))).first(), float)
        step = np.linalg.solve(s[n:].reshape(n, n) + 0.1 * np.eye(n), s[:n] - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _score(f: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + f @ weights[1:], -30, 30)))


def toxicity_column(spark: SparkSession, docs: DataFrame, labels: DataFrame, held: Column, text: str = "text") -> Callable[[Column], Column]:
    """From a text to a struct of ``score`` and ``predicted``, learnt from all labelled rows outside ``held``."""
    apart = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(CURVE_ROWS)) == 0, 2).otherwise(0)
    rows = save(spark, labelled(labels, "toxic", held).select("doc_id", (F.col("toxic") + apart).cast("int").alias("place")), "labels")
    share = rows.agg(F.avg(F.col("place") % 2)).first()[0] or 0.0
    if share in (0, 1):
        return lambda _: F.struct(F.lit(float(share)).alias("score"), F.lit(int(share >= THRESHOLD)).alias("predicted"))
    places = label_table(spark, rows)
    made: list[str] = []
    with recorded(made):
        model = build_model(spark, count_corpus(spark, docs, places, text))
    discard(spark, *(x for x in made if "/model-" not in x))  # only the model's own files are read from here on

    @giving_back
    def features(batches):
        for batch in batches:
            place = looked_up(batch.column(0), places)
            at = pa.array(np.flatnonzero(place >= 2))
            if len(at):
                f = _features(bytescan.encoded(batch.column(1).take(at)), model)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *map(pa.array, f.T), pa.array(place[at] - 2.0)], names=["doc_id", *"abcdy"])

    each = docs.select(F.col("doc_id").cast("long"), text).mapInArrow(features, "doc_id long, a double, b double, c double, d double, y double")
    own = save(spark, each.groupBy("doc_id").agg(F.min(F.struct(*"abcdy")).alias("f")).select("f.*"), "curve")
    n, toxic = own.agg(F.count("*"), F.sum("y")).first()
    weights = _curve(own) if n and 0 < toxic < n else np.array([np.log(share / (1 - share)), 0, 0, 0, 0])

    def columns(texts):
        scores = _score(_features(texts, model), weights)
        return [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]

    return text_udf("score double, predicted int", columns)


def score_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, held: Column, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 from a score of 0.3 on) beside ``keep``.

    Learns from all labelled rows outside ``held``. Null and empty texts have no expressions
    and get the curve's score of that. Without labels of both kinds every score is the share of
    toxic ones (0.0 if there are none). Equal texts get equal scores, however long they are; rows
    that repeat a labelled doc_id are all counted, and one of them serves for the curve. An empty table gives no rows. Columns
    other than ``doc_id``, the text and ``keep`` may have any name.
    """
    score = toxicity_column(spark, docs, labels, held, text)
    return docs.select(*keep, score(F.col(text)).alias("__made")).select(*keep, "__made.score", "__made.predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(4, 2)
    out = score_toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
