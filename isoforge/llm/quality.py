"""Quality classifier: a sparse ensemble of rules over statistics of each text.

Paths of a random forest's trees are conjunctive rules; a lasso logistic regression over
the rules keeps a few with weights; these are compiled into one Spark column expression, so
that scoring is a projection of the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm import bytescan
from isoforge.llm.common import giving_back, held_out, labelled, runs, save, table, text_udf
from isoforge.llm.lookup import label_table, looked_up

TREES, DEPTH, LASSO = 24, 3, 0.001
THRESHOLD = 0.3

STATS = (
    "words", "mean_word", "upper_share", "digit_share", "symbol_share", "stop_share", "bar_share", "bang_share", "wide_share",
    "distinct_words", "distinct_triples", "lines", "distinct_lines", "words_per_line", "edge_symbol_share", "capital_share",
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_UPPER, _DIGIT = _table(bytes(range(65, 91))), _table(b"0123456789")
_SYMBOL, _STOP, _BAR, _BANG = _table(b"#$%&*+/<=>@\\^_`{}~[]"), _table(b".,;:?"), _table(b"|"), _table(b"!")
_WIDE = _table(bytes(range(128, 256)))
_LINE = bytescan.word_table(b"\n")
_LETTER = _table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def statistics(texts: list[bytes]) -> list[pa.Array]:
    """The columns STATS of each text; all 0 without words."""
    out = np.zeros((len(texts), len(STATS)))
    for part in bytescan.slices(texts):
        starts, ends, firsts = bytescan.bounds(part, bytescan.NOT_SPACE)
        hashes = bytescan.word_hashes(part, starts, ends)
        parted = part.data.copy()
        parted[part.begins[1:] - 1] = 10  # a text ends a line
        by_line = bytescan.Slice(part.first, parted, part.begins, part.lengths)
        line_starts, line_ends, line_firsts = bytescan.bounds(by_line, _LINE)
        line_hashes = bytescan.word_hashes(by_line, line_starts, line_ends)
        counts = [np.add.reduceat(t[part.data], part.begins[:-1]) for t in (_UPPER, _DIGIT, _SYMBOL, _STOP, _BAR, _BANG, _WIDE, _LETTER)]
        size = np.maximum(part.lengths, 1)
        edges = np.concatenate(([0], np.cumsum(_SYMBOL[part.data[ends - 1]] | _BANG[part.data[ends - 1]] if len(ends) else [])))
        capitals = np.concatenate(([0], np.cumsum(_UPPER[part.data[starts]] if len(starts) else [])))
        letters = np.concatenate(([0], np.cumsum(ends - starts)))
        for i in range(len(part)):
            a, b = firsts[i], firsts[i + 1]
            n = b - a
            if not n:
                continue
            own, lines = hashes[a:b], line_hashes[line_firsts[i] : line_firsts[i + 1]]
            triples = bytescan.shingle_hashes(own, 3)
            upper, digit, symbol, stop, bar, bang, wide, letter = (c[i] for c in counts)
            out[part.first + i] = (
                n, (letters[b] - letters[a]) / n, upper / max(letter, 1), digit / size[i], symbol / size[i], stop / size[i], bar / size[i], bang / size[i], wide / size[i],
                len(np.unique(own)) / n, len(np.unique(triples)) / len(triples), len(lines), len(np.unique(lines)) / max(1, len(lines)), n / max(1, len(lines)),
                (edges[b] - edges[a]) / n, (capitals[b] - capitals[a]) / n,
            )
    return [pa.array(c) for c in out.T]


def tree_rules(debug: str) -> list[tuple[tuple[int, str, float], ...]]:
    """Conjunctions (feature, '<=' or '>', bound) along each path of a tree, whole paths and their beginnings."""
    rules, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) ([-\d.Ee]+)\)", line)
        if m:
            depth = (len(m[1]) - 3) // 1
            path = [x for x in path if x[0] < depth] + [(depth, (int(m[3]), m[4], float(m[5])))]
            rules.add(tuple(sorted(x[1] for x in path)))
    return sorted(rules)


def rule_column(rule: tuple[tuple[int, str, float], ...], stats: str = "stats") -> Column:
    """The rule's tests on the fields of the column ``stats``."""
    tests = [F.col(stats)[STATS[i]] <= bound if op == "<=" else F.col(stats)[STATS[i]] > bound for i, op, bound in rule]
    return reduce(Column.__and__, tests)


def rules_met(stats: Column, rules: list[tuple[tuple[int, str, float], ...]]) -> Column:
    """An array of 1.0 for each rule whose tests the struct ``stats`` passes, else 0.0.

    One function of all rules: as many columns would make a plan that the driver compiles, and sends with each job on them.
    """

    @F.arrow_udf("array<double>")
    def met(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = [c.to_numpy(zero_copy_only=False) for c in batch.flatten()]
            out = np.empty((len(batch), len(rules)))
            for i, rule in enumerate(rules):
                out[:, i] = np.logical_and.reduce([values[f] <= bound if op == "<=" else values[f] > bound for f, op, bound in rule])
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * np.int32(len(rules))), pa.array(out.ravel()))

    return met(stats)


def fit_rules(train: DataFrame, label: str = "label") -> tuple[float, list[tuple[float, tuple]]]:
    """Constant and weighted rules, from rows with ``stats`` and a label of 0.0 or 1.0 (both must occur)."""
    vectors = VectorAssembler(inputCols=list(STATS), outputCol="vector").transform(train.select(label, "stats.*"))
    forest = RandomForestClassifier(labelCol=label, featuresCol="vector", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=7).fit(vectors)
    rules = sorted({r for t in forest.trees for r in tree_rules(t.toDebugString)})
    if not rules:
        return float("nan"), []
    tested = save(train.sparkSession, train.select(label, rules_met(F.col("stats"), rules).alias("met")), "rules").select(label, array_to_vector("met").alias("rules"))
    lasso = LogisticRegression(labelCol=label, featuresCol="rules", regParam=LASSO, elasticNetParam=1.0, maxIter=60, standardization=False).fit(tested)
    weights = lasso.coefficients.toArray()
    return float(lasso.intercept), [(float(w), r) for w, r in zip(weights, rules, strict=True) if abs(w) > 1e-6]


def score_column(constant: float, rules: list[tuple[float, tuple]], stats: str = "stats") -> Column:
    total = F.lit(constant)
    for weight, rule in rules:
        total = total + F.when(rule_column(rule, stats), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def statistics_of(text: Column) -> Column:
    """A struct of STATS."""
    return text_udf(", ".join(f"{s} double" for s in STATS), statistics)(text)


def quality_score(spark: SparkSession, docs: DataFrame, labels: DataFrame, held: Column, text: str = "text") -> Callable[[str], Column]:
    """From the name of a column of ``statistics_of`` to the score, learnt from all labelled rows outside ``held``.

    Labels are looked up where the documents are; only labelled rows' texts are read for learning, and their statistics are shuffled.
    """
    places = label_table(spark, labelled(labels, "quality", held).select("doc_id", F.col("quality").cast("int").alias("place")))

    @giving_back
    def known(batches):
        for batch in batches:
            place = looked_up(batch.column(0), places)
            at = np.flatnonzero(place >= 0)
            ids, texts = (batch.column(i).take(pa.array(at)) for i in (0, 1))
            for a, b in runs(texts):
                stats = statistics(bytescan.encoded(texts.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(place[at[a:b]].astype(float)), *stats], names=["doc_id", "label", *STATS])

    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(known, f"doc_id long, label double, {', '.join(f'{s} double' for s in STATS)}")
    one = each.groupBy("doc_id").agg(F.first("label").alias("label"), F.min(F.struct(*STATS)).alias("stats"))
    train = save(spark, one.sortWithinPartitions("doc_id"), "train")
    n, good = train.agg(F.count("*"), F.sum("label")).first()
    if not n or good in (0, n):
        return lambda _: F.lit(1.0 if not n else good / n)
    constant, rules = fit_rules(train)
    return (lambda stats: score_column(constant, rules, stats)) if rules else lambda _: F.lit(good / n)


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, held: Column, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 from a score of 0.3 on) beside ``keep``.

    Learns from all labelled rows outside ``held``. Null and empty texts have statistics of 0
    and the rules' score of those. With labels of one kind alone, or none, every score is the
    share of good ones (1.0 without labels, so that nothing is rejected). Equal texts get equal
    scores, however long they are; of rows that repeat a labelled doc_id one is learnt from. An
    empty table gives no rows. Columns other than ``doc_id``, the text and ``keep`` may have any name.
    """
    score = quality_score(spark, docs, labels, held, text)
    made = docs.select(*keep, statistics_of(F.col(text)).alias("__stats"))
    return made.select(*keep, score("__stats").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(5, 0)
    out = score_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
