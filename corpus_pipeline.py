"""From documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), reads all rows of ``docs`` and returns a DataFrame;
the next stage gets it written as Parquet and read again.
"""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoforge.llm.byte_bpe import PACKING_FILE
from isoforge.llm.common import discard, fresh, held_out, keep_batches_small, recorded, save, shared_dir, table
from isoforge.llm.ngram_join import jaccard_components
from isoforge.llm.packing import pack
from isoforge.llm.quality import THRESHOLD, quality_score, statistics_of
from isoforge.llm.secret_scan import redact_secrets
from isoforge.llm.toxicity import toxicity_column


def _stage(function):
    """Deletes what the stages before have saved: their results are written and read again by then.

    From the first stage on the session hands Python a few megabytes of rows at a time.
    """

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        keep_batches_small(spark)
        discard(spark, *_saved)
        _saved.clear()
        with recorded(_saved):
            return function(spark, docs, sf_dir)

    return run_stage


#: Folders that the last stage has saved, which its result may still be read from.
_saved: list[str] = []


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; all labelled rows may be learnt from but those held out.

    Null and empty texts have no expressions and get the curve's score of that; without labels all
    stay. Repeated rows stay or go together. An empty table gives none. Columns may have any name.
    """
    score, name = toxicity_column(spark, docs, table(spark, sf_dir, "labels"), held_out(4, 2)), fresh(docs, "__toxicity")
    return docs.withColumn(name, score(F.col("text"))).filter(F.col(name)["predicted"] == 0).drop(name)


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept.

    Null and empty texts have statistics of 0 and the rules' decision on those; without labels all
    stay. Repeated rows stay or go together. An empty table gives none. Columns may have any name.
    """
    score, name = quality_score(spark, docs, table(spark, sf_dir, "labels"), held_out(5, 0)), fresh(docs, "__statistics")
    return docs.withColumn(name, statistics_of(F.col("text"))).filter(score(name) >= THRESHOLD).drop(name)


@_stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that n-gram similarity joins, the one with the smallest doc_id, then row number; of equal rows without words, one.

    Rows are told apart by a number of their own, so that null and shared doc_ids join nothing. Null
    ids come after others. Only numbers are shuffled to choose; an empty table gives none, and columns
    may have any name.
    """
    row = fresh(docs, "__row")
    rows = save(spark, docs.withColumn(row, F.monotonically_increasing_id()), "rows", "zstd")
    own = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    groups = save(spark, jaccard_components(spark, own.select("row", "text"), "row").join(own.select("row", "id"), "row"), "groups")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"]
    kept = groups.filter("n_shingles > 0").groupBy("component_id").agg(first.alias(row)).select(row)
    wordless = rows.join(groups.filter("n_shingles = 0").select(F.col("row").alias(row)), row).drop(row).distinct()
    return rows.join(kept, row).drop(row).select(docs.columns).unionByName(wordless.select(docs.columns))


@_stage
def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets that look live replaced; what holds for ``redact_secrets`` holds here."""
    return redact_secrets(spark, docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens; what holds for ``pack`` holds here."""
    return pack(spark, docs, public_tokenizers.path(PACKING_FILE))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", cut_secrets),
    ("packing", pack_sequences),
]

#: The models, the joins' components and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage saves, and its input if it is a stage's result, is deleted when its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/stage-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    discard(spark, *_saved)
    _saved.clear()
    return docs
