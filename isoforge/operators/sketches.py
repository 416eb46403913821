"""Statistics over cells from sketches that can be stored and merged: a new sample is added without the cells of others.

A sketch is that of Spark's own quantile functions (KLL). Its size follows ``k`` and not the cells, and partial ones are made
before the shuffle, so that no task holds all values of a metric. A quantile's rank is off by at most
``rank_error(k)`` of the cells, at 99 percent confidence; up to about k cells it is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 2000


def rank_error(k: int = K) -> float:
    """Largest difference of a quantile's rank, as a share of the cells, at 99 percent confidence; the sketch's published bound."""
    return 2.296 / k**0.9021


def metric_sketches(long: DataFrame, keys: tuple[str, ...] = ("sampleID", "metric"), k: int = K) -> DataFrame:
    """keys, n, mean, m2 (sum of squares about the mean), least, most, sketch of ``value``; nulls and NaN are left out."""
    own = long.filter(F.col("value").isNotNull() & ~F.isnan("value")).select(*keys, F.col("value").cast("double").alias("value"))
    m2 = F.var_pop("value") * F.count("value")
    return own.groupBy(*keys).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), m2.alias("m2"), F.min("value").alias("least"), F.max("value").alias("most"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: tuple[str, ...] = ("sampleID", "metric"), k: int = K) -> DataFrame:
    """Rows of the same keys as one, from runs, parts or (with fewer keys) samples."""
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    # Squares about the common mean: those within, and those of the means.
    between = F.sum(F.col("n") * F.col("mean") * F.col("mean")) - n * mean * mean
    out = sketches.groupBy(*keys).agg(n.alias("n"), mean.alias("mean"), (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return out


def add_to_sketches(long: DataFrame, path: str, keys: tuple[str, ...] = ("sampleID", "metric"), k: int = K) -> None:
    """Append a run's sketches to a table; what is there isn't read."""
    metric_sketches(long, keys, k).write.mode("append").parquet(path)


def stored_sketches(spark: SparkSession, path: str, keys: tuple[str, ...] = ("sampleID", "metric"), k: int = K) -> DataFrame:
    return merged_sketches(spark.read.parquet(path), keys, k)


def sketched_quantile(q: float):
    """The least value that the share ``q`` of all values doesn't exceed."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))


def sketched_medians(sketches: DataFrame) -> DataFrame:
    """sampleID, metric, median, as ``cohort_medians`` has them but for the sketch's error."""
    return sketches.select("sampleID", "metric", sketched_quantile(0.5).alias("median"))


def sketched_stats(sketches: DataFrame, keys: tuple[str, ...] = ("metric",), k: int = K) -> DataFrame:
    """mean, median, min, max and sd of each metric over all samples, as ``describe_cells`` has them; only the median is approximate."""
    own = merged_sketches(sketches, keys, k)
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return own.select(*keys, F.round("mean", 3).alias("mean"), F.round(sketched_quantile(0.5), 3).alias("median"), F.round("least", 3).alias("min"), F.round("most", 3).alias("max"), F.round(sd, 3).alias("sd"))
