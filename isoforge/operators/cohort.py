"""Statistics over samples."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from isoforge.functions import columns as C
from isoforge.sources.shared import Saved


def cohort_union(summaries: list[DataFrame]) -> DataFrame:
    """All samples' summaries; columns that a sample lacks are 0."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), summaries).na.fill(0)


def cohort_stats(summary: DataFrame) -> DataFrame:
    """Cells of each sample, and means and medians of their counts, of those that the mode's summary has."""
    names = [n for n in ("Reads_in_cell", "Transcripts_in_cell", "UMIs_in_cell", "Genes_in_cell", "UJCs_in_cell") if n in summary.columns]
    both = [x for n in names for x in (F.avg(n).alias(f"mean_{n}"), F.percentile(n, F.lit(0.5)).alias(f"median_{n}"))]
    return summary.groupBy("sampleID").agg(F.countDistinct("CB").alias("cells"), *both, F.avg("MT_perc").alias("mean_MT_perc"))


def cohort_category_long(summary: DataFrame) -> DataFrame:
    names = [f"{C.count_name(c)}_prop" for c in C.CATEGORIES]
    return summary.unpivot(["sampleID", "CB"], names, "category", "percent")


def category_means(summary: DataFrame) -> DataFrame:
    return cohort_category_long(summary).groupBy("sampleID", "category").agg(F.avg("percent").alias("mean_percent"))


def cohort_medians(long: DataFrame) -> DataFrame:
    return long.groupBy("sampleID", "metric").agg(F.percentile("value", F.lit(0.5)).alias("median"))


def drop_constant_features(medians: DataFrame) -> DataFrame:
    """Metrics whose medians vary over samples; the medians, a row for each sample and metric, are saved, so that they are computed once."""
    medians = Saved(medians.sparkSession)(medians)
    vary = medians.groupBy("metric").agg(F.stddev_samp("median").alias("sd")).filter("sd > 0 AND NOT isnan(sd)").select("metric")
    return medians.join(F.broadcast(vary), "metric", "left_semi")


def scale_to_percent(long: DataFrame) -> DataFrame:
    """Shares in 0 to 1.5 as percent: by a metric's name, or if it is never negative."""
    range_ = long.groupBy("metric").agg(F.max("value").alias("top"), F.min("value").alias("low"))
    named = F.lower("metric").rlike("prop|perc|pct|ratio|fraction")
    own = long.join(F.broadcast(range_), "metric")
    return own.withColumn("value", F.when((F.col("top") <= 1.5) & (named | (F.col("low") >= 0)), F.col("value") * 100).otherwise(F.col("value"))).drop("top", "low")


def cohort_pca(medians: DataFrame, k: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores by sample, loadings by metric and component, and shares of variance with their running sum (``running_shares``).

    Medians are standardised. A component's sign makes its largest loading positive. The
    table has a row for each sample, so only samples x metrics meet on the driver.
    """
    names = sorted(r[0] for r in medians.select("metric").distinct().collect())
    wide = medians.groupBy("sampleID").pivot("metric", names).agg(F.first("median"))
    wide = VectorAssembler(inputCols=names, outputCol="raw").transform(wide.na.fill(0.0))
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="std").fit(wide).transform(wide)
    model = PCA(k=min(k, len(names)), inputCol="std", outputCol="pc").fit(scaled)
    matrix = model.pc.toArray()
    signs = [1.0 if matrix[abs(matrix[:, j]).argmax(), j] >= 0 else -1.0 for j in range(matrix.shape[1])]
    scores = model.transform(scaled).withColumn("pc", vector_to_array("pc"))
    scores = scores.select("sampleID", *((F.col("pc")[j] * s).alias(f"PC{j + 1}") for j, s in enumerate(signs)))
    spark = medians.sparkSession
    loadings = spark.createDataFrame([(n, f"PC{j + 1}", float(matrix[i, j] * signs[j])) for i, n in enumerate(names) for j in range(len(signs))], "metric string, pc string, loading double")
    shares = spark.createDataFrame([(j + 1, float(v)) for j, v in enumerate(model.explainedVariance.toArray())], "pc int, share double")
    return scores, loadings, running_shares(shares)


def running_shares(shares: DataFrame) -> DataFrame:
    """``running``: the sum of ``share`` up to each component; a row for each of a few components."""
    return shares.withColumn("running", F.sum("share").over(W.orderBy("pc").rowsBetween(W.unboundedPreceding, 0)))


def top_loadings(loadings: DataFrame, n: int = 10) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("pc").orderBy(F.desc(F.abs("loading")), "metric"))
    return loadings.withColumn("rank", rank).filter(F.col("rank") <= n).withColumn("sign", F.signum("loading").cast("int"))


def first_components(top: DataFrame) -> DataFrame:
    """Each metric once, at its first component."""
    first = F.row_number().over(W.partitionBy("metric").orderBy("pc", "rank"))
    return top.withColumn("__n", first).filter("__n = 1").drop("__n")


def feature_distribution(long: DataFrame, top: DataFrame) -> DataFrame:
    """Statistics over each sample's cells of the metrics in ``top``, as percent where they are shares."""
    own = scale_to_percent(long.join(F.broadcast(top.select("metric").distinct()), "metric", "left_semi"))
    return own.groupBy("sampleID", "metric").agg(F.avg("value").alias("mean"), F.percentile("value", F.lit(0.5)).alias("median"), F.countDistinct("value").alias("different"))
