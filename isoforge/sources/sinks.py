"""Writers of the text outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_cell_summary(df: DataFrame, path: str) -> None:
    """A folder of gzipped parts, tab-separated, with a header; nulls as 0. Columns have the names of the summary's mode."""
    df.na.fill(0).write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """With a header, also of an empty table."""
    df.write.option("header", True).csv(path)


def write_enriched_classification(df: DataFrame, path: str) -> None:
    """Null as NA, booleans as TRUE and FALSE."""
    text = (F.upper(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c).cast("string").alias(c) for c, t in df.dtypes)
    df.select(*text).na.fill("NA").write.option("sep", "\t").option("header", True).csv(path)


def numbered(df: DataFrame, column: str) -> DataFrame:
    """1-based ranks of the distinct values only: sorted ranges are counted first, so no window holds them all.

    The sorted values are persisted, so that both uses see the same ranges.
    """
    own = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ordered = own.orderBy(column).withColumn("part", F.spark_partition_id()).persist()
    lower = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = ordered.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(lower), F.lit(0)))
    rank = F.row_number().over(W.partitionBy("part").orderBy(column))
    return ordered.withColumn("rank", rank).join(before, "part").select(column, (F.col("rank") + F.col("before")).alias("n"))


def mex_triplets(counts: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """row, col, count of (isoform, CB, count) of one sample, 1-based; ``features`` may hold isoforms without counts."""
    rows = numbered(features if features is not None else counts, "isoform").withColumnRenamed("n", "row")
    cols = numbered(counts, "CB").withColumnRenamed("n", "col")
    return counts.join(rows, "isoform").join(cols, "CB").select("row", "col", "count")


def one_file(spark: SparkSession, parts: str, path: str) -> None:
    """Parts that Spark has written, in order, as one file: copied as a stream under another name, which the last step changes; then the parts go."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    making = jvm.org.apache.hadoop.fs.Path(f"{path}.making")
    where = source.getFileSystem(conf)
    out = where.create(making, True)
    for f in sorted((f.getPath() for f in where.listStatus(source)), key=lambda p: p.getName()):
        if f.getName().startswith("part-"):
            own = where.open(f)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(own, out, conf, False)
            own.close()
    out.close()
    where.delete(target, True)
    where.rename(making, target)
    where.delete(source, True)


def write_mex(counts: DataFrame, folder: str, features: DataFrame | None = None) -> None:
    """matrix.mtx, features.tsv and barcodes.tsv, sorted, one file each.

    All three are written as parts beside the folder first; only when no part has failed do they become its files.
    """
    spark = counts.sparkSession
    triplets = mex_triplets(counts, features)
    rows = (features if features is not None else counts).select("isoform").filter("isoform IS NOT NULL").distinct()
    cols = counts.select("CB").filter("CB IS NOT NULL").distinct()
    head = f"%%MatrixMarket matrix coordinate integer general\n{rows.count()} {cols.count()} {triplets.count()}"
    lines = triplets.select(F.struct("col", "row").alias("at"), F.concat_ws(" ", "row", "col", F.col("count").cast("long")).alias("value"))
    zero = F.lit(0).cast("long")
    first = spark.createDataFrame([(head,)], "value string").select(F.struct(zero.alias("col"), zero.alias("row")).alias("at"), "value")
    making = f"{folder.rstrip('/')}.making-{uuid.uuid4().hex}"
    parts = {
        "features.tsv": rows.orderBy("isoform"), "barcodes.tsv": cols.orderBy("CB"),
        "matrix.mtx": first.unionByName(lines).orderBy("at").select("value"),
    }
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(making)
    try:
        for name, df in parts.items():
            df.write.text(f"{making}/{name}")
        at.getFileSystem(conf).mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
        for name in parts:
            one_file(spark, f"{making}/{name}", f"{folder}/{name}")
    finally:
        at.getFileSystem(conf).delete(at, True)
