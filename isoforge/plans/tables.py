"""Bucketed tables of a run: written once, then joined and grouped by their keys without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from isoforge.sources.shared import shared_dir


class Buckets:
    """Tables in the shared folder, known to the session's catalog under names of their own until ``drop``."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: list[str] = []
        self.folder = f"{shared_dir(spark)}/qc-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, tag: str, keys: list[str]) -> DataFrame:
        """``df`` written in buckets by ``keys``; rows are dealt to the buckets' tasks first, so that each bucket is one file."""
        name = f"{tag}_{uuid.uuid4().hex}"
        dealt = df.repartition(self.buckets, *keys)
        dealt.write.format("parquet").bucketBy(self.buckets, keys).sortBy(keys).option("path", f"{self.folder}/{name}").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        self.names = []
