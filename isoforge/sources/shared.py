"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without it gets a folder of its own, on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Saved:
    """Tables that are written once and read back, so that lineage ends there; ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: int = 0) -> None:
        """All but the last ``keep`` tables."""
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        self.paths = self.paths[len(gone) :]
