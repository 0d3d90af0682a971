"""Intermediate tables that go when an operator is done with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.scratch import new_path


class Workspace:
    """Writes tables under one folder of the shared storage and reads them back; ``close`` deletes the folder.

    What outlives the operator is written elsewhere first, so nothing that is still needed depends on it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, new_path(spark, label), 0

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03}-{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
