"""Tables stored between the jobs of an operator."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gatehold.session import scratch_path


class Rounds:
    """Stored tables by label, under the shared scratch folder.

    Storing cuts the lineage: what is read again after an executor is lost are files. A table is deleted once later
    ones have been stored that no longer need it; what a lazy result still reads stays.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[str, tuple[str, StructType]] = {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self._tables[label] = path, df.schema
        return self.read(label)

    def store_bucketed(self, df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
        """The same in buckets of `column`: jobs that group what is returned by it do without a shuffle.

        Only tables can have buckets, so one with a name of its own is in the catalog while it is written.
        """
        path, name = scratch_path(self.spark, label), f"gatehold_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, column).sortBy(column).option("path", path).saveAsTable(name, format="parquet")
        self._tables[label] = path, df.schema
        stored = self.spark.read.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # its files stay
        return stored

    def read(self, label: str) -> DataFrame:
        path, schema = self._tables[label]
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *labels: str) -> None:
        """Delete tables, and let Spark's cleaner find the shuffle files of jobs whose frames are gone."""
        jvm = self.spark.sparkContext._jvm
        for label in list(labels):
            path = jvm.org.apache.hadoop.fs.Path(self._tables.pop(label)[0])
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()

    def clear(self, *kept: str) -> None:
        """Delete all tables that are left but `kept`, once nothing lazy reads them any more."""
        self.drop(*(label for label in self._tables if label not in kept))
