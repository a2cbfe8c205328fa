"""Bucketed stage tables: inputs that are joined many times on one key are dealt out once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wardflow.session import delete_path


@dataclass(frozen=True)
class BucketedTable:
    """A table of the session catalog whose files lie in ``path``, bucketed and sorted by its keys."""
    spark: SparkSession
    name: str
    path: str

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Remove the catalog entry and the files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.path)


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None) -> BucketedTable:
    """Write ``df`` under ``path`` as a catalog table with ``buckets`` buckets (the session's shuffle partitions) by ``keys``.

    Rows are dealt to tasks by the bucket's own hash, so each bucket is one sorted
    file.  Tables with the same keys and number of buckets join, and group by the keys or
    more columns, without an exchange.  All rows of one key lie in one bucket: choose keys that
    no large share of the rows has in common.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"wardflow_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).sortWithinPartitions(*keys).write.format("parquet")
     .bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name))
    return BucketedTable(spark, name, path)
