"""Scans of the parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType

from wardflow.sources.schemas import TABLE_DDL


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table with its fixed schema; pruning and pushdown stay on."""
    return spark.read.schema(TABLE_DDL[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def typed_times(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` with the times of ``ddl`` that it holds as text parsed; what is no time becomes NULL."""
    times = {f.name for f in StructType.fromDDL(ddl) if isinstance(f.dataType, TimestampNTZType)}
    text = [f.name for f in df.schema if f.name in times and isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in text}) if text else df


class Tables:
    """Lazy ``{name: DataFrame}`` access to one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.names = tuple(names or TABLE_DDL)

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_DDL:
            return self[name]
        raise AttributeError(name)

    def register_views(self, prefix: str = "") -> None:
        """Name every table in the session catalog."""
        for n in self.names:
            self[n].createOrReplaceTempView(f"{prefix}{n}")

    def drop_views(self, prefix: str = "") -> None:
        for n in self.names:
            self.spark.catalog.dropTempView(f"{prefix}{n}")


def list_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    """Tables visible in the session catalog whose names start with ``prefix``."""
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]
