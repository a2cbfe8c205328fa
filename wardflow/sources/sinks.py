"""Stage writers (CSV with header, or Parquet), overwrite semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# CSV text form of timestamps: full microseconds (Spark's default keeps milliseconds).
NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write one stage; ``overwrite`` replaces an earlier run's output."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)
    else:
        w.parquet(path)


def read_stage(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Read a written stage back with its known schema (no inference)."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("timestampNTZFormat", NTZ_FORMAT).csv(path)
    return r.parquet(path)


def materialise(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Cut lineage through a written table in the shared folder.

    Unlike a local checkpoint this survives the loss of executors: later
    stages re-read files, not blocks held by one machine.
    """
    write_stage(df, path, "parquet")
    return read_stage(spark, path, df.schema, "parquet")
