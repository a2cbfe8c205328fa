"""Per-stage row counts as tables; a run collects them while it writes (``sources.commit``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def metrics_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The observed counts as a (STAGE, ROW_COUNT) DataFrame."""
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], "STAGE STRING, ROW_COUNT BIGINT")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Lazy (STAGE, ROW_COUNT) over several stage DataFrames, one aggregate each."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("ROW_COUNT"))
             .select(F.lit(name).alias("STAGE"), "ROW_COUNT") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)
