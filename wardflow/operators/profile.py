"""Table profiling — null counts, duplicate rows, key checks.

Duplicate detection is exact but shuffles two row hashes per row; tables
with hash groups of more than one row are read a second time, and only those rows are
compared in full.
"""

from __future__ import annotations

from functools import reduce
import uuid

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from wardflow.session import cut_lineage

_FLOATS = (DoubleType, FloatType)


def _is_float(t) -> bool:
    return isinstance(t, _FLOATS)


def _missing_sql(name: str, t) -> str:
    c = f"`{name}`"
    return f"({c} IS NULL OR isnan({c}))" if _is_float(t) else f"{c} IS NULL"


def _normalised_sql(name: str, t) -> str:
    """Column text with -0.0 and NaN variants collapsed, as grouping compares them."""
    c = f"`{name}`"

    def norm(x: str) -> str:
        return f"CASE WHEN isnan({x}) THEN double('NaN') WHEN {x} = 0 THEN 0D ELSE CAST({x} AS DOUBLE) END"

    if _is_float(t):
        return norm(c)
    if isinstance(t, ArrayType) and _is_float(t.elementType):
        return f"transform({c}, x -> {norm('x')})"
    return c


def _views(tables: dict[str, DataFrame]) -> dict[str, str]:
    """Register each table under a unique temp-view name for one SQL statement."""
    tag = uuid.uuid4().hex[:8]
    names = {}
    for n, df in tables.items():
        names[n] = f"wf_{tag}_{n}"
        df.createOrReplaceTempView(names[n])
    return names


def _run_sql(spark, sql: str, views: dict[str, str]) -> DataFrame:
    """Analyse the statement, then drop the helper views (the plan keeps them resolved)."""
    df = spark.sql(sql)
    df.schema  # forces analysis while the views exist
    for v in views.values():
        spark.catalog.dropTempView(v)
    return df


def duplicate_report(tables: dict[str, DataFrame]) -> DataFrame:
    """P2 for many tables: (TABLE_NAME, ROW_COUNT, DUPLICATE_ROWS).

    One pass hashes every row twice and counts (table, hashes) groups in one
    aggregate; the row counts are observed on it, and only groups of more than one row
    are written (the candidates).  Tables with candidates are then compared
    on full rows, restricted to the candidates by a semi join; the others are not read again.
    Floats are normalised (-0.0, NaN) the way grouping compares them, so the
    hash agrees with DISTINCT.
    """
    spark = next(iter(tables.values())).sparkSession
    row_hash = {n: [F.expr(f"{h}({', '.join(_normalised_sql(f.name, f.dataType) for f in df.schema.fields)})").alias(a)
                    for h, a in (("xxhash64", "_h1"), ("hash", "_h2"))] for n, df in tables.items()}
    hashed = reduce(DataFrame.unionAll, [df.select(F.lit(n).alias("TABLE_NAME"), *row_hash[n])
                                         for n, df in tables.items()])
    groups = hashed.groupBy("TABLE_NAME", "_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation()
    cand = cut_lineage(groups.observe(seen, *[F.sum(F.when(F.col("TABLE_NAME") == n, F.col("_n"))).alias(n)
                                              for n in tables]).where("_n > 1"))
    rows = seen.get
    again = {r[0] for r in cand.select("TABLE_NAME").distinct().collect()}  # at most one row per table
    parts = [spark.createDataFrame([(n, rows[n] or 0, 0) for n in tables if n not in again],
                                   "TABLE_NAME STRING, ROW_COUNT BIGINT, DUPLICATE_ROWS BIGINT")]
    for n in sorted(again):
        full = tables[n].select("*", *row_hash[n]).join(cand.where(F.col("TABLE_NAME") == n), ["_h1", "_h2"], "left_semi")
        sizes = full.groupBy(*tables[n].columns).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(sizes.agg(F.lit(n).alias("TABLE_NAME"), F.lit(rows[n]).cast("bigint").alias("ROW_COUNT"),
                               F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("DUPLICATE_ROWS")))
    return reduce(DataFrame.unionAll, parts)


def profile_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    """O1/P3 (nulls part): long table over all tables, one SQL statement; empty schemas are skipped."""
    tables = {n: df for n, df in tables.items() if df.columns}
    spark = next(iter(tables.values())).sparkSession
    views = _views(tables)
    parts = []
    for n, df in tables.items():
        fields = df.schema.fields
        counts = ", ".join(f"CAST(count_if({_missing_sql(f.name, f.dataType)}) AS BIGINT) AS c{i}"
                           for i, f in enumerate(fields))
        pairs = ", ".join(f"'{f.name}', c{i}" for i, f in enumerate(fields))
        parts.append(f"SELECT '{n}' AS TABLE_NAME, stack({len(fields)}, {pairs}) AS (COLUMN_NAME, NULL_COUNT) "
                     f"FROM (SELECT {counts} FROM {views[n]}) a")
    body = "\nUNION ALL ".join(parts)
    return _run_sql(spark, f"SELECT * FROM ({body}) q WHERE NULL_COUNT > 0", views)


def profile_duplicates(tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None,
                       foreign_keys: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Per table, rows, duplicate rows, the declared key and references ('None' if none)."""
    tables = {n: df for n, df in tables.items() if df.columns}
    refs: dict[str, list[str]] = {}
    for child, col, parent, pcol in foreign_keys or []:
        refs.setdefault(child, []).append(f"{col} -> {parent}.{pcol}")

    def declared(texts: dict[str, str]):
        out = F.lit("None")
        for n, text in texts.items():
            out = F.when(F.col("TABLE_NAME") == n, F.lit(text)).otherwise(out)
        return out
    return duplicate_report(tables).withColumns({
        "PRIMARY_KEYS": declared({n: ",".join(k) for n, k in (keys or {}).items() if k}),
        "FOREIGN_KEYS": declared({n: ", ".join(r) for n, r in refs.items()})})


def key_uniqueness(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """P5: does each declared key identify a row?  One aggregate per table."""
    parts = []
    for n, k in keys.items():
        per_key = tables[n].groupBy(*k).agg(F.count(F.lit(1)).alias("_n"))
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in k])
        parts.append(per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("ROW_COUNT"),
            F.count(F.lit(1)).cast("bigint").alias("DISTINCT_KEYS"),
            F.count(F.when(F.col("_n") > 1, 1)).cast("bigint").alias("DUPLICATED_KEYS"),
            F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("bigint").alias("NULL_KEY_ROWS"))
            .select(F.lit(n).alias("TABLE_NAME"), F.lit(",".join(k)).alias("KEY_COLUMNS"), "*"))
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(tables: dict[str, DataFrame], foreign_keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """Child rows whose non-null key has no parent row (anti join)."""
    parts = []
    for child, ccol, parent, pcol in foreign_keys:
        # child keys are counted first (map-side partial aggregation), so a hot
        # key reaches the anti join as one row, whatever its multiplicity
        keys = tables[child].groupBy(F.col(ccol).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        parents = tables[parent].select(F.col(pcol).alias("_k")).distinct()
        orphans = (keys.where(F.col("_k").isNotNull()).join(parents, "_k", "left_anti")
                   .select(F.lit(0).cast("bigint").alias("_c"), F.col("_n").alias("_o")))
        both = keys.select(F.col("_n").alias("_c"), F.lit(0).cast("bigint").alias("_o")).unionByName(orphans)
        parts.append(both.agg(
            F.lit(child).alias("CHILD_TABLE"), F.lit(ccol).alias("CHILD_COLUMN"),
            F.lit(parent).alias("PARENT_TABLE"), F.lit(pcol).alias("PARENT_COLUMN"),
            F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("CHILD_ROWS"),
            F.coalesce(F.sum("_o"), F.lit(0)).cast("bigint").alias("ORPHAN_ROWS")))
    return reduce(DataFrame.unionByName, parts)
