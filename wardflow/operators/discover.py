"""P5 / P6 without declared keys (S4, S5): which columns identify a row, and which refer to them.

Tables become cells (column, value), which are counted: a column whose values are all
different is a key, and a column whose every value also occurs in a key column refers to it.
References need the cells of every column, keys only those of columns that are near unique.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType,
                               StringType, TimestampNTZType, TimestampType)

from wardflow.operators.profile import _is_float, _normalised_sql
from wardflow.session import cut_lineage

# Values compare within a class; the number is part of a value's name.
_CLASSES = (("integer", (ByteType, ShortType, IntegerType, LongType), "CAST({c} AS BIGINT)"), ("text", (StringType,), "{c}"),
            ("time", (TimestampNTZType, TimestampType, DateType), "CAST({c} AS TIMESTAMP_NTZ)"), ("decimal", (DecimalType,), "CAST({c} AS STRING)"))


def value_class(t: DataType) -> str:
    if _is_float(t):
        return "real"
    for name, types, _ in _CLASSES:
        if isinstance(t, types):
            return name
    return t.simpleString() if isinstance(t, ArrayType) else "other"


def _value_sql(name: str, t: DataType) -> str:
    """The value as it compares within its class; NULL also for NaN."""
    c = f"`{name}`"
    for _, types, sql in _CLASSES:
        if isinstance(t, types):
            return sql.format(c=c)
    return f"CASE WHEN NOT isnan({c}) THEN {_normalised_sql(name, t)} END" if _is_float(t) else _normalised_sql(name, t)


def _hashes(cls: str, values: list[str]) -> tuple[str, str]:
    """Two 64-bit hashes that name a value (or a tuple of values) of a class."""
    args = ", ".join(values)
    return f"xxhash64('{cls}', {args})", f"xxhash64('{cls}', 1, {args})"


class Cells:
    """The counted cells of several tables: col (number of a column), h1, h2 (null for a missing value), n."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = {n: df for n, df in tables.items() if df.columns}
        self.columns = [(n, f.name, value_class(f.dataType)) for n, df in self.tables.items() for f in df.schema.fields]
        number = {(n, c): i for i, (n, c, _) in enumerate(self.columns)}
        parts = []
        for n, df in self.tables.items():
            cells = []
            for f in df.schema.fields:
                v = _value_sql(f.name, f.dataType)
                h1, h2 = _hashes(value_class(f.dataType), [v])
                cells.append(f"named_struct('col', {number[n, f.name]}, 'h1', if({v} IS NULL, NULL, {h1}), "
                             f"'h2', if({v} IS NULL, NULL, {h2}))")
            parts.append(df.select(F.explode(F.expr(f"array({', '.join(cells)})")).alias("c")).select("c.col", "c.h1", "c.h2"))
        # frequent values are counted map-side
        self.counted = cut_lineage(reduce(DataFrame.unionAll, parts).groupBy("col", "h1", "h2").agg(F.count(F.lit(1)).alias("n")))

    @property
    def spark(self) -> SparkSession:
        return self.counted.sparkSession

    def names(self) -> DataFrame:
        """The columns by number: a few rows of metadata."""
        return self.spark.createDataFrame([(i, *c) for i, c in enumerate(self.columns)],
                                          "col INT, TABLE_NAME STRING, COLUMN_NAME STRING, class STRING")

    def profile(self) -> DataFrame:
        """One row per column: rows, missing values, distinct values, and whether it is a key."""
        c = self.counted.groupBy("col").agg(
            F.sum("n").alias("ROW_COUNT"), F.coalesce(F.sum(F.when(F.col("h1").isNull(), F.col("n"))), F.lit(0)).alias("NULL_COUNT"),
            F.count("h1").alias("DISTINCT_VALUES"))
        found = self.names().join(c, "col", "left").na.fill(0, ["ROW_COUNT", "NULL_COUNT", "DISTINCT_VALUES"])
        return found.withColumn("IS_KEY", F.expr("ROW_COUNT > 0 AND DISTINCT_VALUES = ROW_COUNT"))

    def inclusions(self) -> DataFrame:
        """(child, parent, N_VALUES): every value of column ``child`` also occurs in column ``parent``.

        A value's set of columns has at most as many entries as there are columns, and there are few different sets:
        they are counted before pairs are formed.
        """
        holders = self.counted.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.array_sort(F.collect_set("col")).alias("cols"))
        sets = holders.groupBy("cols").agg(F.count(F.lit(1)).alias("n"))
        pairs = sets.select("n", F.explode("cols").alias("child"), "cols").select("n", "child", F.explode("cols").alias("parent"))
        common = cut_lineage(pairs.groupBy("child", "parent").agg(F.sum("n").alias("N_VALUES")))
        whole = common.where("child = parent").select("child", "N_VALUES")
        return common.where("child <> parent").join(whole, ["child", "N_VALUES"])


def discover_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Every minimal key of one or two columns: TABLE_NAME, KEY_COLUMNS, ROW_COUNT.

    One pass counts rows and missing values and sketches each column's distinct values.  The cells of columns that
    are near unique by the sketch are counted exactly.  Pairs are tried only for tables without a single key column,
    and only pairs without missing values whose distinct counts could name every row.  An empty table has no key.
    """
    tables = {n: df for n, df in tables.items() if df.columns}
    seen = _sketches(tables)
    likely = {n: [c for c in df.columns if _near_unique(seen[n, c].values, seen[n, c].rows)] for n, df in tables.items()}
    parts, keyed = [], set()
    if any(likely.values()):
        single = cut_lineage(Cells({n: tables[n].select(*cs) for n, cs in likely.items() if cs}).profile().where("IS_KEY"))
        keyed = {r.TABLE_NAME for r in single.select("TABLE_NAME").distinct().collect()}  # at most one row per table
        parts.append(single.select("TABLE_NAME", F.col("COLUMN_NAME").alias("KEY_COLUMNS"), "ROW_COUNT"))
    for name, df in tables.items():
        rows = seen[name, df.columns[0]].rows
        if not rows or name in keyed:
            continue
        most = {c: 1.25 * seen[name, c].values + 8 for c in df.columns if not seen[name, c].missing}  # well above the sketch's error
        pairs = [p for p in combinations(most, 2) if most[p[0]] * most[p[1]] >= rows]
        parts += _unique_pairs(name, df, pairs, most, rows)
    spark = next(iter(tables.values())).sparkSession
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "TABLE_NAME STRING, KEY_COLUMNS STRING, ROW_COUNT BIGINT")


@dataclass(frozen=True)
class _Sketch:
    rows: int
    missing: int
    values: int  # distinct values, to a few percent


def _sketches(tables: dict[str, DataFrame]) -> dict[tuple[str, str], _Sketch]:
    """Rows, missing values and about how many distinct values every column has: one aggregate per table."""
    parts = []
    for n, df in tables.items():
        aggs = []
        for f in df.schema.fields:
            v = _value_sql(f.name, f.dataType)
            named = F.expr(f"if({v} IS NULL, NULL, {_hashes(value_class(f.dataType), [v])[0]})")
            aggs.append(F.struct(F.count(named).alias("known"), F.approx_count_distinct(named, 0.02).alias("about")))
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*aggs).alias("cols")).select(F.lit(n).alias("t"), "n_rows", "cols"))
    return {(r.t, c): _Sketch(r.n_rows, r.n_rows - x.known, x.about) for r in reduce(DataFrame.unionAll, parts).collect()  # a row per table
            for c, x in zip(tables[r.t].columns, r.cols)}


def _near_unique(values: int, rows: int) -> bool:
    """Whether a column of about so many values may name every row; a sketch of few values can miss some."""
    return rows > 0 and (rows <= 1000 or values >= 0.8 * rows)


SHARES = (4096, 64)  # one value in so many, in the rounds that look for repeated pairs


def _pair_cells(df: DataFrame, pairs: list[tuple[str, str]], kept: list[str] | None = None) -> DataFrame:
    """(p, h1, h2) of every pair (by number) in every row, or only in the rows that meet the pair's condition."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for i, p in enumerate(pairs):
        h1, h2 = _hashes("pair", [_value_sql(c, types[c]) for c in p])
        cell = f"named_struct('p', {i}, 'h1', {h1}, 'h2', {h2})"
        cells.append(f"if({kept[i]}, {cell}, NULL)" if kept else cell)
    rows = df.where(" OR ".join(sorted(set(kept)))) if kept else df
    return rows.select(F.explode(F.expr(f"array({', '.join(cells)})")).alias("e")).where("e IS NOT NULL").select("e.p", "e.h1", "e.h2")


def _unrefuted(df: DataFrame, pairs: list[tuple[str, str]], values: dict[str, float], share: int) -> list[tuple[str, str]]:
    """The pairs without two equal rows among those where the pair's more selective column has one of 1/``share`` of its values.

    Equal pairs share that value, so they are seen together: what is dropped was seen to repeat.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    leads = [max(p, key=values.get) for p in pairs]
    kept = [f"xxhash64({_value_sql(c, types[c])}) % {share} = 0" for c in leads]
    repeated = _pair_cells(df, pairs, kept).groupBy("p", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = {r.p for r in repeated.select("p").distinct().collect()}  # at most one row per pair
    return [p for i, p in enumerate(pairs) if i not in gone]


def _unique_pairs(name: str, df: DataFrame, pairs: list[tuple[str, str]], values: dict[str, float], rows: int) -> list[DataFrame]:
    """Those of ``pairs`` that differ in every row: all rows are counted for every pair that no round saw repeat."""
    for share in SHARES:
        if pairs and rows >= 100 * share:
            pairs = _unrefuted(df, pairs, values, share)
    if not pairs:
        return []
    return [_counted_pairs(name, df, pairs, rows)]


def _counted_pairs(name: str, df: DataFrame, pairs: list[tuple[str, str]], rows: int) -> DataFrame:
    counts = (_pair_cells(df, pairs).groupBy("p", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("p").agg(F.max("n").alias("most")).where("most = 1"))
    names = df.sparkSession.createDataFrame([(i, name, ",".join(p), rows) for i, p in enumerate(pairs)],
                                            "p INT, TABLE_NAME STRING, KEY_COLUMNS STRING, ROW_COUNT BIGINT")
    return names.join(counts.select("p"), "p", "left_semi").drop("p")


def _stem(column: str) -> str:
    """A column's name without its table's prefix: the reference joins on equal names."""
    return column.split("_", 1)[-1].lower()


def discover_references(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns whose every value occurs in a key column of the same class.

    Returns CHILD_TABLE, CHILD_COLUMN, PARENT_TABLE, PARENT_COLUMN, N_VALUES (distinct values of the child),
    PARENT_VALUES, and SAME_NAME: whether the names agree but for a prefix — what tells a reference from
    a small number that happens to be someone's key.  Columns without values refer to nothing.
    """
    cells = Cells(tables)
    profile = cut_lineage(cells.profile())
    stems = cells.spark.createDataFrame([(i, _stem(c)) for i, (_, c, _) in enumerate(cells.columns)], "col INT, stem STRING")
    named = profile.join(stems, "col")
    child = named.select(F.col("col").alias("child"), F.col("TABLE_NAME").alias("CHILD_TABLE"), F.col("COLUMN_NAME").alias("CHILD_COLUMN"),
                         F.col("stem").alias("child_stem"))
    parent = named.where("IS_KEY").select(
        F.col("col").alias("parent"), F.col("TABLE_NAME").alias("PARENT_TABLE"), F.col("COLUMN_NAME").alias("PARENT_COLUMN"),
        F.col("stem").alias("parent_stem"), F.col("DISTINCT_VALUES").alias("PARENT_VALUES"))
    return cells.inclusions().join(child, "child").join(parent, "parent").select(
        "CHILD_TABLE", "CHILD_COLUMN", "PARENT_TABLE", "PARENT_COLUMN", "N_VALUES", "PARENT_VALUES",
        F.expr("child_stem = parent_stem").alias("SAME_NAME"))
