"""P1-P3, A8-A10 over a mergeable state: only new or changed files are read again.

The state holds, for every profiled file, its distinct rows as 128-bit hashes
with their number and a bitmap of their missing columns.  Row counts, null counts
and duplicate rows of any set of files are sums over the state.
"""

from __future__ import annotations

from functools import reduce
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.operators.profile import _missing_sql, _normalised_sql

_WORD = 62  # columns of one bitmap word
_FILES = "TABLE_NAME STRING, path STRING, uri STRING, length BIGINT, modified TIMESTAMP, file BIGINT, batch STRING"
_ROWS = "TABLE_NAME STRING, file BIGINT, h1 BIGINT, h2 BIGINT, n BIGINT, missing ARRAY<BIGINT>, batch STRING"


def list_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The files of each table: TABLE_NAME, path, uri (as ``_metadata.file_path``), length, modified, and file (names this version of it).

    Spark lists them; no content is read.
    """
    def files(name: str, path: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return found.select(F.lit(name).alias("TABLE_NAME"), "path", F.col("_metadata.file_path").alias("uri"), "length", F.col("modificationTime").alias("modified"))
    listed = reduce(DataFrame.unionAll, [files(n, p) for n, p in paths.items()])
    return listed.where("length > 0").withColumn("file", F.xxhash64("TABLE_NAME", "path", "length", "modified"))


class ProfileState:
    """A state in ``folder`` (on any file system that Spark knows) for tables of the given schemas (DDL)."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str]):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas

    def _read(self, name: str, ddl: str) -> DataFrame:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(f"{self.folder}/{name}")

    def known(self) -> DataFrame:
        """Files whose rows are in the state."""
        return self._read("files", _FILES)

    def update(self, listing: DataFrame) -> list[str]:
        """Bring the files of ``listing`` into the state; returns the paths that were read.

        Rows are written first and the batch's list of files last, so a batch that stopped counts for nothing.
        """
        new = listing.join(self.known().select("file"), "file", "left_anti")
        todo: dict[str, list] = {}
        for r in new.collect():  # one row per new file
            todo.setdefault(r.TABLE_NAME, []).append(r)
        if not todo:
            return []
        batch = uuid.uuid4().hex
        parts = [self._rows(name, [r.path for r in files]) for name, files in todo.items()]
        rows = reduce(DataFrame.unionAll, parts)
        versions = self.spark.createDataFrame([tuple(r[c] for c in ("TABLE_NAME", "uri", "file")) for f in todo.values() for r in f],
                                              "TABLE_NAME STRING, uri STRING, file BIGINT")
        kept = rows.join(versions, ["TABLE_NAME", "uri"]).select("TABLE_NAME", "file", "h1", "h2", "n", "missing", F.lit(batch).alias("batch"))
        kept.write.mode("append").parquet(f"{self.folder}/rows")
        listed = [(r.TABLE_NAME, r.path, r.uri, r.length, r.modified, r.file, batch) for f in todo.values() for r in f]
        self.spark.createDataFrame(listed, _FILES).coalesce(1).write.mode("append").parquet(f"{self.folder}/files")
        return sorted(r.path for f in todo.values() for r in f)

    def _rows(self, name: str, paths: list[str]) -> DataFrame:
        """Distinct rows of some files of a table: TABLE_NAME, uri, h1, h2, n, missing; one scan."""
        df = self.spark.read.schema(self.schemas[name]).parquet(*paths)
        fields = df.schema.fields
        values = ", ".join(_normalised_sql(f.name, f.dataType) for f in fields)
        words = []
        for w in range(0, len(fields), _WORD):
            bits = " | ".join(f"shiftleft(CAST({_missing_sql(f.name, f.dataType)} AS BIGINT), {i})" for i, f in enumerate(fields[w:w + _WORD]))
            words.append(bits)
        hashed = df.select(F.lit(name).alias("TABLE_NAME"), F.col("_metadata.file_path").alias("uri"),
                           F.expr(f"xxhash64({values})").alias("h1"), F.expr(f"xxhash64('second', {values})").alias("h2"),
                           F.expr(f"array({', '.join(words)})").alias("missing"))
        return hashed.groupBy("TABLE_NAME", "uri", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.first("missing").alias("missing"))

    def rows(self, listing: DataFrame) -> DataFrame:
        """The state's rows of the listed files; batches without a list of files, and other versions of a file, are left out."""
        valid = self.known().join(listing.select("file"), "file", "left_semi").select("file", "batch").distinct()
        return self._read("rows", _ROWS).join(valid, ["file", "batch"], "left_semi")

    def nulls(self, listing: DataFrame) -> DataFrame:
        """As ``profile_nulls``: TABLE_NAME, COLUMN_NAME, NULL_COUNT of the columns with missing values."""
        merged = self.rows(listing).groupBy("TABLE_NAME", "missing").agg(F.sum("n").alias("n"))  # few different bitmaps
        parts = []
        for name in self.schemas:
            columns = self.spark.createDataFrame([], self.schemas[name]).columns
            flags = ", ".join(f"if((missing[{i // _WORD}] & {1 << (i % _WORD)}L) <> 0, '{c}', NULL)" for i, c in enumerate(columns))
            parts.append(merged.where(F.col("TABLE_NAME") == name).select(
                "TABLE_NAME", F.explode(F.expr(f"filter(array({flags}), c -> c IS NOT NULL)")).alias("COLUMN_NAME"), "n"))
        return reduce(DataFrame.unionAll, parts).groupBy("TABLE_NAME", "COLUMN_NAME").agg(F.sum("n").alias("NULL_COUNT"))

    def duplicates(self, listing: DataFrame) -> DataFrame:
        """As ``duplicate_report``: TABLE_NAME, ROW_COUNT, DUPLICATE_ROWS; tables without rows count 0.

        Rows are equal if their 128 bits of hash are.
        """
        merged = self.rows(listing).groupBy("TABLE_NAME", "h1", "h2").agg(F.sum("n").alias("n"))
        counts = merged.groupBy("TABLE_NAME").agg(F.sum("n").alias("ROW_COUNT"), (F.sum("n") - F.count(F.lit(1))).alias("DUPLICATE_ROWS"))
        names = self.spark.createDataFrame([(n,) for n in self.schemas], "TABLE_NAME STRING")
        return names.join(counts, "TABLE_NAME", "left").na.fill(0, ["ROW_COUNT", "DUPLICATE_ROWS"])
