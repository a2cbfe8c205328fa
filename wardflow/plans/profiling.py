"""Profiling reports over the driver's tables."""

from __future__ import annotations

from functools import reduce
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardflow.operators import profile as P
from wardflow.operators.discover import discover_keys, discover_references
from wardflow.operators.profile_state import ProfileState, list_files
from wardflow.session import owned_dir
from wardflow.sources.schemas import TABLE_DDL, TABLES
from wardflow.sources.tables import Tables, list_tables

# Key metadata supplied by the caller (Parquet declares none); fixed values.
KEYS: dict[str, list[str]] = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


class Profiling:
    def __init__(self, spark: SparkSession, sf_dir: str, names=TABLES):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.t = Tables(spark, sf_dir, names)
        self.tables = {n: self.t[n] for n in names}

    def nulls(self) -> DataFrame:
        return P.profile_nulls(self.tables)

    def duplicates(self) -> DataFrame:
        return P.profile_duplicates(self.tables, KEYS, FOREIGN_KEYS)

    def key_uniqueness(self) -> DataFrame:
        return P.key_uniqueness(self.tables, KEYS)

    def orphan_keys(self) -> DataFrame:
        return P.orphan_keys(self.tables, FOREIGN_KEYS)

    # --- without declared keys ---

    def discovered_keys(self) -> DataFrame:
        return discover_keys(self.tables)

    def discovered_references(self) -> DataFrame:
        return discover_references(self.tables)

    # --- over a state that is brought up to date ---

    def _state(self) -> tuple[ProfileState, DataFrame]:
        """A state built from half of the files, then brought up to date with the rest."""
        state = ProfileState(self.spark, owned_dir(self.spark, "wardflow-profile"), {n: TABLE_DDL[n] for n in self.tables})
        listing = list_files(self.spark, {n: f"{self.sf_dir}/{n}.parquet" for n in self.tables})
        state.update(listing.where("file % 2 = 0"))
        state.update(listing)
        return state, listing

    def incremental_nulls(self) -> DataFrame:
        state, listing = self._state()
        return state.nulls(listing)

    def incremental_duplicates(self) -> DataFrame:
        state, listing = self._state()
        return state.duplicates(listing)

    # --- through the catalog ---

    def catalog_report(self) -> DataFrame:
        """Every table that the session's catalog lists, with its columns and rows read by that name."""
        prefix = f"catalog_{uuid.uuid4().hex[:8]}_"
        self.t.register_views(prefix)
        parts = []
        for name in list_tables(self.spark, prefix):
            df = self.spark.table(name)
            parts.append(df.agg(F.count(F.lit(1)).alias("ROW_COUNT")).select(
                F.lit(name[len(prefix):]).alias("TABLE_NAME"), F.lit(",".join(df.columns)).alias("COLUMNS"), "ROW_COUNT"))
        report = reduce(DataFrame.unionAll, parts)
        report.schema  # resolves the names before they are dropped
        self.t.drop_views(prefix)
        return report
