"""T4 / T5: ordered head (bounded top-k) and positional slices at any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.session import cut_lineage

_SHIFT = 33  # monotonically_increasing_id: partition number above, row number below


def head_rows(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """``sort_values(keys).head(n)`` — planned as a per-partition top-k merge."""
    return df.orderBy(*keys).limit(n)


class OrderedRows:
    """``df`` dealt by ranges of its keys and written once, with the number of rows of each range.

    Rows of equal keys are ordered by a hash of the whole row, which also lets a
    frequent key lie in several ranges.  Only one count per range comes to the driver.
    """

    def __init__(self, df: DataFrame, keys: list[str]):
        order = [*keys, F.xxhash64(*df.columns)]
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        self.keys = keys
        self.rows = cut_lineage(dealt.select("*", F.monotonically_increasing_id().alias("_row")))
        counts = self.rows.groupBy(F.shiftright("_row", _SHIFT).alias("p")).count().collect()  # at most n rows
        self.counts = sorted((r.p, r["count"]) for r in counts)

    def __len__(self) -> int:
        return sum(n for _, n in self.counts)

    def slice(self, start: int, stop: int) -> DataFrame:
        """Rows of the positions ``[start, stop)``, in order; only the ranges that hold them are read."""
        start, stop = max(0, start), min(stop, len(self))
        inside, before = F.lit(False), 0
        for p, n in self.counts:
            lo, hi = max(start - before, 0), min(stop - before, n)
            if lo < hi:
                inside = inside | F.col("_row").between((p << _SHIFT) + lo, (p << _SHIFT) + hi - 1)
            before += n
        return self.rows.where(inside).orderBy("_row").drop("_row")


def slice_rows(df: DataFrame, keys: list[str], start: int, stop: int) -> DataFrame:
    """``sort_values(keys).iloc[start:stop]``: range partitions and their prefix counts, at any depth."""
    return OrderedRows(df, keys).slice(start, stop)


def slice_from_share(df: DataFrame, keys: list[str], share: float, n: int) -> DataFrame:
    """``n`` rows from the position ``floor(share * rows)`` on."""
    rows = OrderedRows(df, keys)
    start = int(share * len(rows))
    return rows.slice(start, start + n)
