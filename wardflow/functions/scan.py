"""Ordered scans per key, computed in two levels so a hot key is split.

A plain window ``partitionBy(key).orderBy(ts)`` sends every row of a key to
one task.  Here the rows are dealt out by ranges of (key, ts, ...), whose
bounds Spark takes from the data, and written with the number of their range:
a window inside each (key, range) gives local values, and a window over the
per-range summaries (at most one row per range and key) what is carried in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow.session import cut_lineage


def episode_scan(df: DataFrame, key: str, ts: str, order: list[str], is_end: str,
                 is_start: str, ranges: int | None = None) -> DataFrame:
    """One ordered pass per ``key`` that yields, for every row:

    * ``S``       — starts so far (inclusive running count),
    * ``S_open``  — value of ``S`` at the latest end event at or before the row (0 if none),
    * ``NEXT_END`` — time of the first end event after the row in the order (NULL if none).

    ``order`` names the tie-break columns after ``ts``; ``is_end`` / ``is_start``
    are SQL predicates.  A task holds about 1/``ranges`` of all rows (default:
    the shuffle partitions), however they spread over keys and times.  Both
    levels read the written ranges, so ``df`` is computed once for them.
    Frames only grow from the start of the partition, so each window is a
    single linear pass.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bk = "_bucket"
    asc = ", ".join([f"`{ts}`"] + [f"`{o}`" for o in order])
    desc = ", ".join([f"`{ts}` DESC"] + [f"`{o}` DESC" for o in order])
    part = f"PARTITION BY `{key}`, {bk}"
    grow = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    base = cut_lineage(df.repartitionByRange(ranges, key, ts, *order).select(
        "*", F.spark_partition_id().alias(bk), F.expr(f"CAST({is_end} AS INT) AS _e"),
        F.expr(f"CAST({is_start} AS BIGINT) AS _s")))
    local = base.selectExpr(
        "*", f"sum(_s) OVER ({part} ORDER BY {asc} {grow}) AS _ls",
        f"min(CASE WHEN _e = 1 THEN `{ts}` END) OVER ({part} ORDER BY {desc} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _ln")
    local = local.selectExpr("*", f"max(CASE WHEN _e = 1 THEN _ls END) OVER ({part} ORDER BY {asc} {grow}) AS _lo")
    summary = local.groupBy(key, bk).agg(
        F.expr("sum(_s) AS _ts"), F.expr(f"min(CASE WHEN _e = 1 THEN `{ts}` END) AS _te"),
        F.expr("max(CASE WHEN _e = 1 THEN _ls END) AS _tl"))
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carried = summary.selectExpr(
        f"`{key}`", bk, "_te", "_tl",
        f"coalesce(sum(_ts) OVER (PARTITION BY `{key}` ORDER BY {bk} {before}), 0) AS _cs",
        f"min(_te) OVER (PARTITION BY `{key}` ORDER BY {bk} DESC {before}) AS _cn")
    carried = carried.selectExpr(
        f"`{key}`", bk, "_cs", "_cn", f"max(_cs + _tl) OVER (PARTITION BY `{key}` ORDER BY {bk} {before}) AS _co")
    out = local.join(carried, [key, bk], "inner")
    return out.select(*[f"`{c}`" for c in df.columns], F.expr("_cs + _ls AS S"),
                      F.expr("CAST(coalesce(_cs + _lo, _co, 0) AS BIGINT) AS S_open"),
                      F.expr("coalesce(_ln, _cn) AS NEXT_END"))
