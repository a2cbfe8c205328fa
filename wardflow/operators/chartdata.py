"""V1-V6: the aggregates behind the reference's plots, as DataFrames.

Drawing is out of scope; these produce what a plotting library would
compute from the rows.  Group statistics use partial aggregation; per-group
parameters (quartiles, histogram ranges, bandwidths) are small tables joined
back on the group keys, with rows of one group dealt to several tasks, or read as a scalar
when there is no group.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from wardflow.session import cut_lineage


def _keys(*cols) -> list[str]:
    out = []
    for c in cols:
        if c and c not in out:
            out.append(c)
    return out


def _clean(df: DataFrame, keys: list[str], y: str | None) -> DataFrame:
    cond = F.lit(True)
    for c in keys + ([y] if y else []):
        cond = cond & F.col(c).isNotNull()
        if y and c == y:
            cond = cond & ~F.isnan(F.col(c).cast("double"))
    return df.where(cond)


SALTS = 32


def _join_on(df: DataFrame, stats: DataFrame, keys: list[str], spread: str = "_y") -> DataFrame:
    """Attach per-group parameters; rows of one group are dealt by ``spread`` to ``SALTS`` join keys.

    Without group keys the parameters are one global-aggregate row: it is read as a scalar
    subquery (evaluated once, no join), never joined on a constant key."""
    if keys:
        salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        rows = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
        return rows.join(salted, [*keys, "_salt"], "inner").drop("_salt")
    packed = stats.select(F.struct(*stats.columns).alias("_s")).scalar()
    return df.select("*", *[packed[c].alias(c) for c in stats.columns])


def scatter_points(df: DataFrame, x: str, y: str, hue: str | None = None, facet: str | None = None,
                   per_hue: int | None = None, sample_key: list[str] | None = None) -> DataFrame:
    """V1: the (x, y[, hue][, facet]) points with missing values dropped.

    ``per_hue`` draws a sample of exactly that many points of each (facet, hue), or all if there are
    fewer: those with the smallest md5 of the ``sample_key`` columns (names of a row), so that the
    sample depends on the rows alone.  Two bounded top-k steps: first within 64 parts of a
    hue, then among their winners.
    """
    keys = _keys(facet, x, hue)
    points = _clean(df, keys, y)
    shown = [*[F.col(c) for c in keys], F.col(y).cast("double").alias("Y")]
    if per_hue is None:
        return points.select(*shown)
    if not sample_key:
        raise ValueError("a sample needs the columns that name a row")
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in sample_key])
    hashed = points.select(*shown, F.md5(text).alias("_h"))
    groups, order = _keys(facet, hue), ["_h", x, "Y"]
    part = hashed.withColumn("_part", F.pmod(F.xxhash64("_h"), F.lit(64)))
    some = part.withColumn("_n", F.row_number().over(Window.partitionBy(*groups, "_part").orderBy(*order))).where(F.col("_n") <= per_hue)
    if not groups:
        return some.orderBy(*order).limit(per_hue).drop("_h", "_part", "_n")
    best = some.withColumn("_n", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("_n") <= per_hue)
    return best.drop("_h", "_part", "_n")


def group_stats(df: DataFrame, x: str, y: str, hue: str | None = None, facet: str | None = None) -> DataFrame:
    """V3/V5: per (facet, x, hue) mean, count and sample standard deviation of y."""
    keys = _keys(facet, x, hue)
    v = F.col(y).cast("double")
    return _clean(df, keys, y).groupBy(*keys).agg(
        F.avg(v).alias("MEAN"), F.count(v).alias("N"), F.stddev_samp(v).alias("STDDEV"))


RANK_BOUND = 4_096  # distinct values that one task ranks


def rank_candidates(d: DataFrame, keys: list[str], y: str, probs: list[float], bound: int = RANK_BOUND,
                    buckets: int = 64, accuracy: int = 2_000) -> tuple[DataFrame, DataFrame]:
    """Few values that hold the ranks of the quantiles, and where each set of them starts.

    Returns (values, targets): keys, _id, y and the count _c of each value; and keys, _id, _start (rows
    of the group below the set), _n (rows of the group) and _ranks (q, r).  A set (keys, _id) has at most ``bound`` values.

    Values are counted per (group, value) once.  While a set has more values, a bounded sketch cuts it into
    ``buckets`` ranges, a histogram counts them, its prefix sums locate the ranks, and only the ranges
    that hold one go on: each round leaves about 1/``buckets`` of a set per rank, whatever the values' distribution.
    """
    vc = cut_lineage(d.groupBy(*keys, y).agg(F.count(F.lit(1)).alias("_c")))
    ranks = ", ".join(f"named_struct('q', {i}, 'r', CAST({f}({p!r}D * (_n - 1)) AS BIGINT))"
                      for i, p in enumerate(probs) for f in ("floor", "ceil"))
    sets = vc.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d")).where("_n > 0")
    sets = cut_lineage(sets.select(*keys, F.lit("").alias("_id"), F.lit(0).cast("bigint").alias("_start"), "_n", "_d",
                                   F.expr(f"array({ranks})").alias("_ranks")))
    values, of = vc.withColumn("_id", F.lit("")), [*keys, "_id"]
    done_values, done_sets = [], []
    while True:
        small, large = sets.where(F.col("_d") <= bound), sets.where(F.col("_d") > bound)
        done_sets.append(small.drop("_d"))
        done_values.append(_join_on(values, small.select(*of), of, y))
        if large.isEmpty():
            break
        now = _join_on(values, large.select(*of), of, y)
        cuts = [i / buckets for i in range(1, buckets)]
        bounds = cut_lineage(now.groupBy(*of).agg(F.percentile_approx(y, cuts, accuracy).alias("_bounds")))
        cut = _join_on(now, bounds, of, y).withColumn("_b", F.expr(f"size(filter(_bounds, b -> b < `{y}`))")).drop("_bounds")
        hist = cut.groupBy(*of, "_b").agg(F.sum("_c").alias("_rows"), F.count(F.lit(1)).alias("_d"))
        prefix = Window.partitionBy(*of).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("_below", F.sum("_rows").over(prefix) - F.col("_rows"))  # at most ``buckets`` rows a set
        hit = hist.join(large.drop("_d"), of).withColumn("_start", F.col("_start") + F.col("_below")).withColumn(
            "_ranks", F.expr("filter(_ranks, t -> t.r >= _start AND t.r < _start + _rows)")).where("size(_ranks) > 0")
        name = F.concat_ws(".", "_id", F.col("_b").cast("string")).alias("_id")
        sets = cut_lineage(hit.select(*keys, name, "_start", "_n", "_d", "_ranks"))
        values = cut_lineage(_join_on(cut.select(*keys, name, y, "_c"), sets.select(*of), of, y))
    return reduce(DataFrame.unionByName, done_values), reduce(DataFrame.unionByName, done_sets)


def exact_quantiles(d: DataFrame, keys: list[str], y: str, probs: list[float], bound: int = RANK_BOUND,
                    buckets: int = 64) -> DataFrame:
    """Exact linear-interpolation quantiles per group; no task ranks more than ``bound`` values of a group.

    The result equals Spark's ``percentile``: (hi - pos) * v[lo] + (pos - lo) * v[hi]
    with pos = p * (n - 1).  Returns keys + ``Q0``, ``Q1``, ... columns.
    """
    values, sets = rank_candidates(d, keys, y, probs, bound, buckets)
    of = [*keys, "_id"]
    before = Window.partitionBy(*of).orderBy(y).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("_before", F.sum("_c").over(before) - F.col("_c"))
    picked = (ranked.join(sets, of).select(*keys, "_n", "_c", F.col(y).alias("_v"), (F.col("_start") + F.col("_before")).alias("_at"),
                                           F.explode("_ranks").alias("_t"))
              .where("_t.r >= _at AND _t.r < _at + _c").select(*keys, "_n", "_v", F.col("_t.q").alias("_q"), F.col("_t.r").alias("_r")))
    out = picked.groupBy(*keys, "_n").agg(*[
        F.struct(F.min(F.when(F.col("_q") == i, F.col("_r"))).alias("lo"),
                 F.max(F.when(F.col("_q") == i, F.col("_r"))).alias("hi"),
                 F.min_by("_v", F.when(F.col("_q") == i, F.col("_r"))).alias("vlo"),
                 F.max_by("_v", F.when(F.col("_q") == i, F.col("_r"))).alias("vhi")).alias(f"_s{i}")
        for i in range(len(probs))])
    cols = []
    for i, p in enumerate(probs):
        pos = f"({p!r}D * (_n - 1))"
        cols.append(F.expr(f"CASE WHEN _s{i}.lo = _s{i}.hi THEN _s{i}.vlo ELSE "
                           f"(_s{i}.hi - {pos}) * _s{i}.vlo + ({pos} - _s{i}.lo) * _s{i}.vhi END").alias(f"Q{i}"))
    return out.select(*keys, *cols)


def box_stats(df: DataFrame, x: str, y: str, hue: str | None = None, facet: str | None = None) -> DataFrame:
    """V2: quartiles (exact, linear interpolation), whiskers at the extreme
    points within 1.5 IQR, and the outlier count, per (facet, x, hue)."""
    keys = _keys(facet, x, hue)
    # the values feed two branches (ranks and whiskers)
    d = cut_lineage(_clean(df, keys, y).select(*keys, F.col(y).cast("double").alias("_y")))
    q = exact_quantiles(d, keys, "_y", [0.25, 0.5, 0.75])
    q = q.select(*keys, F.col("Q0").alias("Q1"), F.col("Q1").alias("MEDIAN"), F.col("Q2").alias("Q3"))
    j = _join_on(d, q, keys)
    lo = F.col("Q1") - 1.5 * (F.col("Q3") - F.col("Q1"))
    hi = F.col("Q3") + 1.5 * (F.col("Q3") - F.col("Q1"))
    inside = (F.col("_y") >= lo) & (F.col("_y") <= hi)
    return j.groupBy(*keys, "Q1", "MEDIAN", "Q3").agg(
        F.min(F.when(inside, F.col("_y"))).alias("WHISKER_LOW"),
        F.max(F.when(inside, F.col("_y"))).alias("WHISKER_HIGH"),
        F.count(F.when(~inside, 1)).alias("OUTLIERS"), F.count(F.lit(1)).alias("N"))


def _range_stats(d: DataFrame, keys: list[str]) -> DataFrame:
    return d.groupBy(*keys).agg(F.min("_y").alias("_lo"), F.max("_y").alias("_hi"),
                                F.count(F.lit(1)).alias("_n"), F.stddev_samp("_y").alias("_sd"))


def histogram(df: DataFrame, col: str, bins: int = 30, by: list[str] | None = None) -> DataFrame:
    """V4/V6: equal-width bins over [min, max] per group (a zero-width range is
    widened by 0.5 each side); every bin is listed, empty ones with 0."""
    keys = list(by or [])
    d = _clean(df, keys, col).select(*keys, F.col(col).cast("double").alias("_y"))
    st = _range_stats(d, keys)
    st = st.select(*keys,
                   F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                   F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.least(F.floor((F.col("_y") - F.col("_lo")) / width).cast("int"), F.lit(bins - 1))
    counts = _join_on(d, st, keys).groupBy(*keys, b.alias("BIN")).agg(F.count(F.lit(1)).alias("COUNT"))
    grid = st.select(*keys, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("BIN"))
    out = grid.join(counts, keys + ["BIN"], "left")
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return out.select(*keys, "BIN", (F.col("_lo") + F.col("BIN") * w).alias("BIN_START"),
                      (F.col("_lo") + (F.col("BIN") + 1) * w).alias("BIN_END"),
                      F.coalesce("COUNT", F.lit(0)).cast("bigint").alias("COUNT"))


CELLS_PER_BANDWIDTH = 4   # a value lies within 1/8 bandwidth of its cell's centre
ORDER = 9                 # moments kept of each cell
REACH = 9.0               # bandwidths beyond which a kernel is left out


def cell_moments(d: DataFrame, keys: list[str], gridsize: int, cut: float) -> tuple[DataFrame, DataFrame]:
    """Moments of the values in cells of a quarter bandwidth, and the parameters of each group.

    Returns (cells, params): keys, _cell, _m0.. (sums of the powers of the distance from
    the centre, in bandwidths); and keys, _n, _bw, _a (first grid point), _step.  Values farther than ``REACH`` bandwidths from
    every grid point are in no cell, so a group has at most ``gridsize * (2 * REACH * CELLS_PER_BANDWIDTH + 3)``
    cells, whatever its values.
    """
    st = _range_stats(d, keys).where((F.col("_n") > 1) & (F.col("_sd") > 0))
    st = st.withColumn("_bw", F.pow(F.col("_n").cast("double"), -0.2) * F.col("_sd"))
    st = st.withColumn("_a", F.col("_lo") - cut * F.col("_bw")).withColumn(
        "_step", (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_bw")) / F.lit(float(gridsize - 1)))
    params = cut_lineage(st.select(*keys, "_n", "_bw", "_a", "_step"))
    placed = _join_on(d, params, keys).withColumn(
        "_near", F.expr(f"_a + least(greatest(round((_y - _a) / _step), 0D), {gridsize - 1}D) * _step"))
    placed = placed.where(f"abs(_y - _near) <= {REACH + 1 / CELLS_PER_BANDWIDTH}D * _bw").withColumn(
        "_cell", F.expr(f"floor((_y - _a) / (_bw / {CELLS_PER_BANDWIDTH}))"))
    placed = placed.withColumn("_t1", F.expr(f"(_y - _a) / _bw - (_cell + 0.5D) / {CELLS_PER_BANDWIDTH}"))
    powers = {f"_t{k}": f"_t{k // 2} * _t{k - k // 2}" for k in range(2, ORDER + 1)}
    for name, text in powers.items():
        placed = placed.withColumn(name, F.expr(text))
    sums = [F.count(F.lit(1)).cast("double").alias("_m0"), *[F.sum(f"_t{k}").alias(f"_m{k}") for k in range(1, ORDER + 1)]]
    return placed.groupBy(*keys, "_cell").agg(*sums), params


def density(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0,
            by: list[str] | None = None) -> DataFrame:
    """V4 (kde): Gaussian kernel density with Scott's bandwidth
    (n^-1/5 x sample sd) at ``gridsize`` points over [min - cut bw, max + cut bw].

    A fast Gauss transform: rows are reduced to the moments of cells, and a cell adds to
    the grid points within its reach the Hermite expansion of its kernels.  With |t| <= 1/8 and terms up
    to t^9 the rest of a kernel is at most 1.09 (1/8)^10 / sqrt(10!) / (1 - 1/8) < 7e-13 (Cramer's bound on Hermite
    functions), and a kernel left out is below exp(-40): DENSITY is within 3e-13 / bandwidth of the exact sum.
    """
    keys = list(by or [])
    d = cut_lineage(_clean(df, keys, col).select(*keys, F.col(col).cast("double").alias("_y")))
    cells, params = cell_moments(d, keys, gridsize, cut)
    centre = f"((_cell + 0.5D) / {CELLS_PER_BANDWIDTH})"  # in bandwidths from the first grid point
    placed = _join_on(cells, params, keys, "_cell").withColumn("_s", F.expr("_step / _bw"))
    reach = placed.withColumn("_from", F.expr(f"greatest(ceil(({centre} - {REACH}D) / _s), 0)")).withColumn(
        "_to", F.expr(f"least(floor(({centre} + {REACH}D) / _s), {gridsize - 1})")).where("_from <= _to")
    at = reach.withColumn("POINT", F.expr("explode(sequence(cast(_from AS int), cast(_to AS int)))")).withColumn(
        "_u", F.expr(f"POINT * _s - {centre}"))
    at = at.withColumns({"_h0": F.lit(1.0), "_h1": F.col("_u")})
    for k in range(2, ORDER + 1):
        at = at.withColumn(f"_h{k}", F.expr(f"_u * _h{k - 1} - {k - 1} * _h{k - 2}"))
    terms = " + ".join(f"_m{k} * _h{k} / {float(math.factorial(k))!r}D" for k in range(ORDER + 1))
    g = at.groupBy(*keys, "POINT").agg(F.sum(F.expr(f"exp(-0.5D * _u * _u) * ({terms})")).alias("_sum"))
    grid = params.withColumn("POINT", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))))
    norm = F.lit(1.0 / math.sqrt(2 * math.pi)) / (F.col("_n") * F.col("_bw"))
    return grid.join(g, [*keys, "POINT"], "left").select(
        *keys, "POINT", (F.col("_a") + F.col("POINT") * F.col("_step")).alias("X"),
        (F.coalesce("_sum", F.lit(0.0)) * norm).alias("DENSITY"))
