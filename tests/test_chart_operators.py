"""V1, V2, V4, V6, T5: rank selection, densities by cell moments, exact-size samples, deep slices."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.operators import chartdata as V, ordering as T

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A group of a million distinct values of very uneven spread beside small ones, a constant one and infinities."""
    big = spark.range(1_000_000).select(F.lit("big").alias("g"), F.expr("exp(rand(5) * 60) * if(id % 3 = 0, -1, 1) + id * 1e-9").alias("y"))
    small = spark.range(5000).select(F.expr("concat('s', id % 7)").alias("g"), F.expr("cast(id % 50 AS double)").alias("y"))
    one = spark.range(300_000).select(F.lit("constant").alias("g"), F.lit(4.25).alias("y"))
    ends = spark.createDataFrame([("ends", float("inf")), ("ends", float("-inf")), ("ends", 1.0), ("single", 2.0)], "g STRING, y DOUBLE")
    from wardflow.session import cut_lineage
    return cut_lineage(big.union(small).union(one).union(ends))


def test_quantiles_equal_percentile(spark, skewed):
    got = {r.g: [r[f"Q{i}"] for i in range(len(PROBS))] for r in V.exact_quantiles(skewed, ["g"], "y", PROBS).collect()}
    want = {r.g: r.p for r in skewed.groupBy("g").agg(F.percentile("y", PROBS).alias("p")).collect()}
    assert got == want
    one = V.exact_quantiles(skewed.where("g = 'big'").select("y"), [], "y", PROBS).first()
    assert [one[f"Q{i}"] for i in range(len(PROBS))] == want["big"]


def test_no_task_ranks_more_than_the_bound(spark, skewed):
    values, sets = V.rank_candidates(skewed, ["g"], "y", PROBS)
    sizes = {(r.g, r._id): r["count"] for r in values.groupBy("g", "_id").count().collect()}
    assert max(sizes.values()) <= V.RANK_BOUND
    assert sum(n for (g, _), n in sizes.items() if g == "big") <= 2 * len(PROBS) * V.RANK_BOUND
    assert {(r.g, r._id) for r in sets.collect()} == set(sizes)
    fewer, _ = V.rank_candidates(skewed, ["g"], "y", [0.5], bound=10, buckets=8)  # many rounds
    assert max(r["count"] for r in fewer.groupBy("g", "_id").count().collect()) <= 10


def test_empty_groups(spark):
    none = spark.createDataFrame([], "g STRING, y DOUBLE")
    assert V.exact_quantiles(none, ["g"], "y", PROBS).count() == 0
    assert V.exact_quantiles(none.select("y"), [], "y", PROBS).count() == 0
    assert V.density(none, "y", by=["g"]).count() == 0


def _kde(values, gridsize=200, cut=3.0):
    v = np.array(values)
    bw = len(v) ** -0.2 * v.std(ddof=1)
    x = np.linspace(v.min() - cut * bw, v.max() + cut * bw, gridsize)
    return bw, np.array([np.exp(-0.5 * ((p - v) / bw) ** 2).sum() for p in x]) / (len(v) * bw * math.sqrt(2 * math.pi))


def test_density_error_bound(spark):
    """Smooth, clustered, far-flung and two-valued groups against the exact kernel sum."""
    rng = np.random.default_rng(3)
    groups = {"normal": rng.normal(5, 2, 3000), "clusters": np.r_[rng.normal(0, 1e-3, 2000), rng.normal(1, 1e-3, 1000)],
              "tails": np.r_[rng.standard_cauchy(3000), 1e7, -1e7], "two": np.array([1.0, 2.0]), "offset": 1e6 + rng.random(500)}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("flat", 1.0)] * 5 + [("lone", 1.0)],
                               "g STRING, y DOUBLE")
    got = {}
    for r in V.density(df, "y", by=["g"]).collect():
        got.setdefault(r.g, {})[r.POINT] = r.DENSITY
    assert set(got) == set(groups)  # no spread, no density
    for g, v in groups.items():
        bw, want = _kde(v)
        # the oracle's own rounding grows with the offset of the values
        assert np.abs(np.array([got[g][i] for i in range(200)]) - want).max() <= 3e-13 / bw + 1e-9 * want.max(), g
    alone = V.density(df.where("g = 'normal'"), "y").orderBy("POINT").collect()
    assert [r.DENSITY for r in alone] == pytest.approx([got["normal"][i] for i in range(200)], rel=1e-12)


def test_density_rows_are_bounded_by_cells(spark):
    d = spark.range(400_000).select(F.expr("tan((rand(2) - 0.5) * 3.14159)").alias("_y"))  # every value differs
    cells, _ = V.cell_moments(d, [], 50, 3.0)
    assert cells.count() <= 50 * (2 * V.REACH * V.CELLS_PER_BANDWIDTH + 3)


def test_sample_has_exactly_k_rows(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", None]), float(i), None if i % 50 == 0 else i * 0.5) for i in range(4000)]
    rows += [(9000 + i, "few", 1.0, 2.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id BIGINT, hue STRING, x DOUBLE, y DOUBLE").repartition(7)
    got = V.scatter_points(df, "x", "y", "hue", per_hue=20, sample_key=["id"]).collect()
    assert Counter(r.hue for r in got) == {"hot": 20, "a": 20, "b": 20, "few": 5}
    clean = [r for r in rows if r[1] is not None and r[3] is not None]
    for hue in ("hot", "a"):
        best = sorted((hashlib.md5(str(r[0]).encode()).hexdigest(), r[2], r[3]) for r in clean if r[1] == hue)[:20]
        assert sorted((r.x, r.Y) for r in got if r.hue == hue) == sorted(b[1:] for b in best)
    assert V.scatter_points(df, "x", "y", per_hue=7, sample_key=["id"]).count() == 7
    assert V.scatter_points(df, "x", "y", "hue").count() == len(clean)
    with pytest.raises(ValueError):
        V.scatter_points(df, "x", "y", "hue", per_hue=3)


def test_slices_at_any_depth(spark):
    rows = [(i % 10, (i * 7919) % 5003, "x" * (i % 3)) for i in range(5003)]
    df = spark.createDataFrame(rows, "a INT, b INT, s STRING").repartition(5)
    want = sorted(rows)
    for start, stop in ((0, 5), (10, 16), (4500, 4600), (5000, 9999), (6000, 6010), (5, 5), (0, 6000)):
        assert [tuple(r) for r in T.slice_rows(df, ["a", "b"], start, stop).collect()] == want[start:stop]
    assert [tuple(r) for r in T.slice_from_share(df, ["a", "b"], 0.9, 7).collect()] == want[4502:4509]
    # ties: every row exactly once over adjoining slices
    parts = [T.slice_rows(df, ["a"], k, k + 1000) for k in range(0, 5003, 1000)]
    assert sorted(tuple(r) for p in parts for r in p.collect()) == want
    plan = T.slice_rows(df, ["a", "b"], 4500, 4600)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "PushedFilters: [Or(" in plan or "GreaterThanOrEqual(_row" in plan
    assert T.slice_rows(df.limit(0), ["a"], 0, 5).count() == 0
