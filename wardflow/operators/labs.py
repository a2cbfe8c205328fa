"""O7 lab subset, O8 latest value per 12 h block, O9 latest per subject."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.config import GridSpec
from wardflow.functions.match import contains_ci, regex_contains_ci
from wardflow.functions.timegrid import slot_of, slot_start
from wardflow.operators.timeblocks import _FIRST, _LAST, with_block_range

LAB_COLUMNS = [C.SUBJECT_ID, C.HADM_ID, C.ITEMID, C.CHARTTIME, C.VALUENUM, C.VALUEUOM, C.LABEL]


SPREAD = 64  # parts that the rows of one test are dealt to


def label_labs(labs: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Attach LABEL from the lab dictionary (J5) unless the rows carry one.

    Tests are few and some are most of the rows: the rows of a test are dealt to ``SPREAD`` parts
    by a hash of the row, and the dictionary has an entry for each part.
    """
    if dictionary is None:
        return labs
    names = dictionary.select(C.ITEMID, C.LABEL).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = labs.withColumn("_part", F.pmod(F.xxhash64(*labs.columns), F.lit(SPREAD)).cast("int"))
    return dealt.join(names, [C.ITEMID, "_part"], "inner").drop("_part")


def subset_labs(cohort: DataFrame, labs: DataFrame, patterns=("Troponin", "BNP"),
                dictionary: DataFrame | None = None) -> DataFrame:
    """Tests whose label matches a pattern, inside ``[admit, discharge)``
    of a cohort row (cohort rows stay duplicated per code, as in the reference).

    The equi-join on (subject, admission) replaces the reference's chunked
    ``IN`` lists; Spark may add a runtime bloom filter on the large side.  Only the cohort's tests meet the dictionary.
    A NaN value is a missing one, as in pandas: it leaves here as NULL.
    """
    cond = F.lit(False)
    for p in patterns:
        cond = cond | contains_ci(F.col(C.LABEL), p)
    stays = cohort.select(C.SUBJECT_ID, C.HADM_ID, C.ADMIT, C.DISCHARGE)
    lab = labs.select(*[c for c in LAB_COLUMNS if dictionary is None or c != C.LABEL])
    j = lab.join(stays, [C.SUBJECT_ID, C.HADM_ID], "inner")
    j = j.where((F.col(C.CHARTTIME) >= F.col(C.ADMIT)) & (F.col(C.CHARTTIME) < F.col(C.DISCHARGE)))
    return label_labs(j, dictionary).where(cond).select(*LAB_COLUMNS, C.ADMIT, C.DISCHARGE).withColumn(
        C.VALUENUM, F.when(~F.isnan(C.VALUENUM), F.col(C.VALUENUM)))


def stay_blocks(cohort: DataFrame, grid: GridSpec) -> DataFrame:
    """Distinct (SUBJECT_ID, HADM_ID, block index) of the expansion, with the admit time."""
    r = with_block_range(cohort, C.ADMIT, C.DISCHARGE, grid)
    r = r.select(C.SUBJECT_ID, C.HADM_ID, C.ADMIT, F.expr(f"explode(sequence({_FIRST}, {_LAST}))").alias("_k"))
    return r.groupBy(C.SUBJECT_ID, C.HADM_ID, "_k").agg(F.max(C.ADMIT).alias(C.ADMIT))


def stay_timelines(cohort: DataFrame, lab_subset: DataFrame, grid: GridSpec,
                   tests: tuple[tuple[str, str], ...]) -> DataFrame:
    """One row per stay with a block: SUBJECT_ID, HADM_ID, _blocks (k, admit) and _seen.

    ``_seen`` has an entry for each of the stay's blocks with tests: the last non-null value and
    unit of every test in it, each column on its own (N5).  Both arrays have at most one entry per
    block of the grid.  Everything is grouped and joined by (subject, admission) alone, so inputs that are
    bucketed by these keys need no exchange.
    """
    match = {prefix: regex_contains_ci(F.col(C.LABEL), name) for prefix, name in tests}
    any_test = F.lit(False)
    for m in match.values():
        any_test = any_test | m
    order = F.struct(C.CHARTTIME, C.ITEMID, C.VALUENUM, C.VALUEUOM)
    aggs = []
    for prefix, m in match.items():
        aggs.append(F.max_by(C.VALUENUM, F.when(m & F.col(C.VALUENUM).isNotNull(), order)).alias(f"{prefix}_VAL"))
        aggs.append(F.max_by(C.VALUEUOM, F.when(m & F.col(C.VALUEUOM).isNotNull(), order)).alias(f"{prefix}_UNIT"))
    stay = [C.SUBJECT_ID, C.HADM_ID]
    per_block = (lab_subset.where(any_test).withColumn("_k", slot_of(C.CHARTTIME, grid, grid.block_us))
                 .groupBy(*stay, "_k").agg(*aggs))
    seen = per_block.groupBy(*stay).agg(F.collect_list(F.struct("_k", *_columns(tests))).alias("_seen"))
    blocks = stay_blocks(cohort, grid).groupBy(*stay).agg(F.collect_list(F.struct("_k", C.ADMIT)).alias("_blocks"))
    # a test in a block that the stay does not have is not carried on
    return blocks.join(seen, stay, "left").withColumn("_seen", F.expr(
        "filter(_seen, t -> array_contains(transform(_blocks, b -> b._k), t._k))"))


def _columns(tests: tuple[tuple[str, str], ...]) -> list[str]:
    return [f"{p}_{c}" for p, _ in tests for c in ("VAL", "UNIT")]


def values_at(k: str, tests: tuple[tuple[str, str], ...]) -> list:
    """Columns of every test: the last non-null entry of ``_seen`` up to block ``k`` (forward fill)."""
    return [F.expr(f"array_max(transform(filter(_seen, t -> t._k <= {k} AND t.{c} IS NOT NULL), "
                   f"t -> struct(t._k AS _k, t.{c} AS v))).v").alias(c) for c in _columns(tests)]


def block_values(timelines: DataFrame, grid: GridSpec, tests: tuple[tuple[str, str], ...]) -> DataFrame:
    """O8 with ADMISSION_DATE: a row for every block of every stay with each test's latest value and unit."""
    rows = timelines.select(C.SUBJECT_ID, C.HADM_ID, "_seen", F.explode("_blocks").alias("_b"))
    rows = rows.select(C.SUBJECT_ID, C.HADM_ID, "_seen", F.col("_b._k").alias("_k"), F.col(f"_b.{C.ADMIT}").alias(C.ADMIT))
    return rows.select(C.SUBJECT_ID, C.HADM_ID, slot_start("_k", grid, grid.block_us).alias(C.B12),
                       *values_at("_k", tests), C.ADMIT)


def latest_labs_with_admit(cohort: DataFrame, lab_subset: DataFrame, grid: GridSpec,
                           tests: tuple[tuple[str, str], ...]) -> DataFrame:
    """O8 for several tests, keeping ADMISSION_DATE (input of O9)."""
    return block_values(stay_timelines(cohort, lab_subset, grid, tests), grid, tests)


def latest_labs(cohort: DataFrame, lab_subset: DataFrame, grid: GridSpec,
                tests: tuple[tuple[str, str], ...]) -> DataFrame:
    """O8 for several tests at once: SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR, <P>_VAL, <P>_UNIT ..."""
    return latest_labs_with_admit(cohort, lab_subset, grid, tests).drop(C.ADMIT)


def latest_lab(cohort: DataFrame, lab_subset: DataFrame, grid: GridSpec,
               test_name: str, prefix: str) -> DataFrame:
    """For each admission block, the latest value and unit seen up to the
    block's end, counting tests from the stay's first block on."""
    return latest_labs(cohort, lab_subset, grid, ((prefix, test_name),))


def latest_per_subject(cohort: DataFrame, lab_subset: DataFrame, grid: GridSpec,
                       test_name: str, prefix: str) -> DataFrame:
    """Value at the last block of each subject's latest admission."""
    return latest_per_subject_all(cohort, lab_subset, grid, ((prefix, test_name),))


def latest_per_subject_all(cohort: DataFrame, lab_subset: DataFrame, grid: GridSpec,
                           tests: tuple[tuple[str, str], ...]) -> DataFrame:
    """O9 for several tests: one row per subject with every test's value and unit.

    One aggregate per subject (partial aggregation map-side, so a subject
    with very many stays is not sent whole to one task); ties on the admit
    time go to the larger admission id.
    """
    return pick_latest_per_subject(latest_labs_with_admit(cohort, lab_subset, grid, tests), tests)


def pick_latest_per_subject(per_block: DataFrame, tests: tuple[tuple[str, str], ...]) -> DataFrame:
    """O9 from per-block latest values that carry ADMISSION_DATE."""
    names = _columns(tests)
    pick = F.max_by(F.struct(*names), F.struct(C.ADMIT, C.HADM_ID, C.B12)).alias("_p")
    g = per_block.groupBy(C.SUBJECT_ID).agg(pick)
    return g.select(C.SUBJECT_ID, *[F.col(f"_p.{n}").alias(n) for n in names])
