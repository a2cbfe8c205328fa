"""Clinical view of the driver's ``events`` table.

* stay      = each ``signup``: subject = user, admission = event id, unit =
  the user's ``c_mktsegment``, admit = ts, discharge = first ``purchase`` of
  the user strictly later than the signup (NULL if none).
* shift     = each ``click``: caregiver = user, unit = segment, start = ts,
  end = ts + round(value * 3600) seconds.
* lab       = each ``view`` / ``error`` event attributed to the user's stays
  whose ``[admit, discharge)`` contains it; item = event id, value = value,
  unit of measure = label = event type.

Stays and lab attribution come from one ordered pass over the user's
signup, purchase and lab events (``episode_scan``): a signup's discharge is
the next purchase in the order, and a lab lies in exactly the stays
numbered (S at the last purchase, S] when a next purchase exists.  Everything is
an equi-join on unique keys; no pairs are built and filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.functions.scan import episode_scan
from wardflow.functions.timegrid import add_micros
from wardflow.sources.tables import Tables

# Fixed event-type names of the mapping.
STAY_EVENT = "signup"
END_EVENT = "purchase"
SHIFT_EVENT = "click"
LAB_EVENTS = ("view", "error")

_KIND_END, _KIND_STAY, _KIND_LAB = 0, 1, 2


def _segments(t: Tables) -> DataFrame:
    return t["customer"].select(F.col("c_custkey").alias("user_id"),
                                F.col("c_mktsegment").alias(C.UNIT))


def ordered_events(t: Tables) -> DataFrame:
    """Signup, purchase and lab events with their episode quantities (``episode_scan``).

    At equal times purchases sort first, then signups, then labs, so a
    purchase never discharges a signup of the same instant and a lab at a
    discharge instant falls outside that stay.
    """
    ev = (t["events"]
          .where(F.col("event_type").isin(STAY_EVENT, END_EVENT, *LAB_EVENTS))
          .select("user_id", "event_id", "ts", "event_type", "value"))
    kind = (F.when(F.col("event_type") == END_EVENT, _KIND_END)
            .when(F.col("event_type") == STAY_EVENT, _KIND_STAY)
            .otherwise(_KIND_LAB))
    ev = ev.withColumn("_kind", kind)
    return episode_scan(ev, "user_id", "ts", ["_kind", "event_id"],
                        f"_kind = {_KIND_END}", f"_kind = {_KIND_STAY}")


def stays(t: Tables, ordered: DataFrame | None = None) -> DataFrame:
    """Cohort-shaped stays: SUBJECT_ID, HADM_ID, CURR_CAREUNIT, ADMISSION_DATE, DISCHARGE_DATE."""
    o = ordered if ordered is not None else ordered_events(t)
    s = o.where(F.col("_kind") == _KIND_STAY).join(_segments(t), "user_id", "left")
    return s.select(F.col("user_id").alias(C.SUBJECT_ID), F.col("event_id").alias(C.HADM_ID),
                    C.UNIT, F.col("ts").alias(C.ADMIT), F.col("NEXT_END").alias(C.DISCHARGE))


def staff(t: Tables) -> DataFrame:
    """Staff-shaped shifts: CURR_CAREUNIT, HADM_ID (NULL), CGID, LABEL, STARTTIME, ENDTIME."""
    c = t["events"].where(F.col("event_type") == SHIFT_EVENT)
    c = c.join(_segments(t), "user_id", "left")
    return c.select(C.UNIT, F.lit(None).cast("bigint").alias(C.HADM_ID),
                    F.col("user_id").alias(C.CGID), F.col("event_type").alias(C.LABEL),
                    F.col("ts").alias(C.START),
                    add_micros("ts", "CAST(round(value * 3600) AS BIGINT) * 1000000L").alias(C.END))


def labs(t: Tables, ordered: DataFrame | None = None) -> DataFrame:
    """LABS-shaped rows with LABEL: one row per (lab event, stay containing it).

    The stays containing a lab are the signups numbered (S_open, S] — those
    since the last purchase — provided a later purchase discharges them.
    The explode emits exactly the output pairs; the join is on a unique key.
    """
    o = ordered if ordered is not None else ordered_events(t)
    lab = o.where((F.col("_kind") == _KIND_LAB) & F.col("NEXT_END").isNotNull()
                  & (F.col("S") > F.col("S_open")))
    lab = lab.select("user_id", "event_id", "ts", "event_type", "value",
                     F.explode(F.sequence(F.col("S_open") + 1, F.col("S"))).alias("_rank"))
    signup_rank = o.where(F.col("_kind") == _KIND_STAY).select(
        "user_id", F.col("S").alias("_rank"), F.col("event_id").alias(C.HADM_ID))
    out = lab.join(signup_rank, ["user_id", "_rank"], "inner")
    return out.select(F.col("user_id").alias(C.SUBJECT_ID), C.HADM_ID,
                      F.col("event_id").alias(C.ITEMID), F.col("ts").alias(C.CHARTTIME),
                      F.col("value").alias(C.VALUENUM), F.col("event_type").alias(C.VALUEUOM),
                      F.col("event_type").alias(C.LABEL))


# --- DuckDB oracle fragments (brute force: correlated minimum, range join) ---

def grid_ctes(grid) -> str:
    return f"""grid AS (
  SELECT TIMESTAMP '{grid.start_sql}' + to_microseconds(i * {grid.block_us}) AS B12
  FROM range({grid.n_blocks}) r(i)),
subs AS (SELECT k FROM range({grid.subs_per_block}) r(k))"""


def oracle_ctes(grid) -> str:
    return f"""
stays AS (
  SELECT s.user_id AS SUBJECT_ID, s.event_id AS HADM_ID, c.c_mktsegment AS CURR_CAREUNIT,
         s.ts AS ADMISSION_DATE,
         (SELECT min(p.ts) FROM events p WHERE p.event_type = 'purchase'
            AND p.user_id = s.user_id AND p.ts > s.ts) AS DISCHARGE_DATE
  FROM events s LEFT JOIN customer c ON c.c_custkey = s.user_id
  WHERE s.event_type = 'signup'),
staff AS (
  SELECT c.c_mktsegment AS CURR_CAREUNIT, CAST(NULL AS BIGINT) AS HADM_ID, e.user_id AS CGID,
         e.event_type AS LABEL, e.ts AS STARTTIME,
         e.ts + to_microseconds(CAST(round(e.value * 3600) AS BIGINT) * 1000000) AS ENDTIME
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
  WHERE e.event_type = 'click'),
labs AS (
  SELECT e.user_id AS SUBJECT_ID, s.HADM_ID, e.event_id AS ITEMID, e.ts AS CHARTTIME,
         e.value AS VALUENUM, e.event_type AS VALUEUOM, e.event_type AS LABEL
  FROM events e JOIN stays s ON s.SUBJECT_ID = e.user_id
   AND e.ts >= s.ADMISSION_DATE AND e.ts < s.DISCHARGE_DATE
  WHERE e.event_type IN ('view', 'error')),
{grid_ctes(grid)}"""


def gappy_oracle_ctes(grid) -> str:
    """The same inputs with values missing, as in ``GappyEventsStudy`` (NaN counts as missing)."""
    ctes = oracle_ctes(grid)
    for name in ("stays", "staff", "labs"):
        ctes = ctes.replace(f"{name} AS (", f"whole_{name} AS (", 1)
    ctes = ctes.replace("JOIN stays s", "JOIN whole_stays s")
    return ctes + """,
stays AS (SELECT * REPLACE (CASE WHEN SUBJECT_ID % 7 <> 0 THEN ADMISSION_DATE END AS ADMISSION_DATE,
                            CASE WHEN HADM_ID % 11 <> 0 THEN CURR_CAREUNIT END AS CURR_CAREUNIT) FROM whole_stays),
staff AS (SELECT * REPLACE (CASE WHEN CGID % 5 <> 0 THEN STARTTIME END AS STARTTIME) FROM whole_staff),
labs AS (SELECT * REPLACE (CASE WHEN ITEMID % 3 <> 0 THEN VALUENUM END AS VALUENUM) FROM whole_labs)"""
