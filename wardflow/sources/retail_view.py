"""Clinical view of the retail tables, for the shape of the O2/O3 SQL.

subject = ``o_custkey``, admission = order, diagnosis code = the line's part
brand (title: the brand's first part name), admit event = order with status
'O' at ``o_orderdate`` in the customer's segment (no unit at the lowest priority), discharge events = lines
with status 'F' at ``l_shipdate``, tests = lines
whose item number the lab dictionary names by return flag,
staff = the line's supplier on shift from ship date for one day.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wardflow import config as C
from wardflow.config import CohortSpec
from wardflow.functions.timegrid import add_micros
from wardflow.sources.tables import Tables

# Fixed values of the retail mapping.
RETAIL_SPEC = CohortSpec(code_prefixes=("Brand#2",), code_equals=("Brand#13",),
                         month_start=datetime(2000, 6, 1), month_end=datetime(2000, 7, 1),
                         required_lab_pattern="R", staff_label_pattern="7")
DAY_US = 86_400_000_000


def _lines(t: Tables) -> DataFrame:
    o = t["orders"].select("o_orderkey", "o_custkey")
    return t["lineitem"].join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def diagnoses(t: Tables) -> DataFrame:
    p = t["part"].select("p_partkey", "p_brand")
    d = _lines(t).join(p, F.col("l_partkey") == F.col("p_partkey"), "inner")
    return d.select(F.col("o_custkey").alias(C.SUBJECT_ID), F.col("l_orderkey").alias(C.HADM_ID),
                    F.col("l_linenumber").alias("SEQ_NUM"), F.col("p_brand").alias(C.ICD9_CODE))


def icd_dictionary(t: Tables) -> DataFrame:
    return t["part"].groupBy(F.col("p_brand").alias(C.ICD9_CODE)).agg(F.min("p_name").alias("LONG_TITLE"))


def transfers(t: Tables) -> DataFrame:
    c = t["customer"].select("c_custkey", "c_mktsegment")
    o = t["orders"].join(c, F.col("c_custkey") == F.col("o_custkey"), "left")
    admits = o.select(F.col("o_custkey").alias(C.SUBJECT_ID), F.col("o_orderkey").alias(C.HADM_ID),
                      F.when(F.col("o_orderstatus") == "O", "admit").otherwise("transfer").alias("EVENTTYPE"),
                      F.expr("if(o_orderpriority LIKE '5%', null, c_mktsegment)").alias(C.UNIT),
                      F.col("o_orderdate").alias("INTIME"))
    ends = _lines(t).where(F.col("l_linestatus") == "F").select(
        F.col("o_custkey").alias(C.SUBJECT_ID), F.col("l_orderkey").alias(C.HADM_ID),
        F.lit("discharge").alias("EVENTTYPE"), F.lit(None).cast("string").alias(C.UNIT),
        F.col("l_shipdate").alias("INTIME"))
    return admits.unionByName(ends)


def labs(t: Tables) -> DataFrame:
    return _lines(t).select(F.col("o_custkey").alias(C.SUBJECT_ID), F.col("l_orderkey").alias(C.HADM_ID),
                            F.expr("cast(ascii(l_returnflag) AS bigint)").alias(C.ITEMID),
                            F.col("l_shipdate").alias(C.CHARTTIME), F.col("l_quantity").alias(C.VALUENUM),
                            F.col("l_linestatus").alias(C.VALUEUOM))


def lab_dictionary(t: Tables) -> DataFrame:
    """Test names by item: the return flag of each item number."""
    return t["lineitem"].select(F.expr("cast(ascii(l_returnflag) AS bigint)").alias(C.ITEMID),
                                F.col("l_returnflag").alias(C.LABEL)).distinct()


def treatment_team(t: Tables) -> DataFrame:
    return t["lineitem"].select(F.col("l_orderkey").alias(C.HADM_ID), F.col("l_suppkey").alias(C.CGID),
                                F.col("l_shipdate").alias(C.START),
                                add_micros("l_shipdate", f"{DAY_US}L").alias(C.END))


def caregivers(t: Tables) -> DataFrame:
    return t["supplier"].select(F.col("s_suppkey").alias(C.CGID), F.col("s_name").alias(C.LABEL),
                                F.lit(None).cast("string").alias("DESCRIPTION"))


# How a time kept as text is spoiled, by the admission: what is no time must come out as NULL.
BAD_TIMES = {0: "", 1: "not a time", 2: "2000-13-45 10:00:00"}
BAD_EVERY = 13


def text_time_sql(time: str, key: str) -> str:
    """SQL (Spark's and DuckDB's) of a time as text; every 13th admission's is spoiled in one of three ways."""
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in BAD_TIMES.items())
    return f"CASE WHEN {key} % {BAD_EVERY} = 0 THEN CASE {key} % {len(BAD_TIMES)} {cases} END ELSE CAST({time} AS {{text}}) END"


def as_text(df: DataFrame, *times: str) -> DataFrame:
    """``df`` (with HADM_ID) as a source that keeps its times as text."""
    return df.withColumns({t: F.expr(text_time_sql(t, C.HADM_ID).format(text="STRING")) for t in times})


# --- DuckDB oracle: the cohort and the staff rows from their definition, with EXISTS and scalar lookups ---

ORACLE_CTES = """
line AS (SELECT *, o_custkey AS subject, ascii(l_returnflag) AS item FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
june AS (
  SELECT o_custkey AS subject, o_orderkey AS adm, date_trunc('second', o_orderdate) AS since,
         CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE
           (SELECT c_mktsegment FROM customer WHERE c_custkey = o_custkey) END AS unit
  FROM orders WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2000-06-01' AND o_orderdate < TIMESTAMP '2000-07-01'),
leave AS (SELECT subject AS SUBJECT_ID, l_orderkey AS HADM_ID, max(l_shipdate) AS DISCHARGE_DATE
          FROM line WHERE l_linestatus = 'F' GROUP BY 1, 2),
with_r AS (SELECT subject AS SUBJECT_ID, l_orderkey AS HADM_ID FROM line WHERE lower(l_returnflag) LIKE '%r%' GROUP BY 1, 2),
cohort AS (
  SELECT j.subject AS SUBJECT_ID, j.adm AS HADM_ID, b.brand AS ICD9_CODE,
         (SELECT min(p_name) FROM part WHERE p_brand = b.brand) AS ICD_DESCRIPTION, j.unit AS CURR_CAREUNIT,
         j.since AS ADMISSION_DATE,
         (SELECT date_trunc('second', max(x.DISCHARGE_DATE)) FROM leave x WHERE x.HADM_ID = j.adm) AS DISCHARGE_DATE
  FROM june j JOIN (
    SELECT DISTINCT l_orderkey AS adm, p_brand AS brand FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE lower(p_brand) LIKE 'brand#2%' OR p_brand = 'Brand#13') b ON b.adm = j.adm
  WHERE EXISTS (SELECT 1 FROM with_r w WHERE w.HADM_ID = j.adm)),
units AS (SELECT DISTINCT o_orderkey AS adm, CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE c_mktsegment END AS unit
          FROM orders LEFT JOIN customer ON c_custkey = o_custkey
          UNION SELECT l_orderkey, NULL FROM line WHERE l_linestatus = 'F'),
staff_rows AS (
  SELECT DISTINCT u.unit AS CURR_CAREUNIT, u.adm AS HADM_ID, l.l_suppkey AS CGID, s.s_name AS LABEL,
    date_trunc('second', l.l_shipdate) AS STARTTIME, date_trunc('second', l.l_shipdate + INTERVAL 1 DAY) AS ENDTIME
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN units u ON u.adm = l.l_orderkey
  WHERE s.s_name LIKE '%7%')"""

# the same rows under the names that the study's stages use
ORACLE_INPUTS = ORACLE_CTES + """,
stays AS (SELECT SUBJECT_ID, HADM_ID, CURR_CAREUNIT, ADMISSION_DATE, DISCHARGE_DATE FROM cohort),
staff AS (SELECT * FROM staff_rows),
labs AS (SELECT subject AS SUBJECT_ID, l_orderkey AS HADM_ID, item AS ITEMID, l_shipdate AS CHARTTIME,
                l_quantity AS VALUENUM, l_linestatus AS VALUEUOM, l_returnflag AS LABEL FROM line)"""


def text_oracle_ctes() -> str:
    """The same definitions over orders and lines whose times are text, parsed with TRY_CAST."""
    def parsed(time: str, key: str) -> str:
        return f"TRY_CAST({text_time_sql(time, key).format(text='VARCHAR')} AS TIMESTAMP) AS {time}"
    ctes = ORACLE_CTES
    for name in ("lineitem", "orders"):
        ctes = re.sub(rf"\b{name}\b", f"text_{name}", ctes)
    # one day more of an unknown time is unknown, and a shift's end is a text of its own
    return (f"text_orders AS (SELECT * REPLACE ({parsed('o_orderdate', 'o_orderkey')}) FROM orders),\n"
            f"text_lineitem AS (SELECT * REPLACE ({parsed('l_shipdate', 'l_orderkey')}) FROM lineitem),{ctes}")
