"""Explicit load schemas (DDL) of the driver's test tables.

Reading with a fixed schema avoids inference and keeps types stable across
files; Parquet column pruning still applies.
"""

from __future__ import annotations

TABLE_DDL: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
               "props STRING"),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

TABLES: tuple[str, ...] = tuple(TABLE_DDL)

# Clinical tables of the reference data model (FIXTURES A).
CLINICAL_DDL: dict[str, str] = {
    "TRANSFERS": ("SUBJECT_ID BIGINT, HADM_ID BIGINT, EVENTTYPE STRING, PREV_CAREUNIT STRING, "
                  "CURR_CAREUNIT STRING, INTIME TIMESTAMP_NTZ, OUTTIME TIMESTAMP_NTZ"),
    "CARE_GIVERS": "CGID BIGINT, LABEL STRING, DESCRIPTION STRING",
    "TREATMENT_TEAM": "HADM_ID BIGINT, CGID BIGINT, STARTTIME TIMESTAMP_NTZ, ENDTIME TIMESTAMP_NTZ",
    "LABS": ("SUBJECT_ID BIGINT, HADM_ID BIGINT, ITEMID BIGINT, CHARTTIME TIMESTAMP_NTZ, "
             "VALUENUM DOUBLE, VALUEUOM STRING"),
    "ICD_LABS": "ITEMID BIGINT, LABEL STRING, LOINC_CODE STRING",
    "DIAGNOSES": "SUBJECT_ID BIGINT, HADM_ID BIGINT, SEQ_NUM INT, ICD9_CODE STRING",
    "ICD_DIAGNOSES": "ICD9_CODE STRING, LONG_TITLE STRING",
}


def column_names(ddl: str) -> list[str]:
    """Top-level column names of a simple DDL string."""
    names, depth, cur = [], 0, ""
    for ch in ddl:
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            names.append(cur.strip().split()[0])
            cur = ""
        else:
            cur += ch
    if cur.strip():
        names.append(cur.strip().split()[0])
    return names
