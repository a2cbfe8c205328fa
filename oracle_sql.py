"""DuckDB oracle SQL for the registered queries (brute force, independent plans).

The oracle deliberately follows the reference's literal recipe — theta joins
against the grid, correlated minima, per-sub-block windows — so it checks the
closed forms used by the Spark plans rather than repeating them.
"""

from __future__ import annotations

from wardflow.config import EVENTS_GRID as G, JUNE_2000
from wardflow.sources import events_view as ev, retail_view as rv

SUB = f"to_microseconds({G.sub_us})"  # sub-blocks of both grids


def _stages(inputs: str, grid, patterns: tuple[str, str]) -> str:
    """Inputs (stays, staff, labs, grid, subs) and the expanded rows and test subset built from them."""
    end = f"TIMESTAMP '{grid.end_sql}'"
    return inputs + f""",
pexp AS (
  SELECT s.SUBJECT_ID, s.HADM_ID, s.CURR_CAREUNIT, g.B12 AS TIME_BLOCK_12HR,
         g.B12 + to_microseconds(k * {grid.sub_us}) AS TIME_BLOCK_4HR, s.ADMISSION_DATE,
         coalesce(s.DISCHARGE_DATE, {end}) AS DISCHARGE_DATE
  FROM stays s JOIN grid g ON s.ADMISSION_DATE <= g.B12 AND g.B12 < coalesce(s.DISCHARGE_DATE, {end})
  CROSS JOIN subs),
nexp AS (
  SELECT n.CGID, n.CURR_CAREUNIT, g.B12 AS TIME_BLOCK_12HR,
         g.B12 + to_microseconds(k * {grid.sub_us}) AS TIME_BLOCK_4HR
  FROM staff n JOIN grid g ON n.STARTTIME <= g.B12 AND g.B12 < coalesce(n.ENDTIME, {end})
  CROSS JOIN subs),
nur AS (
  SELECT CURR_CAREUNIT, TIME_BLOCK_12HR, TIME_BLOCK_4HR, count(*) AS nn FROM nexp
  WHERE CURR_CAREUNIT IS NOT NULL GROUP BY ALL),
labsub AS (
  SELECT l.SUBJECT_ID, l.HADM_ID, l.ITEMID, l.CHARTTIME, l.VALUENUM, l.VALUEUOM, l.LABEL,
         s.ADMISSION_DATE, s.DISCHARGE_DATE
  FROM labs l JOIN stays s ON l.SUBJECT_ID = s.SUBJECT_ID AND l.HADM_ID = s.HADM_ID
  WHERE (l.LABEL ILIKE '%{patterns[0]}%' OR l.LABEL ILIKE '%{patterns[1]}%')
    AND l.CHARTTIME >= s.ADMISSION_DATE AND l.CHARTTIME < s.DISCHARGE_DATE)"""


CTES = _stages(ev.oracle_ctes(G), G, ("view", "error"))
GAPPY = _stages(ev.gappy_oracle_ctes(G), G, ("view", "error"))
RETAIL = _stages(f"{rv.ORACLE_INPUTS},\n{ev.grid_ctes(JUNE_2000)}", JUNE_2000, ("R", "A"))


def _with(body: str) -> str:
    return f"WITH {CTES}\n{body}"


def _summary(tag: str, num_cte: str, num: str, num_prefix: str, ratio_prefix: str, avg: str,
             ratio_expr: str, zero_as_one: bool) -> str:
    np_expr = f"CASE WHEN coalesce(x.{num}, 0) = 0 THEN 1 ELSE x.{num} END" if zero_as_one \
        else f"coalesce(x.{num}, 0)"
    return f""",
{tag}_num AS ({num_cte}),
{tag}_m AS (
  SELECT coalesce(x.CURR_CAREUNIT, n.CURR_CAREUNIT) AS u,
         coalesce(x.TIME_BLOCK_12HR, n.TIME_BLOCK_12HR) AS b12,
         coalesce(x.TIME_BLOCK_4HR, n.TIME_BLOCK_4HR) AS b4,
         {np_expr} AS cnt, coalesce(n.nn, 0) AS nn
  FROM {tag}_num x FULL JOIN nur n ON x.CURR_CAREUNIT = n.CURR_CAREUNIT
   AND x.TIME_BLOCK_12HR = n.TIME_BLOCK_12HR AND x.TIME_BLOCK_4HR = n.TIME_BLOCK_4HR),
{tag}_r AS (SELECT *, {ratio_expr} AS ratio FROM {tag}_m),
{tag}_r2 AS (SELECT *, CASE WHEN avg(ratio) OVER (PARTITION BY u) = 0 THEN NULL
                      ELSE ratio / avg(ratio) OVER (PARTITION BY u) END AS norm,
              row_number() OVER (PARTITION BY u, b12 ORDER BY b4) AS pos FROM {tag}_r),
{tag}_s AS (
  SELECT u AS CURR_CAREUNIT, b12 AS TIME_BLOCK_12HR, count(*) AS present,
    CAST(coalesce(max(CASE WHEN pos = 1 THEN cnt END), 0) AS BIGINT) AS {num_prefix}_1,
    CAST(coalesce(max(CASE WHEN pos = 2 THEN cnt END), 0) AS BIGINT) AS {num_prefix}_2,
    CAST(coalesce(max(CASE WHEN pos = 3 THEN cnt END), 0) AS BIGINT) AS {num_prefix}_3,
    CAST(coalesce(max(CASE WHEN pos = 1 THEN nn END), 0) AS BIGINT) AS NURSES_4HR_1,
    CAST(coalesce(max(CASE WHEN pos = 2 THEN nn END), 0) AS BIGINT) AS NURSES_4HR_2,
    CAST(coalesce(max(CASE WHEN pos = 3 THEN nn END), 0) AS BIGINT) AS NURSES_4HR_3,
    coalesce(max(CASE WHEN pos = 1 THEN ratio END), 0.0) AS {ratio_prefix}_1,
    coalesce(max(CASE WHEN pos = 2 THEN ratio END), 0.0) AS {ratio_prefix}_2,
    coalesce(max(CASE WHEN pos = 3 THEN ratio END), 0.0) AS {ratio_prefix}_3,
    CASE WHEN count(*) >= 1 THEN max(CASE WHEN pos = 1 THEN norm END) ELSE 0.0 END AS UNIT_NORM_RATIO_4HR_1,
    CASE WHEN count(*) >= 2 THEN max(CASE WHEN pos = 2 THEN norm END) ELSE 0.0 END AS UNIT_NORM_RATIO_4HR_2,
    CASE WHEN count(*) >= 3 THEN max(CASE WHEN pos = 3 THEN norm END) ELSE 0.0 END AS UNIT_NORM_RATIO_4HR_3
  FROM {tag}_r2 GROUP BY u, b12),
{tag} AS (SELECT * EXCLUDE (present),
  ({ratio_prefix}_1 + {ratio_prefix}_2 + {ratio_prefix}_3) / 3.0 AS {avg},
  (coalesce(UNIT_NORM_RATIO_4HR_1, 0) + coalesce(UNIT_NORM_RATIO_4HR_2, 0) + coalesce(UNIT_NORM_RATIO_4HR_3, 0))
   / NULLIF((UNIT_NORM_RATIO_4HR_1 IS NOT NULL)::INT + (UNIT_NORM_RATIO_4HR_2 IS NOT NULL)::INT
            + (UNIT_NORM_RATIO_4HR_3 IS NOT NULL)::INT, 0) AS AVG_UNIT_NORM_RATIO
FROM {tag}_s)"""


def _o5_ctes() -> str:
    num = """SELECT CURR_CAREUNIT, TIME_BLOCK_12HR, TIME_BLOCK_4HR, count(*) AS nd FROM (
    SELECT *, min(CASE WHEN TIME_BLOCK_4HR >= DISCHARGE_DATE THEN TIME_BLOCK_4HR END)
      OVER (PARTITION BY SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR) AS dtb FROM pexp) q
    WHERE TIME_BLOCK_4HR = dtb AND CURR_CAREUNIT IS NOT NULL GROUP BY ALL"""
    return _summary("o5", num, "nd", "DISCHARGE_4HR", "DISCHARGE_NURSE_RATIO_4HR",
                          "AVG_DISCHARGE_TO_NURSE_RATIO",
                          "CASE WHEN nn = 0 THEN 0.0 ELSE cnt::DOUBLE / nn END", False)


def _o6_ctes() -> str:
    num = """SELECT CURR_CAREUNIT, TIME_BLOCK_12HR, TIME_BLOCK_4HR, count(*) AS np FROM pexp
    WHERE TIME_BLOCK_4HR >= ADMISSION_DATE AND TIME_BLOCK_4HR < DISCHARGE_DATE
      AND CURR_CAREUNIT IS NOT NULL GROUP BY ALL"""
    return _summary("o6", num, "np", "PATIENTS_4HR", "NURSE_TO_PATIENT_RATIO_4HR",
                          "AVG_NURSE_TO_PATIENT_RATIO", "nn::DOUBLE / cnt", True)


def _latest_cte(prefix: str, label: str) -> str:
    return f"""
t_{prefix} AS (SELECT * FROM labsub WHERE regexp_matches(LABEL, '{label}', 'i')),
j_{prefix} AS (
  SELECT p.SUBJECT_ID, p.HADM_ID, p.TIME_BLOCK_4HR, t.CHARTTIME, t.ITEMID, t.VALUENUM, t.VALUEUOM
  FROM (SELECT DISTINCT SUBJECT_ID, HADM_ID, TIME_BLOCK_4HR FROM pexp) p
  JOIN t_{prefix} t ON p.SUBJECT_ID = t.SUBJECT_ID AND p.HADM_ID = t.HADM_ID
   AND t.CHARTTIME >= p.TIME_BLOCK_4HR AND t.CHARTTIME < p.TIME_BLOCK_4HR + {SUB}),
l4_{prefix} AS (
  SELECT SUBJECT_ID, HADM_ID, TIME_BLOCK_4HR,
    arg_max(VALUENUM, (CHARTTIME, ITEMID, VALUENUM)) FILTER (WHERE VALUENUM IS NOT NULL) AS v,
    arg_max(VALUEUOM, (CHARTTIME, ITEMID, coalesce(VALUENUM, -1e308), VALUEUOM)) FILTER (WHERE VALUEUOM IS NOT NULL) AS un
  FROM j_{prefix} GROUP BY ALL),
ff_{prefix} AS (
  SELECT p.SUBJECT_ID, p.HADM_ID, p.TIME_BLOCK_12HR, p.TIME_BLOCK_4HR, p.ADMISSION_DATE,
    last_value(l.v IGNORE NULLS) OVER w AS fv, last_value(l.un IGNORE NULLS) OVER w AS fu
  FROM (SELECT DISTINCT SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR, TIME_BLOCK_4HR, ADMISSION_DATE FROM pexp) p
  LEFT JOIN l4_{prefix} l ON p.SUBJECT_ID = l.SUBJECT_ID AND p.HADM_ID = l.HADM_ID
   AND p.TIME_BLOCK_4HR = l.TIME_BLOCK_4HR
  WINDOW w AS (PARTITION BY p.SUBJECT_ID, p.HADM_ID ORDER BY p.TIME_BLOCK_4HR
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o8_{prefix} AS (
  SELECT SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR, max(ADMISSION_DATE) AS ADMISSION_DATE,
    arg_max(fv, TIME_BLOCK_4HR) FILTER (WHERE fv IS NOT NULL) AS {prefix}_VAL,
    arg_max(fu, TIME_BLOCK_4HR) FILTER (WHERE fu IS NOT NULL) AS {prefix}_UNIT
  FROM ff_{prefix} GROUP BY ALL),
o9_{prefix} AS (
  SELECT SUBJECT_ID, {prefix}_VAL, {prefix}_UNIT FROM (
    SELECT *, row_number() OVER (PARTITION BY SUBJECT_ID
      ORDER BY ADMISSION_DATE DESC, HADM_ID DESC, TIME_BLOCK_12HR DESC) AS rn FROM o8_{prefix}) q
  WHERE rn = 1)"""


LATEST = _latest_cte("VIEW", "view") + "," + _latest_cte("ERROR", "error")
RATIOS = _o5_ctes() + _o6_ctes()


def _with_latest(body: str) -> str:
    return f"WITH {CTES},{LATEST}\n{body}"


def _with_all(body: str) -> str:
    return f"WITH {CTES},{LATEST}{RATIOS}\n{body}"


def _obs(p1: str, p2: str) -> str:
    return f"""
obs AS (
  SELECT b.SUBJECT_ID, b.HADM_ID, b.CURR_CAREUNIT, b.TIME_BLOCK_12HR,
    d.AVG_DISCHARGE_TO_NURSE_RATIO, d.AVG_UNIT_NORM_RATIO AS DISCHARGE_UNIT_NORM_RATIO,
    p.AVG_NURSE_TO_PATIENT_RATIO, p.AVG_UNIT_NORM_RATIO AS PATIENT_UNIT_NORM_RATIO,
    v.{p1}_VAL, v.{p1}_UNIT, e.{p2}_VAL, e.{p2}_UNIT
  FROM (SELECT DISTINCT SUBJECT_ID, HADM_ID, CURR_CAREUNIT, TIME_BLOCK_12HR FROM pexp) b
  LEFT JOIN o5 d ON b.CURR_CAREUNIT = d.CURR_CAREUNIT AND b.TIME_BLOCK_12HR = d.TIME_BLOCK_12HR
  LEFT JOIN o6 p ON b.CURR_CAREUNIT = p.CURR_CAREUNIT AND b.TIME_BLOCK_12HR = p.TIME_BLOCK_12HR
  LEFT JOIN o8_{p1} v ON b.SUBJECT_ID = v.SUBJECT_ID AND b.HADM_ID = v.HADM_ID
   AND b.TIME_BLOCK_12HR = v.TIME_BLOCK_12HR
  LEFT JOIN o8_{p2} e ON b.SUBJECT_ID = e.SUBJECT_ID AND b.HADM_ID = e.HADM_ID
   AND b.TIME_BLOCK_12HR = e.TIME_BLOCK_12HR)"""


OBS = _obs("VIEW", "ERROR")

LAST_UNIT = """,
last_unit AS (
  SELECT l.SUBJECT_ID, l.HADM_ID, l.CURR_CAREUNIT, l.TIME_BLOCK_12HR,
         v.VIEW_VAL, v.VIEW_UNIT, e.ERROR_VAL, e.ERROR_UNIT
  FROM (SELECT SUBJECT_ID, HADM_ID, arg_max(CURR_CAREUNIT, TIME_BLOCK_12HR) AS CURR_CAREUNIT,
               max(TIME_BLOCK_12HR) AS TIME_BLOCK_12HR FROM pexp GROUP BY ALL) l
  LEFT JOIN o9_VIEW v ON l.SUBJECT_ID = v.SUBJECT_ID
  LEFT JOIN o9_ERROR e ON l.SUBJECT_ID = e.SUBJECT_ID)"""


def _profile_nulls() -> str:
    from wardflow.sources.schemas import TABLE_DDL, column_names
    parts = []
    for t, ddl in TABLE_DDL.items():
        for c, typ in zip(column_names(ddl), [x.strip().split()[1] for x in _split(ddl)]):
            miss = f"{c} IS NULL OR isnan({c})" if typ in ("DOUBLE", "FLOAT") else f"{c} IS NULL"
            parts.append(f"SELECT '{t}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, "
                         f"CAST(count(*) FILTER (WHERE {miss}) AS BIGINT) AS NULL_COUNT FROM {t}")
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) q WHERE NULL_COUNT > 0"


def _split(ddl: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in ddl:
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return out + [cur]


def _profile_duplicates() -> str:
    from wardflow.plans.profiling import FOREIGN_KEYS, KEYS
    from wardflow.sources.schemas import TABLES
    refs = {t: ", ".join(f"{c} -> {p}.{pc}" for ch, c, p, pc in FOREIGN_KEYS if ch == t) or "None" for t in TABLES}
    parts = [f"SELECT '{t}' AS TABLE_NAME, CAST(count(*) AS BIGINT) AS ROW_COUNT, "
             f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS BIGINT) AS DUPLICATE_ROWS, "
             f"'{','.join(KEYS[t]) if t in KEYS else 'None'}' AS PRIMARY_KEYS, '{refs[t]}' AS FOREIGN_KEYS FROM {t}"
             for t in TABLES]
    return "\nUNION ALL\n".join(parts)


def _key_uniqueness() -> str:
    from wardflow.plans.profiling import KEYS
    parts = []
    for t, k in KEYS.items():
        ks = ", ".join(k)
        nul = " OR ".join(f"{c} IS NULL" for c in k)
        parts.append(f"SELECT '{t}' AS TABLE_NAME, '{','.join(k)}' AS KEY_COLUMNS, "
                     f"CAST(coalesce(sum(n), 0) AS BIGINT) AS ROW_COUNT, CAST(count(*) AS BIGINT) AS DISTINCT_KEYS, "
                     f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS DUPLICATED_KEYS, "
                     f"CAST(coalesce(sum(n) FILTER (WHERE {nul}), 0) AS BIGINT) AS NULL_KEY_ROWS "
                     f"FROM (SELECT {ks}, count(*) AS n FROM {t} GROUP BY {ks}) q")
    return "\nUNION ALL\n".join(parts)


def _orphan_keys() -> str:
    from wardflow.plans.profiling import FOREIGN_KEYS
    parts = [f"SELECT '{c}' AS CHILD_TABLE, '{cc}' AS CHILD_COLUMN, '{p}' AS PARENT_TABLE, "
             f"'{pc}' AS PARENT_COLUMN, CAST(count(*) AS BIGINT) AS CHILD_ROWS, "
             f"CAST(count(*) FILTER (WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {p} "
             f"WHERE {pc} IS NOT NULL)) AS BIGINT) AS ORPHAN_ROWS FROM {c}"
             for c, cc, p, pc in FOREIGN_KEYS]
    return "\nUNION ALL\n".join(parts)


def _columns() -> list[tuple[str, str, str]]:
    """(table, column, class of its type) of every column."""
    from wardflow.sources.schemas import TABLE_DDL, column_names
    kinds = {"INT": "integer", "BIGINT": "integer", "STRING": "text", "TIMESTAMP_NTZ": "time", "DOUBLE": "real"}
    return [(t, c, kinds.get(typ, typ)) for t, ddl in TABLE_DDL.items()
            for c, typ in zip(column_names(ddl), [x.strip().split()[1] for x in _split(ddl)])]


def _known(c: str, kind: str) -> str:
    return f"CASE WHEN NOT isnan({c}) THEN {c} END" if kind == "real" else c


def _discovered_keys() -> str:
    """Distinct counts of every column, and of every pair of a table without a key column."""
    parts = []
    for t in dict.fromkeys(t for t, _, _ in _columns()):
        cols = [(c, _known(c, k)) for x, c, k in _columns() if x == t]
        for c, v in cols:
            parts.append(f"SELECT '{t}' AS TABLE_NAME, '{c}' AS KEY_COLUMNS, 1 AS size, count(*) AS ROW_COUNT, "
                         f"count(DISTINCT {v}) AS d FROM {t}")
        for i, (a, va) in enumerate(cols):
            for b, vb in cols[i + 1:]:
                parts.append(f"SELECT '{t}', '{a},{b}', 2, count(*), (SELECT count(*) FROM (SELECT DISTINCT {va} AS x, {vb} AS y FROM {t}) p "
                             f"WHERE x IS NOT NULL AND y IS NOT NULL) FROM {t}")
    return ("WITH c AS (" + " UNION ALL ".join(parts) + ") SELECT TABLE_NAME, KEY_COLUMNS, CAST(ROW_COUNT AS BIGINT) AS ROW_COUNT "
            "FROM c WHERE ROW_COUNT > 0 AND d = ROW_COUNT AND (size = 1 OR TABLE_NAME NOT IN ("
            "SELECT TABLE_NAME FROM c WHERE size = 1 AND ROW_COUNT > 0 AND d = ROW_COUNT))")


def _discovered_references() -> str:
    """Per class of types: every value with every column that holds it, joined on the value."""
    text, parts = {"real": "CAST(CAST({0} AS DOUBLE) AS VARCHAR)"}, []
    for t, c, k in _columns():
        if k in ("integer", "text", "time", "real"):
            v = _known(c, k)
            parts.append(f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, '{c.split('_', 1)[-1]}' AS stem, '{k}' AS kind, "
                         f"{text.get(k, 'CAST({0} AS VARCHAR)').format(v)} AS v, (SELECT count(*) FROM {t}) AS size FROM {t} WHERE {v} IS NOT NULL")
    return ("WITH cells AS (" + " UNION ALL ".join(parts) + "), "
            "cols AS (SELECT t, c, stem, kind, size, count(*) AS d FROM cells GROUP BY ALL), "
            "met AS (SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, count(*) AS n FROM cells a JOIN cells b "
            "ON a.kind = b.kind AND a.v = b.v AND NOT (a.t = b.t AND a.c = b.c) "
            "JOIN cols p ON p.t = b.t AND p.c = b.c AND p.d = p.size GROUP BY ALL) "
            "SELECT ct AS CHILD_TABLE, cc AS CHILD_COLUMN, pt AS PARENT_TABLE, pc AS PARENT_COLUMN, CAST(n AS BIGINT) AS N_VALUES, "
            "CAST(p.d AS BIGINT) AS PARENT_VALUES, x.stem = p.stem AS SAME_NAME FROM met "
            "JOIN cols x ON x.t = ct AND x.c = cc AND x.d = n JOIN cols p ON p.t = pt AND p.c = pc")


def _catalog_report() -> str:
    names = {}
    for t, c, _ in _columns():
        names.setdefault(t, []).append(c)
    return " UNION ALL ".join(f"SELECT '{t}' AS TABLE_NAME, '{','.join(cs)}' AS COLUMNS, CAST(count(*) AS BIGINT) AS ROW_COUNT FROM {t}"
                              for t, cs in names.items())


def _text_times(body: str) -> str:
    ctes = rv.text_oracle_ctes() + rv.ORACLE_INPUTS[len(rv.ORACLE_CTES):]
    return f"WITH {_stages(ctes + ',' + ev.grid_ctes(JUNE_2000), JUNE_2000, ('R', 'A'))}\n{body}"


def _clean(src: str, keys: list[str], y: str) -> str:
    cond = " AND ".join([f"{k} IS NOT NULL" for k in keys] + [f"{y} IS NOT NULL", f"NOT isnan({y})"])
    ks = "".join(f"{k}, " for k in keys)
    return f"SELECT {ks}CAST({y} AS DOUBLE) AS y FROM {src} WHERE {cond}"


def _scatter(src: str, keys: list[str], y: str) -> str:
    return f"SELECT * RENAME (y AS Y) FROM ({_clean(src, keys, y)}) q"


def _stats(src: str, keys: list[str], y: str) -> str:
    ks = ", ".join(keys)
    return (f"SELECT {ks}, avg(y) AS MEAN, count(y) AS N, stddev_samp(y) AS STDDEV "
            f"FROM ({_clean(src, keys, y)}) d GROUP BY {ks}")


def _box(src: str, keys: list[str], y: str) -> str:
    ks = ", ".join(keys)
    inside = "y >= Q1 - 1.5 * (Q3 - Q1) AND y <= Q3 + 1.5 * (Q3 - Q1)"
    return f"""SELECT {ks}, Q1, MEDIAN, Q3, min(y) FILTER (WHERE {inside}) AS WHISKER_LOW,
  max(y) FILTER (WHERE {inside}) AS WHISKER_HIGH, count(*) FILTER (WHERE NOT ({inside})) AS OUTLIERS,
  count(*) AS N
FROM ({_clean(src, keys, y)}) d JOIN (
  SELECT {ks}, quantile_cont(y, 0.25) AS Q1, quantile_cont(y, 0.5) AS MEDIAN, quantile_cont(y, 0.75) AS Q3
  FROM ({_clean(src, keys, y)}) d0 GROUP BY {ks}) q USING ({ks})
GROUP BY {ks}, Q1, MEDIAN, Q3"""


def _hist(src: str, keys: list[str], y: str, bins: int) -> str:
    ks = "".join(f"{k}, " for k in keys)
    gb = f"GROUP BY {', '.join(keys)}" if keys else ""
    using = f"USING ({', '.join(keys)})" if keys else "ON TRUE"
    return f"""SELECT {"".join(f"st.{k}, " for k in keys)}CAST(b.i AS INTEGER) AS BIN,
  lo + b.i * ((hi - lo) / {float(bins)}) AS BIN_START, lo + (b.i + 1) * ((hi - lo) / {float(bins)}) AS BIN_END,
  CAST(coalesce(c.n, 0) AS BIGINT) AS COUNT
FROM (SELECT {ks}CASE WHEN min(y) = max(y) THEN min(y) - 0.5 ELSE min(y) END AS lo,
             CASE WHEN min(y) = max(y) THEN max(y) + 0.5 ELSE max(y) END AS hi
      FROM ({_clean(src, keys, y)}) d {gb}) st
CROSS JOIN range({bins}) b(i)
LEFT JOIN (
  SELECT {"".join(f"d.{k}, " for k in keys)}LEAST(CAST(floor((y - lo) / ((hi - lo) / {float(bins)})) AS INTEGER), {bins - 1}) AS BIN,
         count(*) AS n
  FROM ({_clean(src, keys, y)}) d JOIN (
    SELECT {ks}CASE WHEN min(y) = max(y) THEN min(y) - 0.5 ELSE min(y) END AS lo,
           CASE WHEN min(y) = max(y) THEN max(y) + 0.5 ELSE max(y) END AS hi
    FROM ({_clean(src, keys, y)}) d1 {gb}) s2 {using}
  GROUP BY ALL) c ON c.BIN = b.i {"".join(f" AND c.{k} = st.{k}" for k in keys)}"""


def _density(src: str, y: str, gridsize: int = 200, cut: float = 3.0, by: str = "") -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    d = f"({_clean(src, [by] if by else [], y)})"
    join = f"USING ({by})" if by else "ON TRUE"
    return f"""SELECT {key}CAST(p.i AS INTEGER) AS POINT, a + p.i * step AS X,
  sum(exp(-0.5 * ((a + p.i * step - y) / bw) * ((a + p.i * step - y) / bw))) * ({1.0 / (2 * 3.141592653589793) ** 0.5!r} / (n * bw)) AS DENSITY
FROM {d} d JOIN
  (SELECT *, lo - {cut} * bw AS a, (hi - lo + {2 * cut} * bw) / {float(gridsize - 1)} AS step FROM (
     SELECT *, pow(CAST(n AS DOUBLE), -0.2) * sd AS bw FROM (
       SELECT {key}min(y) AS lo, max(y) AS hi, count(*) AS n, stddev_samp(y) AS sd
       FROM {d} d0 {group}) s0 WHERE n > 1 AND sd > 0) s1) st {join}, range({gridsize}) p(i)
GROUP BY {key}p.i, a, step, n, bw"""


def _retail(body: str) -> str:
    return f"WITH {rv.ORACLE_CTES}\n{body}"


def _retail_latest(body: str) -> str:
    return f"WITH {RETAIL},{_latest_cte('RETURNED', 'R')},{_latest_cte('ACCEPTED', 'A')}{RATIOS},{_obs('RETURNED', 'ACCEPTED')}\n{body}"


def _gappy(body: str) -> str:
    return f"WITH {GAPPY},{LATEST}{RATIOS},{OBS}\n{body}"


def _gappy_nulls() -> str:
    inputs = {"stays": "SUBJECT_ID HADM_ID CURR_CAREUNIT ADMISSION_DATE DISCHARGE_DATE",
              "staff": "CURR_CAREUNIT CGID LABEL STARTTIME ENDTIME",
              "labs": "SUBJECT_ID HADM_ID ITEMID CHARTTIME VALUENUM VALUEUOM LABEL"}
    parts = [f"SELECT '{t}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, count(*) - count({c}) AS NULL_COUNT FROM {t}"
             for t, cols in inputs.items() for c in cols.split()]
    return f"WITH {GAPPY}\nSELECT * FROM ({' UNION ALL '.join(parts)}) q WHERE NULL_COUNT > 0"


def _run_counts(cohort: str, staff: str, p1: str, p2: str, extra: str = "") -> str:
    """Rows of every stage of a run, in its order; ``extra`` is a column over STAGE."""
    stages = {"cohort": cohort, "staff_assignments": staff, "expanded_patients": "pexp", "expanded_nurses": "nexp",
              "discharge_ratio": "o5", "patient_ratio": "o6", "labs_subset": "labsub",
              **{f"lab_results_{p.lower()}": f"o8_{p}" for p in (p1, p2)},
              **{f"latest_{p.lower()}": f"o9_{p}" for p in (p1, p2)}, "observations": "obs"}
    body = " UNION ALL ".join(f"SELECT '{n}' AS STAGE, CAST(count(*) AS BIGINT) AS ROW_COUNT FROM {t}" for n, t in stages.items())
    return f"SELECT *{extra} FROM ({body}) q"


# the stages that a stopped run leaves complete: the first five in the run's order
_FIRST_FIVE = "('cohort', 'staff_assignments', 'expanded_patients', 'expanded_nurses', 'discharge_ratio')"


U, B = "CURR_CAREUNIT", "TIME_BLOCK_12HR"
SQL: dict[str, str] = {
    "chart_scatter": _with(_o5_ctes() + "\n" + _scatter("o5", [B, U], "AVG_DISCHARGE_TO_NURSE_RATIO")),
    "chart_scatter_sample": _with_all("," + OBS + """
SELECT TIME_BLOCK_12HR, CURR_CAREUNIT, AVG_NURSE_TO_PATIENT_RATIO AS Y FROM (
  SELECT *, row_number() OVER (PARTITION BY CURR_CAREUNIT ORDER BY md5(CAST(SUBJECT_ID AS VARCHAR) || '|' || CAST(HADM_ID AS VARCHAR)
      || '|' || CAST(TIME_BLOCK_12HR AS VARCHAR))) AS rn
  FROM obs WHERE CURR_CAREUNIT IS NOT NULL AND AVG_NURSE_TO_PATIENT_RATIO IS NOT NULL) q WHERE rn <= 40"""),
    "slice_deep": _with_all("," + OBS + """
SELECT * EXCLUDE (rn, n) FROM (
  SELECT *, row_number() OVER (ORDER BY SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR, CURR_CAREUNIT) - 1 AS rn, count(*) OVER () AS n FROM obs) q
WHERE rn >= floor(0.9 * n) AND rn < floor(0.9 * n) + 100"""),
    "chart_box": _with(_o6_ctes() + "\n" + _box("o6", [U], "AVG_NURSE_TO_PATIENT_RATIO")),
    "chart_bar": _with_latest(LAST_UNIT + "\n" + _stats("last_unit", [U], "VIEW_VAL")),
    "chart_line": _with_all("," + OBS + "\n" + _stats("obs", [B, U], "VIEW_VAL")),
    "chart_hist": _with_latest("\n" + _hist("o9_VIEW", [], "VIEW_VAL", 50)),
    "chart_density": _with_latest("\n" + _density("o9_VIEW", "VIEW_VAL")),
    "chart_facet_scatter": _with(_o6_ctes() + "\n" + _scatter("o6", [U, B], "AVG_NURSE_TO_PATIENT_RATIO")),
    "chart_facet_line": _with_all("," + OBS + "\n" + _stats("obs", [U, B], "ERROR_VAL")),
    "chart_facet_box": _with_all("," + OBS + "\n" + _box("obs", [U, B], "VIEW_VAL")),
    "chart_facet_hist": _with_all("," + OBS + "\n" + _hist("obs", [U], "VIEW_VAL", 30)),
    "chart_facet_density": _with_all("," + OBS + "\n" + _density("obs", "VIEW_VAL", by=U)),
    "retail_observations": _retail_latest("SELECT * FROM obs"),
    "retail_event_staff_ratio": _retail_latest("SELECT * FROM o5"),
    "retail_staff_subject_ratio": _retail_latest("SELECT * FROM o6"),
    "retail_labs_subset": _retail_latest("SELECT * FROM labsub"),
    "gappy_observations": _gappy("SELECT * FROM obs"),
    "gappy_null_report": _gappy_nulls(),
    "profile_nulls": _profile_nulls(),
    "profile_duplicates": _profile_duplicates(),
    "key_uniqueness": _key_uniqueness(),
    "orphan_keys": _orphan_keys(),
    "discovered_keys": _discovered_keys(),
    "discovered_references": _discovered_references(),
    "incremental_nulls": _profile_nulls(),
    "incremental_duplicates": f"SELECT TABLE_NAME, ROW_COUNT, DUPLICATE_ROWS FROM ({_profile_duplicates()}) q",
    "catalog_report": _catalog_report(),
    "text_times_cohort": _text_times("SELECT * FROM cohort"),
    "text_times_staff": _text_times("SELECT * FROM staff_rows"),
    "text_times_labs": _text_times("SELECT * FROM labsub"),
    "cohort_select": _retail("SELECT * FROM cohort"),
    "latest_end_per_stay": _retail("SELECT * FROM leave"),
    "required_lab_semi": _retail("SELECT * FROM with_r"),
    "cohort_subject_count": _retail(
        "SELECT CAST(count(DISTINCT SUBJECT_ID) + coalesce(max(CASE WHEN SUBJECT_ID IS NULL THEN 1 ELSE 0 END), 0) "
        "AS BIGINT) AS N_SUBJECTS FROM cohort"),
    "staff_assignments": _retail("SELECT * FROM staff_rows"),
    "event_stays": _with("SELECT * FROM stays"),
    "expand_stays": _with("SELECT * FROM pexp"),
    "expand_staff": _with("SELECT * FROM nexp"),
    "event_staff_ratio": _with(_o5_ctes() + "\nSELECT * FROM o5"),
    "staff_subject_ratio": _with(_o6_ctes() + "\nSELECT * FROM o6"),
    "labs_subset": _with("SELECT * FROM labsub"),
    "csv_roundtrip": _with(_o5_ctes() + "\nSELECT * FROM o5"),
    "cohort_run_metrics": _with_all("," + OBS + "\n" + _run_counts("stays", "staff", "VIEW", "ERROR")),
    "retail_run_metrics": _retail_latest(_run_counts("cohort", "staff_rows", "RETURNED", "ACCEPTED")),
    "resumed_run_metrics": _retail_latest(_run_counts("cohort", "staff_rows", "RETURNED", "ACCEPTED",
                                                      f", STAGE IN {_FIRST_FIVE} AS RESUMED")),
    "stage_metrics": _with_all("," + OBS + "\n" + _run_counts("stays", "staff", "VIEW", "ERROR")),
    "latest_lab_view": _with_latest(
        "SELECT SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR, VIEW_VAL, VIEW_UNIT FROM o8_VIEW"),
    "latest_lab_error": _with_latest(
        "SELECT SUBJECT_ID, HADM_ID, TIME_BLOCK_12HR, ERROR_VAL, ERROR_UNIT FROM o8_ERROR"),
    "latest_per_subject_view": _with_latest("SELECT * FROM o9_VIEW"),
    "latest_per_subject_error": _with_latest("SELECT * FROM o9_ERROR"),
    "staff_block_counts": _with(
        "SELECT CURR_CAREUNIT, TIME_BLOCK_12HR, count(CGID) AS NURSE_COUNT FROM nexp "
        "WHERE CURR_CAREUNIT IS NOT NULL GROUP BY ALL"),
    "observations": _with_all("," + OBS + "\nSELECT * FROM obs"),
    "last_unit_labs": _with_latest(LAST_UNIT + "\nSELECT * FROM last_unit"),
    "tested_counts_by_unit": _with_latest(
        LAST_UNIT + "\nSELECT CURR_CAREUNIT, count(SUBJECT_ID) AS PATIENT_COUNT, "
        "count(VIEW_VAL) AS View_Count, count(ERROR_VAL) AS Error_Count FROM last_unit "
        "WHERE CURR_CAREUNIT IS NOT NULL GROUP BY ALL"),
    "subject_lookup": _with_latest(LAST_UNIT + "\nSELECT * FROM last_unit WHERE SUBJECT_ID = 42"),
    "unit_labels": _with_latest(
        "SELECT VIEW_UNIT AS UNIT_LABEL, count(*) AS N_SUBJECTS, count(VIEW_VAL) AS N_VALUES FROM o9_VIEW GROUP BY ALL"),
    "head_rows": _with_all("," + OBS + "\nSELECT * FROM obs ORDER BY SUBJECT_ID, HADM_ID, "
                           "TIME_BLOCK_12HR LIMIT 5"),
    "slice_rows": _with(_o5_ctes() + "\nSELECT * FROM o5 ORDER BY CURR_CAREUNIT, TIME_BLOCK_12HR "
                        "LIMIT 6 OFFSET 10"),
    "subject_block_counts": _with(
        "SELECT CURR_CAREUNIT, TIME_BLOCK_12HR, count(SUBJECT_ID) AS SUBJECT_COUNT FROM pexp "
        "WHERE CURR_CAREUNIT IS NOT NULL GROUP BY ALL"),
}

_RATIO5 = ("DISCHARGE_NURSE_RATIO_4HR_1", "DISCHARGE_NURSE_RATIO_4HR_2", "DISCHARGE_NURSE_RATIO_4HR_3",
           "UNIT_NORM_RATIO_4HR_1", "UNIT_NORM_RATIO_4HR_2", "UNIT_NORM_RATIO_4HR_3",
           "AVG_DISCHARGE_TO_NURSE_RATIO", "AVG_UNIT_NORM_RATIO")
_RATIO6 = ("NURSE_TO_PATIENT_RATIO_4HR_1", "NURSE_TO_PATIENT_RATIO_4HR_2", "NURSE_TO_PATIENT_RATIO_4HR_3",
           "UNIT_NORM_RATIO_4HR_1", "UNIT_NORM_RATIO_4HR_2", "UNIT_NORM_RATIO_4HR_3",
           "AVG_NURSE_TO_PATIENT_RATIO", "AVG_UNIT_NORM_RATIO")

_OBS = ("AVG_DISCHARGE_TO_NURSE_RATIO", "DISCHARGE_UNIT_NORM_RATIO", "AVG_NURSE_TO_PATIENT_RATIO",
        "PATIENT_UNIT_NORM_RATIO", "VIEW_VAL", "ERROR_VAL")

# Double columns per query: both sides round them to 6 places before hashing.
DOUBLES: dict[str, tuple[str, ...]] = {
    "labs_subset": ("VALUENUM",),
    "event_staff_ratio": _RATIO5,
    "staff_subject_ratio": _RATIO6,
    "latest_lab_view": ("VIEW_VAL",),
    "latest_lab_error": ("ERROR_VAL",),
    "latest_per_subject_view": ("VIEW_VAL",),
    "latest_per_subject_error": ("ERROR_VAL",),
    "observations": _OBS,
    "head_rows": _OBS,
    "slice_rows": _RATIO5,
    "slice_deep": _OBS,
    "chart_scatter_sample": ("Y",),
    "last_unit_labs": ("VIEW_VAL", "ERROR_VAL"),
    "subject_lookup": ("VIEW_VAL", "ERROR_VAL"),
    "csv_roundtrip": _RATIO5,
    "chart_scatter": ("Y",),
    "chart_facet_scatter": ("Y",),
    "chart_box": ("Q1", "MEDIAN", "Q3", "WHISKER_LOW", "WHISKER_HIGH"),
    "chart_facet_box": ("Q1", "MEDIAN", "Q3", "WHISKER_LOW", "WHISKER_HIGH"),
    "chart_bar": ("MEAN", "STDDEV"),
    "chart_line": ("MEAN", "STDDEV"),
    "chart_facet_line": ("MEAN", "STDDEV"),
    "chart_hist": ("BIN_START", "BIN_END"),
    "chart_facet_hist": ("BIN_START", "BIN_END"),
    "chart_density": ("X", "DENSITY"),
    "chart_facet_density": ("X", "DENSITY"),
    "retail_observations": _OBS[:4] + ("RETURNED_VAL", "ACCEPTED_VAL"),
    "retail_event_staff_ratio": _RATIO5,
    "retail_staff_subject_ratio": _RATIO6,
    "retail_labs_subset": ("VALUENUM",),
    "text_times_labs": ("VALUENUM",),
    "gappy_observations": _OBS,
}


def rounded_sql(name: str, sql: str) -> str:
    cols = DOUBLES.get(name)
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) oracle_q"
