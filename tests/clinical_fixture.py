"""Hand-sized clinical fixture (FIXTURES.md section B); all times in 2000."""

from __future__ import annotations

from datetime import datetime

from wardflow.sources.schemas import CLINICAL_DDL


def ts(s: str | None):
    if s is None:
        return None
    md, hm = s.split(" ")
    m, d = md.split("-")
    h, mi = hm.split(":")
    return datetime(2000, int(m), int(d), int(h), int(mi))


TRANSFERS = [
    (1, 101, "admit", "CCU", "06-02 10:00"), (1, 101, "transfer", "MICU", "06-03 09:00"),
    (1, 101, "discharge", None, "06-04 03:00"), (1, 102, "admit", "CCU", "06-20 00:00"),
    (1, 102, "discharge", None, "06-21 23:00"), (2, 201, "admit", "MICU", "06-10 13:00"),
    (2, 201, "discharge", None, "06-10 23:00"), (3, 301, "admit", "SICU", "06-29 11:00"),
    (4, 401, "admit", "CCU", "05-31 20:00"), (4, 401, "discharge", None, "06-02 20:00"),
    (5, 501, "admit", None, "06-05 05:00"), (5, 501, "discharge", None, "06-06 04:00"),
    (8, 801, "admit", "MICU", "06-10 01:00"), (8, 801, "discharge", None, "06-10 18:00"),
    (6, 601, "admit", "CCU", "06-03 06:00"), (6, 601, "discharge", None, "06-04 04:00"),
]
DIAGNOSES = [(1, 101, "4280"), (1, 101, "4254"), (1, 101, "4019"), (1, 102, "42830"), (2, 201, "4299"),
             (3, 301, "78551"), (4, 401, "4280"), (5, 501, "4281"), (6, 601, "4280"), (8, 801, "4280")]
ICD_DIAGNOSES = [("4280", "CHF NOS"), ("4254", "Prim cardiomyopathy"), ("4299", "Heart disease NOS"),
                 ("78551", "Cardiogenic shock"), ("4281", "Left heart failure"), ("4019", "Hypertension")]
ICD_LABS = [(1, "Troponin T"), (2, "TROPONIN I"), (3, "NTproBNP"), (4, "Sodium")]
CARE_GIVERS = [(1, "RN"), (2, "Intern"), (3, "MD"), (4, None)]
TREATMENT_TEAM = [(101, 1, "06-03 00:00", "06-03 12:00"), (101, 1, "06-03 12:00", "06-04 00:00"),
                  (101, 2, "06-03 00:00", "06-03 12:00"), (101, 3, "06-03 00:00", "06-03 12:00"),
                  (201, 1, "06-10 12:00", "06-11 00:00"), (301, 4, "06-29 12:00", "06-30 00:00"),
                  (301, 1, "06-29 07:00", "06-29 19:00")]
LABS = [(1, 101, 1, "06-02 11:00", 9.9, "ng/mL"), (1, 101, 1, "06-03 01:00", 0.5, "ng/mL"),
        (1, 101, 2, "06-03 14:00", None, "ng/ml"), (1, 101, 3, "06-03 05:00", 800.0, "pg/mL"),
        (1, 101, 1, "06-04 05:00", 7.7, "ng/mL"), (1, 102, 2, "06-21 13:00", 0.04, "ng/ml"),
        (2, 201, 1, "06-10 14:00", 0.2, "ng/mL"), (3, 301, 1, "06-29 13:00", 1.1, "ng/mL"),
        (4, 401, 1, "06-01 01:00", 0.3, "ng/mL"), (5, 501, 2, "06-05 16:00", 2.5, "ng/mL"),
        (6, 601, 4, "06-03 13:00", 140.0, "mEq/L"), (8, 801, 1, "06-10 02:00", 3.3, "ng/mL")]


def tables(spark) -> dict:
    seq = {}
    diag = []
    for s, h, c in DIAGNOSES:
        seq[h] = seq.get(h, 0) + 1
        diag.append((s, h, seq[h], c))
    rows = {
        "TRANSFERS": [(s, h, e, None, u, ts(t), None) for s, h, e, u, t in TRANSFERS],
        "CARE_GIVERS": [(c, l, None) for c, l in CARE_GIVERS],
        "TREATMENT_TEAM": [(h, c, ts(a), ts(b)) for h, c, a, b in TREATMENT_TEAM],
        "LABS": [(s, h, i, ts(t), v, u) for s, h, i, t, v, u in LABS],
        "ICD_LABS": [(i, l, None) for i, l in ICD_LABS],
        "DIAGNOSES": diag,
        "ICD_DIAGNOSES": ICD_DIAGNOSES,
    }
    return {n: spark.createDataFrame(r, CLINICAL_DDL[n]) for n, r in rows.items()}
