"""Small frozen parameter objects shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# Column names of the clinical data model (fixed values; outputs keep them).
SUBJECT_ID = "SUBJECT_ID"
HADM_ID = "HADM_ID"
ICD9_CODE = "ICD9_CODE"
ICD_DESCRIPTION = "ICD_DESCRIPTION"
UNIT = "CURR_CAREUNIT"
ADMIT = "ADMISSION_DATE"
DISCHARGE = "DISCHARGE_DATE"
CGID = "CGID"
LABEL = "LABEL"
START = "STARTTIME"
END = "ENDTIME"
ITEMID = "ITEMID"
CHARTTIME = "CHARTTIME"
VALUENUM = "VALUENUM"
VALUEUOM = "VALUEUOM"
B12 = "TIME_BLOCK_12HR"
B4 = "TIME_BLOCK_4HR"


@dataclass(frozen=True)
class GridSpec:
    """Regular time grid: blocks of ``block_hours`` split into sub-blocks.

    The number of blocks follows the reference rule: whole days between
    ``start`` and ``end`` times blocks per day, plus one.  Open interval
    ends are filled with ``end``.
    """

    start: datetime
    end: datetime
    block_hours: int = 12
    sub_hours: int = 4

    def __post_init__(self):
        if self.block_hours % self.sub_hours or 24 % self.block_hours:
            raise ValueError("block must divide a day and be a multiple of sub-block")

    @property
    def subs_per_block(self) -> int:
        return self.block_hours // self.sub_hours

    @property
    def n_blocks(self) -> int:
        return (self.end - self.start).days * (24 // self.block_hours) + 1

    @property
    def block_us(self) -> int:
        return self.block_hours * 3_600_000_000

    @property
    def sub_us(self) -> int:
        return self.sub_hours * 3_600_000_000

    @property
    def start_sql(self) -> str:
        return self.start.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def end_sql(self) -> str:
        return self.end.strftime("%Y-%m-%d %H:%M:%S")


# Grid of the reference study (June 2000) and of the driver's events table.
JUNE_2000 = GridSpec(datetime(2000, 6, 1, 0, 0), datetime(2000, 6, 30, 23, 59))
EVENTS_GRID = GridSpec(datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 30, 23, 59))


@dataclass(frozen=True)
class CohortSpec:
    """Parameters of the cohort selection (O2) and staff selection (O3)."""

    code_prefixes: tuple[str, ...] = ("428", "425")
    code_equals: tuple[str, ...] = ("4299", "78551")
    month_start: datetime = datetime(2000, 6, 1)
    month_end: datetime = datetime(2000, 7, 1)
    required_lab_pattern: str = "Troponin"
    staff_label_pattern: str = "RN"
    admit_event: str = "admit"
    discharge_event: str = "discharge"


@dataclass(frozen=True)
class LabSpec:
    """Tests to follow: column prefix -> pattern of the test's label."""

    tests: dict = field(default_factory=lambda: {"TROPONIN": "Troponin", "BNP": "BNP"})
