"""Business configuration of the capacity and cost reports.

Every literal that the reports compare against (task ids, tag ids, cut-off
dates, excluded users, purchase-order types ...) is a field here, so a caller
can re-aim a report without touching an operator.  ``Config()`` carries the
reports' own ids and cut-offs, except the pattern and the label of the named
product tag: they have no default, and a report that needs them fails while it
is planned when they are unset.  ``FIXTURE_CONFIG`` is the configuration that
matches the test tables (see ``capstan.sources.fixtures``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass


# ---------------------------------------------------------------------------
# Labels and status literals exactly as the reports spell them
# (including the "quoated" misspelling of the original report text).
# ---------------------------------------------------------------------------
LEGACY_PPAP_STATUSES = (
    "Approved",
    "Interim Approved",
    "A - Interim / Documentation",
    "B - Capacity Improvement",
    "C - Capability Improvement",
    "D - Prototype / Deviation",
    "E - Uncontrolled",
    "Rejected",
)
TASK_LEGACY = "Legacy Part"
TASK_UNDEFINED = "Part Definition Not Completed"
TASK_APPROVED = "Approved"
TASK_REJECTED = "Rejected"
TASK_NOT_REVIEWED = "Not Reviewed"
TASK_NOT_SUBMITTED = "Not Submitted"
TASK_PCR_PENDING = "PCR Pending"
TASK_NOT_REQUIRED = "Not Required"

EFFECTIVE_CURRENT = "Current"
EFFECTIVE_PAST = "Past"
EFFECTIVE_FUTURE = "Future"
EFFECTIVE_MISSING = "Dates missing"

MODEL_3 = "Model 3 (EBOM)"
MODEL_SHARED_SX = "Shared S/X"
MODEL_X = "Model X"
MODEL_S = "Model S"
MODEL_OTHER = "Others/Inactive"

PROGRAM_PASSTHROUGH = ("Subcontract", "Missing", "New", "BOM Error", "Rework", "Warp Error")
PROGRAM_MODEL_3 = "Model 3"
PROGRAM_EXISTING = "Existing Programs (S/X/TE)"

STATUS_GREATER = "{kind} capacity greater than quoted"
STATUS_LESS = "{kind} capacity less than quoated"
STATUS_NO_QUOTE = "No Quoted data"
STATUS_NO_VALUE = "No {kind} data"
STATUS_NO_DATA = "No data"

CAPACITY_CONTRACT = "Contract"
CAPACITY_CURRENT = "Current Capacity"
# The defaults of ``Config`` below are fixed values too: ids, codes, patterns and
# cut-off dates that must equal the reports' for equal results.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    # Time the report is "run at" (the reference's GETDATE()). ``None`` means
    # the wall clock, captured once when a plan is built (see ``as_of_ts``).
    as_of: dt.datetime | None = None

    # capacity study task and the tags that mark vehicle programs
    capacity_task_id: int = 40
    tag_model_s: int = 31
    tag_model_x: int = 30
    tag_model_3: int = 124
    named_tag_pattern: str | None = None      # no default: the product name is the deployment's
    named_tag_type_id: int = 2
    energy_label: str | None = None           # model label of parts carrying the named tag; no default either
    excluded_user_ids: tuple[int, ...] = (2586, 2583, 2584)
    # task names that count towards the v1 status rollup:
    # name LIKE any of ``rollup_any`` OR name LIKE all of ``rollup_all``
    rollup_any: tuple[str, ...] = ("%capacity%",)
    rollup_all: tuple[str, ...] = ("%run%", "%rate%")
    # Plain (case-sensitive) string comparison by default; ``True`` switches
    # LIKE filters to ILIKE.  Equality, IN, lookups and merge keys follow when the
    # sources are read as ``Sources.collated()``.
    case_insensitive: bool = False

    # purchasing
    open_po_statuses: tuple[str, ...] = ("C", "R")
    open_line_statuses: tuple[str, ...] = ("A", "C")
    price_po_types: tuple[int, ...] = (1, 8, 9, 17)
    date_priced_po_type: int = 9
    date_priced_po_status: str = "R"
    date_priced_line_status: str = "A"
    date_pricing_cutoff: dt.datetime = dt.datetime(2017, 6, 30)
    rate_type: str = "Month-end"

    # bill of material
    sample_cutoff: dt.datetime = dt.datetime(2015, 10, 10)
    recent_days: int = 7

    def as_of_ts(self) -> dt.datetime:
        """The report time as a naive timestamp (timestamp_ntz semantics)."""
        return self.as_of if self.as_of is not None else dt.datetime.now().replace(microsecond=0)

    def fixed(self) -> "Config":
        """Copy with ``as_of`` pinned, so every sub-plan sees the same instant."""
        return dataclasses.replace(self, as_of=self.as_of_ts())

    def required(self, name: str) -> str:
        """A setting without default; raises when it is unset."""
        value = getattr(self, name)
        if value is None:
            raise ValueError(f"Config.{name} has no default and must be set for this report")
        return value

    def replace(self, **kw) -> "Config":
        return dataclasses.replace(self, **kw)


# Configuration matching the derived test tables (FIXTURES.md conventions).
FIXTURE_CONFIG = Config(
    as_of=dt.datetime(1998, 6, 15, 12, 0, 0),
    named_tag_pattern="%Stationary Energy%",
    energy_label="Energy",
    excluded_user_ids=(4, 7),
    date_pricing_cutoff=dt.datetime(1998, 6, 15),
    sample_cutoff=dt.datetime(2015, 10, 10),
)
