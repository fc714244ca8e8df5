"""Labels of the reports: code decoding, ordered buckets and the rules that choose a label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from supplyloom.functions.text import as_int, is_numeric, same_text

# --- fixed values: they must read exactly as the consumers of the reports expect -----------------

DONE_LABELS = {1: "Yes", 2: "No", 3: "Deactivated"}
YES_NO_LABELS = {0: "No", 1: "Yes"}
UNKNOWN = "Unknown"
CAP_VERSIONS = {"Version 3": "CRSA v3.0", "Version 4": "CRSA v4.0"}
PROCESS_TYPES = {0: "Old Process", 1: "New SCM Star Process"}
MATERIAL_TYPES = {0: "Direct Material", 1: "Indirect Material"}
UNKNOWN_MATERIAL = "Unknown Material Type"
EXPIRATION_CODES = {0: "Unlimited", 1: "Other", 4: "CRSA", 5: "SC", 9: "CS"}
MODULES = {1: "coc_old", 4: "crsa", 5: "sc", 9: "cs"}

TOTAL_TIME_BOUNDS = [100, 200, 300]
TOTAL_TIME_LABELS = ["b) 0-99", "c) 199 - 100", "d) 200 - 299", "e) 300 and above"]
TOTAL_TIME_NULL = "a) blank"

AGE_BOUNDS = [5, 10, 20, 40]
AGE_LABELS = ["a) less 1 weeks", "b) 1 - 2 weeks", "c) 2 - 4 weeks", "d) 4 - 8 weeks", "e) more then 8 weeks"]
AGE_NULL = "0) missing data"

STEP_TIME_BUCKETS = {
    "Data clarification": ([15], ["a) < 3 weeks", "c) > 3 weeks"]),
    "CoC Acceptance": ([10, 20], ["a) < 2 weeks", "b) < 2-4 weeks", "c) > 3 weeks"]),
    "Qualification": ([15, 25], ["a) < 3 weeks ", "b) 3-5 weeks", "c) > 5 weeks"]),
    "Finalization": ([5], ["a) < 1 week", "b) > 1 week"]),
}

REQUEST_TYPE_MODULES_ONLY = "New (Modules only)"
REQUEST_TYPE_COC_AND_MODULES = "New (CoC+Modules)"
REQUEST_TYPE_COC_ONLY = "New (Coc Only)"
REQUEST_TYPE_CHECK = "Check"
REQUEST_TYPE_CODES = {2: "Renewal", 3: "Check", 4: "Hardcopy", 5: "Referencing", 6: "User Support"}

KPI_RECEIVED = "Number of received Supplier Qualifications (Input)"
KPI_COC_AND_MODULES = "Number of finished Supplier Qualifications (New CoC + Modules)"
KPI_REQUEST_TYPES = {
    "Number of finished Supplier Qualifications (New CoC + Modules)": "New (CoC+Modules)",
    "Number of finished Supplier Qualifications (New CoC only)": "New (Coc Only)",
    "Number of finished Supplier Qualifications (New Modules only)": "New (Modules only)",
    "Number of finished Supplier Qualifications (Check)": "Check",
    "Number of finished Supplier Qualifications (Renewal)": "Renewal",
    "Number of finished Supplier Qualifications (Hard Copy)": "Hardcopy",
    "Number of finished Supplier Qualifications (Referencing)": "Referencing",
}
REQUEST_TYPE_KPIS = {
    "New": "Number of finished Supplier Qualifications (New)",
    "Check": "Number of finished Supplier Qualifications (Check)",
    "Renewal": "Number of finished Supplier Qualifications (Renewal)",
    "Hardcopy": "Number of finished Supplier Qualifications (Hardcopy)",
}
KPI_TEAMS = ["Source-2-Contract", "PS1 ES2", "IN-DC PS2 5", "SCMS S2C MY", "SCM FSS AA ASN", "Supplier Qualification"]

BACKLOG_NOT_STARTED = "a) Not Started"
BACKLOG_CLARIFICATION = "b) Data Clarification Escalated"
BACKLOG_COC = "c) CoC"
BACKLOG_COC_ESCALATED = "d) CoC Escalated"
BACKLOG_QUALIFICATION = "e) Qualfication (CRCA SC CS)"
BACKLOG_QUALIFICATION_ESCALATED = "f) Qualfication Escalated (CRCA SC CS)"
BACKLOG_FINALIZATION = "g) Finalization"

# --- label operators -----------------------------------------------------------------------------


def decode(col: Column, mapping: Mapping, default: str | None = None) -> Column:
    """Code to label. Text codes compare without case or trailing blanks."""
    chain = None
    for code, label in mapping.items():
        hit = same_text(col, code) if isinstance(code, str) else col == code
        chain = (F if chain is None else chain).when(hit, F.lit(label))
    return chain.otherwise(F.lit(default))


def bucket(
    col: Column, bounds: Sequence[float], labels: Sequence[str], null_label: str | None = None, inclusive: bool = True
) -> Column:
    """Label of the range a number falls in; ``inclusive`` puts a bound into the lower range."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one more label than bounds is needed")
    chain = F.when(col.isNull(), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        chain = chain.when(col <= bound if inclusive else col < bound, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def bucket_by(key: Column, value: Column, table: Mapping[str, tuple[Sequence[float], Sequence[str]]]) -> Column:
    """As ``bucket``, with bounds and labels that depend on ``key``; NULL for other keys and NULL values."""
    chain = None
    for name, (bounds, labels) in table.items():
        chain = (F if chain is None else chain).when(same_text(key, name), bucket(value, bounds, labels))
    return chain.otherwise(F.lit(None))


def first_true(rules: Sequence[tuple[Column, str | None]], default: str | None = None) -> Column:
    """Label of the first condition that holds."""
    chain = None
    for condition, label in rules:
        chain = (F if chain is None else chain).when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def decode_mixed(col: Column, mapping: Mapping[int, str]) -> Column:
    """Known whole numbers become labels, other text stays as it is, other numbers become NULL."""
    return F.when(~is_numeric(col), col).otherwise(decode(as_int(col), mapping))


def mixed_text(col: Column, companion: Column) -> Column:
    """The companion text, kept only beside a numeric code."""
    return F.when(is_numeric(col), companion).otherwise(F.lit(""))


def kpi_to_request_type(kpi_name: Column) -> Column:
    return decode(kpi_name, KPI_REQUEST_TYPES)


def request_type_to_kpi(request_type: Column) -> Column:
    return decode(request_type, REQUEST_TYPE_KPIS)


def total_time_label(days: Column) -> Column:
    return bucket(days, TOTAL_TIME_BOUNDS, TOTAL_TIME_LABELS, TOTAL_TIME_NULL, inclusive=False)


def age_label(days: Column) -> Column:
    return bucket(days, AGE_BOUNDS, AGE_LABELS, AGE_NULL)


def step_time_label(step: Column, days: Column) -> Column:
    return bucket_by(step, days, STEP_TIME_BUCKETS)


def not_qualified_step(qualification: Column, coc: Column, registration: Column) -> Column:
    return first_true(
        [
            (qualification == 1, "Qualification Step"),
            (coc == 1, "CoC Step"),
            (registration == 1, "Old Registration Step"),
        ]
    )


def current_step(status: Column, escalation_tab: Column, escalation_solved: Column, step: Column) -> Column:
    """Workflow step shown on the dashboard: closed states first, then an open clarification, then the step."""
    return first_true(
        [
            (same_text(status, "Not started"), "a) Not Started"),
            (same_text(status, "Finished"), "f) Finished"),
            (same_text(status, "Finished not qualified"), "g) Finished not qualified"),
            (same_text(status, "Out of scope"), "h) Out of scope"),
            (same_text(escalation_tab, "Data Clarification") & escalation_solved.isNull(), "b) Data clarification"),
            (same_text(step, "CoC Acceptance"), "c) CoC Acceptance"),
            (same_text(step, "Qualification"), "d) Qualification"),
            (same_text(step, "Finalization"), "e) Finalization"),
        ]
    )


def backlog_step(status: Column, open_clarification: Column, step: Column) -> Column:
    """Backlog step of an unfinished request. ``c) CoC`` is reachable here (see README, deviations)."""
    in_process, escalated = same_text(status, "In Process"), same_text(status, "Escalated")
    coc, qualification = same_text(step, "CoC Acceptance"), same_text(step, "Qualification")
    return first_true(
        [
            (same_text(status, "Finished", "Finished not qualified", "Out of scope"), None),
            (same_text(status, "Not started"), BACKLOG_NOT_STARTED),
            (open_clarification, BACKLOG_CLARIFICATION),
            (coc & in_process, BACKLOG_COC),
            (coc & escalated, BACKLOG_COC_ESCALATED),
            (qualification & in_process, BACKLOG_QUALIFICATION),
            (qualification & escalated, BACKLOG_QUALIFICATION_ESCALATED),
            (same_text(step, "Finalization"), BACKLOG_FINALIZATION),
        ]
    )


