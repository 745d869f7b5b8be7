"""Maps from scheduler states to task statuses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The status of each raw state, by profile, and what any other state becomes.
PROFILES: dict[str, dict[str, str]] = {
    "slurm": {"PENDING": "submitted", "CONFIGURING": "submitted", "RUNNING": "running", "RESIZING": "running", "COMPLETING": "running", "SUSPENDED": "running", "COMPLETED": "finished", "CANCELLED": "failed", "FAILED": "failed", "TIMEOUT": "failed", "NODE_FAIL": "failed", "OUT_OF_MEMORY": "failed", "PREEMPTED": "failed"},
    "slurm_submit": {"PENDING": "submitted", "SUSPENDED": "submitted", "RESV_DEL_HOLD": "submitted", "REQUEUED": "submitted", "CONFIGURING": "running", "RUNNING": "running", "COMPLETING": "running", "STAGE_OUT": "running", "SIGNALING": "running"},
    "pbs": {"Q": "submitted", "H": "submitted", "W": "submitted", "T": "submitted", "R": "running", "E": "running"},
    "controller_slurm": {"PENDING": "submitted", "CONFIGURING": "submitted", "RUNNING": "running", "COMPLETING": "running", "SUSPENDED": "running", "COMPLETED": "finished", "FAILED": "failed", "CANCELLED": "failed", "TIMEOUT": "failed", "NODE_FAIL": "failed", "OUT_OF_MEMORY": "failed", "PREEMPTED": "failed", "BOOT_FAIL": "failed"},
    "controller_pbs": {"Q": "submitted", "H": "submitted", "W": "submitted", "T": "submitted", "R": "running", "E": "running", "C": "finished"},
    "pbs_flow": {"Q": "submitted", "H": "submitted", "W": "submitted", "T": "submitted", "S": "submitted", "R": "running", "E": "running"},
}
OTHER = {"slurm": "unknown", "slurm_submit": "submitted", "pbs": "unknown", "controller_slurm": "", "controller_pbs": "", "pbs_flow": "submitted"}
#: States that count by how they begin, and what they become.
BEGINS = {"slurm_submit": {"COMPLETED": "finished", "FAILED": "failed", "CANCELLED": "failed", "TIMEOUT": "failed", "NODE_FAIL": "failed", "OUT_OF_MEMORY": "failed", "PREEMPTED": "failed", "BOOT_FAIL": "failed", "DEADLINE": "failed"}}
#: States that end a PBS job, whose exit code then decides, and profiles that take the raw state as it is.
ENDED = {"pbs": ("C", "F"), "pbs_flow": ("C",)}
WHOLE = ("slurm_submit", "controller_slurm", "controller_pbs", "pbs_flow")


def mapped_status(state: str | Column, profile: str = "slurm", exit_code: str | None = None) -> Column:
    """The status of a raw state. Slurm suffixes (as in ``CANCELLED+``) are cut, or ignored where states count by how they
    begin, but for the controllers' profiles; a PBS
    job that has ended has finished if its exit code is 0 or unknown, else failed. Empty: no opinion."""
    raw = F.upper(F.trim(F.coalesce(F.col(state) if isinstance(state, str) else state, F.lit(""))))
    head = raw if profile in WHOLE else F.regexp_extract(raw, r"^([^\s+]*)", 1)
    pairs = [x for item in PROFILES[profile].items() for x in map(F.lit, item)]
    found = F.element_at(F.create_map(*pairs), head)
    for begin, status in BEGINS.get(profile, {}).items():
        found = F.when(raw.startswith(begin), status).otherwise(found)
    if profile in ENDED:
        code = F.coalesce(F.col(exit_code).cast("int"), F.lit(0)) if exit_code else F.lit(0)
        found = F.when(head.isin(*ENDED[profile]), F.when(code == 0, "finished").otherwise("failed")).otherwise(found)
    return F.coalesce(found, F.lit(OTHER[profile]))


def record_status(status: str) -> Column:
    """Submitted, running, finished and failed as they are (lower case), everything else is planned."""
    own = F.lower(F.trim(status))
    return F.when(own.isin("submitted", "running", "finished", "failed"), own).otherwise("planned")


def inferred_status(counts: str, status: str | None = None) -> Column:
    """A record's status or, where it has none, that of its counts (a map from status to number): failed if any has failed,
    finished if some have and none runs or waits, else unknown."""
    some = lambda s: F.coalesce(F.element_at(F.col(counts), F.lit(s)), F.lit(0)) > 0
    found = F.when(some("failed"), "failed").when(some("finished") & ~some("running") & ~some("submitted"), "finished").otherwise("unknown")
    return F.coalesce(F.nullif(F.lower(F.trim(status)), F.lit("")), found) if status else found


def preferred_status(tags: str, scheduler: str, precedence: str = "tags") -> Column:
    """The status by completion tags or by the scheduler, whichever comes first; an empty one has no opinion."""
    order = (tags, scheduler) if precedence == "tags" else (scheduler, tags)
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in order])
