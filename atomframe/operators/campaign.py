"""Campaign tables: normalisation, reconciliation with marker scans, recovery after an outage, and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from atomframe.functions.expressions import first_text
from atomframe.operators.index import first_per_group

# The legacy names of fields, the states, and the fields that may hold a job's identifier.
LEGACY = {"poscar_path_11": "poscar_path", "task_dir_15": "task_dir", "structure_path": "source_structure_path", "job": "job_id"}
STATES = ["planned", "selected", "submitted", "running", "finished", "failed", "completed"]
ENDED = ["finished", "failed", "completed"]


def normalised(records: DataFrame, version: str = "campaign.v1") -> DataFrame:
    """Legacy fields fill new ones where those are null; schema_version and status get their defaults."""
    out = records
    for old, new in LEGACY.items():
        if old in out.columns:
            out = out.withColumn(new, F.coalesce(new, old) if new in out.columns else F.col(old)).drop(old)
    for name, default in (("schema_version", version), ("status", "planned")):
        out = out.withColumn(name, F.coalesce(name, F.lit(default)) if name in out.columns else F.lit(default))
    return out


def scan_result(status: str = "status") -> Column:
    """success: finished, not failed, structure and output there, converged, footer there; failed; or pending."""
    ok = F.col("tag_finished") & ~F.col("tag_failed") & F.col("poscar") & F.col("outcar") & F.col("ediff_reached") & F.col("normal_footer")
    return F.when(ok, "success").when(F.col("tag_failed") | (F.col(status) == "failed"), "failed").otherwise("pending")


def scanned_once(scan: DataFrame, order: str | None = None) -> DataFrame:
    """One __result for each target, system and frame of a scan: the last by ``order``, else success before pending before
    failed."""
    best = F.max_by("result", order) if order else F.max("result")
    return scan.groupBy("target", "system", "frame").agg(best.alias("__result"))


def reconciled(entries: DataFrame, targets: DataFrame, scan: DataFrame, order: str | None = None) -> DataFrame:
    """Each entry (system, frame, target) with result and reason. ``targets``: target, available. One target only is
    everybody's. Of repeated scan rows one counts (see ``scanned_once``). The order of reasons: unknown_target, scan_failed, missing_remote_frame, failed, success, not_terminal."""
    given = resolved_target(targets, entries)
    known = targets.select("target", F.col("available").alias("__available"))
    found = scanned_once(scan, order)
    joined = given.join(known, "target", "left").join(found, ["target", "system", "frame"], "left")
    reason = (
        F.when(F.col("__available").isNull(), "unknown_target")
        .when(~F.col("__available"), "scan_failed")
        .when(F.col("__result").isNull(), "missing_remote_frame")
        .when(F.col("__result") == "failed", "failed")
        .when(F.col("__result") == "success", "success")
        .otherwise("not_terminal")
    )
    result = F.when(reason.isin("failed", "success"), reason).otherwise("pending")
    return joined.withColumn("result", result).withColumn("reason", reason).drop("__available", "__result")


def archive_report(rows: DataFrame) -> DataFrame:
    """Expected, successful, failed and pending entries of each system and of all (system null), with ready or partial."""
    ok, bad, open_ = (F.count_if(F.col("result") == x) for x in ("success", "failed", "pending"))
    sets = rows.rollup("system").agg(F.grouping("system").cast("int").alias("is_total"), F.count("*").alias("expected"), ok.alias("successful"), bad.alias("failed"), open_.alias("pending"))
    return sets.withColumn("status", F.when(F.col("failed") + F.col("pending") > 0, "partial").otherwise("ready"))


def duplicates_across_targets(scan: DataFrame, result: str = "success") -> DataFrame:
    """Keys that have converged on more than one target, with those targets."""
    many = scan.where(F.col("result") == result).groupBy("system", "frame").agg(F.sort_array(F.collect_set("target")).alias("targets"))
    return many.where(F.size("targets") > 1)


#: The fields that may hold the id or name of an entry's job.
IDENTIFIERS = ["job_id", "pbs_job_id", "slurm_job_id", "pbs_job_name", "slurm_job_name", "job_name"]


def resolved_target(targets: DataFrame, entries: DataFrame) -> DataFrame:
    """``entries`` with their target: the one they name if it is known or there are several, else the only one there is."""
    only = targets.agg(F.when(F.count("*") == 1, F.first("target")).alias("__only"))
    return entries.crossJoin(F.broadcast(only)).withColumn("target", F.coalesce("__only", first_text("target"))).drop("__only")


def active_entries(entries: DataFrame, key: list[str], jobs: DataFrame) -> DataFrame:
    """target, key and __ids of the entries of which some identifier (__ids) is the id or name of an active job of the
    same target. Equal keys on other targets, or with other jobs, are other entries."""
    active = jobs.select("target", F.explode(F.array("job_id", "name")).alias("id")).where("id is not null and id <> ''").distinct()
    named = entries.select("target", *key, "__ids", F.explode("__ids").alias("id"))
    return named.join(active, ["target", "id"], "left_semi").select("target", *key, "__ids").distinct()


def recovery_plan(
    entries: DataFrame,
    targets: DataFrame,
    scan: DataFrame,
    jobs: DataFrame,
    identifiers: list[str] | None = None,
    allow_lost: list[str] | None = None,
    strict_targets: bool = False,
    stamp: str | None = None,
) -> DataFrame:
    """What becomes of submitted and running entries after an outage: action, new_status and reason; the input stays.

    An entry's identifiers are its columns of those names and what ``extras`` (a map) has under them. Order: no target, unknown target (only if strict), unavailable target (but those in ``allow_lost``), terminal scan,
    still active, reset. An entry without a target takes the only one there is. ``stamp`` is the time of the recovery."""
    key = ["system", "frame"]
    live = resolved_target(targets, entries.where(F.lower("status").isin("submitted", "running")))
    names = identifiers or IDENTIFIERS
    held = [F.col(c).cast("string") for c in names if c in entries.columns]
    held += [F.col("extras")[c] for c in names] if "extras" in entries.columns else []
    live = live if "job_id" in live.columns else live.withColumn("job_id", F.lit(None).cast("string"))
    live = live.withColumn("__ids", F.array_distinct(F.array_compact(F.array(*[F.nullif(F.trim(c), F.lit("")) for c in held]))) if held else F.array().cast("array<string>"))
    active = active_entries(live, key, jobs).withColumn("__active", F.lit(True))
    known = targets.select("target", F.col("available").alias("__available"))
    found = scanned_once(scan)
    joined = live.join(known, "target", "left").join(found, ["target", *key], "left").join(active, ["target", *key, "__ids"], "left")
    blank = F.col("target").isNull()
    unknown = F.col("__available").isNull() if strict_targets else F.lit(False)
    gone = ~F.coalesce("__available", F.lit(True)) & ~F.coalesce(F.col("target").isin(*allow_lost or [""]), F.lit(False))
    reset = F.col("action") == "recovered_for_resubmit"
    action = (
        F.when(blank | unknown | gone, "unresolved")
        .when(F.col("__result").isin("success", "failed"), "normalized_terminal")
        .when(F.col("__active"), "preserved_active")
        .otherwise("recovered_for_resubmit")
    )
    reason = F.when(blank | unknown, "unknown_target").when(gone, "target_unavailable").when(reset, "scheduler_job_missing_without_terminal_marker")
    ended = F.when(F.col("__result") == "success", "finished").otherwise("failed")
    new = F.when(F.col("action") == "normalized_terminal", ended).when(reset, "selected").otherwise(F.col("status"))
    out = joined.withColumn("action", action).withColumn("reason", reason)
    out = out.withColumns({"new_status": new, "recovered_previous_status": F.when(reset, F.col("status")), "recovered_after_outage_at": F.when(reset, F.lit(stamp))})
    return out.withColumn("job_id", F.when(~reset, F.col("job_id"))).drop("__available", "__result", "__active", "__ids")


def status_counts(df: DataFrame, *by: str, status: str = "status", states: list[str] = STATES) -> DataFrame:
    """Counts of all states, zeros included, with total, terminal and unfinished."""
    name = F.col(status)
    ended = F.count_if(name.isin(*[s for s in states if s in ENDED]))
    out = df.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(name == s).alias(s) for s in states], ended.alias("terminal"))
    return out.withColumn("unfinished", F.greatest(F.col("total") - F.col("terminal"), F.lit(0)))


def unit_rollup(df: DataFrame, *by: str, status: str = "status") -> DataFrame:
    """A unit's status: failed, running or submitted if any task is, finished if all are, else prepared."""
    has = lambda s: F.bool_or(F.col(status) == s)
    state = F.when(has("failed"), "failed").when(has("running"), "running").when(has("submitted"), "submitted").when(F.bool_and(F.col(status) == "finished"), "finished").otherwise("prepared")
    return df.groupBy(*by).agg(F.count("*").alias("tasks"), state.alias("unit_status"))


def job_summary(jobs: DataFrame, key: str = "task_key", status: str = "status") -> DataFrame:
    """Physical jobs, distinct tasks, duplicates and statuses of each target. Jobs without a task key are not counted."""
    s = F.col(status)
    statuses = ("running", "submitted", "finished", "failed", "unknown")
    own = jobs.where(F.coalesce(F.trim(key), F.lit("")) != "")
    by_key = own.groupBy("target", key).agg(F.count("*").alias("n"), *[F.count_if(s == x).alias(x) for x in statuses])
    total = [F.sum(x).alias({"submitted": "queued"}.get(x, x)) for x in statuses]
    return by_key.groupBy("target").agg(F.sum("n").alias("physical_jobs"), F.count(key).alias("unique_tasks"), F.sum(F.col("n") - 1).alias("duplicate_jobs"), *total)


def cross_target_summary(targets: DataFrame, summary: DataFrame) -> DataFrame:
    """Sums over the targets that answered; those that did not are counted apart and never as zeros."""
    columns = ["physical_jobs", "unique_tasks", "duplicate_jobs", "running", "queued"]
    joined = targets.join(summary, "target", "left")
    down = F.count_if(~F.col("available"))
    status = F.when(down == 0, "available").when(down < F.count("*"), "partial").otherwise("unavailable")
    known = lambda c: F.sum(F.when(F.col("available"), F.coalesce(c, F.lit(0))))
    return joined.agg(F.count("*").alias("targets"), down.alias("unavailable"), *[known(c).alias(c) for c in columns], status.alias("status"))


def preferred_job(jobs: DataFrame, *by: str, state: str = "state", order: list[str] = ["R", "E", "Q", "H", "W", "T", "C"], first: str = "job_id") -> DataFrame:  # noqa: B006
    """One job of each name: the best by state, then the first."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(state)), F.lit(0)), F.lit(len(order) + 1))
    best = jobs.groupBy(*by).agg(F.min_by(F.struct(first, state), F.struct(rank, F.col(first))).alias("b"))
    return best.select(*by, F.col("b")[first].alias(first), F.col("b")[state].alias(state))


def host_matrix(df: DataFrame, host: str, status: str = "status", states: list[str] = ["submitted", "running"]) -> DataFrame:  # noqa: B006
    return df.groupBy(host).agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == s).alias(s) for s in states])


def completed_campaigns(summary: DataFrame, name: str = "campaign", root: str = "root", include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Campaigns of which every task has finished, by name patterns, with a root."""
    others = [s for s in STATES if s != "finished"]
    out = summary.where((F.col("total") > 0) & (F.col("finished") == F.col("total")))
    for s in others:
        if s in summary.columns:
            out = out.where(F.col(s) == 0)
    out = out.where(F.coalesce(F.trim(root), F.lit("")) != "")
    out = out.where(F.col(name).rlike(include)) if include else out
    return out.where(~F.col(name).rlike(exclude)) if exclude else out


def manifest_header(records: DataFrame, source: str = "source", status: str = "status") -> DataFrame:
    """Sources, records scanned, entries and the records skipped because they are not finished."""
    done = F.col(status) == "finished"
    return records.agg(F.count_distinct(source).alias("sources"), F.count("*").alias("records"), F.count_if(done).alias("entries"), F.count_if(~F.coalesce(done, F.lit(False))).alias("skipped"))


def conversion_units(df: DataFrame, by: list[str], example: str, status: str = "status", most: int = 3) -> DataFrame:
    """Finished tasks of each unit (as ``by``: group, natoms and elements) with the first and the last example, and the first
    ``most`` of them in a list. Tasks keep their own first ones before they meet."""
    done = df.where(F.col(status) == "finished")
    few = first_per_group(done, by, [example], most).groupBy(*by).agg(F.sort_array(F.collect_list(example)).alias("examples"))
    units = done.groupBy(*by).agg(F.count("*").alias("tasks"), F.min(example).alias("first_example"), F.max(example).alias("last_example"))
    same = reduce(lambda a, b: a & b, [units[c].eqNullSafe(few[c]) for c in by])
    return units.join(few, same).select(*[units[c] for c in by], "tasks", "first_example", "last_example", "examples")
