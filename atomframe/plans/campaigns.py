"""Queries on campaign tables: orders are entries, lineitem flags are marker scans, events are jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from atomframe.functions import states
from atomframe.functions.expressions import task_key_below
from atomframe.operators import campaign as C
from atomframe.session import table

STATUS = "case o_orderstatus when 'F' then 'finished' when 'P' then 'running' else 'submitted' end"


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("status", F.expr(STATUS))


def status_counts(spark, sf_dir):
    return C.status_counts(orders(spark, sf_dir), "o_orderpriority")


COUNTS_SQL = f"""
with o as (select *, {STATUS} as status from orders)
select o_orderpriority, count(*) as total, 0::bigint as planned, 0::bigint as selected, count(*) filter (status = 'submitted') as submitted, count(*) filter (status = 'running') as running,
  count(*) filter (status = 'finished') as finished, 0::bigint as failed, 0::bigint as completed, count(*) filter (status = 'finished') as terminal, count(*) filter (status <> 'finished') as unfinished
from o group by 1
"""


def unit_rollup(spark, sf_dir):
    return C.unit_rollup(orders(spark, sf_dir), "o_custkey")


ROLLUP_SQL = f"""
with o as (select *, {STATUS} as status from orders)
select o_custkey, count(*) as tasks, case when bool_or(status = 'running') then 'running' when bool_or(status = 'submitted') then 'submitted' when bool_and(status = 'finished') then 'finished' else 'prepared' end as unit_status
from o group by 1
"""


def host_matrix(spark, sf_dir):
    return C.host_matrix(orders(spark, sf_dir).withColumn("host", F.concat(F.lit("host"), F.col("o_custkey") % 5)), "host")


HOST_SQL = f"""
with o as (select 'host' || (o_custkey % 5) as host, {STATUS} as status from orders)
select host, count(*) as total, count(*) filter (status = 'submitted') as submitted, count(*) filter (status = 'running') as running from o group by 1
"""


def completed_campaigns(spark, sf_dir):
    counts = C.status_counts(orders(spark, sf_dir).withColumn("campaign", F.concat(F.lit("c"), F.col("o_orderkey") % 6000)), "campaign").withColumn("root", F.when(F.expr("campaign like '%1'"), " ").otherwise(F.concat(F.lit("/data/"), "campaign")))
    return C.completed_campaigns(counts, exclude="5$").select("campaign", "total", "root")


COMPLETED_SQL = f"""
with o as (select 'c' || (o_orderkey % 6000) as campaign, {STATUS} as status from orders)
select campaign, count(*) as total, '/data/' || campaign as root from o group by 1
having bool_and(status = 'finished') and campaign not like '%1' and campaign not like '%5'
"""


def manifest_header(spark, sf_dir):
    return C.manifest_header(orders(spark, sf_dir), "o_custkey")


HEADER_SQL = "select count(distinct o_custkey) as sources, count(*) as records, count(*) filter (o_orderstatus = 'F') as entries, count(*) filter (o_orderstatus <> 'F') as skipped from orders"


def conversion_units(spark, sf_dir):
    out = C.conversion_units(orders(spark, sf_dir).withColumn("natoms", F.col("o_custkey") % 4), ["o_orderpriority", "natoms"], "o_orderkey")
    return out.withColumn("examples", F.array_join("examples", ","))


UNITS_SQL = """
with f as (select *, o_custkey % 4 as natoms, row_number() over (partition by o_orderpriority, o_custkey % 4 order by o_orderkey) as r from orders where o_orderstatus = 'F')
select o_orderpriority, natoms, count(*) as tasks, min(o_orderkey) as first_example, max(o_orderkey) as last_example, string_agg(o_orderkey::varchar, ',' order by o_orderkey) filter (r <= 3) as examples from f group by 1, 2
"""


def normalised_records(spark, sf_dir):
    """Orders as records of an older version: the path under its old name, status missing for some."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("/old/"), "o_orderkey").alias("poscar_path_11"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("/new/"), "o_orderkey")).alias("poscar_path"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("unknown")).when(F.col("o_orderkey") % 3 == 1, F.lit("running")).alias("status"))
    return C.normalised(o).withColumn("status", states.record_status("status"))


NORMALISED_SQL = """
select o_orderkey, case when o_orderkey % 2 = 0 then '/new/' else '/old/' end || o_orderkey as poscar_path,
  case when o_orderkey % 3 = 1 then 'running' else 'planned' end as status, 'campaign.v1' as schema_version from orders
"""


def jobs(spark, sf_dir):
    """Events as jobs of three targets; the event type gives a scheduler state. Those of every seventh user have no task."""
    e = table(spark, sf_dir, "events")
    raw = F.create_map(*[F.lit(x) for x in ("view", "RUNNING", "click", "PENDING", "error", "FAILED+", "purchase", "COMPLETED", "signup", "BOOT_FAIL")])
    rows = e.select(F.concat(F.lit("t"), F.col("user_id") % 3).alias("target"), F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("key"), "user_id")).alias("task_key"), F.col("event_id").cast("string").alias("job_id"), F.element_at(raw, F.col("event_type")).alias("state"))
    return rows.withColumn("status", states.mapped_status("state", "slurm"))


JOBS = """j as (select 't' || (user_id % 3) as target, case when user_id % 7 <> 0 then 'key' || user_id end as task_key, case event_type when 'view' then 'running' when 'click' then 'submitted' when 'error' then 'failed' when 'purchase' then 'finished' else 'unknown' end as status from events)"""


def job_summary(spark, sf_dir):
    return C.job_summary(jobs(spark, sf_dir))


JOB_SQL = f"""
with {JOBS}
select target, count(*) as physical_jobs, count(distinct task_key) as unique_tasks, count(*) - count(distinct task_key) as duplicate_jobs, count(*) filter (status = 'running') as running,
  count(*) filter (status = 'submitted') as queued, count(*) filter (status = 'finished') as finished, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'unknown') as unknown
from j where task_key is not null group by 1
"""


def cross_target_summary(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("t"), "n_nationkey").alias("target"), (F.col("n_nationkey") % 4 != 1).alias("available"))
    return C.cross_target_summary(n, job_summary(spark, sf_dir))


CROSS_SQL = f"""
with {JOBS}, s as ({JOB_SQL.split(chr(10), 2)[2]}),
n as (select 't' || n_nationkey as target, n_nationkey % 4 <> 1 as available from nation)
select count(*) as targets, count(*) filter (not available) as unavailable, cast(sum(coalesce(physical_jobs, 0)) filter (available) as bigint) as physical_jobs, cast(sum(coalesce(unique_tasks, 0)) filter (available) as bigint) as unique_tasks,
  cast(sum(coalesce(duplicate_jobs, 0)) filter (available) as bigint) as duplicate_jobs, cast(sum(coalesce(running, 0)) filter (available) as bigint) as running, cast(sum(coalesce(queued, 0)) filter (available) as bigint) as queued,
  case when count(*) filter (not available) = 0 then 'available' when count(*) filter (not available) < count(*) then 'partial' else 'unavailable' end as status
from n left join s using (target)
"""


def preferred_job(spark, sf_dir):
    letters = F.create_map(*[F.lit(x) for x in ("view", "R", "click", "Q", "error", "C", "purchase", "E", "signup", "X")])
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 3000).alias("name"), "event_id", F.element_at(letters, F.col("event_type")).alias("state"))
    return C.preferred_job(e, "name", first="event_id")


PREFERRED_SQL = """
with e as (select event_id % 3000 as name, event_id, case event_type when 'view' then 'R' when 'purchase' then 'E' when 'click' then 'Q' when 'error' then 'C' else 'X' end as state from events)
select name, event_id, state from e qualify row_number() over (partition by name order by case state when 'R' then 1 when 'E' then 2 when 'Q' then 3 when 'C' then 7 else 8 end, event_id) = 1
"""


#: Raw states of schedulers, with and without suffixes.
RAW_STATES = [
    "PENDING", "CONFIGURING", "RUNNING", "RESIZING", "COMPLETING", "SUSPENDED", "COMPLETED", "FAILED", "CANCELLED", "CANCELLED by 7", "CANCELLED+", "TIMEOUT", "NODE_FAIL", "OUT_OF_MEMORY", "PREEMPTED", "BOOT_FAIL", "DEADLINE",
    "STAGE_OUT", "SIGNALING", "RESV_DEL_HOLD", "REQUEUED", "FAILED_NODE", "running ", "Q", "H", "W", "T", "R", "E", "C", "F", "S", "odd", "",
]


def state_profiles(spark, sf_dir):
    """Every raw state of the events through all profiles."""
    n = len(RAW_STATES)
    e = table(spark, sf_dir, "events").select(F.element_at(F.array(*[F.lit(x) for x in RAW_STATES]), (F.col("event_id") % n + 1).cast("int")).alias("state"), (F.col("event_id") % (2 * n) < n).cast("int").alias("code"))
    profiles = {"slurm": "slurm", "submit": "slurm_submit", "pbs": "pbs", "controller_slurm": "controller_slurm", "controller_pbs": "controller_pbs", "pbs_flow": "pbs_flow"}
    return e.groupBy("state", "code").agg(F.count("*").alias("n")).withColumns({c: states.mapped_status("state", p, "code") for c, p in profiles.items()})


PROFILES_SQL = f"""
with e as (select {RAW_STATES!r}[event_id % {len(RAW_STATES)} + 1] as state, (event_id % {2 * len(RAW_STATES)} < {len(RAW_STATES)})::int as code from events), u as (select *, upper(trim(state)) as s, regexp_extract(upper(trim(state)), '^[^ +]*') as h from e)
select state, code, count(*) as n,
  case when h in ('PENDING', 'CONFIGURING') then 'submitted' when h in ('RUNNING', 'RESIZING', 'COMPLETING', 'SUSPENDED') then 'running' when h = 'COMPLETED' then 'finished' when h in ('FAILED', 'CANCELLED', 'TIMEOUT', 'NODE_FAIL', 'OUT_OF_MEMORY', 'PREEMPTED') then 'failed' else 'unknown' end as slurm,
  case when s in ('RUNNING', 'COMPLETING', 'STAGE_OUT', 'SIGNALING', 'CONFIGURING') then 'running' when s = 'COMPLETED' then 'finished' when regexp_matches(s, '^(FAILED|CANCELLED|TIMEOUT|NODE_FAIL|OUT_OF_MEMORY|PREEMPTED|BOOT_FAIL|DEADLINE)') then 'failed' else 'submitted' end as submit,
  case when s in ('Q', 'H', 'W', 'T') then 'submitted' when s in ('R', 'E') then 'running' when s in ('C', 'F') then case when code = 0 then 'finished' else 'failed' end else 'unknown' end as pbs,
  case when s in ('PENDING', 'CONFIGURING') then 'submitted' when s in ('RUNNING', 'COMPLETING', 'SUSPENDED') then 'running' when s = 'COMPLETED' then 'finished' when s in ('FAILED', 'CANCELLED', 'TIMEOUT', 'NODE_FAIL', 'OUT_OF_MEMORY', 'PREEMPTED', 'BOOT_FAIL') then 'failed' else '' end as controller_slurm,
  case when s in ('Q', 'H', 'W', 'T') then 'submitted' when s in ('R', 'E') then 'running' when s = 'C' then 'finished' else '' end as controller_pbs,
  case when s in ('R', 'E') then 'running' when s = 'C' then case when code = 0 then 'finished' else 'failed' end else 'submitted' end as pbs_flow
from u group by 1, 2, s, h
"""


def entries(spark, sf_dir):
    """Orders as entries of four targets (one of them blank), every twelfth on a second target too."""
    o = table(spark, sf_dir, "orders").withColumn("first", F.element_at(F.array(F.lit("F"), F.lit("O"), F.lit("X"), F.lit("")), (F.col("o_orderkey") % 4 + 1).cast("int")))
    o = o.withColumn("target", F.explode(F.when(F.col("o_orderkey") % 12 == 0, F.array("first", F.lit("X"))).otherwise(F.array("first"))))
    status = F.expr("case o_orderstatus when 'F' then if(o_orderkey % 5 = 0, 'RUNNING', 'running') when 'P' then 'submitted' else 'planned' end")
    return o.select(F.concat(F.lit("system_"), F.col("o_custkey") % 50).alias("system"), F.col("o_orderkey").cast("string").alias("frame"), "target", status.alias("status"), F.concat(F.lit("j"), "o_custkey").alias("job_id"))


def scan(spark, sf_dir):
    """Line items of an order as marker rows of the target their status names; a fifth of them lies in another system."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linestatus").alias("target")).agg(F.max("l_quantity").alias("q"), F.min("l_discount").alias("d"), F.max("l_tax").alias("t"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    system = F.concat(F.when(F.col("o_orderkey") % 5 == 0, F.lit("other_")).otherwise("system_"), F.col("o_custkey") % 50)
    flags = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("target", system.alias("system"), F.col("o_orderkey").cast("string").alias("frame"), (F.col("q") > 20).alias("tag_finished"), (F.col("d") > 0.08).alias("tag_failed"), F.lit(True).alias("poscar"), (F.col("t") > 0.02).alias("outcar"), F.lit(True).alias("ediff_reached"), F.lit(True).alias("normal_footer"), F.lit("").alias("status"))
    return flags.withColumn("result", C.scan_result())


SCAN = """li as (select l_orderkey, l_linestatus as target, max(l_quantity) as q, min(l_discount) as d, max(l_tax) as t from lineitem group by 1, 2),
sc as (select target, case when o_orderkey % 5 = 0 then 'other_' else 'system_' end || (o_custkey % 50) as system, cast(o_orderkey as varchar) as frame, case when q > 20 and not d > 0.08 and t > 0.02 then 'success' when d > 0.08 then 'failed' else 'pending' end as result from li join orders on l_orderkey = o_orderkey),
oo as (select *, ['F', 'O', 'X', ''][o_orderkey % 4 + 1] as target from orders union all select *, 'X' as target from orders where o_orderkey % 12 = 0),
en as (select 'system_' || (o_custkey % 50) as system, cast(o_orderkey as varchar) as frame, target, case o_orderstatus when 'F' then case when o_orderkey % 5 = 0 then 'RUNNING' else 'running' end when 'P' then 'submitted' else 'planned' end as status, 'j' || o_custkey as job_id from oo),
ta as (select case r_regionkey when 0 then 'F' when 1 then 'O' else 'Y' || r_regionkey end as target, r_regionkey <> 1 as available from region)"""


def targets(spark, sf_dir):
    name = F.when(F.col("r_regionkey") == 0, "F").when(F.col("r_regionkey") == 1, "O").otherwise(F.concat(F.lit("Y"), "r_regionkey"))
    return table(spark, sf_dir, "region").select(name.alias("target"), (F.col("r_regionkey") != 1).alias("available"))


def archive_reconcile(spark, sf_dir):
    """Every scan row comes twice."""
    twice = scan(spark, sf_dir).unionByName(scan(spark, sf_dir))
    return C.reconciled(entries(spark, sf_dir), targets(spark, sf_dir), twice).select("system", "frame", "result", "reason")


RECONCILE_BODY = f"""
with {SCAN},
r as (select en.system, en.frame, case when ta.target is null then 'unknown_target' when not available then 'scan_failed' when sc.result is null then 'missing_remote_frame' when sc.result in ('failed', 'success') then sc.result else 'not_terminal' end as reason
  from en left join ta on en.target = ta.target left join sc on sc.target = en.target and sc.system = en.system and sc.frame = en.frame),
x as (select system, frame, case when reason in ('failed', 'success') then reason else 'pending' end as result, reason from r)
"""
RECONCILE_SQL = RECONCILE_BODY + "select * from x"


def archive_report(spark, sf_dir):
    return C.archive_report(archive_reconcile(spark, sf_dir))


REPORT_SQL = RECONCILE_BODY + """
select system, grouping(system)::int as is_total, count(*) as expected, count(*) filter (result = 'success') as successful, count(*) filter (result = 'failed') as failed, count(*) filter (result = 'pending') as pending,
  case when count(*) filter (result <> 'success') > 0 then 'partial' else 'ready' end as status
from x group by rollup (system)
"""


def cross_target_duplicates(spark, sf_dir):
    return C.duplicates_across_targets(scan(spark, sf_dir))


DUPLICATES_SQL = f"with {SCAN} select system, frame, list(distinct target order by target) as targets from sc where result = 'success' group by 1, 2 having count(distinct target) > 1"


def active_jobs(spark, sf_dir):
    """Users who viewed as active jobs of two targets; the others' events as jobs that are none of an entry's."""
    viewed = F.col("event_type") == "view"
    return table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 2 == 0, "F").otherwise("X").alias("target"), F.concat(F.when(viewed, F.lit("j")).otherwise("k"), "user_id").alias("job_id"), F.lit(None).cast("string").alias("name"))


PLAN = ["system", "frame", "target", "action", "reason", "new_status", "job_id", "recovered_previous_status"]


def recovery_plan(spark, sf_dir):
    return C.recovery_plan(entries(spark, sf_dir), targets(spark, sf_dir), scan(spark, sf_dir), active_jobs(spark, sf_dir), ["job_id"]).select(PLAN)


def recovery_one_target(spark, sf_dir):
    """With one target only, entries that name none or another are its own."""
    return C.recovery_plan(entries(spark, sf_dir), targets(spark, sf_dir).where("target = 'F'"), scan(spark, sf_dir), active_jobs(spark, sf_dir)).select(PLAN)


def _recovery_sql(entries: str) -> str:
    return f"""
with {SCAN},
ac as (select distinct case when event_id % 2 = 0 then 'F' else 'X' end as target, case event_type when 'view' then 'j' else 'k' end || user_id as id from events),
e2 as ({entries}),
p as (select e2.system, e2.frame, e2.target, e2.status, e2.job_id, sc.result,
  case when e2.target is null or available = false then 'unresolved' when sc.result in ('success', 'failed') then 'normalized_terminal' when ac.id is not null then 'preserved_active' else 'recovered_for_resubmit' end as action
  from e2 left join ta on e2.target = ta.target left join sc on sc.target = e2.target and sc.system = e2.system and sc.frame = e2.frame left join ac on ac.target = e2.target and ac.id = e2.job_id
  where lower(e2.status) in ('submitted', 'running'))
select system, frame, target, action, case when target is null then 'unknown_target' when action = 'unresolved' then 'target_unavailable' when action = 'recovered_for_resubmit' then 'scheduler_job_missing_without_terminal_marker' end as reason,
  case when action = 'normalized_terminal' then case when result = 'success' then 'finished' else 'failed' end when action = 'recovered_for_resubmit' then 'selected' else status end as new_status,
  case when action <> 'recovered_for_resubmit' then job_id end as job_id, case when action = 'recovered_for_resubmit' then status end as recovered_previous_status
from p
"""


def recovery_from_documents(spark, sf_dir):
    """Entries read from JSON documents, which name their jobs under one of six fields."""
    from atomframe.sources import records

    e = entries(spark, sf_dir).withColumn("k", F.col("frame").cast("long") % 6)
    own = F.element_at(F.array(*[F.lit(x) for x in C.IDENTIFIERS]), (F.col("k") + 1).cast("int"))
    text = F.concat(F.lit('{"entries":[{"system_name":"'), "system", F.lit('","frame":"'), "frame", F.lit('","target":"'), "target", F.lit('","status":"'), "status", F.lit('","'), own, F.lit('":"'), "job_id", F.lit('"}]}'))
    read, _ = records.campaign_entries(e.select(F.concat("frame", F.lit("/"), "target").alias("file"), text.alias("text")))
    plan = C.recovery_plan(read, targets(spark, sf_dir), scan(spark, sf_dir), active_jobs(spark, sf_dir))
    return plan.select([c for c in PLAN if c != "job_id"])


RECOVERY_SQL = _recovery_sql("select * replace (nullif(target, '') as target) from en")
RECOVERY_DOCUMENTS_SQL = f"select system, frame, target, action, reason, new_status, recovered_previous_status from ({RECOVERY_SQL})"
ONE_TARGET_SQL = _recovery_sql("select * replace ('F' as target) from en")


def workdir_keys(spark, sf_dir):
    """Orders as working directories: the task below a run root, or none."""
    path = F.expr("case o_orderkey % 5 when 0 then concat('/other/s', o_custkey, '/f', o_orderkey) when 1 then concat('/runs/a/s', o_custkey) when 2 then concat('/runs/a//s', o_custkey) else concat('/runs/a/s', o_custkey, '/f', o_orderkey, if(o_orderkey % 2 = 0, '/deep/', '')) end")
    o = table(spark, sf_dir, "orders").select("o_orderkey", path.alias("workdir"))
    return o.select("o_orderkey", task_key_below("workdir", "/runs/a/").alias("task_key"))


WORKDIR_SQL = "select o_orderkey, case when o_orderkey % 5 in (3, 4) then 's' || o_custkey || '/f' || o_orderkey else '' end as task_key from orders"

QUERIES = {f.__name__: f for f in (status_counts, unit_rollup, host_matrix, completed_campaigns, manifest_header, conversion_units, normalised_records, job_summary, cross_target_summary, preferred_job, state_profiles, archive_reconcile, archive_report, cross_target_duplicates, recovery_plan, recovery_one_target, workdir_keys)}
ORACLES = dict(zip(QUERIES, (COUNTS_SQL, ROLLUP_SQL, HOST_SQL, COMPLETED_SQL, HEADER_SQL, UNITS_SQL, NORMALISED_SQL, JOB_SQL, CROSS_SQL, PREFERRED_SQL, PROFILES_SQL, RECONCILE_SQL, REPORT_SQL, DUPLICATES_SQL, RECOVERY_SQL, ONE_TARGET_SQL, WORKDIR_SQL), strict=True))

QUERIES["recovery_from_documents"] = recovery_from_documents
ORACLES["recovery_from_documents"] = RECOVERY_DOCUMENTS_SQL
