"""Streaming queries: events as a stream of files; and text sources and sinks over texts made from the tables."""

from __future__ import annotations

import datetime
import uuid
from functools import reduce

from pyspark.sql import functions as F

from atomframe.operators import dataset
from atomframe.plans import datasets
from atomframe.session import shared_folder, table
from atomframe.sources import records, sinks
from atomframe.streaming import status as S


def events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return S.file_stream(spark, f"{sf_dir}/event*.parquet", schema)


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


RANK = "case event_type when 'purchase' then 3 when 'error' then 2 else 1 end"


def latest_status(spark, sf_dir):
    out = S.latest_status(events(spark, sf_dir).withColumn("rank", F.expr(RANK)), ["user_id"], "ts", "event_type", "rank")
    return S.drained(out, "complete", _folder(spark, "latest")).select("user_id", "status", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


LATEST_SQL = """
select user_id, arg_max(event_type, (ts, case event_type when 'purchase' then 3 when 'error' then 2 else 1 end)) as status, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as at from events group by 1
"""


def incremental_candidates(spark, sf_dir):
    """Users with a purchase, each added to the campaign once."""
    folder = _folder(spark, "campaign")
    found = events(spark, sf_dir).where("event_type = 'purchase' and user_id % 3 = 0").select("user_id")
    query = found.writeStream.foreachBatch(S.add_new(f"{folder}/table", ["user_id"])).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("user_id long").parquet(f"{folder}/table")


CANDIDATES_SQL = "select distinct user_id from events where event_type = 'purchase' and user_id % 3 = 0"


def inactivity(spark, sf_dir):
    out = S.inactivity(events(spark, sf_dir), "ts", "6 hours", "1 hour", "user_id")
    return _times(S.drained(out, "append", _folder(spark, "inactivity")), "active_from", "silent_at")


def _times(df, *names):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in names})


INACTIVITY_SQL = """
with e as (select user_id, ts, coalesce(ts - lag(ts) over (partition by user_id order by ts) >= interval 6 hour, true) as fresh from events),
s as (select *, sum(fresh::int) over (partition by user_id order by ts rows unbounded preceding) as k from e),
w as (select user_id, min(ts) as a, max(ts) + interval 6 hour as b, count(*) as events from s group by user_id, k)
select user_id, strftime(a, '%Y-%m-%d %H:%M:%S') as active_from, strftime(b, '%Y-%m-%d %H:%M:%S') as silent_at, events from w where b <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)
"""


def periodic_counts(spark, sf_dir):
    out = S.periodic_counts(events(spark, sf_dir), "ts", "event_type", ["purchase", "signup"], "3 hours", "1 hour")
    return _times(S.drained(out, "append", _folder(spark, "counts")), "start", "end")


COUNTS_SQL = """
with w as (select time_bucket(interval 3 hour, ts, timestamp '2000-01-01') as a, count(*) as total, count(*) filter (event_type in ('purchase', 'signup')) as finished from events group by 1)
select strftime(a, '%Y-%m-%d %H:%M:%S') as start, strftime(a + interval 3 hour, '%Y-%m-%d %H:%M:%S') as "end", total, finished, total - finished as unfinished from w where a + interval 3 hour <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)
"""


def sliding_counts(spark, sf_dir):
    out = S.periodic_counts(events(spark, sf_dir), "ts", "event_type", ["purchase"], "6 hours", "0 seconds", "3 hours")
    return _times(S.drained(out, "append", _folder(spark, "sliding")), "start", "end")


SLIDING_SQL = """
with b as (select time_bucket(interval 3 hour, ts, timestamp '2000-01-01') as x, event_type from events), s as (select x as a, event_type from b union all select x - interval 3 hour, event_type from b),
w as (select a, count(*) as total, count(*) filter (event_type = 'purchase') as finished from s group by 1)
select strftime(a, '%Y-%m-%d %H:%M:%S') as start, strftime(a + interval 6 hour, '%Y-%m-%d %H:%M:%S') as "end", total, finished, total - finished as unfinished from w where a + interval 6 hour <= (select date_trunc('millisecond', max(ts)) from events)
"""


def duplicate_jobs(spark, sf_dir):
    named = events(spark, sf_dir).select(F.to_date("ts").cast("string").alias("snapshot"), (F.col("user_id") % 3).alias("target"), "user_id")
    return S.drained(S.duplicate_jobs(named, "snapshot", "target", "user_id"), "complete", _folder(spark, "duplicates"))


DUPLICATE_SQL = "select cast(cast(ts as date) as varchar) as snapshot, user_id % 3 as target, user_id, count(*) as jobs from events group by 1, 2, 3 having count(*) > 1"


def log_metrics(spark, sf_dir):
    """Logs made from orders: one for each customer, with a marker line and numbers before and after it."""
    o = table(spark, sf_dir, "orders")
    kind = F.expr("case o_orderkey % 4 when 0 then concat('number of test data : ', o_orderkey % 90) when 1 then concat('Force RMSE : ', o_orderkey, 'e-2 eV/A') when 2 then '# ----------weighted average of errors----------' else 'noise' end")
    rows = o.select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("line"), kind.alias("value"))
    out = records.log_metrics(rows, {"Force RMSE": "force_rmse"}, "weighted average")
    return records.with_mev(out, ["force_rmse"]).withColumns({c: F.round(c, 6) for c in ("force_rmse", "force_rmse_meV")})


LOG_SQL = """
with o as (select o_custkey as file, o_orderkey as line from orders), m as (select file, min(line) filter (line % 4 = 2) as m from o group by 1), j as (select * from o join m using (file))
select file, cast(sum(line % 90) filter (line % 4 = 0 and coalesce(line < m, true)) as bigint) as frames, count(*) filter (line % 4 = 0 and coalesce(line < m, true)) as groups,
  round(max(line) filter (line % 4 = 1 and line > m) / 100, 6) as force_rmse, round(max(line) filter (line % 4 = 1 and line > m) * 10.0, 6) as force_rmse_meV
from j group by 1
"""


def progress_logs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    value = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("total=100 submitted="), F.col("o_orderkey") % 20, F.lit(" running=5 finished="), F.col("o_orderkey") % 50, F.lit(" failed=1"))).otherwise("working")
    return records.progress(o.select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("line"), value.alias("value")), window=5000)


PROGRESS_SQL = """
with o as (select o_custkey as file, o_orderkey as line from orders), e as (select file, max(line) as last, max(line) filter (line % 3 = 0) as line from o group by 1)
select file, line, 100::bigint as total, line % 20 as submitted, 5::bigint as running, line % 50 as finished, 1::bigint as failed, greatest(100 - line % 20 - 5 - line % 50 - 1, 0) as planned from e where line > last - 5000
"""


def campaign_documents(spark, sf_dir):
    """Campaign documents made from orders, one for each customer: entries, records or neither."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.create_map(F.lit("system_name"), F.concat(F.lit("s"), F.col("o_custkey") % 7), F.lit("frame_name"), F.col("o_orderkey").cast("string"), F.lit("status"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(" ")).otherwise("running"), F.lit("price"), F.col("o_orderkey").cast("string")).alias("e"))
    lists = o.groupBy("o_custkey").agg(F.to_json(F.collect_list("e")).alias("j"))
    key = F.when(F.col("o_custkey") % 3 == 0, F.lit("entries")).when(F.col("o_custkey") % 3 == 1, F.lit("records")).otherwise("rows")
    texts = lists.select(F.col("o_custkey").alias("file"), F.concat(F.lit('{"'), key, F.lit('":'), "j", F.lit("}")).alias("text"))
    entries, _ = records.campaign_entries(texts)
    return entries.select("file", "system", "frame", "status", F.col("extras")["price"].alias("price"))


DOCUMENTS_SQL = """
select o_custkey as file, 's' || (o_custkey % 7) as system, cast(o_orderkey as varchar) as frame, case when o_orderkey % 5 <> 0 then 'running' end as status, cast(o_orderkey as varchar) as price from orders where o_custkey % 3 <> 2
"""


def job_snapshots(spark, sf_dir):
    """Scheduler texts made from events, one for each user, in the five layouts in turn: the jobs read back."""
    e = table(spark, sf_dir, "events").withColumn("kind", F.col("user_id") % 5)
    line = F.expr("""case kind
      when 0 then concat_ws(' ', event_id, 'main', concat('n', event_id), upper(event_type), '1:00')
      when 1 then concat_ws('|', event_id, concat('n', event_id), event_type)
      when 2 then concat(event_id, '.server u x  n', event_id, ' ', upper(event_type), ' main')
      when 3 then concat('Job Id: ', event_id, '.server\n    Job_Name = n', event_id, '\n    job_state = ', event_type, '\n    queue = main\n    Variable_List = A=1,PBS_O_WORKDIR=/runs/\n\t', user_id, ',\n        B=2')
      else concat('JobId=', event_id, ' JobName=n', event_id, ' JobState=', upper(event_type), ' Partition=main WorkDir=/runs/', user_id) end""")
    head = F.expr("case kind when 0 then 'JOBID PARTITION NAME STATE TIME\n' when 1 then 'JOBID|NAME|STATE\n' when 2 then 'Job id Name User Time Use S Queue\n------ ---- ----\n' else '' end")
    texts = e.groupBy("kind", F.col("user_id").alias("file")).agg(F.array_join(F.collect_list(line), "\n").alias("body")).select("kind", "file", F.concat(head, "body").alias("text"))
    kinds = ("squeue", "squeue_pipes", "qstat", "qstat_full", "scontrol")
    return reduce(lambda a, b: a.unionByName(b), [records.job_rows(texts.where(F.col("kind") == k), name) for k, name in enumerate(kinds)])


JOBS_SQL = """
select user_id as file, event_id || case when user_id % 5 = 3 then '.server' else '' end as job_id, 'n' || event_id as name, upper(event_type) as state,
  case when user_id % 5 in (1, 2) then '' else 'main' end as queue, case when user_id % 5 in (3, 4) then '/runs/' || user_id else '' end as workdir from events
"""


def exclusion_lists(spark, sf_dir):
    """Exclusion lines made from customers, read back."""
    c = table(spark, sf_dir, "customer")
    value = F.expr("case c_custkey % 5 when 0 then concat('task_key: system_', c_custkey, '__frame_1') when 1 then concat('path: /data/', c_custkey, '/POSCAR # kept') when 2 then '# only a comment' when 3 then concat('/x/system_', c_custkey, '/frame_22/POSCAR') else c_name end")
    return records.exclusions(c.select(F.col("c_custkey").alias("line"), value.alias("value"))).select("line", "kind", "key")


EXCLUSION_SQL = """
select c_custkey as line, case c_custkey % 5 when 0 then 'task_key' when 1 then 'path' when 3 then 'task_key' else 'unresolved' end as kind,
  case c_custkey % 5 when 0 then 'system_' || c_custkey || '/frame_1' when 1 then '/data/' || c_custkey || '/POSCAR' when 3 then 'system_' || c_custkey || '/frame_22' end as key
from customer where c_custkey % 5 <> 2
"""


def exclusion_export(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("system_"), "o_custkey").alias("system"), F.concat(F.lit("frame_"), "o_orderkey").alias("frame"), F.expr("case o_orderstatus when 'F' then 'finished' when 'P' then '' else 'running' end").alias("status"))
    return sinks.exclusion_lines(o, ["finished"])


EXPORT_SQL = "select distinct 'task_key:system_' || o_custkey || '/frame_' || o_orderkey as value from orders where o_orderstatus in ('F', 'P')"


def system_manifests(spark, sf_dir):
    """A manifest made from suppliers with an index gap and a repeated path: what is wrong with it."""
    s = table(spark, sf_dir, "supplier").select(F.expr("cast(if(s_suppkey = 5, 6, s_suppkey) as string)").alias("index"), F.concat(F.lit("/s/"), F.when(F.col("s_suppkey") == 9, 8).otherwise(F.col("s_suppkey"))).alias("system_path"), F.lit("").alias("block"), F.lit(None).cast("string").alias("label"), F.lit('["O","H"]').alias("elements"), F.lit("[1,2]").alias("counts"), F.lit("7").alias("frames"), F.lit("3").alias("natoms"))
    return records.system_manifest(s)[1]


MANIFEST_SQL = """
with s as (select case when s_suppkey = 5 then 6 else s_suppkey end as i, case when s_suppkey = 9 then 8 else s_suppkey end as p from supplier)
select 'index_not_contiguous' as code from s having min(i) <> 0 or max(i) <> count(*) - 1 or count(distinct i) <> count(*) union all select 'path_repeated' from s having count(distinct p) < count(*)
"""


def xyz_text_export(spark, sf_dir):
    """Embeddings as frames of two atoms, as extended XYZ."""
    v = lambda a, n: f"transform(slice(embedding, {a}, {n}), x -> cast(x as double))"
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.lit(2).alias("natoms"), F.array(F.lit(1), F.lit(0)).alias("types"), F.array(F.lit("O"), F.lit("H")).alias("type_map"), F.expr(v(1, 6)).alias("coord"), F.expr(v(7, 6)).alias("force"), F.expr(v(13, 9)).alias("box"), F.lit(None).cast("double").alias("energy"), F.lit(None).cast("array<double>").alias("virial"))
    return sinks.extended_xyz(e, digits=4).select("vec_id", "xyz")


XYZ_SQL = """
with e as (select vec_id, [format('{:.4f}', x::double) for x in embedding] as s from embeddings)
select vec_id, '2' || chr(10) || 'energy=0.0000 config_type=unlabeled pbc="T T T" Lattice="' || array_to_string(s[13:21], ' ') || '" Properties=species:S:1:pos:R:3:force:R:3' || chr(10)
  || 'H ' || array_to_string(s[1:3], ' ') || ' ' || array_to_string(s[7:9], ' ') || chr(10) || 'O ' || array_to_string(s[4:6], ' ') || ' ' || array_to_string(s[10:12], ' ') as xyz from e
"""


def frame_archive(spark, sf_dir):
    """The frames of the embeddings, archived in another order of types: index, system and types of each."""
    types = F.expr("transform(sequence(0, 19), i -> (i + cast(vec_id as int)) % 2)")
    frames = datasets.frames(spark, sf_dir).withColumns({"frame_in_set": F.col("vec_id").cast("int"), "types": types})
    out, _, _ = sinks.archive_frames(frames, ["H", "O"])
    return out.select("frame_index", "system_id", "vec_id", F.array_join("types", "").alias("types"))


ARCHIVE_SQL = """
with f as (select vec_id, 'sys' || label as system_path, vec_id % 3 as s from embeddings)
select row_number() over (order by system_path, s, vec_id) - 1 as frame_index, dense_rank() over (order by system_path) - 1 as system_id, vec_id, repeat(case when vec_id % 2 = 0 then '10' else '01' end, 10) as types from f
"""


def archive_validation(spark, sf_dir):
    """Codes for an archive of embeddings with a gap in its index, metadata that know one system less, and frames that
    are not right."""
    frames = datasets.frames(spark, sf_dir).withColumns({"frame_index": F.col("vec_id") + F.when(F.col("vec_id") > 100, 1).otherwise(0), "system_id": F.substr("system_path", F.lit(4)).cast("int")})
    meta = frames.where("system_id > 0").agg(F.count("*").alias("nframes"), F.count_distinct("system_id").alias("nsystems")).withColumn("type_map", F.array(*map(F.lit, ("O", "H", "O"))))
    return dataset.validate_archive(frames, meta)


ARCHIVE_VALIDATION_SQL = f"""
with v as ({datasets.VALIDATION_SQL}), i as (select vec_id + (vec_id > 100)::int as k, label from embeddings), m as (select count(*) as n, count(distinct label) as s from i where label > 0),
t as (select count(*) as n, min(k) as lo, max(k) as hi, count(distinct k) as d, min(label) as s0, max(label) as s1 from i)
select 'entry_count' as code, 1::bigint as n from t, m where t.n <> m.n union all select 'index_not_contiguous', 1 from t where lo <> 0 or hi <> n - 1 or d <> n
union all select 'system_id_out_of_range', 1 from t, m where s0 < 0 or s1 >= m.s union all select 'type_map_not_unique', 1 where len(list_distinct(['O', 'H', 'O'])) <> 3 union all select code, frames from v
"""

def silent_users(spark, sf_dir):
    """Users silent for six hours, by timers; a signup ends a user's activity without a word."""
    rows = events(spark, sf_dir).withColumn("over", F.col("event_type") == "signup")
    out = S.silences(rows, ["user_id"], "ts", datetime.timedelta(hours=6), "1 hour", "over")
    return _times(S.drained(out, "append", _folder(spark, "silences")), "active_from", "silent_at")


SILENT_SQL = """
with e as (select user_id, ts, event_type = 'signup' as over from events), f as (select *, coalesce(over or lag(over) over w or ts - lag(ts) over w >= interval 6 hour, true) as fresh from e window w as (partition by user_id order by ts, over)),
s as (select *, sum(fresh::int) over (partition by user_id order by ts, over rows unbounded preceding) as k from f), n as (select *, lead(over) over (partition by user_id order by ts, over) as ended, lead(ts) over (partition by user_id order by ts, over) as after from s),
w as (select user_id, min(ts) as a, max(ts) as z, count(*) as events, bool_or(over) as over, arg_max(coalesce(ended and after - ts < interval 6 hour, false), ts) as told from n group by user_id, k)
select user_id, strftime(a, '%Y-%m-%d %H:%M:%S') as active_from, strftime(z + interval 6 hour, '%Y-%m-%d %H:%M:%S') as silent_at, events from w
where not over and not told and z + interval 6 hour <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)
"""


def _seen(spark, sf_dir, precedence):
    """Clicks and errors as records, views as job snapshots of the same user up to 3 hours later."""
    e = events(spark, sf_dir)
    tags = F.expr("case when event_id % 3 = 0 then '' when event_type = 'error' then 'failed' else 'finished' end").alias("status")
    scheduler = F.expr("case event_id % 4 when 0 then '' when 1 then 'submitted' else 'running' end").alias("status")
    out = S.seen_status(e.where("event_type in ('click', 'error')").select("user_id", "ts", tags), events(spark, sf_dir).where("event_type = 'view'").select("user_id", "ts", scheduler), "user_id", "3 hours", "1 hour", precedence)
    return _times(S.drained(out, "append", _folder(spark, "seen")), "ts", "snapshot").select("user_id", "ts", "snapshot", "status")


def seen_by_tags(spark, sf_dir):
    return _seen(spark, sf_dir, "tags")


def seen_by_scheduler(spark, sf_dir):
    return _seen(spark, sf_dir, "scheduler")


def _seen_sql(first, second):
    return f"""
with a as (select user_id, ts, case when event_id % 3 = 0 then '' when event_type = 'error' then 'failed' else 'finished' end as tags from events where event_type in ('click', 'error')),
b as (select user_id, ts as snapshot, case event_id % 4 when 0 then '' when 1 then 'submitted' else 'running' end as scheduler from events where event_type = 'view'),
m as (select least(max(ts) filter (event_type in ('click', 'error')), max(ts) filter (event_type = 'view')) - interval 1 hour as mark from events),
j as (select a.user_id, ts, snapshot, tags, scheduler from a left join b on a.user_id = b.user_id and snapshot between ts and ts + interval 3 hour)
select user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, strftime(snapshot, '%Y-%m-%d %H:%M:%S') as snapshot, coalesce(nullif({first}, ''), nullif({second}, ''), '') as status from j, m where snapshot is not null or ts + interval 3 hour < mark
"""


def deduplicated_users(spark, sf_dir):
    """Each user once within the watermark (two weeks, so once), of frames by their stride."""
    named = events(spark, sf_dir).withColumn("frame", F.concat(F.lit("frame_"), "user_id"))
    out = S.new_keys(S.strided(named, "frame", 3, 1), ["user_id"], "ts", "60 days").select("user_id", "frame")
    return S.drained(out, "append", _folder(spark, "keys"))


DEDUPLICATED_SQL = "select distinct user_id, 'frame_' || user_id as frame from events where user_id >= 1 and (user_id - 1) % 3 = 0"

QUERIES = {f.__name__: f for f in (latest_status, incremental_candidates, inactivity, periodic_counts, sliding_counts, duplicate_jobs, log_metrics, progress_logs, campaign_documents, job_snapshots, exclusion_lists, exclusion_export, system_manifests, xyz_text_export, frame_archive, archive_validation)}
ORACLES = dict(zip(QUERIES, (LATEST_SQL, CANDIDATES_SQL, INACTIVITY_SQL, COUNTS_SQL, SLIDING_SQL, DUPLICATE_SQL, LOG_SQL, PROGRESS_SQL, DOCUMENTS_SQL, JOBS_SQL, EXCLUSION_SQL, EXPORT_SQL, MANIFEST_SQL, XYZ_SQL, ARCHIVE_SQL, ARCHIVE_VALIDATION_SQL), strict=True))
QUERIES |= {f.__name__: f for f in (silent_users, seen_by_tags, seen_by_scheduler, deduplicated_users)}
ORACLES |= {"silent_users": SILENT_SQL, "seen_by_tags": _seen_sql("tags", "scheduler"), "seen_by_scheduler": _seen_sql("scheduler", "tags"), "deduplicated_users": DEDUPLICATED_SQL}
