"""Queries on files: fixtures made from the tables are written to the shared folder and read back, or worked on by jobs."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import functions as F

from atomframe import session
from atomframe.operators import dataset, inference, jobs, select
from atomframe.session import shared_folder, table
from atomframe.sources import discovery, groups, records, sinks, structures, trajectories, versions

CONVERGED, FOOTER = structures.CONVERGED, structures.FOOTER


def folder(spark, name: str) -> str:
    """A new folder below the shared one, as a path that tools outside Spark can open too."""
    return re.sub("^file:/+", "/", f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")


def vectors(spark, sf_dir):
    """Embeddings with their components as doubles."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.expr("transform(embedding, x -> cast(x as double))").alias("v"))


V = "v as (select vec_id, label, [x::double for x in embedding] as v from embeddings)"


def frames(spark, sf_dir):
    """Embeddings as frames of two compositions (2 and 3 atoms), in systems by label and sets by a third."""
    n = F.when(F.col("vec_id") % 2 == 0, 2).otherwise(3)
    return vectors(spark, sf_dir).select(
        F.concat(F.lit("sys"), "label").alias("system_path"), F.concat(F.lit("set.00"), F.col("vec_id") % 3).alias("set_name"), F.col("vec_id").cast("int").alias("frame_in_set"), n.alias("natoms"),
        F.expr("if(vec_id % 2 = 0, array(0, 1), array(0, 1, 1))").alias("types"), F.array(F.lit("O"), F.lit("H")).alias("type_map"),
        F.slice("v", F.lit(1), 3 * n).alias("coord"), F.slice("v", 11, 9).alias("box"), F.col("v")[20].alias("energy"), F.slice("v", F.lit(30), 3 * n).alias("force"), F.slice("v", 41, 9).alias("virial"),
    )


def group_files(spark, sf_dir):
    """Frames written as sets of at most 60 frames for each composition, and read back by the source."""
    out = folder(spark, "groups")
    groups.write_groups(frames(spark, sf_dir), out, frames_per_set=60)
    back = groups.read_frame_groups(spark, [out], framesPerPartition="25")
    return back.select(F.element_at(F.split("system_path", "/"), -1).alias("group_name"), "set_name", "frame_in_set", "natoms", "energy", F.col("coord")[3].alias("x"), F.element_at("force", -1).alias("fz"), F.col("virial")[8].alias("w"), "error")


GROUP_FILES_SQL = f"""
with {V}, f as (select *, case when vec_id % 2 = 0 then 2 else 3 end as natoms, row_number() over (partition by vec_id % 2 order by 'sys' || label, vec_id % 3, vec_id) - 1 as k from v)
select case natoms when 2 then 'group_001_n2_o_h' else 'group_002_n3_o_h' end as group_name, 'set.' || lpad(cast(k // 60 as varchar), 3, '0') as set_name, (k % 60)::int as frame_in_set, natoms, v[21] as energy, v[4] as x,
  v[29 + 3 * natoms] as fz, v[49] as w, null::varchar as error from f
"""


def group_summaries(spark, sf_dir):
    """The text files and summaries of written groups: frames, composition, and the sum of the energies in energy.raw."""
    out = folder(spark, "raw")
    rows = groups.write_raw(groups.write_groups(frames(spark, sf_dir), out, frames_per_set=100), out)
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "energy.raw").text(out)
    sums = raw.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("group_name")).agg(F.round(F.sum(F.col("value").cast("double")), 6).alias("energy"))
    return rows.join(sums, "group_name").select("group_name", "frames", "natoms", F.array_join("elements", ",").alias("elements"), F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"), "energy")


GROUP_SUMMARIES_SQL = f"""
with {V} select case when vec_id % 2 = 0 then 'group_001_n2_o_h' else 'group_002_n3_o_h' end as group_name, count(*) as frames, case when vec_id % 2 = 0 then 2 else 3 end as natoms, 'O,H' as elements,
  case when vec_id % 2 = 0 then '1,1' else '1,2' end as counts, round(sum(v[21]), 6) as energy from v group by vec_id % 2
"""


def structure_texts(spark, sf_dir):
    """A structure file for each embedding: three atoms, Direct or Cartesian; every tenth has an unknown mode, others a
    missing row or element."""
    row = lambda a: F.concat_ws(" ", *[F.col("v")[a + k].cast("string") for k in range(3)])
    mode = F.expr("case when vec_id % 10 = 9 then 'Foo' when vec_id % 2 = 0 then 'direct' else 'Cartesian' end")
    names = F.when(F.col("vec_id") % 10 == 8, "O X").otherwise("O H")
    rows = F.when(F.col("vec_id") % 10 == 7, F.concat_ws("\n", row(0), row(3))).otherwise(F.concat_ws("\n", row(0), row(3), row(6)))
    text = F.concat_ws("\n", F.lit("title"), F.lit("2.0"), F.lit("1 0 0"), F.lit("0 2 0"), F.lit("0 0 4"), names, F.lit("1 2"), mode, rows)
    return vectors(spark, sf_dir).select("vec_id", "v", "label", text.alias("text"))


def structure_files(spark, sf_dir):
    out = folder(spark, "structures")
    sinks.write_texts(structure_texts(spark, sf_dir).select(F.concat(F.lit("s/"), "vec_id", F.lit("/POSCAR")).alias("path"), "text"), out)
    back = structures.read_structures(spark, out, type_map=["H", "O"])
    return back.select(F.element_at(F.split("path", "/"), -2).cast("long").alias("vec_id"), "natoms", F.array_join("elements", ",").alias("elements"), F.round(F.col("coord")[4], 6).alias("y"), F.round(F.col("coord")[8], 6).alias("z"), F.array_join("types", "").alias("types"), F.col("error").isNotNull().alias("failed"))


STRUCTURE_FILES_SQL = f"""
with {V}, s as (select *, vec_id % 10 in (7, 8, 9) as failed from v)
select vec_id, case when not failed then 3 end as natoms, case when not failed then 'O,H' end as elements, case when not failed then round(v[5] * case when vec_id % 2 = 0 then 4 else 2 end, 6) end as y,
  case when not failed then round(v[9] * case when vec_id % 2 = 0 then 8 else 2 end, 6) end as z, case when not failed then '100' end as types, failed from s
"""


def output_text(atoms: int = 3):
    """An output of two blocks, of which the last counts; every eleventh is cut off in its force table."""
    v = F.col("v")
    cells = lambda a, n: F.concat_ws(" ", *[v[a + k].cast("string") for k in range(n)])
    table_rows = [cells(20 + 6 * k, 6) for k in range(atoms)]
    rows = F.when(F.col("vec_id") % 11 == 5, F.concat_ws("\n", *table_rows[:-1])).otherwise(F.concat_ws("\n", *table_rows, F.lit(" ----")))
    block = lambda e, rows: F.concat_ws("\n", F.concat(F.lit("  free  energy   TOTEN  =  "), e, F.lit(" eV")), F.lit("VOLUME and BASIS-vectors are now :\na\nb\nc\nd"), cells(0, 6), cells(3, 6), cells(6, 6), F.concat(F.lit("  Total  "), cells(10, 6)), F.lit(" POSITION    TOTAL-FORCE (eV/Angst)\n ----"), rows)
    return F.concat_ws("\n", F.lit("header"), block(F.lit("0.5"), F.concat_ws("\n", *table_rows, F.lit(" ----"))), block(v[18].cast("decimal(20,12)").cast("string"), rows), F.lit(CONVERGED), F.lit(FOOTER))


def output_files(spark, sf_dir):
    out = folder(spark, "outputs")
    sinks.write_texts(vectors(spark, sf_dir).select(F.concat(F.lit("c"), "vec_id", F.lit("/OUTCAR")).alias("path"), output_text().alias("text")), out)
    back = structures.read_calc_outputs(spark, out)
    return back.select(F.substr(F.element_at(F.split("path", "/"), -2), F.lit(2)).cast("long").alias("vec_id"), "natoms", F.round("energy", 6).alias("energy"), F.col("box")[5].alias("box5"), F.col("coord")[6].alias("x2"), F.col("force")[8].alias("fz2"), F.col("virial")[2].alias("zx"), F.col("error").isNotNull().alias("failed"))


OUTPUT_FILES_SQL = f"""
with {V}, s as (select *, vec_id % 11 = 5 as failed from v)
select vec_id, case when not failed then 3 end as natoms, case when not failed then round(v[19], 6) end as energy, case when not failed then v[6] end as box5, case when not failed then v[33] end as x2, case when not failed then v[38] end as fz2,
  case when not failed then v[16] end as zx, failed from s
"""


def trajectory_files(spark, sf_dir):
    """Trajectories of three frames with a tail that is cut off in every fourth."""
    atom = lambda a: F.concat_ws(" ", F.lit("H"), *[F.col("v")[a + k].cast("string") for k in range(3)])
    one = lambda a: F.concat_ws("\n", F.lit("2"), F.concat(F.lit("comment "), "vec_id"), atom(a), atom(a + 3))
    tail = F.when(F.col("vec_id") % 4 == 0, F.concat_ws("\n", F.lit("2"), F.lit("cut"), atom(12))).otherwise(one(12))
    out = folder(spark, "xyz")
    sinks.write_texts(vectors(spark, sf_dir).select(F.concat("vec_id", F.lit(".xyz")).alias("path"), F.concat_ws("\n", one(0), one(6), tail).alias("text")), out)
    back = structures.read_xyz_frames(spark, out)
    return back.select(F.regexp_extract("path", r"(\d+)\.xyz$", 1).cast("long").alias("vec_id"), "frame", "natoms", "comment", F.array_join("species", "").alias("species"), F.col("coord")[5].alias("z"))


TRAJECTORY_SQL = f"""
with {V}, f as (select *, unnest([0, 1, 2]) as frame from v)
select vec_id, frame, 2 as natoms, 'comment ' || vec_id as comment, 'HH' as species, v[6 * frame + 6] as z from f where frame < 2 or vec_id % 4 <> 0
"""


def long_trajectories(spark, sf_dir):
    """Trajectories of up to 200 frames, a few of whose comments look like counts, read in ranges of 4000 bytes; every third
    file has a frame in its middle that is cut off, which ends it."""
    atom = lambda a: F.concat_ws(" ", F.lit("H"), *[F.col("v")[a + k].cast("string") for k in range(3)])
    comment = F.when(F.col("vec_id") % 5 == 0, "1").otherwise(F.concat(F.lit("step "), "vec_id"))
    cut = (F.expr("vec_id div 200") % 3 == 2) & (F.col("vec_id") % 200 == 120)
    one = F.when(cut, F.concat_ws("\n", F.lit("2"), comment, atom(0))).otherwise(F.concat_ws("\n", F.lit("2"), comment, atom(0), atom(3)))
    each = vectors(spark, sf_dir).select(F.expr("vec_id div 200").alias("file"), F.struct("vec_id", one.alias("text")).alias("frame"))
    texts = each.groupBy("file").agg(F.array_sort(F.collect_list("frame")).alias("f"))
    out = folder(spark, "long-xyz")
    sinks.write_texts(texts.select(F.concat("file", F.lit(".xyz")).alias("path"), F.array_join("f.text", "\n").alias("text")), out)
    back = trajectories.read_xyz_frames(spark, out, range_bytes=4000)
    return back.select(F.regexp_extract("path", r"(\d+)\.xyz$", 1).cast("long").alias("file"), "frame", "natoms", "comment", F.col("coord")[5].alias("z"))


LONG_TRAJECTORIES_SQL = f"""
with {V}, f as (select *, vec_id // 200 as file, (row_number() over (partition by vec_id // 200 order by vec_id) - 1)::int as frame from v)
select file, frame, 2 as natoms, case when vec_id % 5 = 0 then '1' else 'step ' || vec_id end as comment, v[6] as z from f where file % 3 <> 2 or vec_id % 200 < 120
  or not exists (select 1 from v c where c.vec_id = file * 200 + 120)
"""


def run_records(spark, sf_dir):
    """Run records of suppliers: in the frame's folder, among the collected records, in both places, or unreadable."""
    s = table(spark, sf_dir, "supplier").withColumn("k", F.col("s_suppkey") % 4)
    system, frame = F.concat(F.lit("system_"), F.col("s_nationkey")), F.concat(F.lit("frame_"), "s_suppkey")
    text = lambda status: F.concat(F.lit('{\n"status":"'), status, F.lit('",\n"sampling":{"start":1,"stride":2,"count":'), "s_suppkey", F.lit('},"paths":{"poscar":"/p/'), "s_suppkey", F.lit('"}}'))
    own = s.where("k <> 1").select(F.concat(system, F.lit("/"), frame, F.lit("/frame_info.json")).alias("path"), F.when(F.col("k") == 3, "{").otherwise(text(F.lit("running"))).alias("text"))
    kept = s.where("k in (1, 2)").select(F.concat(system, F.lit("/frame_records/"), frame, F.lit(".json")).alias("path"), text(F.lit("finished")).alias("text"))
    out = folder(spark, "records")
    sinks.write_texts(own.unionByName(kept), out)
    last = select.last_wins(records.read_run_records(spark, out).select("system", "frame", "status", "sampling", "paths", "unreadable", "place"), ["system", "frame"], ["place"])
    return last.select("system", "frame", "status", F.col("sampling.count").cast("long").alias("n"), F.col("paths")["poscar"].alias("poscar"), "unreadable")


RUN_RECORDS_SQL = """
select 'system_' || s_nationkey as system, 'frame_' || s_suppkey as frame, case s_suppkey % 4 when 0 then 'running' when 3 then null else 'finished' end as status, case when s_suppkey % 4 <> 3 then s_suppkey end as n,
  case when s_suppkey % 4 <> 3 then '/p/' || s_suppkey end as poscar, s_suppkey % 4 = 3 as unreadable from supplier
"""


def calculation_files(spark, sf_dir):
    """A folder for each embedding with its marker files, structure and output."""
    s = structure_texts(spark, sf_dir).withColumn("base", F.concat(F.lit("system_"), "label", F.lit("/frame_"), "vec_id", F.lit("/")))
    every = F.array(
        F.struct(F.lit("POSCAR").alias("name"), F.col("text").alias("body")),
        F.struct(F.lit("OUTCAR").alias("name"), output_text().alias("body")),
        F.struct(F.when(F.col("vec_id") % 3 != 0, "tag_finished").alias("name"), F.lit("").alias("body")),
        F.struct(F.when(F.col("vec_id") % 13 == 0, "tag_failed").alias("name"), F.lit("").alias("body")),
        F.struct(F.when(F.col("vec_id") % 2 == 0, "task_info.json").alias("name"), F.expr("""case when vec_id % 4 = 0 then '{"status": " Finished"}' when vec_id % 14 = 6 then '{"status": "FAILED"}' when vec_id % 14 = 10 then '{"status": ""}' else '{"status": "running"}' end""").alias("body")),
        F.struct(F.when(F.col("vec_id") % 5 < 2, "frame_info.json").alias("name"), F.expr("""if(vec_id % 5 = 0, '{\n  "status": "failed"\n}', '{\n  "status": "planned"\n}')""").alias("body")),
    )
    out = folder(spark, "calculations")
    sinks.write_texts(s.select("base", F.explode(every).alias("f")).where("f.name is not null").select(F.concat("base", "f.name").alias("path"), F.col("f.body").alias("text")), out)
    return out


def marker_scan(spark, sf_dir):
    from atomframe.operators import campaign

    rows = structures.scan_markers(spark, calculation_files(spark, sf_dir), "t").withColumn("result", campaign.scan_result())
    return rows.select("system", "frame", "tag_finished", "tag_failed", "task_info", "frame_info", "ediff_reached", "normal_footer", "task_status", "status", "result")


MARKER_SCAN_SQL = """
with e as (select *, case when vec_id % 4 = 0 then 'finished' when vec_id % 2 = 1 then null when vec_id % 14 = 6 then 'failed' when vec_id % 14 = 10 then '' else 'running' end as task_status, case vec_id % 5 when 0 then 'failed' when 1 then 'planned' end as frame_status from embeddings),
s as (select *, coalesce(nullif(task_status, ''), frame_status, '') as status from e)
select 'system_' || label as system, 'frame_' || vec_id as frame, vec_id % 3 <> 0 as tag_finished, vec_id % 13 = 0 as tag_failed, vec_id % 2 = 0 as task_info, vec_id % 5 < 2 as frame_info, true as ediff_reached, true as normal_footer,
  task_status, status, case when vec_id % 13 = 0 then 'failed' when vec_id % 3 <> 0 then 'success' when status = 'failed' then 'failed' else 'pending' end as result from s
"""


def converted_dataset(spark, sf_dir):
    """The job that converts calculations with a finished tag: frames of the dataset, read back."""
    out = folder(spark, "converted")
    jobs.converted_calculations(spark, calculation_files(spark, sf_dir), out, ["H", "O", "X"], require_tag=True, frames_per_set=40)
    back = groups.read_frame_groups(spark, [out])
    return back.select(F.element_at(F.split("system_path", "/"), -1).alias("group_name"), F.round("energy", 6).alias("energy"), F.col("force")[8].alias("fz2"), F.array_join("types", "").alias("types"))


CONVERTED_SQL = f"""
with {V}
select case when vec_id % 10 = 8 then 'group_002_n3_o_x' else 'group_001_n3_o_h' end as group_name, round(v[19], 6) as energy, v[38] as fz2, case when vec_id % 10 = 8 then '122' else '100' end as types
from v where vec_id % 3 <> 0 and vec_id % 11 <> 5 and vec_id % 10 not in (7, 9)
"""


def conversion_summary(spark, sf_dir):
    """What was selected, converted and skipped of each composition, for calculations whose task has finished."""
    _, summary = jobs.converted_calculations(spark, calculation_files(spark, sf_dir), folder(spark, "converted"), ["H", "O", "X"], require_finished=True)
    return summary.select(F.array_join("elements", ",").alias("elements"), "selected", "converted", "skipped")


CONVERSION_SUMMARY_SQL = """
select case when vec_id % 10 in (7, 9) then null when vec_id % 10 = 8 then 'O,X' else 'O,H' end as elements, count(*) as selected, count(*) filter (vec_id % 11 <> 5 and vec_id % 10 not in (7, 9)) as converted,
  count(*) filter (vec_id % 11 = 5 or vec_id % 10 in (7, 9)) as skipped from embeddings where vec_id % 4 = 0 group by 1
"""


def manifest_files(spark, sf_dir):
    """Systems of parts written as a manifest and read back, typed."""
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") - 1).cast("int").alias("index"), F.concat(F.lit("/d/"), "p_partkey").alias("system_path"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" ").alias("block"), F.lit("l").alias("label"), F.col("p_size").cast("long").alias("frames"), F.lit(3).alias("natoms"), F.split("p_name", " ").alias("elements"), F.array(F.lit(1), F.lit(2)).alias("counts"))
    path = folder(spark, "manifest")
    sinks.write_manifest(p, path)
    typed, _ = records.read_system_manifest(spark, path)
    return typed.select("system_index", "system_path", "block", "frames", "natoms", F.array_join("elements", " ").alias("elements"), F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))


MANIFEST_FILES_SQL = "select (p_partkey - 1)::int as system_index, '/d/' || p_partkey as system_path, case when p_size % 2 = 0 then p_brand else 'unknown' end as block, p_size::bigint as frames, 3 as natoms, p_name as elements, '1,2' as counts from part"


def published_table(spark, sf_dir):
    """Customers published, then replaced by a newer version, then a version that is not valid (and changes nothing)."""
    c, path = table(spark, sf_dir, "customer"), folder(spark, "published")
    negative = lambda df: df.where("c_custkey < 0")
    sinks.publish(c.select("c_custkey", F.lit("old").alias("version")), path, negative)
    sinks.publish(c.select("c_custkey", F.lit("new").alias("version")), path, negative)
    try:
        sinks.publish(c.select((-F.col("c_custkey")).alias("c_custkey"), F.lit("bad").alias("version")), path, negative)
    except ValueError:
        return spark.read.parquet(path)
    raise AssertionError("a table that is not valid was published")


PUBLISHED_SQL = "select c_custkey, 'new' as version from customer"


def table_versions(spark, sf_dir):
    """Orders published in three versions; a publisher that started from an old version and one whose rows are not valid
    leave nothing."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), folder(spark, "versions")
    valid = lambda t: t.where("o_orderkey is null")
    first = versions.publish_version(orders.where("o_orderstatus = 'F'"), path, valid)
    second = versions.publish_version(orders.where("o_orderstatus <> 'P'"), path, valid, first)
    for rows, base, error in ((orders.where("o_orderstatus = 'P'"), first, versions.Conflict), (orders.withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(1))), second, ValueError)):
        try:
            versions.publish_version(rows, path, valid, base)
        except error:
            pass
    versions.publish_version(orders, path, valid, versions.latest(spark, path))
    counts = [versions.read_version(spark, path, n).agg(F.lit(n).cast("long").alias("version"), F.sum("o_orderkey").alias("keys"), F.count_distinct("o_orderstatus").alias("statuses")) for n in (0, 1, 2)]
    own = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return versions.versions(spark, path).join(own, "version").select("version", "based_on", "row_count", "keys", "statuses")


VERSIONS_SQL = """
with n as (select unnest([0, 1, 2]) as version)
select version::bigint as version, case when version > 0 then version - 1 end::bigint as based_on, count(*) as row_count, sum(o_orderkey)::bigint as keys, count(distinct o_orderstatus) as statuses
from n, orders where version = 2 or o_orderstatus = 'F' or (version = 1 and o_orderstatus <> 'P') group by version
"""


def bucketed_archives(spark, sf_dir):
    """Two archives as bucketed tables, compared by frame without an exchange: some frames are missing, some differ."""
    have = frames(spark, sf_dir).select(F.col("frame_in_set").cast("long").alias("frame_index"), "coord", "force")
    changed = have.where("frame_index % 7 <> 3").withColumn("coord", F.when(F.col("frame_index") % 5 == 0, F.transform("coord", lambda x, i: F.when(i < 2, x + 1).otherwise(x))).otherwise(F.col("coord")))
    name = f"archive_{uuid.uuid4().hex}"
    tables = [sinks.save_bucketed(df, f"{name}_{k}", 8, folder(spark, "bucketed")) for k, df in enumerate((have, changed))]
    out = dataset.compare_archives(*tables, "frame_index", ["coord", "force"])
    return out.withColumn("max_abs_difference", F.round("max_abs_difference", 6))


BUCKETED_SQL = """
with b as (select vec_id % 7 = 3 as missing, vec_id % 5 = 0 as moved from embeddings), f as (select unnest(['coord', 'force']) as field)
select field, count(*) filter (not missing) as frames_compared, count(*) filter (missing) as missing_in_archive, 0::bigint as unexpected_in_archive,
  (2 * count(*) filter (field = 'coord' and moved and not missing))::bigint as different_values, max(case when not missing then case when field = 'coord' and moved then 1.0 else 0.0 end end)::double as max_abs_difference from b, f group by field
"""


def report_files(spark, sf_dir):
    n, path = table(spark, sf_dir, "nation"), folder(spark, "report")
    sinks.write_report(n.select("n_nationkey", "n_name"), path)
    return spark.read.schema("n_nationkey int, n_name string").json(path)


REPORT_SQL = "select n_nationkey, n_name from nation"


def role_lists(spark, sf_dir):
    """The systems of each role, as a training job's input names them."""
    s = table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 5 == 0, "test").otherwise("train").alias("role"), F.concat(F.lit("/s/"), F.col("s_nationkey")).alias("path"))
    return spark.createDataFrame([(r, "\n".join(p)) for r, p in sinks.role_lists(s, "path").items()], "role string, paths string")


ROLE_LISTS_SQL = "select case when s_suppkey % 5 = 0 then 'test' else 'train' end as role, string_agg(distinct '/s/' || s_nationkey, chr(10) order by '/s/' || s_nationkey) as paths from supplier group by 1"


def model():
    """A model that knows H and O: energy is the sum of the coordinates by type, the force twice the coordinates."""

    def evaluate(coord, box, types):
        weights = np.repeat(np.array([2.0, 1.0])[types], 3)
        return coord @ weights, 2 * coord, box

    return ["H", "O"], evaluate


def model_inference(spark, sf_dir):
    """Predictions of frames in another order of types than the model's; some have an element that it lacks."""
    f = frames(spark, sf_dir).withColumn("type_map", F.when(F.col("frame_in_set") % 9 == 4, F.array(F.lit("O"), F.lit("X"))).otherwise(F.col("type_map")))
    out = inference.predict(f, model, ["frame_in_set"], atoms_per_batch=50)
    return out.select("frame_in_set", F.round(F.nanvl("energy_pred", F.lit(None).cast("double")), 6).alias("energy"), F.round(F.col("force_pred")[5], 6).alias("fz"), F.col("skipped").isNotNull().alias("failed"))


INFERENCE_SQL = f"""
with {V}, f as (select vec_id::int as frame_in_set, v, case when vec_id % 2 = 0 then 6 else 9 end as n, vec_id % 9 = 4 as failed from v)
select frame_in_set, case when not failed then round(list_sum(v[1:3]) + 2 * list_sum(v[4:n]), 6) end as energy, case when not failed then round(2 * v[6], 6) end as fz, failed from f
"""


def evaluate_model(spark, sf_dir):
    """The job: errors of that model against the frames' energies and forces, by system, family and as a whole. Systems with an
    energy that is no number, with an element that the model lacks or with a set that could not be read fall out whole."""
    f = frames(spark, sf_dir).withColumns({"system_path": F.concat("system_path", F.lit("/"), F.col("frame_in_set") % 40), "label": F.when(F.col("system_path").rlike("[02468]$"), "even").otherwise(" ")})
    f = f.withColumns({"energy": F.when(F.col("frame_in_set") % 97 == 5, float("nan")).otherwise(F.col("energy")), "type_map": F.when(F.col("frame_in_set") % 89 == 7, F.array(F.lit("O"), F.lit("X"))).otherwise(F.col("type_map")), "error": F.when(F.col("frame_in_set") % 83 == 9, "broken")})
    out = jobs.evaluated(f, model, "label", atoms_per_batch=50).levels
    return out.select("level", "label", "system_path", "frames", "force_components", *[F.round(c, 6).alias(c) for c in ("energy_mae_eV", "energy_rmse_meV_per_atom", "force_rmse_eV_per_A", "virial_rmse_eV")])


EVALUATED = f"""
with {V}, f as (select 'sys' || label || '/' || vec_id % 40 as system_path, case when label % 2 = 0 then 'even' else 'unlabeled' end as label, case when vec_id % 2 = 0 then 2 else 3 end as natoms, v, vec_id from v),
bad as (select distinct system_path from f where vec_id % 97 = 5 or vec_id % 89 = 7 or vec_id % 83 = 9),
e as (select *, list_sum(v[1:3]) + 2 * list_sum(v[4:3 * natoms]) - v[21] as d, list_sum([(2 * v[i] - v[29 + i]) ** 2 for i in range(1, 3 * natoms + 1)]) as q, list_sum([(v[10 + i] - v[40 + i]) ** 2 for i in range(1, 10)]) as w from f where system_path not in (from bad))
"""
EVALUATE_SQL = EVALUATED + """
select case when grouping(system_path) = 0 then 'system' when grouping(label) = 0 then 'family' else 'overall' end as level, label, system_path, count(*) as frames, cast(sum(3 * natoms) as bigint) as force_components, round(avg(abs(d)), 6) as energy_mae_eV,
  round(sqrt(avg((d / natoms) ** 2)) * 1000, 6) as energy_rmse_meV_per_atom, round(sqrt(sum(q) / sum(3 * natoms)), 6) as force_rmse_eV_per_A, round(sqrt(sum(w) / (9 * count(*))), 6) as virial_rmse_eV from e group by grouping sets ((label, system_path), (label), ())
"""


def evaluated_manifest(spark, sf_dir):
    """The job over a manifest of frames on disk: the first frames of each system, with the flags of the worst."""
    source, path = folder(spark, "toevaluate"), folder(spark, "manifests")
    mixed = frames(spark, sf_dir).withColumn("types", F.expr("if(frame_in_set % 3 = 0, array(1, 0), types)")).withColumn("natoms", F.size("types"))
    mixed = mixed.withColumns({a: F.slice(a, F.lit(1), 3 * F.col("natoms")) for a in ("coord", "force")})
    groups.write_groups(mixed, source, frames_per_set=25)
    sinks.write_manifest(jobs.manifest_of(spark, [source], block="b")[0], f"{path}/m.tsv")
    found = jobs.evaluated_dataset(spark, model, manifest=f"{path}/m.tsv", most_frames=60)
    systems = found.systems.select(F.element_at(F.split("system_path", "/"), -1).alias("name"), "block", "frames", F.round("force_rmse_eV_per_A", 6).alias("force"), "is_worst_force_rmse_meV_per_A", "is_worst_energy_rmse_meV_per_atom")
    return systems.crossJoin(F.broadcast(found.status.select("status")))  # one row


EVALUATED_MANIFEST_SQL = f"""
with {V}, f as (select vec_id, case when vec_id % 3 = 0 then 'HO' when vec_id % 2 = 0 then 'OH' else 'OHH' end as c, case when vec_id % 3 = 0 or vec_id % 2 = 0 then 2 else 3 end as natoms, 'sys' || label as s, vec_id % 3 as t, v from v),
r as (select *, row_number() over (partition by c order by s, t, vec_id) as k from f),
e as (select c, natoms, case when c = 'HO' then 2 * list_sum(v[1:3]) + list_sum(v[4:6]) else list_sum(v[1:3]) + 2 * list_sum(v[4:3 * natoms]) end - v[21] as d, list_sum([(2 * v[i] - v[29 + i]) ** 2 for i in range(1, 3 * natoms + 1)]) as q from r where k <= 60),
g as (select c, count(*) as frames, sqrt(sum(q) / sum(3 * natoms)) as force, sqrt(avg((d / natoms) ** 2)) as energy from e group by c)
select case c when 'HO' then 'group_001_n2_h_o' when 'OH' then 'group_002_n2_o_h' else 'group_003_n3_o_h' end as name, 'b' as block, frames, round(force, 6) as force,
  force = (select max(force) from g) as is_worst_force_rmse_meV_per_A, energy = (select max(energy) from g) as is_worst_energy_rmse_meV_per_atom, 'PASS' as status from g
"""


def split_files(spark, sf_dir):
    """The job: frames on disk split into train and test datasets; frames of each system in each."""
    source, out = folder(spark, "tosplit"), folder(spark, "split")
    groups.write_groups(frames(spark, sf_dir), source)
    sets, _ = jobs.split_dataset(spark, [source], out, ratio=0.2, seed=3)
    return sets.groupBy("role", "group_name").agg(F.sum("frames").alias("frames"))


SPLIT_FILES_SQL = """
with n as (select vec_id % 2 as k, count(*) as n from embeddings group by 1), t as (select *, least(greatest(round_even(n * 0.2, 0), 1), n - 1)::bigint as test from n),
r as (select k, 'test' as role, test as frames from t union all select k, 'train', n - test from t)
select role, case k when 0 then 'group_001_n2_o_h' else 'group_002_n3_o_h' end as group_name, frames from r
"""


def archived_files(spark, sf_dir):
    """The job: frames on disk, a manifest of them with blocks and labels, in another order than that of the paths, and its
    archive of at most 70 frames of each system: all frames with number, system, block and label."""
    source, out, path = folder(spark, "toarchive"), folder(spark, "archive"), folder(spark, "manifests")
    groups.write_groups(frames(spark, sf_dir), source, frames_per_set=30)
    rows, _ = jobs.manifest_of(spark, [source], label="x")
    turned = rows.withColumns({"index": 1 - F.col("index"), "block": F.when(F.col("index") == 0, "").otherwise("late"), "label": F.when(F.col("index") == 0, "l").otherwise(""), "type_map": F.when(F.col("index") == 0, F.col("type_map")).otherwise(F.col("type_map"))})
    sinks.write_manifest(turned, f"{path}/m.tsv")
    jobs.archived_manifest(spark, f"{path}/m.tsv", out, ["H", "O"], most=70)
    back = spark.read.parquet(f"{out}/frames")
    return back.select("frame_index", "system_id", "block", "label", "natoms", "energy", F.array_join("types", "").alias("types"), F.element_at("force", -1).alias("fz"))


ARCHIVED_SQL = f"""
with {V}, f as (select *, vec_id % 2 as odd, row_number() over (partition by vec_id % 2 order by 'sys' || label, vec_id % 3, vec_id) - 1 as k from v), a as (select *, 1 - odd as system_id from f where k < 70)
select row_number() over (order by system_id, k) - 1 as frame_index, system_id, case system_id when 0 then 'late' else 'unknown' end as block, case system_id when 0 then '' else 'l' end as label, 2 + odd as natoms, v[21] as energy, case odd when 0 then '10' else '100' end as types, v[35 + 3 * odd] as fz from a
"""


def archive_reports(spark, sf_dir):
    """What the archive job and the inspection of the folder say: frames by block and label, bytes, virial frames."""
    source, out, path = folder(spark, "toarchive"), folder(spark, "archive"), folder(spark, "manifests")
    groups.write_groups(frames(spark, sf_dir).withColumn("virial", F.when(F.col("natoms") == 3, F.col("virial"))), source, frames_per_set=100)
    rows, found = jobs.manifest_of(spark, [source], label="x")
    sinks.write_manifest(rows.withColumn("block", F.concat(F.lit("b"), "natoms")), f"{path}/m.tsv")
    report = jobs.archived_manifest(spark, f"{path}/m.tsv", out)
    return report.select("status", "systems", "frames", "virial_frames", "natoms_min", "natoms_max", F.to_json("blocks").alias("blocks"), F.to_json("labels").alias("labels")).crossJoin(F.broadcast(found.select("atoms", "bytes", "type_maps", "errors", "valid")))


ARCHIVE_REPORTS_SQL = """
with n as (select vec_id % 2 as odd, count(*) as n, (count(*) + 99) // 100 as sets from embeddings group by 1)
select 'PASS' as status, count(*) as systems, cast(sum(n) as bigint) as frames, cast(sum(n * odd) as bigint) as virial_frames, 2 as natoms_min, 3 as natoms_max, '{"b2":' || max(n) filter (odd = 0) || ',"b3":' || max(n) filter (odd = 1) || '}' as blocks,
  '{"x":' || cast(sum(n) as bigint) || '}' as labels, cast(sum(n * (2 + odd)) as bigint) as atoms, cast(sum(sets * 128 * (4 + odd) + n * 8 * (10 + 6 * (2 + odd) + 9 * odd)) as bigint) as bytes, 1::bigint as type_maps, 0::bigint as errors, true as valid from n
"""


def group_headers(spark, sf_dir):
    """The index of groups on disk, two for each supplier: one is whole, one in ten of the others has another number of
    forces, one an unreadable type, one a repeated name and one lacks its energies."""
    out = folder(spark, "headers")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("part"))

    def write(batches):
        for pdf in batches:
            for k, part in zip(pdf["s_suppkey"], pdf["part"], strict=True):
                n, atoms, bad = 1 + k % 4, 1 + k % 3, k % 10 if part == "b" else 0
                base = f"{out}/{k % 7}/{k}{part}"
                fs, _ = discovery.opened(base)
                fs.create_dir(f"{base}/set.000", recursive=True)
                arrays = {"coord": np.zeros((n, 3 * atoms)), "box": np.zeros((n, 9)), "energy": np.zeros(n), "force": np.zeros((n + (bad == 3), 3 * atoms))}
                for name, values in arrays.items():
                    if name != "energy" or bad != 9:
                        with fs.open_output_stream(f"{base}/set.000/{name}.npy") as f:
                            np.lib.format.write_array(f, values)
                for name, text in (("type.raw", "x\n" if bad == 5 else "1\n" * atoms), ("type_map.raw", "H\nH\n" if bad == 7 else "H\nO\n")):
                    with fs.open_output_stream(f"{base}/{name}") as f:
                        f.write(text.encode())
            yield pdf.groupby("part", as_index=False).agg(n=("s_suppkey", "size"))

    rows.mapInPandas(write, "part string, n long").agg(F.sum("n")).collect()
    index = discovery.index_groups(spark, [out])
    return index.select(F.element_at(F.split("system_path", "/"), -1).alias("name"), "set_name", "frames", "natoms", F.array_join("elements", ",").alias("elements"), F.array_join("counts", ",").alias("counts"), "type_map_sha256", "bytes", "virial", F.regexp_extract("error", "^[A-Za-z]+: ([a-z_]+)", 1).alias("error"))


GROUP_HEADERS_SQL = r"""
with g as (select s_suppkey as k, p, 1 + s_suppkey % 4 as n, 1 + s_suppkey % 3 as atoms, case when p = 'b' then s_suppkey % 10 else 0 end as bad from supplier, (values ('a'), ('b')) x(p)),
h as (select *, bad in (3, 9) as set_bad, bad in (5, 7) as group_bad from g)
select k || p as name, case when not group_bad then 'set.000' end as set_name, case when not group_bad and not set_bad then n end::bigint as frames, case when not group_bad then atoms end::int as natoms, case when not group_bad then 'O' end as elements,
  case when not group_bad then atoms::varchar end as counts, case when not group_bad then sha256('H' || chr(10) || 'O' || chr(10)) end as type_map_sha256, case when not group_bad and not set_bad then 512 + 8 * n * (6 * atoms + 10) end::bigint as bytes,
  case when not group_bad and not set_bad then false end as virial, case bad when 3 then 'frame' when 5 then 'invalid' when 7 then 'type_map' when 9 then 'missing' end as error from h
"""


def filtered_frames(spark, sf_dir):
    """Frames of one set name, within a range, of the groups on disk: the source reads no others."""
    out = folder(spark, "groups")
    groups.write_groups(frames(spark, sf_dir), out, frames_per_set=40)
    back = groups.read_frame_groups(spark, [out], sets="error is null and set_name in ('set.001', 'set.002')", first=5, last=30, framesPerPartition="16")
    return back.select(F.element_at(F.split("system_path", "/"), -1).alias("group_name"), "set_name", "frame_in_set", "energy")


FILTERED_SQL = f"""
with {V}, f as (select *, row_number() over (partition by vec_id % 2 order by 'sys' || label, vec_id % 3, vec_id) - 1 as k from v)
select case vec_id % 2 when 0 then 'group_001_n2_o_h' else 'group_002_n3_o_h' end as group_name, 'set.00' || k // 40 as set_name, (k % 40)::int as frame_in_set, v[21] as energy from f where k // 40 in (1, 2) and k % 40 between 5 and 29
"""


def structure_round_trip(spark, sf_dir):
    """Structures written as text, atoms regrouped by element and wrapped into the cell, and read back."""
    v = vectors(spark, sf_dir).where("size(v) >= 9")
    box = F.array(*[F.lit(float(x)) for x in (4, 0, 0, 0, 5, 0, 0, 0, 6)])
    s = v.select("vec_id", F.lit(3).alias("natoms"), F.array(*[F.lit(x) for x in (1, 0, 1)]).alias("types"), F.array(F.lit("H"), F.lit("O")).alias("type_map"), F.slice("v", 1, 9).alias("coord"), box.alias("box"), F.concat(F.lit("t"), "vec_id").alias("title"))
    out = folder(spark, "texts")
    sinks.write_texts(sinks.structure_text(s, ["H", "O"]).select(F.concat(F.lit("s/"), "vec_id", F.lit("/POSCAR")).alias("path"), "text"), out)
    back = structures.read_structures(spark, out)
    return back.select(F.element_at(F.split("path", "/"), -2).cast("long").alias("vec_id"), F.array_join("elements", ",").alias("elements"), F.array_join("counts", ",").alias("counts"), *[F.round(F.pmod(F.round(F.col("coord")[k], 9), F.lit(float(d))), 5).alias(f"x{k}") for k, d in ((0, 4), (4, 5), (8, 6))])


STRUCTURE_ROUND_SQL = f"""
with {V}, w as (select vec_id, v[4] - 4 * floor(v[4] / 4) as a, v[2] - 5 * floor(v[2] / 5) as b, v[9] - 6 * floor(v[9] / 6) as c from v)
select vec_id, 'H,O' as elements, '1,2' as counts, round(case when round(a, 9) = 4 then 0 else a end, 5) as x0, round(case when round(b, 9) = 5 then 0 else b end, 5) as x4, round(case when round(c, 9) = 6 then 0 else c end, 5) as x8 from w
"""


def validated_files(spark, sf_dir):
    """Codes of converted groups on disk whose summaries were changed, or whose files were taken away."""
    out = folder(spark, "dataset")
    f = frames(spark, sf_dir).withColumns({"natoms": 2 + F.col("frame_in_set") % 5, "types": F.expr("concat(array(0), array_repeat(1, cast(1 + frame_in_set % 5 as int)))")})
    f = f.withColumns({"coord": F.expr("array_repeat(0.5D, 3 * natoms)"), "force": F.expr("array_repeat(0.25D, 3 * natoms)"), "virial": F.when(F.col("natoms") != 4, F.col("virial"))})
    groups.write_raw(groups.write_groups(f, out), out)
    summary = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "convert_summary.json").text(out, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    changed = summary.select(F.concat(name, F.lit("/convert_summary.json")).alias("path"), F.when(name.contains("_n3_"), F.regexp_replace("value", '"frames": ', '"frames_skipped": 1, "frames_selected": 7, "frames": ')).when(name.contains("_n5_"), F.regexp_replace("value", '"frames": [0-9]+', '"frames": 0')).otherwise(F.col("value")).alias("text"))
    sinks.write_texts(session.written(changed, "summaries"), out)
    return jobs.validated_dataset(spark, out)


VALIDATED_SQL = """
with g as (select 2 + vec_id % 5 as n, count(*) as frames from embeddings group by 1), m as (select 'group_00' || n - 1 || '_n' || n || '_o_h' as group_name, * from g)
select group_name, 'skipped_frames' as code from m where n = 3 union all select group_name, 'selected_not_converted' from m where n = 3 and frames <> 7 union all select group_name, 'missing: virial' from m where n = 4
union all select group_name, 'nothing_converted' from m where n = 5 union all select group_name, 'frame count mismatch: ' || a from m, (values ('coord'), ('box'), ('energy'), ('force'), ('virial')) x(a) where n = 5
"""


def dataset_checks(spark, sf_dir):
    """Codes of a converted dataset made from parts: repeated or missing compositions, skipped frames, nothing converted, unlike
    counts and totals, arrays that are missing."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part")
    counts = F.when(k % 50 == 0, F.array(k, F.lit(1).cast("long"))).otherwise(F.array(k - F.when(k % 40 == 0, 1).otherwise(0)))
    elements = F.when(k % 60 == 7, F.array().cast("array<string>")).otherwise(F.array("p_brand"))
    converted = F.when(k % 45 == 1, 0).otherwise(F.col("p_size") - F.when(k % 30 == 0, 1).otherwise(0))
    g = p.select(F.concat(F.lit("g"), k).alias("group_name"), elements.alias("elements"), counts.alias("counts"), F.when(k % 45 == 1, 0).otherwise(F.col("p_size")).alias("selected"), converted.alias("converted"), F.when(k % 30 == 0, 1).otherwise(0).alias("skipped"))
    arrays = g.where("group_name not like '%1'").select("group_name", F.explode(F.array(*[F.lit(a) for a in dataset.ARRAYS])).alias("array"), F.col("converted").alias("raw_rows"), "converted").withColumn("npy_rows", F.col("converted") - F.when((F.col("array") == "force") & F.col("group_name").endswith("7"), 1).otherwise(0)).drop("converted")
    arrays = arrays.where("not (array = 'virial' and group_name like '%3')")
    totals = g.agg((F.count("*") + 1).alias("group_count"), F.sum("converted").alias("frames_converted"))
    return dataset.validate_dataset(g, arrays, totals)


DATASET_CHECKS_SQL = """
with g as (select 'g' || p_partkey as group_name, case when p_partkey % 60 = 7 then [] else [p_brand] end as e, case when p_partkey % 50 = 0 then [p_partkey, 1] else [p_partkey - case when p_partkey % 40 = 0 then 1 else 0 end] end as c, p_partkey as k, case when p_partkey % 45 = 1 then 0 else p_size - case when p_partkey % 30 = 0 then 1 else 0 end end as n from part),
n as (select *, count(*) over (partition by e, c) as same from g), a as (select unnest(['coord', 'box', 'energy', 'force', 'virial']) as array_name)
select group_name, 'duplicate_composition' as code from n where same > 1 union all select group_name, 'composition_missing' from g where len(e) = 0 union all select group_name, 'element_count_length' from g where len(c) <> 1 and len(e) > 0
union all select group_name, 'selected_not_converted' from g where k % 30 = 0 and k % 45 <> 1 union all select group_name, 'skipped_frames' from g where k % 30 = 0 union all select group_name, 'nothing_converted' from g where n <= 0
union all select group_name, 'missing: ' || array_name from g, a where group_name like '%1' or (array_name = 'virial' and group_name like '%3') union all select group_name, 'frame count mismatch: force' from g where group_name like '%7' union all select null, 'group_count'
"""


def excluded_keys(spark, sf_dir):
    """Keys of manifests and lists together: entries of orders with two statuses, and lines of customers."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("system_"), "o_custkey").alias("system"), F.concat(F.lit("frame_"), F.col("o_orderkey") % 10).alias("frame"), F.expr("case o_orderstatus when 'F' then 'finished' when 'P' then ' ' else 'running' end").alias("status"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("/p/"), "o_orderkey")).alias("source_structure_path"))
    c = table(spark, sf_dir, "customer").select(F.expr("case c_custkey % 3 when 0 then 'task_key' when 1 then 'path' else 'unresolved' end").alias("kind"), F.expr("case c_custkey % 3 when 0 then concat('system_', c_custkey, '/frame_1') when 1 then concat('/p/', c_custkey) end").alias("key"))
    return select.exclusion_keys(o, c, ["finished"])


EXCLUDED_KEYS_SQL = """
with o as (select * from orders where o_orderstatus in ('F', 'P'))
select 'task_key' as kind, 'system_' || o_custkey || '/frame_' || (o_orderkey % 10) as key from o union select 'path', '/p/' || o_orderkey from o where o_orderkey % 3 = 0
union select 'task_key', 'system_' || c_custkey || '/frame_1' from customer where c_custkey % 3 = 0 union select 'path', '/p/' || c_custkey from customer where c_custkey % 3 = 1
"""

ORACLES = {
    "group_files": GROUP_FILES_SQL,
    "group_summaries": GROUP_SUMMARIES_SQL,
    "group_headers": GROUP_HEADERS_SQL,
    "filtered_frames": FILTERED_SQL,
    "structure_files": STRUCTURE_FILES_SQL,
    "structure_round_trip": STRUCTURE_ROUND_SQL,
    "output_files": OUTPUT_FILES_SQL,
    "trajectory_files": TRAJECTORY_SQL,
    "long_trajectories": LONG_TRAJECTORIES_SQL,
    "table_versions": VERSIONS_SQL,
    "bucketed_archives": BUCKETED_SQL,
    "run_records": RUN_RECORDS_SQL,
    "marker_scan": MARKER_SCAN_SQL,
    "converted_dataset": CONVERTED_SQL,
    "conversion_summary": CONVERSION_SUMMARY_SQL,
    "manifest_files": MANIFEST_FILES_SQL,
    "published_table": PUBLISHED_SQL,
    "report_files": REPORT_SQL,
    "role_lists": ROLE_LISTS_SQL,
    "model_inference": INFERENCE_SQL,
    "evaluate_model": EVALUATE_SQL,
    "evaluated_manifest": EVALUATED_MANIFEST_SQL,
    "split_files": SPLIT_FILES_SQL,
    "archived_files": ARCHIVED_SQL,
    "archive_reports": ARCHIVE_REPORTS_SQL,
    "validated_files": VALIDATED_SQL,
    "dataset_checks": DATASET_CHECKS_SQL,
    "excluded_keys": EXCLUDED_KEYS_SQL,
}
QUERIES = {name: globals()[name] for name in ORACLES}
