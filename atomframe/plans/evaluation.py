"""Queries on prediction errors: lineitem as frames, embeddings as vectors, prices as parity points."""

from __future__ import annotations

from pyspark.sql import functions as F

from atomframe.operators import dataset, index, metrics
from atomframe.session import table


def price_frames(spark, sf_dir):
    """lineitem: family, system, natoms, and a discounted price as the prediction of the price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("family"), F.col("l_linestatus").alias("system"), F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("natoms"), F.col("l_extendedprice").alias("energy_true"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("energy_pred"))


def rounded(df, names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


def error_metrics_levels(spark, sf_dir):
    out = metrics.metrics_by_level(price_frames(spark, sf_dir))
    names = ["energy_mae_eV", "energy_rmse_eV", "energy_mae_meV_per_atom", "energy_rmse_meV_per_atom"]
    return rounded(out.select("level", "family", "system", "frames", *names), names, 4)


LEVELS_SQL = """
with f as (select l_returnflag as family, l_linestatus as system, l_extendedprice * (1 - l_discount) - l_extendedprice as e, l_quantity as n from lineitem)
select case when grouping(system) = 0 then 'system' when grouping(family) = 0 then 'family' else 'overall' end as level, family, system, count(*) as frames,
  round(sum(abs(e)) / count(*), 4) as energy_mae_eV, round(sqrt(sum(e * e) / count(*)), 4) as energy_rmse_eV,
  round(sum(abs(e / n)) / count(*) * 1000, 4) as energy_mae_meV_per_atom, round(sqrt(sum((e / n) * (e / n)) / count(*)) * 1000, 4) as energy_rmse_meV_per_atom
from f group by grouping sets ((family, system), (family), ())
"""


def worst_system_flags(spark, sf_dir):
    by = metrics.error_metrics(price_frames(spark, sf_dir), "supplier").select("supplier", F.round("energy_rmse_eV", 4).alias("rmse"), F.round("energy_rmse_meV_per_atom", 4).alias("rmse_atom"))
    return metrics.worst_flags(by, "supplier", "rmse", "rmse_atom")


WORST_SQL = """
with f as (select l_suppkey as supplier, l_extendedprice * (1 - l_discount) - l_extendedprice as e, l_quantity as n from lineitem),
m as (select supplier, round(sqrt(sum(e * e) / count(*)), 4) as rmse, round(sqrt(sum((e / n) * (e / n)) / count(*)) * 1000, 4) as rmse_atom from f group by supplier)
select *, row_number() over (order by rmse desc, supplier) = 1 as is_worst_rmse, row_number() over (order by rmse_atom desc, supplier) = 1 as is_worst_rmse_atom from m
"""


def vector_error_metrics(spark, sf_dir):
    """Embeddings against their values rounded to one decimal, as forces; per label."""
    e = table(spark, sf_dir, "embeddings").withColumn("force_true", F.expr("transform(embedding, x -> cast(x as double))"))
    frames = e.select("label", F.lit(64).alias("natoms"), F.lit(0.0).alias("energy_true"), F.lit(0.0).alias("energy_pred"), "force_true", F.expr("transform(force_true, x -> bround(x, 1))").alias("force_pred"))
    names = ["force_mae_eV_per_A", "force_rmse_eV_per_A", "force_mae_meV_per_A", "force_rmse_meV_per_A"]
    return rounded(metrics.error_metrics(frames, "label").select("label", "frames", *names), names, 5)


VECTOR_SQL = """
with v as (select label, vec_id, unnest(embedding)::double as x from embeddings), e as (select label, vec_id, round_even(x, 1) - x as d from v)
select label, count(distinct vec_id) as frames, round(avg(abs(d)), 5) as force_mae_eV_per_A, round(sqrt(avg(d * d)), 5) as force_rmse_eV_per_A,
  round(avg(abs(d)) * 1000, 5) as force_mae_meV_per_A, round(sqrt(avg(d * d)) * 1000, 5) as force_rmse_meV_per_A
from e group by label
"""


def evaluation_status(spark, sf_dir):
    """Systems (suppliers) fail if one of their large frames has a discount of a tenth."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.when(F.max(F.when(F.col("l_quantity") > 48, F.col("l_discount"))) >= 0.1, "discount").alias("error"))
    return metrics.evaluation_status(li, continue_on_error=True)


STATUS_SQL = """
with s as (select l_suppkey, coalesce(max(l_discount) filter (l_quantity > 48) >= 0.1, false) as bad from lineitem group by 1)
select count(*) as systems, count(*) filter (bad) as errors, case when count(*) filter (not bad) = 0 then 'FAIL' when count(*) filter (bad) = 0 then 'PASS' else 'PARTIAL' end as status from s
"""


def parity_summary(spark, sf_dir):
    return rounded(metrics.parity_summary(price_frames(spark, sf_dir), "energy_true", "energy_pred", "family"), ["mae", "rmse"], 4)


PARITY_SQL = """
select l_returnflag as family, count(*) as points, round(avg(abs(l_extendedprice * (1 - l_discount) - l_extendedprice)), 4) as mae,
  round(sqrt(avg((l_extendedprice * (1 - l_discount) - l_extendedprice) * (l_extendedprice * (1 - l_discount) - l_extendedprice))), 4) as rmse
from lineitem group by 1
"""


def parity_hexbin(spark, sf_dir):
    return rounded(metrics.parity_hexbin(price_frames(spark, sf_dir), "energy_true", "energy_pred"), ["log_points"])


HEXBIN_SQL = """
with p as (select l_extendedprice as x, l_extendedprice * (1 - l_discount) as y from lineitem),
b as (select min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from p),
g as (select (x - x0) / (x1 - x0) * 160 as gx, (y - y0) / (y1 - y0) * 92 as gy from p, b),
c as (select *, (gx - round_even(gx, 0)) * (gx - round_even(gx, 0)) + 3 * ((gy - round_even(gy, 0)) * (gy - round_even(gy, 0))) <
  (gx - floor(gx) - 0.5) * (gx - floor(gx) - 0.5) + 3 * ((gy - floor(gy) - 0.5) * (gy - floor(gy) - 0.5)) as first from g)
select case when first then 0 else 1 end as lattice, cast(case when first then round_even(gx, 0) else floor(gx) end as bigint) as i,
  cast(case when first then round_even(gy, 0) else floor(gy) end as bigint) as j, count(*) as points, round(log10(count(*)), 6) as log_points
from c group by 1, 2, 3
"""


def batch_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("natoms", 1 + F.col("o_custkey") % 40)
    return index.atom_batches(o, "o_custkey", ["o_orderkey"], "natoms", budget=100, cap=8).select("o_custkey", "o_orderkey", "batch_frames", "batch_id")


BATCH_SQL = """
with o as (select o_custkey, o_orderkey, least(greatest(1, 100 // (1 + o_custkey % 40)), 8) as batch_frames from orders)
select *, cast((row_number() over (partition by o_custkey order by o_orderkey) - 1) // batch_frames as bigint) as batch_id from o
"""


def archive_compare(spark, sf_dir):
    """Embeddings against an archive of them: every seventh missing, some with another value, a NaN or a shorter array."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.expr("transform(embedding, x -> cast(x as double))").alias("v"))
    changed = F.expr("case vec_id % 5 when 1 then transform(v, (x, i) -> if(i = 3, x + 0.25, x)) when 2 then transform(v, (x, i) -> if(i = 0, double('nan'), x)) when 3 then slice(v, 1, 63) else v end")
    archive = e.where("vec_id % 7 <> 0").select("vec_id", changed.alias("v"))
    return dataset.compare_archives(e, archive, "vec_id", ["v"], atol=0.0)


COMPARE_SQL = """
with k as (select vec_id, vec_id % 7 <> 0 as there, vec_id % 5 as m from embeddings)
select 'v' as field, count(*) filter (there) as frames_compared, count(*) filter (not there) as missing_in_archive, 0::bigint as unexpected_in_archive,
  cast(sum(case m when 1 then 1 when 2 then 1 when 3 then 64 else 0 end) filter (there) as bigint) as different_values, 'infinity'::double as max_abs_difference
from k
"""

QUERIES = {f.__name__: f for f in (error_metrics_levels, worst_system_flags, vector_error_metrics, evaluation_status, parity_summary, parity_hexbin, batch_ids, archive_compare)}
ORACLES = {"error_metrics_levels": LEVELS_SQL, "worst_system_flags": WORST_SQL, "vector_error_metrics": VECTOR_SQL, "evaluation_status": STATUS_SQL, "parity_summary": PARITY_SQL, "parity_hexbin": HEXBIN_SQL, "batch_ids": BATCH_SQL, "archive_compare": COMPARE_SQL}


def parity_report(spark, sf_dir):
    """Parity of embeddings against their values rounded to one decimal, as forces and virials, with an energy for each: all
    panels, and the points of their hexagons."""
    from atomframe.operators import jobs

    e = table(spark, sf_dir, "embeddings").withColumn("v", F.expr("transform(embedding, x -> cast(x as double))"))
    near = F.expr("transform(v, x -> bround(x, 1))")
    frames = e.select(F.lit(4).alias("natoms"), F.col("v")[20].alias("energy_true"), F.bround(F.col("v")[20], 1).alias("energy_pred"), F.slice("v", 1, 12).alias("force_true"), F.slice(near, 1, 12).alias("force_pred"), F.when(F.col("vec_id") % 3 == 0, F.slice("v", 30, 9)).alias("virial_true"), F.slice(near, 30, 9).alias("virial_pred"))
    summary, cells = jobs.parity_report(frames)
    held = cells.groupBy("panel").agg(F.sum("points").alias("held"))
    return rounded(summary.join(held, "panel"), ["mae", "rmse"], 6)


PARITY_REPORT_SQL = """
with v as (select vec_id, [x::double for x in embedding] as v from embeddings),
p as (select 'energy_per_atom' as panel, v[21] / 4 as a, round_even(v[21], 1) / 4 as b from v union all select 'force_components', unnest(v[1:12]), unnest([round_even(x, 1) for x in v[1:12]]) from v
  union all select 'virial_components', unnest(v[30:38]), unnest([round_even(x, 1) for x in v[30:38]]) from v where vec_id % 3 = 0)
select panel, count(*) as points, round(avg(abs(b - a)), 6) as mae, round(sqrt(avg((b - a) * (b - a))), 6) as rmse, count(*) as held from p group by 1
"""
QUERIES["parity_report"] = parity_report
ORACLES["parity_report"] = PARITY_REPORT_SQL
