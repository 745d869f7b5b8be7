"""Queries on frame datasets: parts as structures of words, embeddings as frames, other tables as lists of systems."""

from __future__ import annotations

from pyspark.sql import functions as F

from atomframe.functions import expressions as X
from atomframe.operators import dataset as D, geometry as G
from atomframe.session import table

CANON = ["red", "blue", "small", "large", "widget", "gear", "bolt"]


def parts(spark, sf_dir):
    """Parts as structures: words of the name are elements, the size gives the counts."""
    p = table(spark, sf_dir, "part").withColumn("elements", F.split("p_name", " "))
    return p.withColumn("counts", F.transform("elements", lambda e, i: (1 + (F.col("p_size") + i) % 3).cast("int"))).withColumn("types", F.transform(F.sequence(F.lit(0), F.col("p_size") % 4), lambda k: (k % F.size("elements")).cast("int")))


P = """p as (select *, string_split(p_name, ' ') as elements from part),
q as (select *, [1 + (p_size + i - 1) % 3 for i in range(1, len(elements) + 1)] as counts, [k % len(elements) for k in range(0, p_size % 4 + 1)] as types from p)"""


def composition_groups(spark, sf_dir):
    return D.composition_groups(parts(spark, sf_dir))


GROUPS_SQL = f"""
with {P}, g as (select elements, counts, count(*) as members, cast(list_sum(counts) as bigint) as natoms from q group by elements, counts)
select elements, counts, members, natoms, array_to_string([elements[i] || case when counts[i] = 1 then '' else cast(counts[i] as varchar) end for i in range(1, len(elements) + 1)], '') as formula,
  dense_rank() over (order by natoms, elements, counts) as group_number from g
"""


def element_counts(spark, sf_dir):
    return D.with_element_counts(parts(spark, sf_dir).select("p_partkey", "types", F.col("elements").alias("type_map"))).select("p_partkey", "elements", F.col("counts").cast("array<bigint>").alias("counts"))


ELEMENTS_SQL = f"""
with {P}, n as (select p_partkey, elements, [len([t for t in types if t = i]) for i in range(0, len(elements))] as c from q)
select p_partkey, [elements[i] for i in range(1, len(elements) + 1) if c[i] > 0] as elements, [cast(c[i] as bigint) for i in range(1, len(elements) + 1) if c[i] > 0] as counts from n
"""


def type_map_union(spark, sf_dir):
    return D.type_map_union(parts(spark, sf_dir), "p_partkey", "elements")


UNION_SQL = f"""
with {P}, s as (select p_partkey, unnest(range(1, len(elements) + 1)) as i, elements from q), f as (select elements[i] as element, min((p_partkey, i)) as pos from s group by 1)
select element, row_number() over (order by pos, element) - 1 as type from f
"""


def type_remap(spark, sf_dir):
    return D.remap_types(parts(spark, sf_dir), CANON, names="elements").select("p_partkey", "missing", F.col("new_types").cast("array<bigint>").alias("new_types"))


REMAP_SQL = f"""
with {P}, m as (select p_partkey, types, elements, list_distinct([e for e in elements if not list_contains({CANON}, e)]) as d from q)
select p_partkey, [e for e in elements if list_contains(d, e)] as missing, case when len(d) = 0 then [cast(list_position({CANON}, elements[t + 1]) - 1 as bigint) for t in types] end as new_types from m
"""


def typemap_counts(spark, sf_dir):
    return D.type_map_counts(parts(spark, sf_dir), "elements", CANON)


TYPEMAPS_SQL = f"with {P} select elements, count(*) as systems, elements = {CANON}[1:len(elements)] as is_prefix from q group by elements"


def element_ordering(spark, sf_dir):
    return parts(spark, sf_dir).select("p_partkey", X.element_order("elements", CANON).alias("ordered"))


ORDERING_SQL = f"""
with {P}, e as (select p_partkey, unnest(elements) as x from q)
select p_partkey, list(x order by coalesce(list_position({CANON}, x), 1000), x) as ordered from e group by 1
"""


def frames_by_label(spark, sf_dir):
    return D.frames_by_label(table(spark, sf_dir, "part").withColumn("natoms", F.col("p_size")), "p_type", "p_brand")


LABELS_SQL = "select p_type, p_brand, count(*) as frames, min(p_size) as natoms_min, max(p_size) as natoms_max from part group by 1, 2"


def coverage_diff(spark, sf_dir):
    """Listed part paths (some twice, some outside the root or with a test component) against those that were sold."""
    path = F.concat(F.when(F.col("p_partkey") % 50 == 0, F.lit("/other/")).otherwise("/root/"), F.when(F.col("p_partkey") % 11 == 0, F.lit("Test_a/")).otherwise(""), F.col("p_partkey"))
    part = table(spark, sf_dir, "part")
    listed = part.select(path.alias("path")).unionByName(part.where("p_partkey % 97 = 1").select(path.alias("path")))
    sold = table(spark, sf_dir, "lineitem").where("l_quantity > 30 or l_partkey % 3 = 0").select((F.col("l_partkey") + 20).alias("p_partkey")).distinct().select(path.alias("path"))
    return D.coverage(listed, sold, "path", "/root")


COVERAGE_SQL = """
with k as (select p_partkey from part union all select p_partkey from part where p_partkey % 97 = 1),
pa as (select p_partkey, case when p_partkey % 50 = 0 then '/other/' else '/root/' end || case when p_partkey % 11 = 0 then 'Test_a/' else '' end || p_partkey as path from (select distinct p_partkey from k union select distinct l_partkey + 20 from lineitem)),
a as (select path, count(*) as n from k join pa using (p_partkey) group by 1),
b as (select path, true as there from (select distinct l_partkey + 20 as p_partkey from lineitem where l_quantity > 30 or l_partkey % 3 = 0) join pa using (p_partkey) where p_partkey % 11 <> 0),
c as (select coalesce(a.path, b.path) as path, n, there from a full join b on a.path = b.path)
select path, 'duplicate' as code from c where n > 1 union all select path, case when path like '%Test%' then 'not_scanned' else 'missing' end from c where there is null union all select path, 'unlisted' from c where n is null
union all select path, 'outside_root' from c where n is not null and path not like '/root/%'
"""


def index_contiguity(spark, sf_dir):
    return D.contiguous_index(table(spark, sf_dir, "orders"), "o_orderkey")


CONTIGUOUS_SQL = "select count(*) as rows, min(o_orderkey) = 0 and max(o_orderkey) = count(*) - 1 and count(distinct o_orderkey) = count(*) as contiguous from orders"


def range_contiguity(spark, sf_dir):
    """Probability ranges of the brands of a type, with gaps where a brand has few parts."""
    g = table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(F.sum("p_size").alias("n"), F.min("p_partkey").alias("pos"))
    from pyspark.sql import Window

    w = Window.partitionBy("p_type").orderBy("pos")
    r = g.withColumn("end", F.sum("n").over(w)).withColumn("start", F.col("end") - F.col("n") + F.when(F.col("n") % 7 == 0, 1).otherwise(0))
    return D.range_gaps(r, ["p_type"], "pos", "start", "end").select("p_type", "p_brand", F.col("start").cast("long").alias("start"), F.col("expected_start").cast("long").alias("expected_start"))


RANGES_SQL = """
with g as (select p_type, p_brand, sum(p_size) as n, min(p_partkey) as pos from part group by 1, 2),
r as (select *, sum(n) over (partition by p_type order by pos) as e from g), s as (select *, e - n + case when n % 7 = 0 then 1 else 0 end as start, lag(e, 1, 0) over (partition by p_type order by pos) as expected_start from r)
select p_type, p_brand, cast(start as bigint) as start, cast(expected_start as bigint) as expected_start from s where start <> expected_start
"""


def fuzzy_match(spark, sf_dir):
    """Misspelt part names against the known ones, by edit distance."""
    p = table(spark, sf_dir, "part").select("p_name").distinct()
    wrong = p.select(F.concat(F.col("p_name"), F.substr(F.lit("xyz"), F.length("p_name") % 3 + 1)).alias("p_name"))
    out = D.similar_names(wrong, p, "p_name")
    return out.withColumn("score", F.round("score", 6)).select("name", "suggestion", "score", "rank")


FUZZY_SQL = """
with p as (select distinct p_name from part), w as (select p_name || substr('xyz', cast(length(p_name) % 3 + 1 as int)) as name from p),
s as (select name, p_name as suggestion, 1 - levenshtein(name, p_name) / greatest(length(name), length(p_name)) as score from w, p where least(length(name), length(p_name)) * 2 >= 0.72 * (length(name) + length(p_name)))
select name, suggestion, round(score, 6) as score, row_number() over (partition by name order by score desc, suggestion) as rank from s where score >= 0.72 qualify rank <= 3
"""


def matching_blocks(spark, sf_dir):
    """The same with the matching-block ratio (an Arrow batch function)."""
    p = table(spark, sf_dir, "part").select("p_name").distinct()
    wrong = p.select(F.concat(F.col("p_name"), F.lit("xy")).alias("p_name"))
    return D.similar_names(wrong, p, "p_name", ratio=D.matching_ratio()).withColumn("score", F.round("score", 6))


def frames(spark, sf_dir):
    """Embeddings as frames of 20 atoms: some with NaN or infinite values, short arrays or types out of range."""
    e = table(spark, sf_dir, "embeddings").withColumn("v", F.expr("transform(embedding, x -> cast(x as double))"))
    coord = F.expr("case when vec_id % 10 = 3 then slice(v, 1, 59) when vec_id % 10 = 4 then transform(slice(v, 1, 60), (x, i) -> if(i < 2, double('nan'), x)) else slice(v, 1, 60) end")
    force = F.expr("case when vec_id % 10 = 5 then transform(slice(v, 1, 60), (x, i) -> if(i = 7, double('infinity'), x)) else slice(v, 1, 60) end")
    return e.select(
        F.concat(F.lit("sys"), F.col("label")).alias("system_path"), F.concat(F.lit("set."), F.col("vec_id") % 3).alias("set_name"), "vec_id", F.lit(20).alias("natoms"), coord.alias("coord"),
        F.expr("if(vec_id % 10 = 6, slice(v, 1, 8), slice(v, 1, 9))").alias("box"), F.expr("if(vec_id % 10 = 7, null, v[0])").alias("energy"), force.alias("force"), F.expr("if(vec_id % 2 = 0, slice(v, 1, 9), null)").alias("virial"),
        F.expr("transform(sequence(0, 19), i -> if(vec_id % 10 = 8 and i = 3, 2, i % 2))").alias("types"), F.array(F.lit("O"), F.lit("H")).alias("type_map"),
    )


def validation_report(spark, sf_dir):
    return D.validation_report(frames(spark, sf_dir))


FRAMES_SQL = """
f as (select vec_id, 'sys' || label as system_path, 'set.' || (vec_id % 3) as set_name,
    case vec_id % 10 when 3 then v[1:59] when 4 then ['nan'::double, 'nan'::double] || v[3:60] else v[1:60] end as coord,
    case vec_id % 10 when 5 then v[1:7] || ['infinity'::double] || v[9:60] else v[1:60] end as force,
    case vec_id % 10 when 6 then v[1:8] else v[1:9] end as box, case when vec_id % 10 <> 7 then v[1] end as energy, case when vec_id % 2 = 0 then v[1:9] end as virial,
    [case when vec_id % 10 = 8 and i = 3 then 2 else i % 2 end for i in range(0, 20)] as types
  from (select *, [x::double for x in embedding] as v from embeddings)),
c as (select *, len(coord) <> 60 as coord_shape, len(force) <> 60 as force_shape, len(box) <> 9 as box_shape, energy is null as energy_missing, coalesce(len(virial) <> 9, false) as virial_shape,
    len(types) <> 20 as types_shape, list_min(types) < 0 or list_max(types) >= 2 as type_out_of_range,
    len([x for x in coord if isnan(x) or isinf(x)]) as nonfinite_coord, len([x for x in box if isnan(x) or isinf(x)]) as nonfinite_box, coalesce(isnan(energy) or isinf(energy), false)::bigint as nonfinite_energy,
    len([x for x in force if isnan(x) or isinf(x)]) as nonfinite_force, coalesce(len([x for x in virial if isnan(x) or isinf(x)]), 0) as nonfinite_virial from f)"""
CODES = ("coord_shape", "force_shape", "box_shape", "energy_missing", "virial_shape", "types_shape", "type_out_of_range")
VALIDATION_SQL = f"with {FRAMES_SQL}, r as (" + " union all ".join([f"select '{x}' as code from c where {x}" for x in CODES] + [f"select 'nonfinite_{x}' from c where nonfinite_{x} > 0" for x in D.ARRAYS]) + ") select code, count(*) as frames from r group by 1"


def nonfinite_shape_checks(spark, sf_dir):
    return D.checked_frames(frames(spark, sf_dir)).select("vec_id", F.array_join("errors", ",").alias("errors"), "nonfinite_coord", "nonfinite_force")


CHECKS_SQL = f"with {FRAMES_SQL} select vec_id, concat_ws(',', {', '.join(f"case when {x} then '{x}' end" for x in CODES)}) as errors, nonfinite_coord, nonfinite_force from c"


def inspect_datasets(spark, sf_dir):
    out = D.inspect_systems(frames(spark, sf_dir))
    return out.select("system_path", "frames", "sets", "natoms", "virial_frames", "nonfinite_coord", "nonfinite_force", "invalid_frames")


INSPECT_SQL = f"""
with {FRAMES_SQL}
select system_path, count(*) as frames, count(distinct set_name) as sets, max(len(types))::int as natoms, count(virial) as virial_frames, cast(sum(nonfinite_coord) as bigint) as nonfinite_coord,
  cast(sum(nonfinite_force) as bigint) as nonfinite_force, count(*) filter ({' or '.join(CODES)}) as invalid_frames from c group by 1
"""


def inspect_root(spark, sf_dir):
    return D.inspect_root(D.inspect_systems(frames(spark, sf_dir)))


ROOT_SQL = f"""
with {FRAMES_SQL}
select count(distinct system_path) as systems, count(*) as frames, cast(sum(len(types)) as bigint) as atoms, 1::bigint as type_maps, count(*) filter ({' or '.join(CODES)}) = 0 as valid from c
"""


def declared_mismatches(spark, sf_dir):
    systems = D.inspect_systems(frames(spark, sf_dir))
    manifest = table(spark, sf_dir, "nation").select(F.concat(F.lit("sys"), "n_nationkey").alias("system_path"), F.when(F.col("n_nationkey") % 2 == 0, F.lit(50).cast("long")).alias("frames"), F.lit(20).alias("natoms"))
    return D.declared_mismatches(manifest, systems)


MISMATCH_SQL = """
with s as (select 'sys' || label as system_path, count(*) as found_frames, 20 as found_natoms from embeddings group by label),
m as (select 'sys' || n_nationkey as system_path, case when n_nationkey % 2 = 0 then 50::bigint end as frames, 20 as natoms from nation)
select m.system_path, frames, natoms, found_frames, found_natoms from m left join s using (system_path) where found_frames is null or frames <> found_frames
"""


def composition_fallback(spark, sf_dir):
    """Brands of parts: from the first line item table that knows them, else from the part itself."""
    part = table(spark, sf_dir, "part")
    a = part.where("p_partkey % 3 = 0").select("p_partkey", F.col("p_size").alias("atoms"))
    b = part.where("p_partkey % 2 = 0").select("p_partkey", (F.col("p_size") - 10).alias("atoms"))
    c = part.select("p_partkey", F.lit(7).alias("atoms"))
    return D.composition_fallback(part.select("p_partkey"), a, b, c, on=["p_partkey"], value="atoms", valid=F.col("atoms") > 0)


FALLBACK_SQL = "select p_partkey, case when p_partkey % 3 = 0 and p_size > 0 then p_size when p_partkey % 2 = 0 and p_size > 10 then p_size - 10 else 7 end as atoms from part"


def sha256_audit(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return D.hash_audit(d, d.where("doc_id % 9 <> 4").withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))), "doc_id", "text")


AUDIT_SQL = """
select doc_id, sha256(text) as left_sha256, case when doc_id % 9 <> 4 then sha256(case when doc_id % 7 = 0 then text || '!' else text end) end as right_sha256, doc_id % 9 <> 4 and doc_id % 7 <> 0 as equal from documents
"""


def positions(spark, sf_dir):
    """The first three components of the embeddings as one atom each, scaled so that some leave the box."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("label", F.col("vec_id").alias("atom"), *[(F.col("embedding")[k].cast("double") * 10).alias(c) for k, c in enumerate("xyz")])


def wrap_positions(spark, sf_dir):
    box = F.array(*[F.lit(float(v)) for v in (2, 0, 0, 1, 4, 0, 0, 0, 5)])
    out = G.wrap_positions(positions(spark, sf_dir).withColumn("box", box))
    return out.select("atom", *[F.round(c, 6).alias(c) for c in ("s0", "s1", "s2", "w0", "w1", "w2")], "out_of_bounds")


WRAP_SQL = """
with e as (select vec_id as atom, embedding[1]::double * 10 as x, embedding[2]::double * 10 as y, embedding[3]::double * 10 as z from embeddings), s as (select atom, (x - y / 4) / 2 as s0, y / 4 as s1, z / 5 as s2 from e)
select atom, round(s0, 6) as s0, round(s1, 6) as s1, round(s2, 6) as s2, round(s0 - floor(s0), 6) as w0, round(s1 - floor(s1), 6) as w1, round(s2 - floor(s2), 6) as w2,
  least(s0, s1, s2) < -1e-8 or greatest(s0, s1, s2) > 1 + 1e-8 as out_of_bounds from s
"""


def unwrapped_trajectories(spark, sf_dir):
    box = F.array(*[F.lit(float(v)) for v in (30, 0, 0, 0, 30, 0, 0, 0, 30)])
    p = positions(spark, sf_dir).withColumns({c: F.col(c) + 0.5 for c in "xyz"}).withColumn("box", box)
    return G.unwrapped_trajectories(G.wrap_positions(p, tolerance=1e-6), "label", "atom", "out_of_bounds")


UNWRAPPED_SQL = """
with e as (select label, vec_id, [embedding[k]::double * 10 + 0.5 for k in [1, 2, 3]] as p from embeddings)
select label, min(vec_id) as first_bad_frame, count(distinct vec_id) as bad_frames from e where list_min(p) / 30 < -1e-6 or list_max(p) / 30 > 1 + 1e-6 group by 1
"""


def close_contacts(spark, sf_dir):
    out = G.close_contacts(positions(spark, sf_dir), "label", 0.6, (6.0, 6.0, 40.0))
    return out.withColumn("distance", F.round("distance", 6))


CONTACTS_SQL = """
with e as (select label, vec_id as a, embedding[1]::double * 10 as x, embedding[2]::double * 10 as y, embedding[3]::double * 10 as z from embeddings),
d as (select p.label, p.a as atom_a, q.a as atom_b, (p.x - q.x) - 6 * round_even((p.x - q.x) / 6, 0) as dx, (p.y - q.y) - 6 * round_even((p.y - q.y) / 6, 0) as dy, p.z - q.z as dz from e p join e q on p.label = q.label and p.a < q.a)
select label, atom_a, atom_b, round(sqrt(dx * dx + dy * dy + dz * dz), 6) as distance from d where sqrt(dx * dx + dy * dy + dz * dz) < 0.6
"""


def skewed_contacts(spark, sf_dir):
    """Contacts in cells that are skewed, of another shape for each label, and smaller than the cutoff along one edge for some."""
    k = F.col("label").cast("double")
    box = F.array(6 + k * 0.1, F.lit(0.0), F.lit(0.0), -3 + k * 0.2, F.lit(5.2), F.lit(0.0), F.lit(0.4), k * 0.1, F.when(F.col("label") % 4 == 0, 0.9).otherwise(7.0))
    rows = positions(spark, sf_dir).withColumn("box", box)
    out = G.cell_contacts(rows, "label", 1.0, periodic=(True, True, True))
    return out.withColumn("distance", F.round("distance", 6))


SKEWED_SQL = """
with e as (select label, label::double as k, vec_id as a, embedding[1]::double * 10 as x, embedding[2]::double * 10 as y, embedding[3]::double * 10 as z from embeddings),
c as (select *, 6 + k * 0.1 as ax, -3 + k * 0.2 as bx, 5.2 as yb, 0.4 as cx, k * 0.1 as cy, case when label % 4 = 0 then 0.9 else 7.0 end as cz from e),
s as (select *, z / cz as w0, (y - z / cz * cy) / yb as v0 from c), t as (select *, (x - w0 * cx - v0 * bx) / ax as u0 from s), h as (select *, u0 - floor(u0) as u, v0 - floor(v0) as v, w0 - floor(w0) as w from t),
i as (select unnest(range(-2, 3)) as n), p as (select p.label, p.a as atom_a, q.a as atom_b, p.ax, p.bx, p.yb, p.cx, p.cy, p.cz, p.u - q.u + i.n as du, p.v - q.v + j.n as dv, p.w - q.w + l.n as dw from h p join h q on p.label = q.label and p.a < q.a, i, i j, i l),
d as (select label, atom_a, atom_b, sqrt((du * ax + dv * bx + dw * cx) ** 2 + (dv * yb + dw * cy) ** 2 + (dw * cz) ** 2) as d from p)
select label, atom_a, atom_b, round(min(d), 6) as distance from d where d < 1.0 group by 1, 2, 3
"""


def range_notation(spark, sf_dir):
    """Ranges of systems in their notation, one text for each customer's orders, with gaps, overlaps, negative and malformed
    ones and wrong last ends: everything that is wrong."""
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))
    start = F.col("k") * 10 + F.when(F.col("k") % 37 == 0, 3).otherwise(0)
    end = F.col("k") * 10 + F.when(F.col("k") % 41 == 0, -5).when(F.col("k") % 5 == 4, 60).otherwise(10)
    raw = F.when(F.col("k") % 43 == 0, F.concat("k", F.lit(":x:0.5"))).when(F.col("k") % 47 == 0, F.concat("k", F.lit(":1"))).otherwise(F.concat_ws(":", start, end, F.lit(" 0.25 ")))
    texts = o.groupBy("o_custkey").agg(F.concat_ws(";", F.lit("prob_sys_size"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", raw.alias("raw")))), lambda x: x.raw), " ; "), F.lit("")).alias("text"), F.max("k").alias("last"))
    parsed = D.parsed_ranges(texts, "o_custkey", "text").join(texts.select("o_custkey", (F.col("last") * 10 + 10).alias("total")), "o_custkey")
    return D.range_errors(parsed, "o_custkey", "position", "start", "end", "total")


RANGE_NOTATION_SQL = """
with o as (select o_custkey, o_orderkey as k, k * 10 + case when k % 37 = 0 then 3 else 0 end as a, k * 10 + case when k % 41 = 0 then -5 when k % 5 = 4 then 60 else 10 end as b, k % 43 = 0 or k % 47 = 0 as bad from orders),
g as (select *, coalesce(lag(b) over (partition by o_custkey order by k), 0) as before, row_number() over (partition by o_custkey order by k desc) = 1 as final from o where not bad),
m as (select o_custkey, max(k) * 10 + 10 as total from o group by 1)
select o_custkey, 'range_gap' as code, before || ' ' || a as detail from g where before <> a union all select o_custkey, 'range_negative', a || ' ' || b from g where b < a
union all select o_custkey, 'range_malformed', k || case when k % 43 = 0 then ':x:0.5' else ':1' end from o where bad union all select o_custkey, 'range_end', total || ' ' || b from g join m using (o_custkey) where final and total <> b
"""


def systems_report(spark, sf_dir):
    """Everything that is wrong with a list of systems (parts): paths, type maps, similar unlisted names."""
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part")
    listed = part.where(k % 3 > 0).select(F.concat(F.lit("/r/s"), F.when(k % 29 == 0, "Test").otherwise(""), F.lpad(k.cast("string"), 7, "0")).alias("p"))
    names = F.expr("case p_partkey % 13 when 0 then array('O', 'X') when 1 then array('H', 'O') when 2 then array('O', 'H', 'Z', 'Y') when 3 then array() when 4 then array('O') else array('O', 'H') end")
    scanned = part.where(k % 3 < 2).select(F.concat(F.lit("/r/s"), F.lpad(k.cast("string"), 7, "0")).alias("p"), names.cast("array<string>").alias("type_map"))
    out = D.systems_report(listed, scanned, "p", "/r", known=scanned.limit(0).select("p"), expected=["O", "H", "Z"])
    return out.where("code <> 'similar'")


SYSTEMS_REPORT_SQL = """
with l as (select '/r/s' || case when p_partkey % 29 = 0 then 'Test' else '' end || lpad(p_partkey::varchar, 7, '0') as path from part where p_partkey % 3 > 0),
s as (select '/r/s' || lpad(p_partkey::varchar, 7, '0') as path, case p_partkey % 13 when 0 then 'O,X' when 1 then 'H,O' when 2 then 'O,H,Z,Y' when 3 then '' when 4 then 'O' else 'O,H' end as names from part where p_partkey % 3 < 2)
select case when path like '%Test%' then 'not_scanned' else 'missing' end as code, path, null as detail from l where path not in (select path from s) union all select 'unlisted', path, null from s where path not in (select path from l)
union all select case names when 'O,X' then 'type_map_unknown' when 'H,O' then 'type_map' when 'O,H,Z,Y' then 'type_map_longer' else 'type_map_empty' end, path, names from s where names not in ('O', 'O,H')
union all select 'type_map_count', names, count(*)::varchar from s where names in ('O', 'O,H') group by names
"""


QUERIES = {f.__name__: f for f in (composition_groups, element_counts, type_map_union, type_remap, typemap_counts, element_ordering, frames_by_label, coverage_diff, index_contiguity, range_contiguity, fuzzy_match, validation_report, nonfinite_shape_checks, inspect_datasets, inspect_root, declared_mismatches, composition_fallback, sha256_audit, wrap_positions, unwrapped_trajectories, close_contacts)}
ORACLES = dict(zip(QUERIES, (GROUPS_SQL, ELEMENTS_SQL, UNION_SQL, REMAP_SQL, TYPEMAPS_SQL, ORDERING_SQL, LABELS_SQL, COVERAGE_SQL, CONTIGUOUS_SQL, RANGES_SQL, FUZZY_SQL, VALIDATION_SQL, CHECKS_SQL, INSPECT_SQL, ROOT_SQL, MISMATCH_SQL, FALLBACK_SQL, AUDIT_SQL, WRAP_SQL, UNWRAPPED_SQL, CONTACTS_SQL), strict=True))
QUERIES["matching_blocks"] = matching_blocks
QUERIES |= {"skewed_contacts": skewed_contacts, "range_notation": range_notation, "systems_report": systems_report}
ORACLES |= {"skewed_contacts": SKEWED_SQL, "range_notation": RANGE_NOTATION_SQL, "systems_report": SYSTEMS_REPORT_SQL}
