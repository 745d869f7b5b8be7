"""Frame datasets: inspection, validation, grouping, type maps, coverage, comparison and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from atomframe.functions.expressions import count_not_finite, element_counts, formula, missing_names, remapped
from atomframe.operators.index import global_index
from atomframe.operators.names import matching_ratio, similar_names  # noqa: F401

ARRAYS = ("coord", "box", "energy", "force", "virial")


def shape_errors() -> Column:
    """Error codes of a frame: array lengths against natoms and type indices against type_map; an absent virial is fine."""
    n = F.col("natoms")
    checks = [
        (F.coalesce(F.size("coord") != 3 * n, F.lit(True)), "coord_shape"),
        (F.coalesce(F.size("force") != 3 * n, F.lit(True)), "force_shape"),
        (F.coalesce(F.size("box") != 9, F.lit(True)), "box_shape"),
        (F.col("energy").isNull(), "energy_missing"),
        (F.col("virial").isNotNull() & (F.size("virial") != 9), "virial_shape"),
        (F.coalesce(F.size("types") != n, F.lit(True)), "types_shape"),
        (F.coalesce(F.exists("types", lambda t: (t < 0) | (t >= F.size("type_map"))), F.lit(False)), "type_out_of_range"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code in checks]))


def checked_frames(frames: DataFrame) -> DataFrame:
    """Adds ``errors`` and ``nonfinite_<array>``."""
    energy = F.when(F.isnan("energy") | (F.abs("energy") == F.lit(float("inf"))), 1).otherwise(0).cast("long")
    counts = {f"nonfinite_{a}": energy if a == "energy" else count_not_finite(a) for a in ARRAYS}
    return frames.withColumn("errors", shape_errors()).withColumns(counts)


def inspect_systems(frames: DataFrame) -> DataFrame:
    """Frames, sets, frames with virial, non-finite values and invalid frames of each system. Where frames have an ``error``
    (sets that could not be read), such rows are counted as broken_sets and nothing else."""
    f = checked_frames(frames)
    there = F.col("error").isNull() if "error" in frames.columns else F.lit(True)
    sums = [F.coalesce(F.sum(F.when(there, F.col(f"nonfinite_{a}"))), F.lit(0)).alias(f"nonfinite_{a}") for a in ARRAYS]
    broken = [F.count_if(~there).alias("broken_sets")] if "error" in frames.columns else []
    own = lambda c: F.when(there, F.col(c))
    return f.groupBy("system_path").agg(
        F.count_if(there).alias("frames"), F.count_distinct(own("set_name")).alias("sets"), F.max("natoms").alias("natoms"), F.count("virial").alias("virial_frames"), *sums,
        F.count_if(there & (F.size("errors") > 0)).alias("invalid_frames"), F.count_distinct(own("natoms")).alias("natoms_values"), F.any_value("type_map", F.lit(True)).alias("type_map"), *broken,
    )


def inspect_root(systems: DataFrame) -> DataFrame:
    """Systems, frames, atoms, distinct type maps, and whether all is well."""
    good = (F.count("*") > 0) & (F.sum("invalid_frames") == 0)
    good = good & (F.sum("broken_sets") == 0) if "broken_sets" in systems.columns else good
    return systems.agg(F.count("*").alias("systems"), F.sum("frames").alias("frames"), F.sum(F.col("frames") * F.col("natoms")).alias("atoms"), F.count_distinct("type_map").alias("type_maps"), F.coalesce(good, F.lit(False)).alias("valid"))


def composition_groups(df: DataFrame, elements: str = "elements", counts: str = "counts") -> DataFrame:
    """Groups of equal (elements, counts) in file order, with natoms, a formula and 1-based numbers by (natoms, elements)."""
    groups = df.groupBy(elements, counts).agg(F.count("*").alias("members"))
    groups = groups.withColumn("natoms", F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)).withColumn("formula", formula(elements, counts))
    placed = global_index(groups, ["natoms", elements, counts], "__i")
    return placed.withColumn("group_number", (F.col("__i") + 1).cast("int")).drop("__i")


def with_element_counts(df: DataFrame, types: str = "types", names: str = "type_map") -> DataFrame:
    found = element_counts(types, names)
    return df.withColumn("__f", found).withColumn("elements", F.col("__f.element")).withColumn("counts", F.col("__f.n")).drop("__f")


def type_map_union(df: DataFrame, system: str, names: str) -> DataFrame:
    """All element names (a few hundred at most) in first-seen order: by system, then place in its map. Adds a 0-based type."""
    seen = df.select(F.col(system).alias("s"), F.posexplode(names).alias("p", "element"))
    first = seen.groupBy("element").agg(F.min(F.struct("s", "p")).alias("at"))
    return first.select("element", (F.row_number().over(Window.orderBy("at", "element")) - 1).alias("type"))


def remap_types(df: DataFrame, target: list[str], types: str = "types", names: str = "type_map") -> DataFrame:
    """Adds ``new_types`` and ``missing``: names that the canonical map lacks, which make the system fail."""
    canon = F.array(*[F.lit(x) for x in target])
    return df.withColumn("missing", missing_names(names, canon)).withColumn("new_types", F.when(F.size("missing") == 0, remapped(types, names, canon)))


def type_map_counts(df: DataFrame, names: str, expected: list[str] | None = None) -> DataFrame:
    """How many systems use each type map, most common first, and whether it begins the expected one."""
    out = df.groupBy(names).agg(F.count("*").alias("systems"))
    if expected is not None:
        canon = F.array(*[F.lit(x) for x in expected])
        out = out.withColumn("is_prefix", F.slice(canon, F.lit(1), F.size(names)) == F.col(names))
    return out


def frames_by_label(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("frames"), F.min("natoms").alias("natoms_min"), F.max("natoms").alias("natoms_max"))


def _tested(path: str) -> Column:
    return F.exists(F.split(path, "/"), lambda x: F.lower(x).contains("test"))


def coverage(listed: DataFrame, scanned: DataFrame, path: str, root: str | None = None) -> DataFrame:
    """(path, code) for duplicate, outside_root, missing and unlisted paths. What was scanned is looked at without paths that
    have a component like *test*; such a path in the list is not_scanned."""
    a = listed.groupBy(path).agg(F.count("*").alias("__n"))
    b = scanned.select(path).distinct().where(~_tested(path)).withColumn("__there", F.lit(True))
    both = a.join(b, path, "full")
    gone = F.col("__there").isNull()
    codes = [F.when(F.col("__n") > 1, "duplicate"), F.when(gone & ~_tested(path), "missing"), F.when(gone & _tested(path), "not_scanned"), F.when(F.col("__n").isNull(), "unlisted")]
    if root:
        codes.append(F.when(F.col("__n").isNotNull() & ~F.col(path).startswith(root.rstrip("/") + "/"), "outside_root"))
    return both.select(path, F.explode(F.array_compact(F.array(*codes))).alias("code"))


def contiguous_index(df: DataFrame, index: str) -> DataFrame:
    """One row: whether the index is 0 .. n - 1 without gaps or repeats."""
    n = F.count("*")
    ok = (n > 0) & (F.min(index) == 0) & (F.max(index) == n - 1) & (F.count_distinct(index) == n)
    return df.agg(n.alias("rows"), F.coalesce(ok, F.lit(False)).alias("contiguous"))


def range_ends(df: DataFrame, group: list[str], position: str, end: str, total: str) -> DataFrame:
    """Groups whose last range does not end at their total."""
    last = df.groupBy(*group).agg(F.max_by(end, position).alias("last_end"), F.max(total).alias("expected_end"))
    return last.where("last_end <> expected_end")


def type_map_codes(systems: DataFrame, expected: list[str]) -> DataFrame:
    """Adds ``code``: type_map_empty, type_map_longer than the expected one, type_map_unknown (elements), type_map (in another
    order), or null where a system's type_map begins the expected one."""
    canon, own = F.array(*[F.lit(x) for x in expected]), F.col("type_map")
    code = (
        F.when(F.coalesce(F.size(own), F.lit(0)) < 1, "type_map_empty")
        .when(F.size(own) > len(expected), "type_map_longer")
        .when(F.slice(canon, F.lit(1), F.size(own)) == own, F.lit(None))
        .when(F.size(F.array_except(own, canon)) > 0, "type_map_unknown")
        .otherwise("type_map")
    )
    return systems.withColumn("code", code)


def systems_report(listed: DataFrame, scanned: DataFrame, path: str, root: str | None = None, known: DataFrame | None = None, ranges: DataFrame | None = None, expected: list[str] | None = None) -> DataFrame:
    """Everything that is wrong with a list of systems, as (code, path, detail): coverage against what was found, similar
    unlisted names (or those of ``known``) for missing paths, type maps that do not begin the expected one (``scanned`` has
    type_map) and how many systems have each that does (type_map_count), and what is wrong with the ranges (group,
    position, start, end, total)."""
    covered = coverage(listed, scanned, path, root)
    empty = F.lit(None).cast("string")
    out = covered.select("code", F.col(path).alias("path"), empty.alias("detail"))
    missing = covered.where("code = 'missing'").select(path)
    near = similar_names(missing, known if known is not None else covered.where("code = 'unlisted'").select(path), path)
    out = out.unionByName(near.select(F.lit("similar").alias("code"), F.col("name").alias("path"), F.col("suggestion").alias("detail")))
    if expected is not None:
        coded = type_map_codes(scanned, expected).withColumn("names", F.array_join("type_map", ","))
        out = out.unionByName(coded.where("code is not null").select("code", F.col(path).alias("path"), F.col("names").alias("detail")))
        good = coded.where("code is null").groupBy("names").agg(F.count("*").cast("string").alias("detail"))
        out = out.unionByName(good.select(F.lit("type_map_count").alias("code"), F.col("names").alias("path"), "detail"))
    if ranges is not None:
        out = out.unionByName(range_errors(ranges, "group", "position", "start", "end", "total").select("code", F.col("group").cast("string").alias("path"), "detail"))
    return out


def parsed_ranges(df: DataFrame, group: str, text: str) -> DataFrame:
    """Ranges of the notation ``prob_sys_size;0:10:0.5;10:12:0.5``: (group, position, raw, start, end, prob), in order; blank
    parts and the leading word are left out, and what is no range has nulls."""
    parts = df.select(group, F.posexplode(F.split(F.coalesce(text, F.lit("")), ";")).alias("position", "raw")).withColumn("raw", F.trim("raw"))
    parts = parts.where((F.col("raw") != "") & ~F.col("raw").startswith("prob_sys_size"))
    cells = F.split("raw", ":")
    three = F.size(cells) == 3
    whole = lambda i: F.when(three & F.trim(F.get(cells, F.lit(i))).rlike("^[+-]?[0-9]+$"), F.expr(f"try_cast(trim(get(split(raw, ':'), {i})) as bigint)"))
    prob = F.when(three, F.expr("try_cast(trim(get(split(raw, ':'), 2)) as double)"))
    valid = whole(0).isNotNull() & whole(1).isNotNull() & prob.isNotNull()
    cell = lambda c: F.when(valid, c)
    return parts.select(group, "position", "raw", cell(whole(0)).alias("start"), cell(whole(1)).alias("end"), cell(prob).alias("prob"))


def range_errors(df: DataFrame, group: str, position: str, start: str, end: str, total: str) -> DataFrame:
    """(group, code, detail) of the ranges of each group, in order of position: range_malformed (null start or end),
    range_gap (a start that is not the end before, the first: not 0), range_negative, and range_end (the last end is not
    the group's total). Malformed ranges are passed over by the others."""
    good = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    expected = F.lag(end, 1, 0).over(Window.partitionBy(group).orderBy(position))
    codes = F.array_compact(F.array(
        F.when(F.col("__expected") != F.col(start), F.struct(F.lit("range_gap").alias("code"), F.concat_ws(" ", "__expected", start).alias("detail"))),
        F.when(F.col(end) < F.col(start), F.struct(F.lit("range_negative").alias("code"), F.concat_ws(" ", start, end).alias("detail"))),
    ))
    swept = good.withColumn("__expected", expected).select(group, F.explode(codes).alias("e")).select(group, "e.code", "e.detail")
    raw = F.col("raw") if "raw" in df.columns else F.col(position).cast("string")
    broken = df.where(F.col(start).isNull() | F.col(end).isNull()).select(group, F.lit("range_malformed").alias("code"), raw.alias("detail"))
    last = range_ends(good, [group], position, end, total).select(group, F.lit("range_end").alias("code"), F.concat_ws(" ", "expected_end", "last_end").alias("detail"))
    return swept.unionByName(broken).unionByName(last)


def range_gaps(df: DataFrame, group: list[str], position: str, start: str, end: str) -> DataFrame:
    """Ranges of a group that do not begin where the one before ended (the first: at 0)."""
    before = F.lag(end, 1, 0).over(Window.partitionBy(*group).orderBy(position))
    return df.withColumn("expected_start", before).where(F.col("expected_start") != F.col(start))


def compare_archives(source: DataFrame, archive: DataFrame, key: str, fields: list[str], atol: float = 0.0) -> DataFrame:
    """For each field: frames compared, frames missing on either side, differing values and the largest difference.

    A value differs if either is NaN or they are further apart than ``atol``; NaN does not count in the largest
    difference, and arrays of different sizes, or only one of them null, differ by infinity."""
    a = source.select(key, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("__a"))
    b = archive.select(key, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("__b"))
    both = a.join(b, key, "full")
    inf = F.lit(float("inf"))
    rows = []
    for f in fields:
        x, y = F.col(f"a_{f}"), F.col(f"b_{f}")
        pairs = F.zip_with(x, y, lambda p, q: F.struct(p.cast("double").alias("p"), q.cast("double").alias("q")))
        same = lambda v: ~F.isnan(v.p) & ~F.isnan(v.q) & ((v.p == v.q) | (F.abs(v.p - v.q) <= atol))
        unlike = (x.isNull() != y.isNull()) | F.coalesce(F.size(x) != F.size(y), F.lit(False))
        bad = F.when(unlike, F.greatest(F.size(x), F.size(y))).otherwise(F.coalesce(F.size(F.filter(pairs, lambda v: ~same(v))), F.lit(0)))
        gaps = F.transform(pairs, lambda v: F.abs(v.p - v.q))
        top = F.when(unlike, inf).otherwise(F.array_max(F.filter(gaps, lambda d: ~F.isnan(d))))
        rows.append(F.struct(F.lit(f).alias("field"), F.when(x.isNull() & y.isNull(), 0).otherwise(bad).alias("bad"), top.alias("top")))
    long = both.select("__a", "__b", F.explode(F.array(*rows)).alias("r"))
    compared = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    return long.groupBy(F.col("r.field").alias("field")).agg(
        F.count_if(compared).alias("frames_compared"),
        F.count_if(F.col("__b").isNull()).alias("missing_in_archive"),
        F.count_if(F.col("__a").isNull()).alias("unexpected_in_archive"),
        F.coalesce(F.sum(F.when(compared & (F.col("r.bad") > 0), F.col("r.bad"))), F.lit(0)).cast("long").alias("different_values"),
        F.max(F.when(compared, F.col("r.top"))).alias("max_abs_difference"),
    )


def declared_mismatches(manifest: DataFrame, systems: DataFrame, key: str = "system_path") -> DataFrame:
    """Systems whose declared frames or natoms differ from what was found; a null declaration is not checked."""
    found = systems.select(key, F.col("frames").alias("found_frames"), F.col("natoms").alias("found_natoms"))
    joined = manifest.select(key, "frames", "natoms").join(found, key, "left")
    bad = F.col("found_frames").isNull() | (F.col("frames") != F.col("found_frames")) | (F.col("natoms") != F.col("found_natoms"))
    return joined.where(F.coalesce(bad, F.lit(False)))


def composition_fallback(keys: DataFrame, *tables: DataFrame, on: list[str], value: str, valid: Column) -> DataFrame:
    """The first table's valid value for each key, in the order of the tables."""
    out = keys
    for i, t in enumerate(tables):
        out = out.join(t.where(valid).select(*on, F.col(value).alias(f"__{i}")), on, "left")
    return out.withColumn(value, F.coalesce(*[F.col(f"__{i}") for i in range(len(tables))])).drop(*[f"__{i}" for i in range(len(tables))])


def hash_audit(left: DataFrame, right: DataFrame, key: str, content: str) -> DataFrame:
    """SHA-256 of both sides and whether they are equal, for every key of either side."""
    digest = lambda t, name: t.select(key, F.sha2(F.col(content).cast("binary"), 256).alias(name))
    return digest(left, "left_sha256").join(digest(right, "right_sha256"), key, "full").withColumn("equal", F.coalesce(F.col("left_sha256") == F.col("right_sha256"), F.lit(False)))


def validation_report(frames: DataFrame) -> DataFrame:
    """(code, frames) for every kind of error among the frames."""
    f = checked_frames(frames)
    bad = F.array_compact(F.array(*[F.when(F.col(f"nonfinite_{a}") > 0, F.lit(f"nonfinite_{a}")) for a in ARRAYS]))
    return f.select(F.explode(F.concat("errors", bad)).alias("code")).groupBy("code").agg(F.count("*").alias("frames"))


def validate_dataset(groups: DataFrame, arrays: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """(group_name, code) of a converted dataset. ``groups``: group_name, elements, counts, selected, converted, skipped and,
    if they are to be checked, types; ``arrays``: group_name, array, raw_rows, npy_rows, of which each group must have all
    five (a null number: that file is missing); ``totals``: one row with group_count and frames_converted as declared (null:
    not declared), whose codes have no group."""
    same = groups.groupBy(F.col("elements").alias("__e"), F.col("counts").alias("__c")).agg(F.count("*").alias("__same"))
    g = groups.join(same, groups["elements"].eqNullSafe(same["__e"]) & groups["counts"].eqNullSafe(same["__c"]))
    none = F.coalesce(F.size("elements"), F.lit(0)) < 1
    codes = [
        F.when(F.col("__same") > 1, "duplicate_composition"),
        F.when(none, "composition_missing").when(F.coalesce(F.size("elements") != F.size("counts"), F.lit(True)), "element_count_length"),
        F.when(F.coalesce(F.col("converted"), F.lit(0)) <= 0, "nothing_converted"),
        F.when(F.coalesce(F.col("selected") != F.col("converted"), F.lit(False)), "selected_not_converted"),
        F.when(F.col("skipped") > 0, "skipped_frames"),
    ]
    if "types" in groups.columns:
        found = F.array_sort(F.transform(F.array_distinct("types"), lambda t: F.size(F.filter("types", lambda x: x == t))))
        codes.append(F.when(F.coalesce(found != F.array_sort("counts"), F.lit(True)), "type_counts"))
    out = g.select("group_name", F.explode(F.array_compact(F.array(*codes))).alias("code"))
    wanted = groups.select("group_name", "converted", F.explode(F.array(*[F.lit(a) for a in ARRAYS])).alias("array"))
    rows = wanted.join(arrays, ["group_name", "array"], "left")
    missing = F.col("raw_rows").isNull() | F.col("npy_rows").isNull()
    unlike = (F.col("raw_rows") != F.coalesce("converted", F.lit(0))) | (F.col("npy_rows") != F.coalesce("converted", F.lit(0)))
    code = F.when(missing, F.concat(F.lit("missing: "), "array")).when(unlike, F.concat(F.lit("frame count mismatch: "), "array"))
    out = out.unionByName(rows.withColumn("code", code).where("code is not null").select("group_name", "code"))
    if totals is not None:
        own = groups.agg(F.count("*").alias("__groups"), F.coalesce(F.sum("converted"), F.lit(0)).alias("__frames")).crossJoin(F.broadcast(totals))  # one row each
        wrong = [F.when(F.col("__groups") != F.col("group_count"), "group_count"), F.when(F.col("__frames") != F.col("frames_converted"), "frames_converted")]
        out = out.unionByName(own.select(F.lit(None).cast("string").alias("group_name"), F.explode(F.array_compact(F.array(*wrong))).alias("code")))
    return out


def validate_archive(frames: DataFrame, meta: DataFrame) -> DataFrame:
    """(code, n) of an archive: entry count, contiguous index, system ids in range, unique type map, and frame checks."""
    systems = F.col("nsystems") if "nsystems" in meta.columns else F.size("systems")
    m = meta.select(F.col("nframes").alias("__n"), systems.alias("__s"), (F.size(F.array_distinct("type_map")) != F.size("type_map")).alias("__dup"))
    top = frames.agg(F.count("*").alias("n"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"), F.count_distinct("frame_index").alias("d"), F.max("system_id").alias("sid"), F.min("system_id").alias("sid0")).crossJoin(F.broadcast(m))  # one row each
    gap = (F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))
    codes = [F.when(F.col("n") != F.col("__n"), "entry_count"), F.when(gap, "index_not_contiguous"), F.when((F.col("sid") >= F.col("__s")) | (F.col("sid0") < 0), "system_id_out_of_range"), F.when(F.col("__dup"), "type_map_not_unique")]
    whole = top.select(F.explode(F.array_compact(F.array(*codes))).alias("code"), F.lit(1).cast("long").alias("n"))
    return whole.unionByName(validation_report(frames).select("code", F.col("frames").alias("n")))
