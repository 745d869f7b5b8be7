"""End-to-end jobs: what users run, as compositions of the sources, operators and writers."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from atomframe.functions import states
from atomframe import session
from atomframe.functions.expressions import element_order, job_name, task_key, task_key_below
from atomframe.operators import campaign, dataset, index, inference, metrics, select
from atomframe.sources import converted, discovery, groups, records, sinks, structures


def inspected(spark: SparkSession, roots: list[str]) -> tuple[DataFrame, DataFrame]:
    """One row for each system below the roots (with its bytes), and one for all of them. Sets that cannot be read are counted
    as broken and make the whole not valid."""
    headers = discovery.index_groups(spark, roots)
    size = headers.groupBy("system_path").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    systems = dataset.inspect_systems(groups.read_indexed(headers)).join(size, "system_path")
    return systems, dataset.inspect_root(systems)


def manifest_of(spark: SparkSession, roots: list[str], block: str = "", label: str = "", broken: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Manifest rows of the systems below the roots, numbered by path, and the report of what was found (see
    ``discovery.index_report``). Only headers are read. A blank block is the name of the system's root. Broken groups are an
    error or, with broken='leave', left out and counted in the report."""
    found = discovery.index_groups(spark, roots)
    sets = discovery.whole_groups(found, broken)
    first = lambda c: F.first(c).alias(c)
    one = sets.groupBy("system_path").agg(F.sum("frames").alias("frames"), *map(first, ("root", "natoms", "elements", "counts", "type_map", "type_map_sha256")))
    name = lambda c: F.regexp_extract(c, "([^/]*)/*$", 1)
    full = one.withColumns({"block": F.lit(block) if block else F.coalesce(F.nullif(name("root"), F.lit("")), F.lit("dataset")), "label": F.lit(label), "relative_path": name("system_path")})
    return index.global_index(full.drop("root"), ["system_path"], "index").select(*sinks.MANIFEST), discovery.index_report(found)


def archived_manifest(spark: SparkSession, manifest: str, folder: str, type_map: list[str] | None = None, most: int = 0) -> DataFrame:
    """The archive of a manifest (a path), systems in its order with their blocks and labels, at most ``most`` frames of each;
    one row of report. A manifest that is not right, a system that is missing, broken or has other frames or atoms than it
    declares, and elements that ``type_map`` (by default all names in first-seen order) lacks are errors, and then there is
    no archive."""
    rows, errors = records.read_system_manifest(spark, manifest)
    if found := [r.code for r in errors.collect()]:
        raise ValueError(f"{manifest}: {', '.join(sorted(found))}")
    rows = session.written(rows, "manifest")
    headers = discovery.whole_groups(discovery.index_folders(rows.select(F.lit("").alias("root"), F.col("system_path").alias("folder"))))
    systems = headers.groupBy("system_path").agg(F.sum("frames").alias("frames"), F.first("natoms").alias("natoms"), F.first("type_map").alias("type_map"))
    if found := dataset.declared_mismatches(rows, systems).limit(10).collect():
        raise ValueError("the manifest declares other frames or atoms: " + "; ".join(f"{r.system_path}: {r.found_frames} frames, {r.found_natoms} atoms" for r in found))
    named = rows.select("system_path", F.col("system_index").cast("long").alias("system_id"), "block", "label")
    if type_map is None:
        type_map = [r.element for r in dataset.type_map_union(systems.join(named, "system_path"), "system_id", "type_map").orderBy("type").collect()]  # a few hundred
    placed = (discovery.limited(headers, most) if most else headers).join(named, "system_path")
    return sinks.write_indexed_archive(placed, folder, type_map)


def converted_calculations(spark: SparkSession, root: str, folder: str, type_order: list[str], require_tag: bool = False, require_finished: bool = False, most: int | None = None, frames_per_set: int = 5000, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Calculations below ``root`` (system/frame folders) as a dataset in the new ``folder``: what was written for each group
    (group_name, frames, natoms, elements, counts), and what was selected, converted and skipped of each composition (null
    elements: the structure could not be read). ``only``: the frames (system, frame) to be looked at. Nothing to convert is an
    error, as are elements without a type."""
    folders = structures.calculation_folders(spark, root)
    scan = structures.eligible(structures.scan_markers(spark, root, "", folders, outputs=False), require_tag, require_finished).select("system", "frame")
    scan = scan if only is None else scan.join(only.distinct(), ["system", "frame"], "left_semi")
    scan = select.natural_top(scan, "system", "frame", most) if most else scan
    parts = F.split("folder", "/")
    found = structures.read_calculations(spark, root, folders.join(scan, ["system", "frame"], "left_semi"))
    mine = session.written(found.withColumns({"system": F.element_at(parts, -2), "frame": F.element_at(parts, -1)}), "parsed")  # outputs are parsed once
    canon = F.array(*[F.lit(x) for x in type_order])
    unknown = mine.where("structure_error is null").where(F.size(F.array_except("elements", canon)) > 0)
    if not unknown.isEmpty():
        raise ValueError(f"elements not in the type order: {unknown.first().elements}")
    good = mine.where("error is null")
    if good.isEmpty():
        raise ValueError(f"nothing to convert below {root}")
    types = F.flatten(F.transform(F.arrays_zip("elements", "counts"), lambda e: F.array_repeat(F.array_position(canon, e.elements).cast("int") - 1, e.counts)))
    frames = good.select(F.concat_ws("/", "system", "frame").alias("system_path"), F.lit("set.000").alias("set_name"), F.lit(0).alias("frame_in_set"), "natoms", types.alias("types"), canon.alias("type_map"), "coord", "box", "energy", "force", "virial")
    written = groups.write_raw(groups.write_groups(frames, folder, frames_per_set), folder)
    summary = mine.groupBy("elements", "counts").agg(F.count("*").alias("selected"), F.count_if(F.col("error").isNull()).alias("converted"), F.count_if(F.col("error").isNotNull()).alias("skipped"))
    return written, summary


def split_dataset(spark: SparkSession, roots: list[str], folder: str, ratio: float = 0.1, seed: int = 0, broken: str = "raise") -> tuple[DataFrame, DataFrame]:
    """Train and test datasets in the new folders ``folder``/train and /test, each system split on its own: the written sets
    (role, group_name, set_name, frames), and the numbers of frames of each system and of all. Sets that cannot be read are
    an error or, with broken='leave', left out (``inspected`` counts them)."""
    frames = groups.whole(groups.read_frame_groups(spark, roots), broken)
    named = frames.withColumn("__frame", F.concat_ws("/", "set_name", "frame_in_set"))
    split = index.train_test_split(named, ["system_path"], "__frame", ratio, seed).drop("__frame")
    out = None
    for role in ("train", "test"):
        sets = groups.write_groups(split.where(F.col("role") == role).drop("role"), f"{folder}/{role}").withColumn("role", F.lit(role))
        out = sets if out is None else out.unionByName(sets)
    return out.select("role", "group_name", "set_name", "frames"), index.split_summary(split, "system_path")


def predicted_structures(spark: SparkSession, root: str, factory: inference.Factory, type_map: list[str], pattern: str = "*POSCAR*", excluded: DataFrame | None = None, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Predictions for the structures below ``root``, without those in ``excluded`` (kind, key); the second table has those
    left out with the reason: matched_task_key, matched_path, or what is wrong with the file."""
    found = structures.read_structures(spark, root, pattern, type_map)
    keyed = found.withColumn("task_key", task_key("path"))
    if excluded is not None:
        known = excluded.select(F.when(F.col("kind") == "task_key", F.col("key")).alias("task_key"), F.when(F.col("kind") == "path", F.col("key")).alias("path"))
        keyed = select.excluded(keyed, known, "task_key", "path")
    else:
        keyed = keyed.withColumn("reason", F.lit(None).cast("string"))
    why = keyed.withColumn("reason", F.coalesce("reason", "error"))
    todo = why.where("reason is null").withColumn("type_map", F.array(*[F.lit(x) for x in type_map]))
    if most:
        folder = todo.withColumn("__folder", F.regexp_replace("path", "/[^/]*$", "")).withColumn("__system", F.regexp_replace("__folder", "/[^/]*$", ""))
        todo = select.natural_top(folder, "__system", "__folder", most).drop("__folder", "__system")
    return inference.predict(todo, factory, ["path"]), why.where("reason is not null").select("path", "reason")


@dataclass
class Evaluation:
    systems: DataFrame  # every system that was evaluated whole, with its errors, rate and worst flags
    levels: DataFrame  # errors of every system, family and the whole
    errors: DataFrame  # systems that fell out, with the reason
    status: DataFrame  # one row: systems, errors, PASS, PARTIAL or FAIL
    run: dict  # frames, seconds in the model, seconds of the run, frames_per_second


def evaluated(frames: DataFrame, factory: inference.Factory, family: str = "block", continue_on_error: bool = False, atoms_per_batch: int = 20_000, frames_per_batch: int = 0) -> Evaluation:
    """A model against frames (system_path, family, natoms, types, type_map, coord, box, energy, force, and optional virial and
    error). The model sees each frame once: tasks hand on sums only. A system of which a frame cannot be read, is not
    finite or cannot be predicted falls out whole and is an error; the status is PASS, PARTIAL (errors that were to be
    passed over) or FAIL, also where nothing was evaluated."""
    began = time.perf_counter()
    blank = "unknown" if family == "block" else "unlabeled"
    named = frames.withColumn(family, F.coalesce(F.nullif(F.trim(family), F.lit("")), F.lit(blank)))
    seen = Observation("evaluation")
    parts = inference.error_sums(named, factory, ["system_path", family], atoms_per_batch, frames_per_batch)
    parts = parts.observe(seen, F.sum("frames").alias("frames"), F.sum("seconds").alias("seconds"))
    sums = session.written(parts, "error-sums").groupBy("system_path").agg(
        F.min(family).alias(family), F.sum("frames").alias("frames"), F.sum("batches").alias("batches"), F.sum("seconds").alias("seconds"), *[F.sum(c).alias(c) for c in inference.SUMS], F.max("error").alias("error"),
    )
    sums = session.written(sums, "system-sums")
    good, had = sums.where("error is null"), sums.agg(F.sum("virial_n").alias("virial"), F.sum("frames").alias("frames")).first()
    # where no frame was evaluated there may be a virial
    levels = metrics.levels_of_sums(good, family, "system_path", bool(had.virial) or (not had.frames and "virial" in frames.columns))
    rates = good.select("system_path", "batches", "seconds", (F.col("frames") / F.nullif("seconds", F.lit(0.0))).alias("frames_per_second"))
    placed = index.global_index(levels.where("level = 'system'").drop("level", "systems").join(rates, "system_path"), ["system_path"], "index")
    flagged = metrics.worst_flags(placed, "index", "energy_rmse_meV_per_atom", "force_rmse_meV_per_A")
    took, figures = time.perf_counter() - began, seen.get
    run = {"frames": figures["frames"] or 0, "seconds": figures["seconds"] or 0.0, "wall_seconds": took, "frames_per_second": (figures["frames"] or 0) / took}
    return Evaluation(flagged, levels, sums.where("error is not null").select("system_path", family, "error"), metrics.evaluation_status(sums, continue_on_error), run)


def evaluated_dataset(spark: SparkSession, factory: inference.Factory, roots: list[str] | None = None, manifest: str | None = None, family: str = "block", most_systems: int = 0, most_frames: int = 0, **options) -> Evaluation:
    """``evaluated`` over the groups below ``roots`` (their block is unknown) or of a ``manifest`` (a path), of which only the
    first systems, by path or index, and the first frames of each are taken if so asked."""
    if manifest is not None:
        rows, errors = records.read_system_manifest(spark, manifest)
        if found := [r.code for r in errors.collect()]:
            raise ValueError(f"{manifest}: {', '.join(sorted(found))}")
        listed = rows.select(F.lit("").alias("root"), F.col("system_path").alias("folder"), "block", "label", F.col("system_index").alias("place"))
    else:
        listed = discovery.group_folders(spark, roots or []).withColumns({"block": F.lit("unknown"), "label": F.lit(""), "place": F.col("folder")})
    listed = session.written(listed.orderBy("place").limit(most_systems) if most_systems else listed, "listed")
    headers = discovery.index_folders(listed)
    headers = discovery.limited(headers, most_frames) if most_frames else headers
    headers = discovery.saved_index(headers.join(listed.select(F.col("folder").alias("system_path"), "block", "label"), "system_path"))
    return evaluated(groups.read_indexed(headers), factory, family, **options)


def parity_report(frames: DataFrame, grid: int = 160) -> tuple[DataFrame, DataFrame]:
    """From predicted frames (see ``metrics.parity_points``): points, mae and rmse of each panel, and the hexagonal counts of
    each. No frames are an error."""
    points = metrics.parity_points(frames)
    if frames.isEmpty():
        raise ValueError("there are no frames")
    summary = metrics.parity_summary(points, "true", "pred", "panel").where("points > 0")
    cells = None
    for panel in ("energy_per_atom", "force_components", "virial_components"):
        one = metrics.parity_hexbin(points.where(F.col("panel") == panel), "true", "pred", grid).withColumn("panel", F.lit(panel))
        cells = one if cells is None else cells.unionByName(one)
    return summary, cells


@dataclass
class Archived:
    rows: DataFrame  # every entry with result and reason
    report: DataFrame  # counts of each system and of all, ready or partial
    duplicates: DataFrame  # frames that converged on several targets
    ready: DataFrame  # entries of the systems that are ready, to be converted
    dataset: str | None = None  # where the ready entries' dataset was published
    backup: str | None = None  # where the one before it is


def archived_campaign(entries: DataFrame, targets: DataFrame, scan: DataFrame, root: str | None = None, dataset_root: str | None = None, type_order: list[str] | None = None, refuse: bool = True, **options) -> Archived:
    """What a campaign's entries have come to on their targets. Frames that converged on several targets are an error, unless
    ``refuse`` is false. With a ``root`` (system/frame folders of the calculations) those of the ready systems are converted
    aside, validated and published as ``dataset_root``; what was there is kept as a backup, and comes back if that fails."""
    rows = campaign.reconciled(entries, targets, scan)
    report = campaign.archive_report(rows)
    double = campaign.duplicates_across_targets(scan).join(entries.select("system", "frame").distinct(), ["system", "frame"], "left_semi")
    if refuse and (found := double.orderBy("system", "frame").limit(10).collect()):
        raise ValueError("converged on several targets: " + "; ".join(f"{r.system}/{r.frame}: {', '.join(r.targets)}" for r in found))
    good = rows.join(report.where("is_total = 0 and status = 'ready'").select("system"), "system", "left_semi").where("result = 'success'")
    out = Archived(rows, report, double, good)
    if root is None or good.isEmpty():
        return out
    spark = entries.sparkSession
    aside = f"{dataset_root.rstrip('/')}.rebuild-{uuid.uuid4().hex}"
    converted_calculations(spark, root, aside, type_order, require_tag=True, only=good.select("system", "frame"), **options)
    out.backup = sinks.installed(spark, aside, dataset_root, lambda path: validated_dataset(spark, path))
    out.dataset = dataset_root
    return out


def recovered_campaign(entries: DataFrame, targets: DataFrame, scan: DataFrame, jobs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """The recovery plan of a campaign, and how many entries have each action (zeros included)."""
    plan = campaign.recovery_plan(entries, targets, scan, jobs, **options)
    actions = ("recovered_for_resubmit", "preserved_active", "normalized_terminal", "unresolved")
    return plan, plan.agg(*[F.count_if(F.col("action") == a).alias(a) for a in actions])


def selected_candidates(runs: DataFrame, pool: DataFrame, keys: list[str], frame: str, path: str = "source_structure_path", status: str = "status", stride: int = 1, most: int | None = None) -> DataFrame:
    """Run records overlaid by the pool's, planned ones only, by stride over the frame numbers, the first ``most`` in
    natural order."""
    rows = select.overlay(runs, pool, keys, path, status).where(F.col(status) == "planned")
    rows = select.stride_by_name(rows, frame, stride) if stride > 1 else rows
    return select.natural_top(rows, keys[0], frame, most) if most else rows


def candidate_manifest(found: DataFrame, keys: list[str], counts: str = "status_counts", finished_only: bool = False, compositions: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Records (keys, status, status_counts, source) as candidates with their status, and the manifest's header.
    ``finished_only`` leaves the others out (the header counts them as skipped). ``compositions``: tables (keys, composition:
    a struct with atom_count) of which the first that knows a candidate's atoms gives its composition."""
    given = found.withColumn("status", states.inferred_status(counts, "status")) if counts in found.columns else found
    rows = given.withColumn("status", states.record_status("status"))
    kept = select.last_wins(rows, keys, ["source"])
    kept = kept.where("status = 'finished'") if finished_only else kept
    if compositions:
        known = dataset.composition_fallback(kept.select(*keys), *compositions, on=keys, value="composition", valid=F.col("composition.atom_count") > 0)
        kept = kept.join(known, keys, "left")
    return kept, campaign.manifest_header(rows)


def planned_tasks(candidates: DataFrame, heads: DataFrame, order: list[str], job: str) -> tuple[DataFrame, DataFrame]:
    """Tasks of candidates (system, frame, frame_number, path) whose structure (path, elements, error) can be read: job name
    and element order; and those that fail, with the error."""
    joined = candidates.join(heads.select("path", "elements", F.col("error").alias("__error")), "path", "left")
    why = F.when(F.coalesce(F.trim("path"), F.lit("")) == "", "no structure").otherwise(F.coalesce("__error", F.when(F.col("elements").isNull(), "structure not found")))
    rows = joined.withColumn("error", why)
    named = rows.where("error is null").withColumns({"job": F.lit(job), "element_order": element_order("elements", order)})
    tasks = named.withColumn("job_name", job_name("job", "system", "frame_number")).drop("job", "error", "__error")
    return tasks, rows.where("error is not null").select("system", "frame", "path", "error")


def campaign_summary(entries: DataFrame, *by: str) -> DataFrame:
    """Counts of all states with total, terminal and unfinished, by the given columns."""
    return campaign.status_counts(entries, *by)


def scheduler_summary(snapshots: dict[str, tuple[DataFrame, str, str]], targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From scheduler texts (target: texts, layout, run root): jobs of each target, and of all that answered (``targets``:
    target, available)."""
    every = None
    for target, (texts, kind, root) in snapshots.items():
        profile = "slurm" if kind in ("squeue", "squeue_pipes", "scontrol") else "pbs"
        rows = records.job_rows(texts, kind).select(F.lit(target).alias("target"), task_key_below("workdir", root).alias("task_key"), states.mapped_status("state", profile).alias("status"))
        every = rows if every is None else every.unionByName(rows)
    summary = campaign.job_summary(every)
    return summary, campaign.cross_target_summary(targets, summary)


def validated_dataset(spark: SparkSession, root: str) -> DataFrame:
    """(group_name, code) of a converted dataset on disk: its summaries (convert_summary.json of the root with ``groups``, or of
    each group), text arrays, array headers and type files. A root without a summary has the code summary_missing."""
    return dataset.validate_dataset(*converted.read_dataset(spark, root)) if converted.has_summary(spark, root) else spark.createDataFrame([(None, "summary_missing")], "group_name string, code string")
