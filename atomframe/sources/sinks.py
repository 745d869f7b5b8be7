"""Writers: frame archives, text exports, manifests, exclusion and system lists, and validated publishing."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atomframe.operators.dataset import validate_archive
from atomframe.operators.index import global_index
from atomframe.functions.expressions import element_order, inverse3, remapped, scaled, wrapped
from atomframe.session import written
from atomframe.sources import discovery, groups


def archive_frames(frames: DataFrame, type_map: list[str], broken: str = "raise") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Globally indexed frames (by system, set and place) with types in the order of ``type_map``; the systems, and one
    row of metadata. ``frames`` as the group source gives them, with optional block and label. Elements that the type map
    lacks are an error, and so are sets that could not be read (``broken``: see ``groups.whole``): no system is left out."""
    canon = F.array(*[F.lit(x) for x in type_map])
    have = groups.whole(frames, broken)
    for c, default in (("block", "unknown"), ("label", "")):
        have = have.withColumn(c, F.coalesce(c, F.lit(default))) if c in have.columns else have.withColumn(c, F.lit(default))
    systems = have.groupBy("system_path").agg(F.count("*").alias("frames"), F.first("natoms").alias("natoms"), F.first("block").alias("block"), F.first("label").alias("label"), F.first(F.array_except("type_map", canon)).alias("missing"))
    if not (bad := systems.where(F.size("missing") > 0)).isEmpty():
        first = bad.orderBy("system_path").first()
        raise ValueError(f"{first.system_path}: elements not in the type map: {list(first.missing)}")
    ids = global_index(systems, ["system_path"], "system_id")
    indexed = global_index(have.join(ids.select("system_path", "system_id"), "system_path"), ["system_path", "set_name", "frame_in_set"])
    out = indexed.withColumn("types", remapped("types", "type_map", canon)).withColumn("type_map", canon)
    meta = ids.agg(F.sum("frames").alias("nframes"), F.count("*").alias("nsystems")).withColumn("type_map", canon)
    return out, ids, meta


def write_archive(frames: DataFrame, folder: str, type_map: list[str], broken: str = "raise") -> DataFrame:
    """Writes frames, systems and meta below ``folder`` (which must be new), frames in the order of their index; one row of
    report, with the number of sets that were left out."""
    out, ids, meta = archive_frames(frames, type_map, broken)
    n = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out.repartitionByRange(n, "frame_index").sortWithinPartitions("frame_index").write.mode("errorifexists").parquet(f"{folder}/frames")
    ids.write.mode("errorifexists").parquet(f"{folder}/systems")
    meta.write.mode("errorifexists").parquet(f"{folder}/meta")
    spark = frames.sparkSession
    written = spark.read.parquet(f"{folder}/frames")
    errors = validate_archive(written, spark.read.parquet(f"{folder}/meta"))
    report = written.agg(F.count("*").alias("frames"), F.count_distinct("system_id").alias("systems"), F.count("virial").alias("virial_frames"), F.min("natoms").alias("natoms_min"), F.max("natoms").alias("natoms_max"))
    out_of_it = groups.left_out(frames) if broken == "leave" else 0
    return report.withColumns({"left_out": F.lit(out_of_it).cast("long"), "status": F.lit("PASS" if errors.isEmpty() else "FAIL")})


def moved(spark: SparkSession, aside: str, path: str) -> None:
    """``aside`` becomes ``path``, which must not be there, in one step."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at(path)) or not fs.rename(at(aside), at(path)):
        raise FileExistsError(path)


def write_indexed_archive(index: DataFrame, folder: str, type_map: list[str]) -> DataFrame:
    """An archive of the sets of ``index`` (see ``discovery``) with system_id, block and label, by system_id and set. Frame
    numbers come from the sets' frames, so the frames are read once, in order, and neither numbered nor shuffled. Written
    aside, validated and published in one step; one row of report."""
    spark, canon = index.sparkSession, F.array(*[F.lit(x) for x in type_map])
    placed = discovery.saved_index(discovery.placed(index, ["system_id", "set_name"]))
    if bad := placed.where(F.size(F.array_except("type_map", canon)) > 0).select("system_path", F.array_except("type_map", canon).alias("missing")).first():
        raise ValueError(f"{bad.system_path}: elements not in the type map: {list(bad.missing)}")
    frames = groups.whole(groups.read_indexed(placed)).withColumn("frame_index", F.col("frame_start") + F.col("frame_in_set"))
    aside = f"{folder.rstrip('/')}.staging-{uuid.uuid4().hex}"
    frames.withColumn("types", remapped("types", "type_map", canon)).withColumn("type_map", canon).drop("error", "frame_start").write.parquet(f"{aside}/frames")
    first = lambda c: F.first(c).alias(c)
    systems = placed.groupBy("system_id", "system_path", "block", "label").agg(F.sum("frames").alias("frames"), first("natoms"), first("elements"), first("counts"), F.sum(F.when(F.col("virial"), F.col("frames")).otherwise(0)).alias("virial_frames"))
    systems.write.parquet(f"{aside}/systems")
    systems = spark.read.parquet(f"{aside}/systems")
    systems.agg(F.sum("frames").alias("nframes"), F.count("*").alias("nsystems")).withColumn("type_map", canon).write.parquet(f"{aside}/meta")
    errors = validate_archive(spark.read.parquet(f"{aside}/frames"), spark.read.parquet(f"{aside}/meta"))
    if found := [r.asDict() for r in errors.limit(20).collect()]:
        raise ValueError(f"not published: {json.dumps(found)}")
    moved(spark, aside, folder)
    return written(archive_summary(spark, folder), "archive-report")


def installed(spark: SparkSession, aside: str, path: str, validate: Callable[[str], DataFrame]) -> str | None:
    """Puts the folder ``aside`` in the place of ``path``: validated there and here (``validate`` gives a table of errors of a
    folder), the old one kept as a backup whose path is returned, and put back if anything fails; ``aside`` is then gone."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    backup = f"{path.rstrip('/')}.backup-{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    had = False
    try:
        if found := [r.asDict() for r in validate(aside).limit(20).collect()]:
            raise ValueError(f"not published: {json.dumps(found)}")
        if had := fs.exists(at(path)):
            fs.rename(at(path), at(backup))
        fs.rename(at(aside), at(path))
        if not validate(path).isEmpty():
            raise ValueError("the published folder is not valid")
    except Exception:
        fs.delete(at(aside), True)
        if had:
            fs.delete(at(path), True)
            fs.rename(at(backup), at(path))
        raise
    return backup if had else None


def archive_summary(spark: SparkSession, folder: str) -> DataFrame:
    """One row of an archive: status, systems, frames, virial_frames, natoms_min and natoms_max, and the frames of each block
    and of each label that is not blank (maps)."""
    s = spark.read.parquet(f"{folder}/systems")
    by = lambda c: s.groupBy(c).agg(F.sum("frames").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"{c}s"))
    whole = s.agg(F.lit("PASS").alias("status"), F.count("*").alias("systems"), F.sum("frames").alias("frames"), F.sum("virial_frames").alias("virial_frames"), F.min("natoms").alias("natoms_min"), F.max("natoms").alias("natoms_max"))
    labels = by("label").select(F.map_filter("labels", lambda k, v: k != "").alias("labels"))
    return whole.crossJoin(F.broadcast(by("block"))).crossJoin(F.broadcast(labels))  # one row each


def save_bucketed(frames: DataFrame, name: str, buckets: int, folder: str | None = None, key: str = "frame_index") -> DataFrame:
    """Indexed frames as the table ``name`` (which must be new; its files below ``folder``, if given), dealt by ``key`` into
    so many buckets of one sorted file each. Two such tables of equally many buckets are joined or compared by the key
    without an exchange of either."""
    rows = frames.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("errorifexists").format("parquet")
    (rows.option("path", folder) if folder else rows).saveAsTable(name)
    return frames.sparkSession.table(name)


def decimals(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", x)


def extended_xyz(frames: DataFrame, digits: int = 8, config: str = "config_type") -> DataFrame:
    """Adds ``xyz``: header and one line for each atom. A missing energy is 0; species come from types and type_map."""
    i = F.sequence(F.lit(0), F.col("natoms") - 1)
    num = lambda array, k: F.format_string(f"%.{digits}f", F.element_at(array, k + 1))
    line = lambda k: F.concat_ws(" ", F.element_at("type_map", F.element_at("types", k + 1) + 1), *[num(a, k * 3 + j) for a in ("coord", "force") for j in range(3)])
    box = F.array_join(F.transform("box", lambda x: F.format_string(f"%.{digits}f", x)), " ")
    virial = F.when(F.col("virial").isNotNull(), F.concat(F.lit(' virial="'), F.array_join(F.transform("virial", lambda x: F.format_string(f"%.{digits}f", x)), " "), F.lit('"'))).otherwise("")
    name = F.coalesce(config, F.lit("unlabeled")) if config in frames.columns else F.lit("unlabeled")
    head = F.concat(F.lit("energy="), decimals(F.coalesce("energy", F.lit(0.0)), digits), F.lit(" config_type="), name, F.lit(' pbc="T T T"'), virial, F.lit(' Lattice="'), box, F.lit('" Properties=species:S:1:pos:R:3:force:R:3'))
    return frames.withColumn("xyz", F.concat_ws("\n", F.col("natoms").cast("string"), head, F.array_join(F.transform(i, line), "\n")))


def write_xyz(frames: DataFrame, folder: str, order: list[str], **options) -> None:
    """Extended XYZ as text files below ``folder`` (which must be new), frames in the given order over the files."""
    n = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = extended_xyz(frames, **options).repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows.select("xyz").write.mode("errorifexists").text(folder)


def structure_text(structures: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``text``: atoms regrouped by element order, wrapped, as scaled coordinates with 16 decimals. Needs natoms, types,
    type_map, coord, box and title."""
    inverse = inverse3("box")
    names = F.transform("types", lambda t: F.element_at("type_map", t + 1))
    ordered = structures.withColumn("__names", names).withColumn("__order", element_order("type_map", order)).withColumn("__order", F.filter("__order", lambda e: F.array_contains("__names", e)))
    s = lambda k: [wrapped(c) for c in scaled([F.element_at("coord", k * 3 + j + 1) for j in range(3)], inverse)]
    row = lambda k: F.concat_ws(" ", *[decimals(c, 16) for c in s(k)])
    places = F.flatten(F.transform("__order", lambda e: F.filter(F.sequence(F.lit(0), F.col("natoms") - 1), lambda k: F.element_at("__names", k + 1) == e)))
    counts = F.transform("__order", lambda e: F.size(F.filter("__names", lambda x: x == e)).cast("string"))
    box = [F.concat_ws(" ", *[decimals(F.element_at("box", 3 * r + c + 1), 16) for c in range(3)]) for r in range(3)]
    text = F.concat_ws("\n", "title", F.lit("1.0"), *box, F.array_join("__order", " "), F.array_join(counts, " "), F.lit("Direct"), F.array_join(F.transform(places, row), "\n"))
    return ordered.withColumn("text", text).drop("__names", "__order")


# The fields of a manifest, in order.
MANIFEST = ["index", "system_path", "block", "label", "frames", "natoms", "elements", "counts", "type_map", "type_map_sha256", "relative_path"]


def manifest_rows(systems: DataFrame) -> DataFrame:
    """Manifest cells as text, in field order; lists are compact JSON, extra columns are left out."""
    have = [c for c in MANIFEST if c in systems.columns]
    cells = [(F.to_json(c) if dict(systems.dtypes)[c].startswith("array") else F.col(c).cast("string")).alias(c) for c in have]
    return systems.select(*cells)


def write_manifest(systems: DataFrame, path: str) -> None:
    """A manifest is a list of systems for people and tools: one file, in order of the index."""
    manifest_rows(systems.orderBy("index")).coalesce(1).write.mode("errorifexists").csv(path, sep="\t", header=True, quote="\u0000")


def exclusion_lines(entries: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """``task_key:system/frame`` of the entries with one of the statuses; a blank status always passes."""
    blank = F.coalesce(F.trim("status"), F.lit("")) == ""
    kept = entries.where(blank | F.col("status").isin(*statuses)) if statuses else entries
    return kept.where("system is not null and frame is not null").select(F.concat(F.lit("task_key:"), "system", F.lit("/"), "frame").alias("value")).distinct()


def write_texts(texts: DataFrame, folder: str) -> int:
    """Writes each row (path, text) to a file of that name below ``folder``, on the executors; returns their number. A
    repeated task writes the same files again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pafs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (pafs.LocalFileSystem(), folder)
        made = None
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                if (place := f"{base}/{path}".rsplit("/", 1)[0]) != made:
                    fs.create_dir(place, recursive=True)
                    made = place
                with fs.open_output_stream(f"{base}/{path}") as f:
                    f.write(text.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    return texts.select("path", "text").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def role_lists(split: DataFrame, path: str, role: str = "role") -> dict[str, list[str]]:
    """The systems of each role, sorted: what a training job's input names. One entry for each system."""
    rows = split.groupBy(role).agg(F.sort_array(F.collect_set(path)).alias("paths")).collect()
    return {r[role]: list(r.paths) for r in rows}


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """Reports never overwrite."""
    getattr(df.write.mode("errorifexists"), kind)(path)


def publish(df: DataFrame, path: str, validate: Callable[[DataFrame], DataFrame]) -> str | None:
    """Writes aside, validates, keeps the old table as a backup, swaps, and validates again; rolls back on failure.
    ``validate`` gives a table of errors. Returns the backup's path."""
    spark: SparkSession = df.sparkSession
    jvm = spark.sparkContext._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stamp = time.strftime("%Y%m%dT%H%M%S", time.gmtime())
    aside, backup = f"{path}.new-{stamp}", f"{path}.backup-{stamp}"
    df.write.mode("errorifexists").parquet(aside)
    if not (errors := validate(spark.read.parquet(aside))).isEmpty():
        found = [r.asDict() for r in errors.limit(20).collect()]
        fs.delete(at(aside), True)
        raise ValueError(f"not published: {json.dumps(found, default=str)}")
    had = fs.exists(at(path))
    if had:
        fs.rename(at(path), at(backup))
    try:
        fs.rename(at(aside), at(path))
        if not validate(spark.read.parquet(path)).isEmpty():
            raise ValueError("the published table is not valid")
    except Exception:
        if fs.exists(at(path)):
            fs.delete(at(path), True)
        if had:
            fs.rename(at(backup), at(path))
        raise
    return backup if had else None
