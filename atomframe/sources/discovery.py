"""Discovery of frame groups: folders are listed and array headers are read on the executors, into a table of sets.

A group is a folder with type.raw, type_map.raw and some ``set.*`` folder with coord.npy. A root that has type.raw is
looked at alone, other roots are walked. The table has one row for each set, or one for a group of which nothing can be
said but ``error``; the driver lists no folder and opens no array. Every file system that Arrow knows can be read.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from atomframe.operators.index import running_total
from atomframe.session import checkpointed, shared_folder

# The arrays of a set; virial may be absent.
ARRAYS = ("coord", "box", "energy", "force", "virial")
INDEX = "root string, system_path string, set_name string, frames long, natoms int, elements array<string>, counts array<int>, type_map array<string>, type_map_sha256 string, bytes long, virial boolean, error string"
FOLDERS = "root string, folder string, is_group boolean"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def children(fs: pafs.FileSystem, folder: str) -> tuple[list[str], set[str]]:
    """Names of the folders (sorted) and of the files in a folder."""
    found = fs.get_file_info(pafs.FileSelector(folder))
    return sorted(i.base_name for i in found if i.type == pafs.FileType.Directory), {i.base_name for i in found if i.type == pafs.FileType.File}


def sets_of(names: list[str]) -> list[str]:
    return [n for n in names if n.startswith("set.")]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folders become their sub-folders (to be listed next) and, if they are groups, a row of their own."""
    for batch in batches:
        for root, folder in zip(batch.column("root").to_pylist(), batch.column("folder").to_pylist(), strict=True):
            fs, base = opened(folder)
            folders, files = children(fs, base)
            rows = []
            if {"type.raw", "type_map.raw"} <= files:
                arrays = fs.get_file_info([f"{base}/{s}/coord.npy" for s in sets_of(folders)])
                if any(i.type == pafs.FileType.File for i in arrays):
                    rows.append((root, folder, True))
            if not (folder == root and "type.raw" in files):
                inner = folders if "type.raw" not in files else [n for n in folders if not n.startswith("set.")]
                rows += [(root, f"{folder}/{n}", False) for n in inner]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.bool_()))], ["root", "folder", "is_group"])


def group_folders(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(root, folder) of all groups below the roots, each once, under the first root that has it. A level of folders is a
    job, its folders are listed by many tasks. A root that is not there is an error."""
    tops = [r.rstrip("/") or "/" for r in roots]
    for top in tops:
        fs, base = opened(top)
        if fs.get_file_info(base).type != pafs.FileType.Directory:
            raise ValueError(f"dataset root not found: {top}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    todo, found = spark.createDataFrame([(t, t) for t in dict.fromkeys(tops)], "root string, folder string"), None
    while True:
        level = checkpointed(todo.repartition(n).mapInArrow(_listed, FOLDERS))
        found = level if found is None else found.unionByName(level)
        todo = level.where("not is_group").select("root", "folder")
        if todo.isEmpty():
            break
    first = F.min_by("root", F.array_position(F.array(*[F.lit(t) for t in tops]), F.col("root")))
    return found.where("is_group").groupBy("folder").agg(first.alias("root")).select("root", "folder")


def type_lines(fs: pafs.FileSystem, folder: str) -> tuple[list[str], list[int], str]:
    """The type map, the types and the hash of the type map's file; what is wrong with them is a ValueError."""
    with fs.open_input_stream(f"{folder}/type_map.raw") as f:
        data = f.read()
    names = [x.strip() for x in data.decode().splitlines() if x.strip()]
    if not names or len(names) != len(set(names)):
        raise ValueError("type_map.raw must contain unique non-empty names")
    with fs.open_input_stream(f"{folder}/type.raw") as f:
        types = [int(x) for line in f.read().decode().splitlines() for x in line.partition("#")[0].split()]
    if types and not 0 <= min(types) <= max(types) < len(names):
        raise ValueError("type.raw index out of bounds")
    return names, types, hashlib.sha256(data).hexdigest()


def array_header(f) -> tuple[tuple[int, ...], bool, np.dtype, int]:
    """Shape, Fortran order, kind and offset of the values of an open .npy file."""
    version = np.lib.format.read_magic(f)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, fortran, kind = read(f)
    if kind.hasobject:
        raise ValueError("arrays of objects are not read")
    return shape, fortran, kind, f.tell()


def checked_set(fs: pafs.FileSystem, folder: str, natoms: int) -> tuple[int, int, bool]:
    """Frames, bytes and whether there is a virial, by the headers of a set's arrays."""
    shapes, size = {}, 0
    for info, name in zip(fs.get_file_info([f"{folder}/{a}.npy" for a in ARRAYS]), ARRAYS, strict=True):
        if info.type != pafs.FileType.File:
            if name != "virial":
                raise ValueError(f"missing {name}.npy")
            continue
        with fs.open_input_file(info.path) as f:
            shapes[name], _, kind, at = array_header(f)
        if at + math.prod(shapes[name]) * kind.itemsize > info.size:
            raise ValueError(f"{name}.npy is cut off")
        size += info.size
    frames = shapes["energy"][0] if shapes["energy"] else 0
    if frames <= 0:
        raise ValueError("empty set")
    if any(not s or s[0] != frames for name, s in shapes.items() if name != "virial"):
        raise ValueError("frame count mismatch")
    per = {name: math.prod(s[1:]) for name, s in shapes.items()}
    if per["coord"] != 3 * natoms:
        raise ValueError("coord/type mismatch")
    if per["force"] != per["coord"]:
        raise ValueError("force/coord mismatch")
    for name, least in (("box", 9), ("energy", 1)):
        if per[name] != least:
            raise ValueError(f"invalid {name} shape")
    if "virial" in shapes and (shapes["virial"][0] != frames or per["virial"] != 9):
        raise ValueError("invalid virial shape")
    return frames, size, "virial" in shapes


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string(), pa.int64(), pa.bool_(), pa.string()]
    for batch in batches:
        for root, folder in zip(batch.column("root").to_pylist(), batch.column("folder").to_pylist(), strict=True):
            fs, base = opened(folder)
            none = dict.fromkeys(names) | {"root": root, "system_path": folder}
            rows = []
            try:
                type_map, types, digest = type_lines(fs, base)
                used = [t for t in range(len(type_map)) if t in set(types)]
                group = none | {"natoms": len(types), "elements": [type_map[t] for t in used], "counts": [types.count(t) for t in used], "type_map": type_map, "type_map_sha256": digest}
                sets = sets_of(children(fs, base)[0])
                if not sets:
                    raise ValueError("no set.* directories")
            except (OSError, ValueError) as e:
                rows.append(none | {"error": f"{type(e).__name__}: {e}"})
                sets = []
            for name in sets:
                try:
                    frames, size, virial = checked_set(fs, f"{base}/{name}", len(types))
                    rows.append(group | {"set_name": name, "frames": frames, "bytes": size, "virial": virial})
                except (OSError, ValueError, EOFError) as e:
                    rows.append(group | {"set_name": name, "error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, kinds, strict=True)], names)


def saved_index(index: DataFrame) -> DataFrame:
    """The table of sets as files, which the reader of frames plans from."""
    path = f"{shared_folder(index.sparkSession)}/group-index-{uuid.uuid4().hex}"
    index.write.parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def index_folders(folders: DataFrame) -> DataFrame:
    """One row for each set of the groups (root, folder): what their headers say. A saved table."""
    n = int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return saved_index(folders.select("root", "folder").repartition(n).mapInArrow(_headers, INDEX))


def index_groups(spark: SparkSession, roots: list[str]) -> DataFrame:
    return index_folders(group_folders(spark, roots))


def limited(index: DataFrame, most: int) -> DataFrame:
    """At most ``most`` frames of each system, the first of its sets; sets of which none is left go. Broken sets stay."""
    before = F.coalesce(F.sum("frames").over(Window.partitionBy("system_path").orderBy("set_name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = index.withColumn("frames", F.least("frames", F.greatest(most - before, F.lit(0))))
    return left.where(F.col("error").isNotNull() | (F.col("frames") > 0))


def placed(index: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``frame_start``: the number of frames in the sets before, in the given order."""
    return running_total(index, order, "frames", "frame_start")


def index_report(index: DataFrame) -> DataFrame:
    """One row: systems, frames, atoms, virial_frames, bytes and type_maps of the groups that are whole, the number of
    broken ones (errors), and whether all is well. A group with a broken set is broken."""
    system = index.groupBy("system_path").agg(
        F.sum("frames").alias("frames"), F.max("natoms").alias("natoms"), F.sum(F.when(F.col("virial"), F.col("frames")).otherwise(0)).alias("virial_frames"),
        F.sum("bytes").alias("bytes"), F.first("type_map").alias("type_map"), F.max("error").alias("error"),
    )
    good = F.col("error").isNull()
    add = lambda c: F.coalesce(F.sum(F.when(good, c)), F.lit(0)).cast("long")
    broken = F.count_if(~good)
    return system.agg(
        F.count_if(good).alias("systems"), add(F.col("frames")).alias("frames"), add(F.col("frames") * F.col("natoms")).alias("atoms"), add(F.col("virial_frames")).alias("virial_frames"),
        add(F.col("bytes")).alias("bytes"), F.count_distinct(F.when(good, F.col("type_map"))).alias("type_maps"), broken.alias("errors"), ((broken == 0) & (F.count("*") > 0)).alias("valid"),
    )


def whole_groups(index: DataFrame, broken: str = "raise") -> DataFrame:
    """The sets of the groups that are whole. ``broken``: what becomes of the others: 'raise' (the default) names some of
    them in a ValueError, 'leave' leaves them out; ``index_report`` counts them."""
    bad = index.where("error is not null")
    if broken == "raise":
        if found := bad.orderBy("system_path", "set_name").limit(10).collect():
            raise ValueError("dataset inspection failed: " + "; ".join(f"{r.system_path}/{r.set_name or ''}: {r.error}" for r in found))
        return index
    return index.join(bad.select("system_path").distinct(), "system_path", "left_anti").select(*index.columns)
