"""Text formats of structures and calculation outputs, parsed file by file on the executors."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from atomframe.session import checkpointed
from atomframe.sources.discovery import opened
from atomframe.sources.trajectories import parse_xyz, read_xyz_frames  # noqa: F401

STRUCTURE = "path string, elements array<string>, counts array<int>, natoms int, box array<double>, coord array<double>, types array<int>, error string"
OUTPUT = "path string, natoms int, energy double, box array<double>, coord array<double>, force array<double>, virial array<double>, error string"
# What marks the parts of an output file.
ENERGY, STRESS = re.compile(r"^(?=.*energy).*TOTEN\s*=\s*([-+]?(?:\d*\.)?\d+(?:[Ee][-+]?\d+)?)", re.M), re.compile(r"^\s*Total\s+(.*)$", re.M)
CELL, FORCES, ATOMS = "VOLUME and BASIS-vectors are now", "TOTAL-FORCE (eV/Angst)", re.compile(r"NIONS\s*=\s*(\d+)")
CONVERGED, FOOTER = "aborting loop because EDIFF is reached", "General timing and accounting informations for this job"


def numbers(text: str) -> list[float]:
    return [float(x) for x in re.findall(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[Ee][-+]?\d+)?", text)]


def parse_structure(text: str, type_map: list[str] | None = None) -> dict:
    """A POSCAR: scale, lattice, elements, counts, optional selective dynamics, Direct or Cartesian coordinates; with a
    type map also the type of each atom. Anything else is a ValueError."""
    lines = [line for line in text.splitlines() if line.strip()]
    if len(lines) < 8:
        raise ValueError("too short")
    scale = float(lines[1].split()[0])
    if scale <= 0:
        raise ValueError("scale must be positive")
    box = np.array([[float(x) for x in line.split()[:3]] for line in lines[2:5]]) * scale
    elements, counts = lines[5].split(), [int(x) for x in lines[6].split()]
    if box.shape != (3, 3) or len(elements) != len(counts) or any(re.fullmatch(r"\d+", e) for e in elements):
        raise ValueError("elements and counts do not match")
    n = sum(counts)
    if n <= 0:
        raise ValueError("no atoms")
    at = 8 if lines[7].strip()[:1].lower() == "s" else 7
    mode = lines[at].strip()[:1].lower()
    if mode not in ("d", "c", "k"):
        raise ValueError(f"unknown coordinate mode {lines[at].strip()}")
    rows = [line.split()[:3] for line in lines[at + 1 : at + 1 + n]]
    if len(rows) < n or any(len(r) < 3 for r in rows):
        raise ValueError("coordinates are missing")
    if missing := [e for e in elements if type_map and e not in type_map]:
        raise ValueError(f"elements not in the type map: {missing}")
    coord = np.array(rows, dtype=float)
    coord = coord @ box if mode == "d" else coord * scale
    types = [type_map.index(e) for e, k in zip(elements, counts, strict=True) for _ in range(k)] if type_map else None
    return {"elements": elements, "counts": counts, "natoms": n, "box": box.ravel().tolist(), "coord": coord.ravel().tolist(), "types": types}


#: Places of XX, YY, ZZ, XY, YZ, ZX in a symmetric 3x3 array, row by row.
STRESS_PLACES = [0, 3, 5, 3, 1, 4, 5, 4, 2]


def parse_output(text: str, natoms: int | None = None) -> dict:
    """The last energy, cell, forces and stress of an OUTCAR. The force table must hold as many atoms as given, else as
    the file names, else all rows up to its closing line; a file that is cut off is a ValueError."""
    energies, stress = ENERGY.findall(text), [x for x in map(numbers, STRESS.findall(text)) if len(x) >= 6]
    cell, force = text.rfind(CELL), text.rfind(FORCES)
    if not energies or cell < 0 or force < 0:
        raise ValueError("energy, cell or forces are missing")
    box = [numbers(line)[:3] for line in text[cell:].splitlines()[5:8]]
    if [len(r) for r in box] != [3, 3, 3]:
        raise ValueError("the cell is cut off")
    named = ATOMS.findall(text)
    natoms = natoms if natoms is not None else int(named[-1]) if named else None
    rows, closed = [], False
    for line in text[force:].splitlines()[2:]:
        if closed := len(rows) == natoms or (natoms is None and bool(rows) and line.strip().startswith("--")):
            break
        if len(x := numbers(line)) >= 6:
            rows.append(x[:6])
    if not rows or not (closed or len(rows) == natoms):
        raise ValueError(f"the force table is cut off at {len(rows)} atoms")
    if not stress:
        raise ValueError("the stress is missing")
    table = np.array(rows)
    return {"natoms": len(rows), "energy": float(energies[-1]), "box": [v for r in box for v in r], "coord": table[:, :3].ravel().tolist(), "force": table[:, 3:].ravel().tolist(), "virial": [stress[-1][k] for k in STRESS_PLACES]}


#: A large output is read backwards by so many bytes at first, then by twice as many each time.
TAIL = 1 << 20


def last_output(read: Callable[[int, int], bytes], size: int, natoms: int | None = None, block: int = TAIL) -> dict:
    """``parse_output`` of a file of any length, of which ``read`` gives bytes: from the end backwards, until the last
    energy, cell, forces and stress are there. The number of atoms is looked for there, then in the first block, and,
    where the force table has another one, backwards through the file. Reads all of a file that lacks one of the four."""
    lo, raw = size, b""
    while lo > 0:
        step = max(0, lo - max(block, size - lo))
        raw, lo = read(step, lo) + raw, step
        text = (raw if lo == 0 else raw[raw.find(b"\n") + 1 :]).decode(errors="replace")
        if min(text.rfind(CELL), text.rfind(FORCES)) >= 0 and ENERGY.search(text) and any(len(numbers(x)) >= 6 for x in STRESS.findall(text)):
            break
    else:
        return parse_output(raw.decode(errors="replace"), natoms)
    if lo == 0 or natoms is not None or ATOMS.search(text):
        return parse_output(text, natoms)
    named = ATOMS.findall(read(0, min(block, lo)).decode(errors="replace"))
    try:
        found = parse_output(text)
    except ValueError:
        found = None
    if found and named and int(named[-1]) == found["natoms"]:
        return found
    return parse_output(text, _last_number_of_atoms(read, lo + raw.find(b"\n") + 1, block))


def _last_number_of_atoms(read: Callable[[int, int], bytes], end: int, block: int) -> int | None:
    """The last number of atoms that is named before ``end``; blocks overlap, so that no line is cut in both."""
    while end > 0:
        lo = max(0, end - block)
        if named := ATOMS.findall(read(lo, end).decode(errors="replace")):
            return int(named[-1])
        end = 0 if lo == 0 else lo + min(256, block // 2)
    return None


def _parsed(df: DataFrame, parse, schema: str) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                row = dict.fromkeys(names) | {"path": path}
                try:
                    row |= parse(bytes(content).decode(errors="replace"))
                except (ValueError, IndexError) as e:
                    row["error"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    return df.mapInPandas(run, schema)


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """path and content of the files below ``root`` whose name fits ``pattern``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")


def read_structures(spark: SparkSession, root: str, pattern: str = "*POSCAR*", type_map: list[str] | None = None) -> DataFrame:
    """One row for each file; a file that cannot be parsed has ``error``."""
    return _parsed(files(spark, root, pattern), partial(parse_structure, type_map=type_map), STRUCTURE)


def read_calc_outputs(spark: SparkSession, root: str, pattern: str = "OUTCAR*") -> DataFrame:
    """One row for each file, read from its end (see ``last_output``) in one task; a file that cannot be parsed has
    ``error``."""
    names = [x.split()[0] for x in OUTPUT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, size in zip(pdf["path"], pdf["length"], strict=True):
                row = dict.fromkeys(names) | {"path": path}
                fs, base = opened(re.sub("^file:/+", "/", path))
                with fs.open_input_file(base) as f:
                    try:
                        row |= last_output(lambda lo, hi, f=f: f.read_at(hi - lo, lo), int(size))
                    except (ValueError, IndexError) as e:
                        row["error"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return listed.select("path", "length").mapInPandas(run, OUTPUT)


def eligible(scan: DataFrame, require_tag: bool = False, require_finished: bool = False) -> DataFrame:
    """Marker rows with structure and output; if asked for, also with the finished tag or a finished task_info."""
    out = scan.where("poscar and outcar")
    out = out.where("tag_finished") if require_tag else out
    return out.where("task_info and coalesce(task_status, '') = 'finished'") if require_finished else out


#: Names of files that say something of a calculation, and rows (of a folder) that a listing task hands on at a time.
MARKERS = ("tag_finished", "tag_failed", "POSCAR", "OUTCAR", "task_info.json", "frame_info.json")
LISTED = 10_000


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folders become the folders in them (to be listed next) and, if there are files, a row with the markers among them."""
    kinds = {"folder": pa.string(), "names": pa.list_(pa.string())}
    for batch in batches:
        for folder in batch.column("folder").to_pylist():
            fs, base = opened(folder)
            inner, files = [], []
            for i in fs.get_file_info(pafs.FileSelector(base)):
                (inner if i.type == pafs.FileType.Directory else files).append(i.base_name)
            rows = [(f"{folder}/{name}", None) for name in inner] + ([(folder, [n for n in files if n in MARKERS])] if files else [])
            for a in range(0, len(rows), LISTED):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + LISTED], strict=True), kinds.values(), strict=True)], list(kinds))


def calculation_folders(spark: SparkSession, root: str) -> DataFrame:
    """folder, system and frame (the last two names of its path) and names (of the marker files in it) of each folder below
    ``root`` that has a file. The executors list a level of folders after another; the driver sees no path."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level, found = spark.createDataFrame([(re.sub("^file:/+", "/", root).rstrip("/"),)], "folder string"), None
    while True:
        level = checkpointed(level.repartition(n).mapInArrow(_listed, "folder string, names array<string>"))
        own = level.where("names is not null")
        found = own if found is None else found.unionByName(own)
        level = level.where("names is null").select("folder")
        if level.isEmpty():
            break
    parts = F.split("folder", "/")
    return found.withColumns({"system": F.element_at(parts, -2), "frame": F.element_at(parts, -1)})


def read_calculations(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """The structure and output files of each folder together: folder, elements, counts, and what the output says, checked
    against the structure's number of atoms. ``error`` says what is wrong with either; ``structure_error`` only with the
    structure. ``folders``: those to be read, as ``calculation_folders`` gives them (by default all below ``root``)."""
    listed = calculation_folders(spark, root) if folders is None else folders
    kinds = f"folder string, elements array<string>, counts array<int>, structure_error string, __n int, {OUTPUT.replace('path string, ', '').replace('error string', '__error string')}"
    names = [x.split()[0] for x in kinds.split(", ")]

    def tried(row: dict, error: str, parse: Callable[[], dict]) -> dict:
        try:
            return parse()
        except (ValueError, IndexError) as e:
            row[error] = f"{type(e).__name__}: {e}"
            return {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for folder in pdf["folder"]:
                fs, base = opened(folder)
                row = dict.fromkeys(names) | {"folder": folder}
                with fs.open_input_file(f"{base}/POSCAR") as f:
                    s = tried(row, "structure_error", lambda f=f: parse_structure(f.read().decode(errors="replace")))
                with fs.open_input_file(f"{base}/OUTCAR") as f:
                    row |= tried(row, "__error", lambda f=f: last_output(lambda lo, hi: f.read_at(hi - lo, lo), f.size()))
                rows.append(row | {"elements": s.get("elements"), "counts": s.get("counts"), "__n": s.get("natoms")})
            yield pd.DataFrame(rows, columns=names).astype({"__n": "Int32", "natoms": "Int32"})

    both = _dealt(listed.where(F.array_contains("names", "POSCAR") & F.array_contains("names", "OUTCAR")).select("folder")).mapInPandas(run, kinds)
    unlike = F.when(F.col("__n") != F.col("natoms"), F.concat(F.lit("ValueError: atoms of the output "), "natoms", F.lit(", of the structure "), "__n"))
    return both.withColumn("error", F.coalesce("structure_error", "__error", unlike)).drop("__n", "__error")


def _dealt(folders: DataFrame) -> DataFrame:
    """Folders in as many tasks as there are partitions, whichever task has listed them."""
    return folders.repartition(int(folders.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def contained(read: Callable[[int, int], bytes], size: int, marks: list[bytes], block: int = TAIL) -> list[bool]:
    """Which of the texts occur in a file of any length, of which ``read`` gives bytes; blocks overlap by the longest text."""
    found, lap = [False] * len(marks), max(map(len, marks)) - 1
    for lo in range(0, size, block):
        part = read(lo, min(size, lo + block + lap))
        found = [have or mark in part for have, mark in zip(found, marks, strict=True)]
        if all(found):
            break
    return found


def scan_markers(spark: SparkSession, root: str, target: str, folders: DataFrame | None = None, outputs: bool = True) -> DataFrame:
    """Marker rows of the frames (root/system/frame/...): which files are there, what the output says, the status in
    task_info.json (task_status, lower case), and status: that one or, where it is blank, that in frame_info.json. File
    contents are read of the outputs and of these two files only, by the tasks. ``folders``: see ``read_calculations``;
    without ``outputs`` they stay closed, and what they say is missing."""
    listed = calculation_folders(spark, root) if folders is None else folders
    marks = [CONVERGED.encode(), FOOTER.encode()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for folder, have in zip(pdf["folder"], pdf["names"], strict=True):
                fs, base = opened(folder)
                said, texts = [False, False], []
                if outputs and "OUTCAR" in have:
                    with fs.open_input_file(f"{base}/OUTCAR") as f:
                        said = contained(lambda lo, hi, f=f: f.read_at(hi - lo, lo), f.size(), marks)
                for name in ("task_info.json", "frame_info.json"):
                    if name in have:
                        with fs.open_input_file(f"{base}/{name}") as f:
                            texts.append(f.read().decode(errors="replace"))
                    else:
                        texts.append(None)
                rows.append((*said, *texts))
            out = pdf[["system", "frame", "names"]].reset_index(drop=True)
            yield out.join(pd.DataFrame(rows, columns=["ediff_reached", "normal_footer", "__task", "__frame"]).astype({"__task": object, "__frame": object}))

    read = _dealt(listed).mapInPandas(run, "system string, frame string, names array<string>, ediff_reached boolean, normal_footer boolean, __task string, __frame string")
    have = lambda name: F.bool_or(F.array_contains("names", name))
    own = lambda c: F.max(F.lower(F.trim(F.get_json_object(c, "$.status"))))
    flags = {"tag_finished": "tag_finished", "tag_failed": "tag_failed", "poscar": "POSCAR", "outcar": "OUTCAR", "task_info": "task_info.json", "frame_info": "frame_info.json"}
    found = read.groupBy("system", "frame").agg(
        *[have(name).alias(c) for c, name in flags.items()], own("__task").alias("task_status"), own("__frame").alias("__frame_status"),
        *([F.bool_or(c).alias(c) for c in ("ediff_reached", "normal_footer")] if outputs else []),
    )
    status = F.coalesce(F.nullif("task_status", F.lit("")), F.col("__frame_status"), F.lit(""))
    return found.withColumn("target", F.lit(target)).withColumn("status", status).drop("__frame_status")
