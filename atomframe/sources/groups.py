"""Frame groups on disk: a Python data source that reads and writes directories of ``set.*`` arrays.

Reading plans from a saved table of sets (``discovery``), whose rows Spark filters before a partition is made. (Filters on the
frames themselves are not pushed into the source: Spark 4.1 keeps what a source was told by one query for later queries on
the same DataFrame that have no filter, which would then lose rows.) Writing is all or nothing: tasks write whole sets aside, the commit moves them to the
new folder in one step, and a job that fails leaves no folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from atomframe.functions.expressions import remapped
from atomframe.operators.index import global_index, numbered_within
from atomframe.session import checkpointed
from atomframe.sources import discovery
from atomframe.sources.discovery import ARRAYS, array_header, opened, type_lines

SCHEMA = "system_path string, set_name string, frame_in_set int, natoms int, types array<int>, type_map array<string>, coord array<double>, box array<double>, energy double, force array<double>, virial array<double>, error string"
#: Columns that the table of sets may have besides its own, and that frames take from it.
CARRIED = {"system_id": "long", "block": "string", "label": "string", "frame_start": "long"}
#: Bytes of values in a batch that a reading task hands on.
BATCH_BYTES = 8 << 20


@dataclass
class Range:
    """Frames first .. last - 1 of a set, or what is wrong with it, and what its row of the table has besides."""

    system: str
    name: str | None
    first: int
    last: int
    error: str | None
    carried: tuple


class SetPart(InputPartition):
    def __init__(self, ranges: list[Range]):
        self.ranges = ranges


class GroupReader(DataSourceReader):
    """Partitions of about ``framesPerPartition`` frames, of one large set or several small ones; only the columns asked for
    are opened."""

    def __init__(self, options: dict):
        self.index = options["index"]
        self.columns = set(options.get("columns", ",".join(ARRAYS)).split(","))
        self.carried = [c for c in options.get("carried", "").split(",") if c]
        self.rows = int(options.get("framesperpartition", 4096))
        self.first, self.last = int(options.get("first", 0)), int(options["last"]) if "last" in options else None

    def partitions(self) -> list[SetPart]:
        fs, base = opened(self.index)
        names = ["system_path", "set_name", "frames", "error", *self.carried]
        table = pads.dataset(base, filesystem=fs, format="parquet", exclude_invalid_files=True).to_table(columns=names)
        order = [("frame_start", "ascending")] if "frame_start" in self.carried else [("system_path", "ascending"), ("set_name", "ascending")]
        out: list[SetPart] = []
        held: list[Range] = []
        size = 0
        for r in table.sort_by(order).to_pylist():
            carried = tuple(r[c] for c in self.carried)
            if r["error"] is not None:
                held.append(Range(r["system_path"], r["set_name"], 0, 0, r["error"], carried))
                continue
            at, end = self.first, r["frames"] if self.last is None else min(r["frames"], self.last)
            while at < end:
                some = min(end, at + self.rows - size)
                held.append(Range(r["system_path"], r["set_name"], at, some, None, carried))
                size += some - at
                at = some
                if size >= self.rows:
                    out.append(SetPart(held))
                    held, size = [], 0
        return [*out, SetPart(held)]

    def read(self, part: SetPart) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, [], [])
        for r in part.ranges:
            fs, base = opened(r.system)
            if r.error is not None:
                yield self._batch(r, 1, [0], None, None, {})
                continue
            if known[0] != r.system:
                names, types, _ = type_lines(fs, base)
                known = (r.system, names, types)
            _, names, types = known
            step = max(1, BATCH_BYTES // (48 * max(1, len(types))))
            for a in range(r.first, r.last, step):
                b = min(r.last, a + step)
                values = {name: _values(fs, f"{base}/{r.name}/{name}.npy", a, b) for name in ARRAYS if name in self.columns}
                yield self._batch(r, b - a, range(a, b), types, names, values)

    def _batch(self, r: Range, n: int, places: Iterable[int], types: list | None, names: list | None, values: dict) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string()), *[pa.list_(pa.float64())] * 2, pa.float64(), *[pa.list_(pa.float64())] * 2, pa.string()]
        cells = [[r.system] * n, [r.name] * n, list(places), [None if types is None else len(types)] * n, [types] * n, [names] * n]
        for a in ARRAYS:
            v = values.get(a)
            cells.append([None] * n if v is None else v[:, 0].tolist() if a == "energy" else list(v))
        arrays = [pa.array(v, t) for v, t in zip([*cells, [r.error] * n], kinds, strict=True)]
        arrays += [pa.array([v] * n, pa.int64() if CARRIED[c] == "long" else pa.string()) for c, v in zip(self.carried, r.carried, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [*(x.split()[0] for x in SCHEMA.split(", ")), *self.carried])


def _values(fs: pafs.FileSystem, path: str, first: int, last: int) -> np.ndarray | None:
    """Rows first .. last - 1 of an array as doubles, each row flat; None where there is no such file."""
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_file(path) as f:
        shape, fortran, kind, at = array_header(f)
        row = int(np.prod(shape[1:])) * kind.itemsize
        if fortran and len(shape) > 1:
            f.seek(0)
            return np.lib.format.read_array(f)[first:last].astype(np.float64).reshape(last - first, -1)
        f.seek(at + first * row)
        return np.frombuffer(f.read((last - first) * row), kind).astype(np.float64).reshape(last - first, -1)


@dataclass
class Written(WriterCommitMessage):
    sets: int


class GroupWriter(DataSourceArrowWriter):
    """Writes rows in order of group_name and set_id (each set's rows in one task) as sets below a new folder."""

    def __init__(self, folder: str, single: bool):
        self.folder, self.single = folder.rstrip("/"), single
        above, _, name = self.folder.rpartition("/")
        self.aside = f"{above}/.{name}.staging-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, base = opened(self.aside)
        own, done = f"{base}/tasks/{uuid.uuid4().hex}", 0
        for rows in _sets(batches):
            group, number = rows.column("group_name")[0].as_py(), rows.column("set_id")[0].as_py()
            place = f"{base}/tree" if self.single else f"{base}/tree/{group}"
            _write_set(fs, f"{own}/{done}", rows)
            fs.create_dir(place, recursive=True)
            for name in ("type.raw", "type_map.raw"):
                fs.move(f"{own}/{done}/{name}", f"{place}/{name}")
            target = f"{place}/set.{number:03d}"
            if fs.get_file_info(target).type == pafs.FileType.Directory:  # from an earlier attempt of this task
                fs.delete_dir(target)
            fs.move(f"{own}/{done}", target)
            done += 1
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = opened(self.aside)
        _, folder = opened(self.folder)
        there = fs.get_file_info(folder)
        if there.type == pafs.FileType.Directory and not fs.get_file_info(pafs.FileSelector(folder)):
            fs.delete_dir(folder)
        elif there.type != pafs.FileType.NotFound:
            raise FileExistsError(folder)
        fs.create_dir(f"{base}/tree", recursive=True)
        fs.move(f"{base}/tree", folder)
        fs.delete_dir(base)

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = opened(self.aside)
        if fs.get_file_info(base).type == pafs.FileType.Directory:
            fs.delete_dir(base)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one set after another."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column("group_name").to_pylist(), batch.column("set_id").to_pylist(), strict=True))
        cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def _write_set(fs: pafs.FileSystem, folder: str, rows: pa.Table) -> None:
    fs.create_dir(folder, recursive=True)
    for name in ARRAYS:
        column = rows.column(name).combine_chunks()
        if name == "virial" and column.null_count:
            continue
        values = np.asarray(column) if name == "energy" else np.asarray(column.flatten()).reshape(len(column), -1)
        with fs.open_output_stream(f"{folder}/{name}.npy") as f:
            np.lib.format.write_array(f, np.ascontiguousarray(values), allow_pickle=False)
    for file, name in (("type.raw", "types"), ("type_map.raw", "type_map")):
        with fs.open_output_stream(f"{folder}/{file}") as f:
            f.write(("\n".join(map(str, rows.column(name)[0].as_py())) + "\n").encode())


class GroupSource(DataSource):
    """``spark.read.format("frame_groups").option("index", path of a saved table of sets)``, and the writer of rows
    (group_name, set_id, types, type_map, coord, box, energy, force, virial) to ``path``."""

    @classmethod
    def name(cls) -> str:
        return "frame_groups"

    def schema(self) -> str:
        return ", ".join([SCHEMA, *(f"{c} {CARRIED[c]}" for c in self.options.get("carried", "").split(",") if c)])

    def reader(self, schema: StructType) -> GroupReader:
        return GroupReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> GroupWriter:
        return GroupWriter(self.options["path"], self.options.get("single", "false") == "true")


def read_indexed(index: DataFrame, **options) -> DataFrame:
    """The frames of a saved table of sets (see ``discovery``); system_id, block, label and frame_start come along if it has
    them. A broken set, or group, is one row with ``error``."""
    spark = index.sparkSession
    spark.dataSource.register(GroupSource)
    files = index.inputFiles()
    if not files:
        raise ValueError("the table of sets must be saved")
    reader = spark.read.format("frame_groups").option("index", files[0].rpartition("/")[0])
    for k, v in (options | {"carried": ",".join(c for c in CARRIED if c in index.columns)}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_frame_groups(spark: SparkSession, roots: list[str], most: int = 0, sets: str | Column | None = None, **options) -> DataFrame:
    """All frames below ``roots``, or the first ``most`` of each system; a set that cannot be read is one row with ``error``.
    ``sets``: a condition on the table of sets (system_path, set_name, natoms, elements, error ...), which keeps others from
    being opened. Options: columns, framesPerPartition, and first and last: of each set only the frames first .. last - 1."""
    index = discovery.index_groups(spark, roots)
    if most or sets is not None:
        index = discovery.limited(index, most) if most else index
        index = discovery.saved_index(index if sets is None else index.where(sets))
    return read_indexed(index, **options)


def whole(frames: DataFrame, broken: str = "raise") -> DataFrame:
    """Frames without the rows that have an ``error``. ``broken``: 'raise' (the default) makes such a row an error of the job,
    'leave' leaves them out; ``left_out`` counts them."""
    if "error" not in frames.columns:
        return frames
    if broken == "leave":
        return frames.where("error is null")
    where = F.concat_ws("/", *[c for c in ("system_path", "set_name") if c in frames.columns])
    refused = F.raise_error(F.concat(F.lit("broken frames: "), where, F.lit(": "), F.col("error"))).cast("boolean")
    return frames.where(F.col("error").isNull() | refused)


def left_out(frames: DataFrame) -> int:
    """How many rows (sets) have an error."""
    return frames.where("error is not null").count() if "error" in frames.columns else 0


def _runs(names: Column) -> tuple[Column, Column]:
    """Elements in order and their counts: the runs of equal neighbours of the atoms' names."""
    places = F.sequence(F.lit(0), F.size(names) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get(names, i) != F.get(names, i - 1)))
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(names)))
    return F.transform(starts, lambda i: F.get(names, i)), F.zip_with(starts, ends, lambda a, b: b - a)


def named_groups(frames: DataFrame) -> DataFrame:
    """Adds ``group_name``, as group_001_n3_o_h: the compositions (elements in order, with counts) numbered by atoms and
    elements. Types and type_map become those of one type map for each group, the least of its frames'."""
    n = F.when(F.size("types") > 0, F.transform("types", lambda t: F.get("type_map", t))).otherwise(F.array().cast("array<string>"))
    elements, counts = _runs(n)
    none = F.size("types") == 0
    keyed = frames.withColumns({"__elements": F.when(none, F.array().cast("array<string>")).otherwise(elements), "__counts": F.when(none, F.array().cast("array<int>")).otherwise(counts)})
    keys = keyed.groupBy("__elements", "__counts").agg(F.min("type_map").alias("__map"), F.first(F.size("types")).alias("__natoms"))
    numbered = global_index(keys, ["__natoms", "__elements", "__counts"], "__k")
    name = F.concat(F.format_string("group_%03d_n%d_", F.col("__k") + 1, F.col("__natoms")), F.lower(F.array_join(F.array_distinct("__elements"), "_")))
    named = keyed.join(numbered.withColumn("group_name", name).select("__elements", "__counts", "__map", "group_name"), ["__elements", "__counts"])
    types = F.when(F.col("type_map") == F.col("__map"), F.col("types")).otherwise(remapped("types", "type_map", F.col("__map")))
    return named.withColumns({"types": types, "type_map": F.col("__map")}).drop("__elements", "__counts", "__map")


def write_groups(frames: DataFrame, folder: str, frames_per_set: int = 5000, broken: str = "raise") -> DataFrame:
    """Writes ``.npy`` sets of at most ``frames_per_set`` frames, type.raw and type_map.raw for each composition (elements in
    order, with counts) to a new folder: several compositions in a folder each, a single one in ``folder`` itself. All is
    published at once or nothing. One row (group_name, set_name, frames) for each set. Frames stay in order of their
    system, set and place. A folder that has something in it is refused, and so are frames with an ``error`` (``broken``:
    see ``whole``)."""
    fs, base = opened(folder)
    if fs.get_file_info(base).type != pafs.FileType.NotFound and fs.get_file_info(pafs.FileSelector(base)):
        raise FileExistsError(folder)
    spark = frames.sparkSession
    have = whole(frames, broken)
    have = have if "virial" in have.columns else have.withColumn("virial", F.lit(None).cast("array<double>"))
    order = [c for c in ("system_path", "set_name", "frame_in_set") if c in have.columns] or ["energy"]
    placed = numbered_within(named_groups(have), ["group_name"], order, "__i")
    placed = placed.withColumn("set_id", F.floor(F.col("__i") / frames_per_set).cast("int"))
    sets = checkpointed(placed.groupBy("group_name", "set_id").agg(F.count("*").alias("frames")))
    single = sets.select("group_name").distinct().count() == 1
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.repartition(n, "group_name", "set_id").sortWithinPartitions("group_name", "set_id", "__i")
    spark.dataSource.register(GroupSource)
    rows.select("group_name", "set_id", "types", "type_map", *ARRAYS).write.format("frame_groups").option("single", str(single).lower()).mode("append").save(folder)
    return sets.select("group_name", F.format_string("set.%03d", F.col("set_id")).alias("set_name"), "frames")


def write_raw(sets: DataFrame, folder: str) -> DataFrame:
    """Adds the text files (``energy.raw`` ...) and convert_summary.json to each written group: one row (group_name, frames,
    natoms, elements, counts). One task for each group writes set after set, so that it holds one set at a time."""
    single = sets.select("group_name").distinct().count() == 1

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, top = opened(folder)
        group, own = pdf["group_name"].iloc[0], uuid.uuid4().hex
        base = top if single else f"{top}/{group}"
        names = pdf.sort_values("set_name", key=lambda s: s.str.extract(r"(\d+)$")[0].astype(int))["set_name"].tolist()
        for a in ARRAYS:
            paths = [f"{base}/{n}/{a}.npy" for n in names]
            if all(i.type == pafs.FileType.File for i in fs.get_file_info(paths)):
                with fs.open_output_stream(f"{base}/.{a}.raw-{own}") as f:
                    for path in paths:
                        with fs.open_input_file(path) as source:
                            values = np.lib.format.read_array(source)
                        np.savetxt(f, values.reshape(len(values), -1))
                fs.move(f"{base}/.{a}.raw-{own}", f"{base}/{a}.raw")
        type_map, types, _ = type_lines(fs, base)
        used = list(dict.fromkeys(types))
        row = {"group_name": group, "frames": int(pdf["frames"].sum()), "natoms": len(types), "elements": [type_map[t] for t in used], "counts": [types.count(t) for t in used]}
        with fs.open_output_stream(f"{base}/.convert_summary.json-{own}") as f:
            f.write(json.dumps(row | {"type_order": type_map}, indent=2, sort_keys=True).encode() + b"\n")
        fs.move(f"{base}/.convert_summary.json-{own}", f"{base}/convert_summary.json")
        return pd.DataFrame({k: [v] for k, v in row.items()})

    return checkpointed(sets.groupBy("group_name").applyInPandas(write, "group_name string, frames long, natoms int, elements array<string>, counts array<int>"))
