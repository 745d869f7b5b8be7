"""XYZ trajectories of any size: a large file is read in byte ranges by many tasks.

Each range looks for the first line at which some frames follow one another (a count, a comment, as many rows) and
follows them to its end. The ranges of a file are then chained from its start: a range is right from where the one
before ended, if that is one of its first frames, and is read again from there if not, so a comment that looks like a count changes nothing but the
work. A file's frames end at the first header that is none or at the first row that is cut off or has no numbers.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from atomframe.session import written
from atomframe.sources.discovery import opened

XYZ = "path string, frame int, natoms int, comment string, species array<string>, coord array<double>"
SEEN = "path string, lo long, hi long, starts array<long>, next long, frames long, stopped boolean"
CHAINED = "path string, lo long, hi long, entry long, first_frame long, frames long, redo boolean"
#: So many frames in a row make a line the start of one, where the range is not known to begin at it.
SURE = 3
#: So many first frames of a range are remembered: a wrong start mostly meets the right ones in a frame or two.
STARTS = 8
#: A batch of frames ends at so many atoms.
BATCH_ATOMS = 200_000
COUNT = re.compile(rb"\s*\d+\s*")


def next_frame(f: io.BufferedIOBase) -> tuple | None:
    """(natoms, comment, species, coord) of the frame that begins here, or None; only a line feed ends a line."""
    if not COUNT.fullmatch(head := f.readline()) or (n := int(head)) < 1:
        return None
    comment, species, coord = f.readline(), [], []
    for _ in range(n):
        if len(cells := f.readline().split()) < 4:
            return None
        try:
            coord += [float(x) for x in cells[1:4]]
        except ValueError:
            return None
        species.append(cells[0].decode(errors="replace"))
    return n, comment.rstrip(b"\r\n").decode(errors="replace"), species, coord


def parse_xyz(text: str) -> Iterator[tuple]:
    """Whole frames up to the first header that is none; an incomplete tail is left out."""
    f, frame = io.BytesIO(text.encode()), 0
    while (found := next_frame(f)) is not None:
        yield frame, *found
        frame += 1


def _entry(f: io.BufferedIOBase, lo: int, hi: int) -> int | None:
    """Where the first frame of a range seems to begin."""
    f.seek(max(lo - 1, 0))
    if lo:
        f.readline()
    while (at := f.tell()) < hi and (line := f.readline()):
        if not COUNT.fullmatch(line):
            continue
        after, good = f.tell(), 0
        f.seek(at)
        while good < SURE and next_frame(f) is not None:
            good += 1
            if f.tell() >= hi:
                good = SURE
        if good == SURE:
            return at
        f.seek(after)
    return None


def _buffered(path: str) -> io.BufferedReader:
    fs, base = opened(re.sub("^file:/+", "/", path))
    return io.BufferedReader(fs.open_input_file(base), 1 << 20)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follows the frames of each range: from its entry if that is known, else from where they seem to begin."""
    for pdf in batches:
        rows = []
        for path, lo, hi, known in zip(pdf["path"], pdf["lo"], pdf["hi"], pdf["entry"], strict=True):
            with _buffered(path) as f:
                entry = int(known) if not pd.isna(known) else _entry(f, lo, hi)
                at, frames, stopped, starts = entry, 0, False, []
                if entry is not None:
                    f.seek(entry)
                    while at < hi and not stopped:
                        if frames < STARTS:
                            starts.append(at)
                        stopped = next_frame(f) is None
                        at, frames = (at, frames) if stopped else (f.tell(), frames + 1)
                rows.append((path, lo, hi, starts, at, frames, stopped))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in SEEN.split(", ")])
        yield out.astype({"next": "Int64"})


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The ranges of one file from its start on: one row of a few numbers for each. A range with no frame where the one
    before ended is to be read again (redo) from there; those after it wait."""
    at, total, waiting, stopped, rows = 0, 0, False, False, []
    for r in pdf.sort_values("lo").itertuples():
        if waiting or stopped or at >= r.hi:
            rows.append((r.path, r.lo, r.hi, None, None, 0, False))
        elif at not in (starts := [int(x) for x in r.starts]):
            rows.append((r.path, r.lo, r.hi, at, None, 0, True))
            waiting = True
        else:
            frames = r.frames - starts.index(at)
            rows.append((r.path, r.lo, r.hi, at, total, frames, False))
            at, total, stopped = r.next, total + frames, r.stopped
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in CHAINED.split(", ")])
    return out.astype({"entry": "Int64", "first_frame": "Int64"})


def chained(ranges: DataFrame) -> DataFrame:
    """Where the frames of each range (path, lo, hi) begin, how many there are, and the number of the first. Each round
    reads again only what began at a wrong line, which is rare: at most one range of a file."""
    key = ["path", "lo"]
    seen = written(ranges.withColumn("entry", F.when(F.col("lo") == 0, F.lit(0)).cast("long")).mapInPandas(_scan, SEEN), "xyz-ranges")
    while True:
        out = written(seen.groupBy("path").applyInPandas(_chain, CHAINED), "xyz-chain")
        redo = out.where("redo")
        if redo.isEmpty():
            return out.where("frames > 0").drop("redo")
        again = redo.select("path", "lo", "hi", "entry").repartition(*key).mapInPandas(_scan, SEEN)
        seen = written(seen.join(redo.select(*key), key, "left_anti").select(seen.columns).unionByName(again), "xyz-ranges")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in XYZ.split(", ")]
    for pdf in batches:
        rows, atoms = [], 0
        for path, entry, first, most in zip(pdf["path"], pdf["entry"], pdf["first_frame"], pdf["frames"], strict=True):
            with _buffered(path) as f:
                f.seek(int(entry))
                number = int(first)
                while (pd.isna(most) or number < first + most) and (found := next_frame(f)) is not None:
                    rows.append((path, number, *found))
                    number, atoms = number + 1, atoms + found[0]
                    if atoms >= BATCH_ATOMS:
                        yield pd.DataFrame(rows, columns=names)
                        rows, atoms = [], 0
        yield pd.DataFrame(rows, columns=names)


def read_xyz_frames(spark: SparkSession, root: str, pattern: str = "*.xyz", range_bytes: int = 64 << 20) -> DataFrame:
    """One row for each whole frame of the files below ``root``. Files above ``range_bytes`` are read twice: to find the
    frames of each range, and to read them; smaller ones once, as one range."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length")
    number = lambda value: F.lit(value).cast("long")
    small = listed.where(F.col("length") <= range_bytes).select("path", number(0).alias("entry"), number(0).alias("first_frame"), number(None).alias("frames"))
    large = written(listed.where(F.col("length") > range_bytes).select("path", F.explode(F.sequence(number(0), F.col("length") - 1, number(range_bytes))).alias("lo"), "length"), "xyz-files")
    if (n := large.count()) == 0:
        return small.mapInPandas(_read, XYZ)
    ranges = large.select("path", "lo", F.least(F.col("lo") + range_bytes, "length").alias("hi")).repartition(min(n, 10_000), "path", "lo")
    found = chained(ranges).select("path", "entry", "first_frame", "frames").repartition(min(n, 10_000), "path", "entry")
    return small.mapInPandas(_read, XYZ).unionByName(found.mapInPandas(_read, XYZ))
