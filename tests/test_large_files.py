"""Files that are read in ranges or from their end give what they give when read whole."""

import io
import random
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from atomframe.operators import dataset, jobs
from atomframe.sources import sinks, structures, trajectories, versions


def trajectory(seed: int, frames: int) -> str:
    """Frames whose comments look like counts, also like the number of rows up to the next header."""
    r = random.Random(seed)
    out = []
    for k in range(frames):
        n = r.choice([1, 2, 3, 3, 3, 4, 9])
        comment = r.choice([str(n - 1), str(n), "1", f"step {k}", "", "2"])
        rows = [f"H {r.random():.3f} {k} {a}" + r.choice(["", " 5", "\r"]) for a in range(n)]
        out += [r.choice(["", " "]) + str(n), comment, *rows]
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("tail", ["", "3\ncut\nH 0 0 0\n", "2\nbad\nH 0 0 x\nH 0 0 0\n1\nlost\nH 1 1 1\n", "no header\n1\nlost\nH 1 1 1\n"])
def test_trajectories_are_the_same_for_any_range(spark, tmp_path, tail):
    text = trajectory(3, 25) + tail
    long = trajectory(4, 5) + "200\nlong\n" + "".join(f"O {k} 0 0\n" for k in range(200)) + trajectory(5, 10)
    for name, content in (("a", text), ("b", long), ("c", tail), ("e", "")):
        (tmp_path / f"{name}.xyz").write_text(content, newline="")
    want = sorted((name, *f) for name, content in (("a", text), ("b", long), ("c", tail)) for f in trajectories.parse_xyz(content))
    assert sum(w[0] == "a" for w in want) == 25 and sum(w[0] == "b" for w in want) == 16
    for size in (120, 1 << 20):
        got = trajectories.read_xyz_frames(spark, str(tmp_path), range_bytes=size).collect()
        assert sorted((r.path[-5], r.frame, r.natoms, r.comment, list(r.species), list(r.coord)) for r in got) == want


def test_a_range_that_began_at_a_comment_is_read_again(tmp_path):
    # every comment is the number of rows that follow its next line, so a range may follow comments only
    text = "".join(f"2\n1\nH {k} 0 0\nH {k} 1 1\n" for k in range(20))
    (tmp_path / "t.xyz").write_text(text)
    f = io.BytesIO(text.encode())
    assert trajectories._entry(f, 1, len(text)) == 2  # the comment of the first frame: wrong, and mended by the chain
    assert len(list(trajectories.parse_xyz(text))) == 20


def block(e: int, atoms: int) -> str:
    rows = "".join(f" {k} {k} {k} {e + k} 0 0\n" for k in range(atoms))
    return f"  free  energy   TOTEN  =  {e} eV\n  VOLUME and BASIS-vectors are now :\n a\n b\n c\n d\n {e} 0 0 1 0 0\n 0 {e} 0 0 1 0\n 0 0 {e} 0 0 1\n Total  1 2 3 4 5 {e}\n POSITION    TOTAL-FORCE (eV/Angst)\n ----\n{rows} ----\n"


def counted(text: str):
    data, read = text.encode(), [0]

    def part(lo, hi):
        read[0] += hi - lo
        return data[lo:hi]

    return part, len(data), read


def test_outputs_are_read_from_their_end():
    text = " NIONS =      8\n" + "".join(block(e, 8) for e in range(1, 1001)) + "end\n"
    part, size, read = counted(text)
    assert structures.last_output(part, size, block=1000) == structures.parse_output(text)
    assert read[0] < 8000 < size // 30


@pytest.mark.parametrize("block_bytes", [64, 300, 5000, 1 << 20])
@pytest.mark.parametrize("change", [
    lambda t: t, lambda t: t.replace("NIONS", "OTHER"), lambda t: t.replace("=      4", "=      5"), lambda t: t.replace("Total", "Totals"), lambda t: t[: t.rindex(" 3 3 3")], lambda t: t.replace("TOTEN", "OTHER"),
    lambda t: t[: len(t) // 2] + "\n NIONS =      3\n" + t[len(t) // 2 :] + "x" * 900, lambda t: "", lambda t: t.rsplit(" POSITION", 1)[0], lambda t: t.rstrip("-\n "), lambda t: t + "é" * 500 + "\n",
])
def test_outputs_are_the_same_from_the_end_and_whole(change, block_bytes):
    text = change(" NIONS =      4\n" + "".join(block(e, 4) for e in range(1, 40)))

    def outcome(f):
        try:
            return f()
        except ValueError as e:
            return str(e)

    part, size, _ = counted(text)
    whole = outcome(lambda: structures.parse_output(text))
    got = outcome(lambda: structures.last_output(part, size, block=block_bytes))
    # a number of atoms that only the middle of a file names, unlike its start, does not count against a table that is closed
    assert got == whole or "NIONS =      3" in text


def test_of_two_publishers_one_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.latest(spark, path) is None and versions.versions(spark, path).count() == 0
    rows = lambda n: spark.range(n).withColumnRenamed("id", "v")
    assert versions.publish_version(rows(3), path) == 0

    def attempt(n):
        try:
            return versions.publish_version(rows(n), path, based_on=0)
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        outcomes = list(pool.map(attempt, range(10, 16)))
    assert sorted(o for o in outcomes if o is not None) == [1]
    winner = outcomes.index(1) + 10
    assert versions.read_version(spark, path).count() == winner and versions.read_version(spark, path, 0).count() == 3
    with pytest.raises(ValueError, match="not published"):
        versions.publish_version(rows(4), path, lambda t: t.where("v = 2"), 1)
    with pytest.raises(ValueError, match="no version"):
        versions.publish_version(rows(4), path, based_on=7)
    assert [p.name[:5] for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")] == ["data-"] * 2
    assert versions.publish_version(rows(0), path, based_on=1) == 2 and versions.read_version(spark, path).dtypes == rows(0).dtypes
    assert [(r.version, r.based_on, r.row_count) for r in versions.versions(spark, path).orderBy("version").collect()] == [(0, None, 3), (1, 0, winner), (2, 1, 0)]


def test_bucketed_archives_are_compared_without_an_exchange(spark, tmp_path):
    a = spark.range(200).selectExpr("id as frame_index", "array(double(id)) as coord")
    b = a.where("frame_index <> 7").selectExpr("frame_index", "if(frame_index = 9, array(double(1)), coord) as coord")
    one, two = (sinks.save_bucketed(df, f"t{uuid.uuid4().hex}", 4, str(tmp_path / str(k))) for k, df in enumerate((a, b)))
    out = dataset.compare_archives(one, two, "frame_index", ["coord"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan[plan.index("SortMergeJoin") :]
    r = out.first()
    assert (r.frames_compared, r.missing_in_archive, r.different_values, r.max_abs_difference) == (199, 1, 1, 8.0)


def test_marker_files_are_listed_and_read_by_the_tasks(spark, tmp_path):
    """The driver has no list of files (Spark's file readers have one), at any depth; marks are found across blocks."""
    for name, files in {"s_1/f_1": {"OUTCAR": f"x\n{structures.CONVERGED}\n", "tag_finished": "", "other": ""}, "s_1/f_2": {"task_info.json": '{"status": " Finished"}'}, "deep/s_2/f_1": {"OUTCAR": "", "POSCAR": "x"}, "s_3/f_1/inner": {"other": ""}}.items():
        (tmp_path / name).mkdir(parents=True)
        for f, text in files.items():
            (tmp_path / name / f).write_text(text)
    scan = structures.scan_markers(spark, str(tmp_path), "t")
    assert scan.inputFiles() == []
    got = {(r.system, r.frame): (r.tag_finished, r.poscar, r.outcar, r.ediff_reached, r.normal_footer, r.task_status, r.status) for r in scan.collect()}
    assert got == {
        ("s_1", "f_1"): (True, False, True, True, False, None, ""), ("s_1", "f_2"): (False, False, False, False, False, "finished", "finished"),
        ("s_2", "f_1"): (False, True, True, False, False, None, ""), ("f_1", "inner"): (False, False, False, False, False, None, ""),
    }
    text = b"." * 37 + structures.CONVERGED.encode() + b"." * 61
    for block in range(1, 140, 7):
        assert structures.contained(lambda lo, hi: text[lo:hi], len(text), [structures.CONVERGED.encode(), b"nowhere"], block) == [True, False]


def test_calculations_are_read_once_and_only_where_they_are_wanted(spark, tmp_path):
    """A job opens the files of the frames that it converts, in one pass and without a list on the driver."""
    for frame, tag in (("f_1", True), ("f_2", False)):
        folder = tmp_path / "s_1" / frame
        folder.mkdir(parents=True)
        (folder / "POSCAR").write_text("too short")
        (folder / "OUTCAR").write_text("x")
        if tag:
            (folder / "tag_finished").write_text("")
    folders = structures.calculation_folders(spark, str(tmp_path))
    tagged = folders.where(F.array_contains("names", "tag_finished"))
    read = structures.read_calculations(spark, str(tmp_path), tagged)
    assert read.inputFiles() == [] and [r.folder[-3:] for r in read.collect()] == ["f_1"]
    assert structures.read_calculations(spark, str(tmp_path)).count() == 2
    with pytest.raises(ValueError, match="nothing to convert"):
        jobs.converted_calculations(spark, str(tmp_path), str(tmp_path / "out"), ["H"], require_tag=True)


def test_a_conversion_reads_by_its_tasks(spark, tmp_path):
    """Frames of one folder level more, hidden folders too, come out as before, with what was skipped."""
    box, atom = "VOLUME and BASIS-vectors are now :\na\nb\nc\nd\n4 0 0 0 0 0\n0 4 0 0 0 0\n0 0 4 0 0 0\n", "0 0 0 0.5 0.5 0.5"
    whole = f"free energy TOTEN = -1.5 eV\n{box}  Total 1 2 3 4 5 6\n POSITION TOTAL-FORCE (eV/Angst)\n ----\n{atom}\n ----\n"
    for k, text in enumerate((whole, whole, whole.replace(" ----\n", "", 2).replace(atom, "")), 1):
        folder = tmp_path / "in" / ("s/.hidden" if k == 2 else "s") / f"f_{k}"
        folder.mkdir(parents=True)
        (folder / "POSCAR").write_text("t\n1.0\n4 0 0\n0 4 0\n0 0 4\nH\n1\nDirect\n0 0 0\n")
        (folder / "OUTCAR").write_text(text)
        (folder / "task_info.json").write_text('{"status": "finished"}')
    written, summary = jobs.converted_calculations(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["H"], require_finished=True)
    assert [(r.frames, r.natoms, list(r.elements)) for r in written.collect()] == [(2, 1, ["H"])]
    assert [(list(r.elements), r.selected, r.converted, r.skipped) for r in summary.collect()] == [(["H"], 3, 2, 1)]
