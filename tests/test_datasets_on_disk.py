"""Groups on disk: discovery, reading with filters, all-or-nothing writing, archives of manifests, evaluation, validation."""

import glob
import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from atomframe.operators import dataset, jobs
from atomframe.sources import discovery, groups, records, sinks
from tests.test_golden import write_group


def index_of(spark, *roots):
    return {(r.system_path.rsplit("/", 1)[1], r.set_name): r for r in discovery.index_groups(spark, [str(r) for r in roots]).collect()}


def test_index_of_good_and_broken_groups(spark, tmp_path):
    write_group(tmp_path / "a/good", ["O", "H"], [0, 1, 1], virial=True)
    write_group(tmp_path / "a/deep/er/forces", ["O"], [0], force_frames=1)
    write_group(tmp_path / "a/types", ["O", "H"], [0, 1])
    (tmp_path / "a/types/type.raw").write_text("0\nx\n")
    write_group(tmp_path / "a/twice", ["O", "O"], [0, 1])
    write_group(tmp_path / "a/beyond", ["O", "H"], [0, 2])
    write_group(tmp_path / "a/cut", ["O"], [0])
    path = tmp_path / "a/cut/set.000/force.npy"
    path.write_bytes(path.read_bytes()[:-4])
    write_group(tmp_path / "a/lacks", ["O"], [0])
    os.remove(tmp_path / "a/lacks/set.000/energy.npy")
    write_group(tmp_path / "a/atoms", ["O"], [0, 0])
    (tmp_path / "a/atoms/type.raw").write_text("0\n")
    write_group(tmp_path / "b", ["H"], [0])
    write_group(tmp_path / "b/inner", ["H"], [0])  # a root with type.raw is looked at alone
    got = index_of(spark, tmp_path / "a", tmp_path / "b", tmp_path / "a")
    errors = {name: (r.error or "").partition(": ")[2] for (name, _), r in got.items()}
    assert errors == {
        "good": "", "forces": "frame count mismatch", "types": "invalid literal for int() with base 10: 'x'", "twice": "type_map.raw must contain unique non-empty names", "beyond": "type.raw index out of bounds",
        "cut": "force.npy is cut off", "lacks": "missing energy.npy", "atoms": "coord/type mismatch", "b": "",
    }
    good = got["good", "set.000"]
    assert (good.frames, good.natoms, good.elements, good.counts, good.virial) == (2, 3, ["O", "H"], [1, 2], True)
    assert good.type_map_sha256 == hashlib.sha256((tmp_path / "a/good/type_map.raw").read_bytes()).hexdigest()
    assert good.bytes == sum(os.path.getsize(p) for p in glob.glob(f"{tmp_path}/a/good/set.000/*.npy"))
    report = discovery.index_report(discovery.index_groups(spark, [str(tmp_path / "a")])).first()
    assert (report.systems, report.frames, report.atoms, report.virial_frames, report.errors, report.valid) == (1, 2, 6, 2, 7, False)
    with pytest.raises(ValueError, match="dataset root not found"):
        discovery.index_groups(spark, [str(tmp_path / "nowhere")])


def test_broken_sets_are_not_left_out_in_silence(spark, tmp_path):
    write_group(tmp_path / "in/good", ["O", "H"], [0, 1])
    write_group(tmp_path / "in/bad", ["O"], [0], force_frames=1)
    roots = [str(tmp_path / "in")]
    frames = groups.read_frame_groups(spark, roots)
    for job in (
        lambda: sinks.write_archive(frames, str(tmp_path / "archive"), ["O", "H"]),
        lambda: groups.write_groups(frames, str(tmp_path / "out")),
        lambda: jobs.split_dataset(spark, roots, str(tmp_path / "split")),
        lambda: jobs.manifest_of(spark, roots),
    ):
        with pytest.raises(Exception, match="frame count mismatch"):
            job()
    assert not (tmp_path / "out").exists()
    left = sinks.write_archive(frames, str(tmp_path / "archive2"), ["O", "H"], broken="leave").first()
    assert (left.status, left.frames, left.left_out) == ("PASS", 2, 1)
    rows, report = jobs.manifest_of(spark, roots, broken="leave")
    r = rows.first()
    assert rows.count() == 1 and (r["index"], r.block, r.relative_path, report.first().errors) == (0, "in", "good", 1)
    assert r.type_map_sha256 == hashlib.sha256(b"O\nH\n").hexdigest()
    systems, whole = jobs.inspected(spark, roots)
    assert {(s.system_path.rsplit("/", 1)[1], s.frames, s.broken_sets, s.bytes > 0) for s in systems.collect()} == {("good", 2, 0, True), ("bad", 0, 1, False)}
    assert whole.first().frames == 2 and not whole.first().valid


def test_conditions_choose_what_is_read(spark, tmp_path):
    for k in range(3):
        write_group(tmp_path / f"g{k}", ["O", "H"], [0, 1], n=20, offset=100.0 * k)
    write_group(tmp_path / "bad", ["O"], [0], force_frames=1)
    root = [str(tmp_path)]
    frames = groups.read_frame_groups(spark, root, framesPerPartition="8")
    one = groups.read_frame_groups(spark, root, sets=F.col("system_path") == str(tmp_path / "g1"), first=4, last=10, framesPerPartition="8")
    assert sorted(r.energy for r in one.collect()) == [100.0 + k for k in range(4, 10)]
    assert one.rdd.getNumPartitions() == 1 and frames.rdd.getNumPartitions() == 8
    # a query with a filter leaves the next ones as they are
    assert frames.where(F.col("system_path") == str(tmp_path / "g1")).where("frame_in_set > 3").count() == 16 and frames.count() == 61
    assert frames.where("error is null").count() == 60 and frames.where("error is not null").count() == 1 and frames.count() == 61
    assert groups.read_frame_groups(spark, root, most=3, sets="error is null").count() == 9
    assert groups.read_frame_groups(spark, root, sets="set_name = 'none'").count() == 0


def test_a_single_composition_is_the_folder_itself(spark, tmp_path):
    write_group(tmp_path / "in/a", ["O", "H"], [0, 1], n=3)
    write_group(tmp_path / "in/b", ["H", "O"], [1, 0], n=2, offset=50.0)
    out = str(tmp_path / "out")
    sets = groups.write_groups(groups.read_frame_groups(spark, [str(tmp_path / "in")]), out, frames_per_set=4)
    assert {(r.group_name, r.set_name, r.frames) for r in sets.collect()} == {("group_001_n2_o_h", "set.000", 4), ("group_001_n2_o_h", "set.001", 1)}
    assert sorted(os.listdir(out)) == ["set.000", "set.001", "type.raw", "type_map.raw"]
    # O,H of one map and of the other are one composition, with the atoms in their order
    assert np.load(f"{out}/set.001/energy.npy").tolist() == [51.0] and open(f"{out}/type_map.raw").read() == "H\nO\n" and open(f"{out}/type.raw").read() == "1\n0\n"
    assert groups.write_raw(sets, out).first().frames == 5 and len(open(f"{out}/energy.raw").read().split()) == 5
    # the order of elements makes a group
    write_group(tmp_path / "in/c", ["O", "H"], [1, 0], n=2)
    both = groups.write_groups(groups.read_frame_groups(spark, [str(tmp_path / "in")]), str(tmp_path / "two"))
    assert {r.group_name for r in both.collect()} == {"group_001_n2_h_o", "group_002_n2_o_h"}


def _failing(flag, times):
    """Rows pass, but the first ``times`` attempts fail after some of them."""

    def run(batches):
        for batch in batches:
            yield batch
            if batch.num_rows:
                n = len(os.listdir(flag))
                open(f"{flag}/{n}-{os.getpid()}", "w").close()
                if n < times:
                    raise RuntimeError("a task fails")

    return run


def test_writing_is_all_or_nothing(spark, tmp_path):
    write_group(tmp_path / "in", ["O", "H"], [0, 1], n=40)
    frames = groups.read_frame_groups(spark, [str(tmp_path / "in")])
    schema = "group_name string, set_id int, types array<int>, type_map array<string>, coord array<double>, box array<double>, energy double, force array<double>, virial array<double>"
    rows = frames.select(F.lit("g").alias("group_name"), F.floor(F.col("frame_in_set") / 10).cast("int").alias("set_id"), "types", "type_map", *groups.ARRAYS).coalesce(1)
    flag = tmp_path / "flags"
    flag.mkdir()
    spark.dataSource.register(groups.GroupSource)
    out = tmp_path / "out"
    with pytest.raises(Exception, match="a task fails"):
        rows.mapInArrow(_failing(str(flag), 99), schema).write.format("frame_groups").option("single", "false").mode("append").save(str(out))
    assert not out.exists() and not glob.glob(f"{tmp_path}/.out*")
    rows.mapInArrow(_failing(str(flag), 0), schema).write.format("frame_groups").option("single", "false").mode("append").save(str(out))
    assert sorted(os.listdir(out / "g")) == ["set.000", "set.001", "set.002", "set.003", "type.raw", "type_map.raw"] and not glob.glob(f"{tmp_path}/.out*")
    with pytest.raises(FileExistsError):
        groups.write_groups(frames, str(out))


def test_a_repeated_task_leaves_one_copy(tmp_path):
    """What a lost attempt has written is replaced; its leftovers go with the commit."""
    writer = groups.GroupWriter(str(tmp_path / "out"), False)
    columns = {"group_name": ["g"] * 3, "set_id": [0, 0, 1], "types": [[0]] * 3, "type_map": [["H"]] * 3, "coord": [[0.0] * 3] * 3, "box": [[1.0] * 9] * 3, "energy": [1.0, 2.0, 3.0], "force": [[0.0] * 3] * 3, "virial": [None] * 3}
    batch = pa.RecordBatch.from_pydict(columns, pa.schema([("group_name", pa.string()), ("set_id", pa.int32()), ("types", pa.list_(pa.int32())), ("type_map", pa.list_(pa.string())), *((c, pa.list_(pa.float64())) for c in ("coord", "box")), ("energy", pa.float64()), *((c, pa.list_(pa.float64())) for c in ("force", "virial"))]))

    def lost():
        yield batch
        raise RuntimeError("the executor is lost")

    with pytest.raises(RuntimeError):
        writer.write(lost())
    assert writer.write(iter([batch.slice(0, 1), batch.slice(1)])).sets == 2
    writer.commit([])
    assert sorted(os.listdir(tmp_path)) == ["out"] and np.load(tmp_path / "out/g/set.000/energy.npy").tolist() == [1.0, 2.0] and not os.path.exists(tmp_path / "out/g/set.000/virial.npy")
    other = groups.GroupWriter(str(tmp_path / "out"), False)
    other.write(iter([batch]))
    with pytest.raises(FileExistsError):
        other.commit([])
    other.abort([])
    assert sorted(os.listdir(tmp_path)) == ["out"]


def manifest_file(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "index int, system_path string, block string, label string, frames int, natoms int")
    sinks.write_manifest(df.withColumns({"elements": F.array(F.lit("O")), "counts": F.array(F.lit(1))}), str(tmp_path / "m/list"))
    return str(tmp_path / "m/list")


def test_archive_of_a_manifest(spark, tmp_path):
    write_group(tmp_path / "m/a", ["O", "H"], [0, 1], n=3)
    write_group(tmp_path / "b", ["H", "O"], [1, 0], n=2, offset=10.0, virial=True)
    path = manifest_file(spark, tmp_path, [(0, str(tmp_path / "b"), "late", "l", 2, 2), (1, "./a", "", "", 3, None)])
    report = jobs.archived_manifest(spark, path, str(tmp_path / "archive"), most=2).first()
    assert (report.status, report.systems, report.frames, report.virial_frames, report.blocks, report.labels) == ("PASS", 2, 4, 2, {"late": 2, "unknown": 2}, {"l": 2})
    rows = spark.read.parquet(str(tmp_path / "archive/frames")).orderBy("frame_index").collect()
    assert [(r.frame_index, r.system_id, r.energy, r.types, r.type_map) for r in rows] == [(0, 0, 10.0, [1, 0], ["H", "O"]), (1, 0, 11.0, [1, 0], ["H", "O"]), (2, 1, 0.0, [1, 0], ["H", "O"]), (3, 1, 1.0, [1, 0], ["H", "O"])]
    with pytest.raises(FileExistsError):
        jobs.archived_manifest(spark, path, str(tmp_path / "archive"))


@pytest.mark.parametrize("frames,natoms,extra,message", [(4, 2, None, "declares other frames"), (3, 5, None, "declares other frames"), (3, 2, "bad", "frame count mismatch"), (3, 2, "gone", "inspection failed"), (3, 2, "a", "path_repeated")])
def test_manifests_that_are_refused(spark, tmp_path, frames, natoms, extra, message):
    write_group(tmp_path / "a", ["O", "H"], [0, 1], n=3)
    write_group(tmp_path / "bad", ["O"], [0], force_frames=1)
    rows = [(0, str(tmp_path / "a"), "", "", frames, natoms)] + ([(1, str(tmp_path / extra), "", "", None, None)] if extra else [])
    with pytest.raises(ValueError, match=message):
        jobs.archived_manifest(spark, manifest_file(spark, tmp_path, rows), str(tmp_path / "archive"))
    assert not (tmp_path / "archive").exists()


def model():
    def evaluate(coord, box, types):
        if len(types) == 5:
            raise RuntimeError("no five atoms")
        return np.ones(len(coord)), np.ones_like(coord), np.full((len(coord), 9), np.nan if len(types) == 4 else 0.0)

    return ["H", "O"], evaluate


def test_evaluation(spark, tmp_path):
    """Two systems, then ones that fall out: by a frame that is not finite, a model that fails, a prediction, a broken set."""
    write_group(tmp_path / "w", ["H", "O"], [0, 1], n=3)
    write_group(tmp_path / "x", ["O", "H"], [0, 1, 1, 0][:3] + [1], n=2)
    os.rename(tmp_path / "x", tmp_path / "four")
    write_group(tmp_path / "y", ["O", "H"], [0, 1, 1], n=2, virial=True)
    for k, system in enumerate(("w", "y")):
        np.save(tmp_path / f"{system}/set.000/energy.npy", np.array([0.5, 1.5, 1.0][: 3 - k]))
    good = jobs.evaluated_dataset(spark, model, roots=[str(tmp_path / "w"), str(tmp_path / "y")])
    whole = {(r.level, r.system_path and r.system_path[-1]): r for r in good.levels.collect()}
    overall = whole["overall", None]
    assert (overall.systems, overall.frames, overall.force_components, overall.virial_components) == (2, 5, 3 * 6 + 2 * 9, 18)
    assert overall.energy_rmse_meV_per_atom == pytest.approx(1000 * np.sqrt((2 * 0.25 / 4 + 2 * 0.25 / 9) / 5)) and overall.force_rmse_eV_per_A == 1.0 and overall.virial_rmse_eV == 0.0
    assert good.status.first().status == "PASS" and good.errors.count() == 0 and good.run["frames"] == 5 and good.run["seconds"] > 0
    flags = {r.system_path[-1]: (r.is_worst_energy_rmse_meV_per_atom, r.is_worst_force_rmse_meV_per_A, r.block) for r in good.systems.collect()}
    assert flags == {"w": (True, True, "unknown"), "y": (False, False, "unknown")}

    np.save(tmp_path / "y/set.000/energy.npy", np.array([0.5, np.nan]))
    write_group(tmp_path / "z", ["O", "H"], [0] * 5, n=2)
    write_group(tmp_path / "bad", ["O"], [0], force_frames=1)
    write_group(tmp_path / "odd", ["O", "X"], [0, 1])
    for on, status in ((False, "FAIL"), (True, "PARTIAL")):
        some = jobs.evaluated_dataset(spark, model, roots=[str(tmp_path)], continue_on_error=on)
        assert {r.system_path.rsplit("/", 1)[1]: r.error.split(": ", 1)[1] for r in some.errors.collect()} == {"y": "input contains NaN/Inf", "z": "no five atoms", "four": "prediction contains NaN/Inf", "bad": "frame count mismatch", "odd": "elements missing from the model: ['X']"}
        assert (some.status.first().status, some.status.first().errors, some.levels.where("level = 'overall'").first().frames) == (status, 5, 3)
    none = jobs.evaluated_dataset(spark, model, roots=[str(tmp_path / "z")], continue_on_error=True)
    assert none.status.first().status == "FAIL" and none.systems.count() == 0


def test_each_frame_is_seen_once(spark, tmp_path):
    write_group(tmp_path / "in/w", ["H", "O"], [0, 1], n=30)
    seen = tmp_path / "seen"
    seen.mkdir()

    def counting():
        def evaluate(coord, box, types):
            with open(f"{seen}/{os.getpid()}", "a") as f:
                f.write("x" * len(coord))
            return np.ones(len(coord)), np.ones_like(coord), None

        return ["H", "O"], evaluate

    found = jobs.evaluated_dataset(spark, counting, roots=[str(tmp_path / "in")], frames_per_batch=7)
    found.systems.collect(), found.levels.collect(), found.status.collect(), found.errors.collect()
    assert sum(os.path.getsize(p) for p in glob.glob(f"{seen}/*")) == 30 and found.systems.first().batches >= 5


def test_validation_of_a_dataset_on_disk(spark, tmp_path):
    out = str(tmp_path / "data")
    write_group(tmp_path / "in", ["O", "H"], [0, 1], n=3, virial=True)
    groups.write_raw(groups.write_groups(groups.read_frame_groups(spark, [str(tmp_path / "in")]), out), out)
    assert jobs.validated_dataset(spark, out).count() == 0
    summary = json.load(open(f"{out}/convert_summary.json"))
    json.dump({"groups": [summary | {"frames_converted": 3, "frames_selected": 4}], "group_count": 2, "frames_converted": 5}, open(f"{out}/convert_summary.json", "w"), indent=1)
    os.remove(f"{out}/force.raw")
    with open(f"{out}/energy.raw", "a") as f:
        f.write("1.0\n")
    assert {r.code for r in jobs.validated_dataset(spark, out).collect()} == {"selected_not_converted", "group_count", "frames_converted", "missing: force", "frame count mismatch: energy"}
    os.remove(f"{out}/convert_summary.json")
    assert [r.code for r in jobs.validated_dataset(spark, out).collect()] == ["summary_missing"]


def test_nothing_converted_is_an_error(spark):
    g = spark.createDataFrame([("a", None, None, 0, 0, 0)], "group_name string, elements array<string>, counts array<int>, selected int, converted int, skipped int")
    a = spark.createDataFrame([], "group_name string, array string, raw_rows int, npy_rows int")
    assert {r.code for r in dataset.validate_dataset(g, a).collect()} == {"composition_missing", "nothing_converted", *(f"missing: {x}" for x in groups.ARRAYS)}


def test_documents_over_several_lines(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"entries": [{"system_name": "s", "frame_name": "f", "pbs_job_id": "77", "status": "running"}]}, indent=2))
    entries, bad = records.read_campaigns(spark, str(tmp_path))
    assert [(r.system, r.frame, r.extras["pbs_job_id"]) for r in entries.collect()] == [("s", "f", "77")] and bad.count() == 0


def test_a_campaign_is_archived(spark, tmp_path):
    """Converged twice is refused; ready systems are converted and published, the dataset before stays as a backup."""
    from tests.test_golden import POSCAR, output

    for frame in ("system_1/frame_1", "system_1/frame_2", "system_2/frame_1"):
        p = tmp_path / "calc" / frame
        p.mkdir(parents=True)
        (p / "POSCAR").write_text(POSCAR)
        (p / "OUTCAR").write_text(output(-1, 3))
        (p / "tag_finished").write_text("")
    e = spark.createDataFrame([("system_1", "frame_1", "t"), ("system_1", "frame_2", "t"), ("system_2", "frame_1", "t"), ("system_2", "frame_2", "t")], "system string, frame string, target string")
    t = spark.createDataFrame([("t", True), ("u", True)], "target string, available boolean")
    scan = [("t", "system_1", "frame_1", "success"), ("t", "system_1", "frame_2", "success"), ("t", "system_2", "frame_1", "success")]
    table = lambda rows: spark.createDataFrame(rows, "target string, system string, frame string, result string")
    with pytest.raises(ValueError, match="system_1/frame_1: t, u"):
        jobs.archived_campaign(e, t, table([*scan, ("u", "system_1", "frame_1", "success")]))
    assert jobs.archived_campaign(e, t, table([*scan, ("u", "system_1", "frame_1", "success")]), refuse=False).duplicates.count() == 1
    out = str(tmp_path / "data")
    args = {"root": str(tmp_path / "calc"), "dataset_root": out, "type_order": ["H", "O"]}
    first = jobs.archived_campaign(e, t, table(scan), **args)
    assert first.backup is None and np.load(f"{out}/set.000/energy.npy").tolist() == [-1.0, -1.0] and first.ready.count() == 2
    second = jobs.archived_campaign(e.where("system = 'system_1'").limit(1), t, table(scan), **args)
    assert np.load(f"{out}/set.000/energy.npy").tolist() == [-1.0] and os.path.exists(f"{second.backup}/type.raw")
    for path in ("system_1/frame_1", "system_1/frame_2"):
        (tmp_path / "calc" / path / "OUTCAR").write_text("cut")
    with pytest.raises(ValueError, match="nothing to convert"):
        jobs.archived_campaign(e, t, table(scan), **args)
    assert np.load(f"{out}/set.000/energy.npy").tolist() == [-1.0] and not glob.glob(f"{out}.rebuild*")
    with pytest.raises(ValueError, match="not published"):
        aside = str(tmp_path / "aside")
        write_group(aside, ["O"], [0])
        sinks.installed(spark, aside, out, lambda path: jobs.validated_dataset(spark, path))
    assert np.load(f"{out}/set.000/energy.npy").tolist() == [-1.0] and not os.path.exists(aside)


@pytest.mark.parametrize("periodic", [(True, True, True), (True, True, False), (False, False, False)])
def test_contacts_equal_brute_force_over_images(spark, periodic):
    from atomframe.operators import geometry

    r = np.random.default_rng(3)
    boxes = {"hex": [[5, 0, 0], [-2.5, 4.33, 0], [0, 0, 8]], "flat": [[4, 0.3, 0], [3.5, 1.2, 0], [0.2, 0.1, 3]], "left": [[0, 3, 0], [3, 0, 0], [0, 0, 2]], "none": [[1, 0, 0], [1, 0, 0], [0, 0, 1]]}
    rows, want = [], {}
    for name, box in boxes.items():
        box, xyz = np.array(box, dtype=float), r.normal(0, 3, (25, 3))
        rows += [(name, i, *map(float, p), box.ravel().tolist()) for i, p in enumerate(xyz)]
        if name == "none":
            continue
        steps = [np.arange(-9, 10) if p else np.array([0]) for p in periodic]
        s = xyz @ np.linalg.inv(box)
        s = np.where(periodic, s - np.floor(s), s)
        shifts = np.array(np.meshgrid(*steps)).reshape(3, -1).T @ box
        for a in range(25):
            for b in range(a + 1, 25):
                d = np.linalg.norm((s[a] - s[b]) @ box + shifts, axis=1).min()
                if d < 1.5:
                    want[name, a, b] = round(float(d), 9)
    df = spark.createDataFrame(rows, "frame string, atom int, x double, y double, z double, box array<double>").repartition(3)
    out = geometry.cell_contacts(df, "frame", 1.5, periodic=periodic).collect()
    assert len(out) == len(want) and {(x.frame, x.atom_a, x.atom_b): round(x.distance, 9) for x in out} == want


def test_candidates_with_compositions(spark):
    found = spark.createDataFrame([("s", "1", "finished", "a"), ("s", "2", "running", "a"), ("s", "3", "finished", "a")], "system string, frame string, status string, source string")
    comp = lambda rows: spark.createDataFrame(rows, "system string, frame string, composition struct<formula:string,atom_count:int>")
    rows, header = jobs.candidate_manifest(found, ["system", "frame"], finished_only=True, compositions=[comp([("s", "1", ("", 0))]), comp([("s", "1", ("H2", 2)), ("s", "3", ("O", 1))]), comp([("s", "3", ("X", 9))])])
    assert {(x.frame, x.composition.formula) for x in rows.collect()} == {("1", "H2"), ("3", "O")}
    assert (header.first().records, header.first().entries, header.first().skipped) == (3, 2, 1)


def test_the_whole_is_a_level_even_if_every_system_falls_out(spark):
    """As SQL's grouping sets: one row of the whole, with no frames and no errors, with a virial or without."""
    row = ("s", 1, [0], ["H"], [0.0] * 3, [1.0] * 9, 1.0, [0.0] * 3, [0.0] * 9, " ", "broken")
    schema = "system_path string, natoms int, types array<int>, type_map array<string>, coord array<double>, box array<double>, energy double, force array<double>, virial array<double>, block string, error string"
    model = lambda: (["H"], lambda coord, box, types: (coord[:, 0], coord, box))
    for rows in ([row], []):
        got = jobs.evaluated(spark.createDataFrame(rows, schema), model).levels.collect()
        assert [(r.level, r.block, r.system_path, r.systems, r.frames, r.force_components, r.energy_mae_eV, r.virial_rmse_eV) for r in got] == [("overall", None, None, 0, 0, None, None, None)]
    got = jobs.evaluated(spark.createDataFrame([row, (*row[:-1], None), ("t", *row[1:-1], None)], schema), model).levels.collect()
    assert sorted((r.level, r.block, r.system_path, r.systems, r.frames) for r in got if r.level != "overall") == [("family", "unknown", None, 1, 1), ("system", "unknown", "t", 1, 1)]
    assert [(r.systems, r.frames, r.virial_components) for r in got if r.level == "overall"] == [(1, 1, 9)]


@pytest.mark.parametrize("height", [0.9, 0.25])
def test_contacts_are_not_gathered(spark, height):
    """Pairs are made once: nothing is aggregated or exchanged after the join (unless an atom is there twice), with few images
    and with many."""
    from atomframe.operators import geometry

    r = np.random.default_rng(5)
    box = np.array([[4.0, 0, 0], [-1.5, 3.0, 0], [0.4, 0.1, height]])
    xyz = r.normal(0, 2, (30, 3))
    shifts = np.array(np.meshgrid([-2, -1, 0, 1, 2], [-2, -1, 0, 1, 2], np.arange(-9, 10))).reshape(3, -1).T @ box
    s = xyz @ np.linalg.inv(box)
    d = lambda i, j: float(np.linalg.norm((s[i] - np.floor(s[i]) - s[j] + np.floor(s[j])) @ box + shifts, axis=1).min())
    rows = [("f", i, *map(float, p), box.ravel().tolist()) for i, p in enumerate(xyz)]
    contacts = lambda rows: geometry.cell_contacts(spark.createDataFrame(rows, "frame string, atom int, x double, y double, z double, box array<double>"), "frame", 1.0, periodic=(True, True, True))
    seen = lambda df: sorted((x.atom_a, x.atom_b, round(x.distance, 9)) for x in df.collect())
    out = contacts(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan.partition("Join")[0]
    assert seen(out) == [(i, j, round(d(i, j), 9)) for i in range(30) for j in range(i + 1, 30) if d(i, j) < 1.0]
    # atom 29 is there a second time, at the place of atom 0
    twice = seen(contacts([*rows, ("f", 29, *rows[0][2:])]))
    least = lambda i, j: min(d(i, j), d(i, 0)) if j == 29 else d(i, j)
    assert twice == [(i, j, round(least(i, j), 9)) for i in range(30) for j in range(i + 1, 30) if least(i, j) < 1.0]
    assert seen(contacts([])) == []
