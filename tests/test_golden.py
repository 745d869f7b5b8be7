"""Facts that the operators must give on small fixtures."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from atomframe.functions import expressions as X, states
from atomframe.operators import campaign, dataset, index, inference, metrics, select
from atomframe.sources import groups, records, sinks, structures
from atomframe.streaming import status as S


def write_group(path, names, types, n=2, virial=False, offset=0.0, force_frames=None):
    os.makedirs(f"{path}/set.000")
    open(f"{path}/type_map.raw", "w").write("\n".join(names) + "\n")
    open(f"{path}/type.raw", "w").write("\n".join(map(str, types)) + "\n")
    k = len(types)
    coord = np.arange(n * k * 3, dtype=np.float32).reshape(n, k, 3) + offset
    np.save(f"{path}/set.000/coord.npy", coord)
    np.save(f"{path}/set.000/box.npy", np.tile(np.eye(3, dtype=np.float32) * 10, (n, 1, 1)))
    np.save(f"{path}/set.000/energy.npy", np.arange(n, dtype=np.float64) + offset)
    np.save(f"{path}/set.000/force.npy", np.zeros((force_frames or n, k, 3), dtype=np.float32))
    if virial:
        np.save(f"{path}/set.000/virial.npy", np.zeros((n, 9), dtype=np.float32))


def test_merged_errors(spark):
    rows = [("s1", 2, 0.0, 2.0, [0.0] * 6, [1.0] * 6)] + [("s2", 4, 0.0, 4.0, [0.0] * 12, [2.0] * 12)] * 3
    df = spark.createDataFrame(rows, "system string, natoms int, energy_true double, energy_pred double, force_true array<double>, force_pred array<double>")
    whole = metrics.error_metrics(df).first()
    assert whole.energy_rmse_meV_per_atom == pytest.approx(1000.0)
    assert whole.force_rmse_eV_per_A == pytest.approx(math.sqrt((6 + 36 * 4) / 42))
    levels = metrics.metrics_by_level(df.withColumn("family", F.lit(" "))).collect()
    assert {(r.level, r.family, r.system) for r in levels} == {("system", "unlabeled", "s1"), ("system", "unlabeled", "s2"), ("family", "unlabeled", None), ("overall", None, None)}


def test_group_source_and_archive(spark, tmp_path):
    write_group(tmp_path / "a/g1", ["O", "H"], [0, 1, 1], virial=True)
    write_group(tmp_path / "a/g2", ["H", "O"], [1, 0, 0], offset=10.0)
    write_group(tmp_path / "b/bad", ["O"], [0], force_frames=1)
    frames = groups.read_frame_groups(spark, [str(tmp_path / "a")], framesPerPartition="1")
    assert frames.count() == 4
    report = dataset.inspect_systems(frames).collect()
    assert all(r.frames == 2 and r.natoms == 3 and r.invalid_frames == 0 for r in report)
    assert dataset.inspect_root(dataset.inspect_systems(frames)).first().valid
    bad = groups.read_frame_groups(spark, [str(tmp_path / "b")]).collect()
    assert len(bad) == 1 and "frame count mismatch" in bad[0].error
    assert sinks.write_archive(frames, str(tmp_path / "archive"), ["H", "O"]).first().status == "PASS"
    stored = spark.read.parquet(str(tmp_path / "archive/frames"))
    assert {tuple(r.types) for r in stored.collect()} == {(1, 0, 0)}
    assert sorted(r.frame_index for r in stored.collect()) == [0, 1, 2, 3]
    same = dataset.compare_archives(stored, stored, "frame_index", ["coord", "virial"]).collect()
    assert all(r.different_values == 0 and r.frames_compared == 4 for r in same)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_archive(frames, str(tmp_path / "archive"), ["H", "O"])


def test_groups_are_written_and_read_back(spark, tmp_path):
    write_group(tmp_path / "in/g", ["O", "H"], [0, 1], n=7)
    write_group(tmp_path / "in/h", ["O", "H"], [0, 1, 1], n=2, virial=True)
    frames = groups.read_frame_groups(spark, [str(tmp_path / "in")])
    out = str(tmp_path / "out")
    sets = groups.write_groups(frames, out, frames_per_set=3)
    assert {(r.group_name, r.set_name, r.frames) for r in sets.collect()} == {("group_001_n2_o_h", "set.000", 3), ("group_001_n2_o_h", "set.001", 3), ("group_001_n2_o_h", "set.002", 1), ("group_002_n3_o_h", "set.000", 2)}
    back = groups.read_frame_groups(spark, [out]).orderBy("system_path", "set_name", "frame_in_set").collect()
    assert [r.energy for r in back] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 0.0, 1.0]
    raw = {r.group_name: r for r in groups.write_raw(sets, out).collect()}
    assert (raw["group_002_n3_o_h"].elements, raw["group_002_n3_o_h"].counts, raw["group_001_n2_o_h"].frames) == (["O", "H"], [1, 2], 7)
    assert np.loadtxt(f"{out}/group_001_n2_o_h/energy.raw").tolist() == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert np.loadtxt(f"{out}/group_002_n3_o_h/coord.raw").shape == (2, 9) and os.path.exists(f"{out}/group_002_n3_o_h/virial.raw")
    with pytest.raises(FileExistsError):
        groups.write_groups(frames, out)


def test_an_archive_leaves_no_system_out(spark, tmp_path):
    write_group(tmp_path / "g1", ["O", "H"], [0, 1])
    write_group(tmp_path / "g2", ["X", "H"], [0, 1])
    with pytest.raises(ValueError, match="X"):
        sinks.write_archive(groups.read_frame_groups(spark, [str(tmp_path)]), str(tmp_path / "archive"), ["H", "O"])


POSCAR = "title\n2.0\n1 0 0\n0 1 0\n0 0 1\nH O\n1 1\nCartesian\n0.5 0 0\n0 0.25 0\n"
DIRECT = "t\n1.0\n2 0 0\n0 4 0\n0 0 6\nSi O\n1 2\nSelective dynamics\nDirect\n0.5 0.5 0.5 T T T\n0 0 0 T T T\n0.25 0 0 T T T\n"


def test_structures(spark, tmp_path):
    (tmp_path / "POSCAR_1").write_text(POSCAR)
    (tmp_path / "POSCAR_2").write_text(DIRECT)
    (tmp_path / "POSCAR_3").write_text("x\n-1\n")
    got = {r.path[-1]: r for r in structures.read_structures(spark, str(tmp_path)).collect()}
    assert got["1"].elements == ["H", "O"] and got["1"].coord[:3] == [1.0, 0.0, 0.0]
    assert got["2"].counts == [1, 2] and got["2"].coord[:3] == [1.0, 2.0, 3.0]
    assert got["3"].error and got["3"].coord is None


def test_structures_that_are_refused():
    for mode in ("Foo", "", "0.5 0 0"):
        with pytest.raises(ValueError):
            structures.parse_structure(POSCAR.replace("Cartesian", mode))
    for bad in (POSCAR.replace("1 1\n", "0 0\n"), POSCAR.replace("0 0.25 0\n", ""), POSCAR.replace("H O\n", "1 1\n")):
        with pytest.raises(ValueError):
            structures.parse_structure(bad)
    assert structures.parse_structure(DIRECT, ["O", "Si"])["types"] == [1, 0, 0]
    with pytest.raises(ValueError, match="type map"):
        structures.parse_structure(DIRECT, ["O"])


def output(e, x, atoms=2):
    rows = "".join(f" {k} {k} {k} {x + k} 0 0\n" for k in range(atoms))
    return f"  free  energy   TOTEN  =  {e} eV\n  VOLUME and BASIS-vectors are now :\n a\n b\n c\n d\n {x} 0 0 1 0 0\n 0 {x} 0 0 1 0\n 0 0 {x} 0 0 1\n Total  1 2 3 4 5 6\n POSITION    TOTAL-FORCE (eV/Angst)\n ----\n{rows} ----\n"


def test_outputs_take_the_last_blocks(spark, tmp_path):
    (tmp_path / "OUTCAR").write_text(output(-1, 3) + output(-2.5, 4))
    r = structures.read_calc_outputs(spark, str(tmp_path)).first()
    assert (r.energy, r.natoms, r.box[0], r.force[3]) == (-2.5, 2, 4.0, 5.0)
    assert r.virial == [1, 4, 6, 4, 2, 5, 6, 5, 3]


def test_outputs_that_are_cut_off():
    whole = output(-1, 3, 3)
    assert structures.parse_output(whole, 3)["natoms"] == 3
    for bad in (whole[: whole.rindex(" 2 2 2")], whole.replace(" 0 3 0 0 1 0", " 0 3"), whole.replace("Total ", "Totals"), whole.replace("free  energy", "free")):
        with pytest.raises(ValueError):
            structures.parse_output(bad)
    for natoms in (4, 5):
        with pytest.raises(ValueError, match="cut off at 3"):
            structures.parse_output(whole, natoms)
    assert structures.parse_output("NIONS =  3\n" + whole)["natoms"] == 3
    with pytest.raises(ValueError):
        structures.parse_output("NIONS =  4\n" + whole)


def test_calculations_are_checked_against_their_structure(spark, tmp_path):
    for name, atoms in (("a", 2), ("b", 3)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "POSCAR").write_text(POSCAR)
        (tmp_path / name / "OUTCAR").write_text(output(-1, 3, atoms))
    got = {r.folder[-1]: r for r in structures.read_calculations(spark, str(tmp_path)).collect()}
    assert got["a"].error is None and got["a"].energy == -1 and got["a"].elements == ["H", "O"] and "of the structure 2" in got["b"].error


def test_xyz_stops_at_the_incomplete_tail(spark, tmp_path):
    frame = "2\ncomment\nH 0 0 0\nO 1 1 1\n"
    (tmp_path / "t.xyz").write_text(frame * 2 + "2\ncut\nH 0 0 0\n")
    assert structures.read_xyz_frames(spark, str(tmp_path)).count() == 2


def test_marker_scan_and_reconciliation(spark, tmp_path):
    for f, text in (("tag_finished", ""), ("POSCAR", "x"), ("OUTCAR", f"a\n{structures.CONVERGED}\n{structures.FOOTER}\n")):
        p = tmp_path / "system_1/frame_1" / f
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    (tmp_path / "system_1/frame_2").mkdir()
    (tmp_path / "system_1/frame_2/tag_failed").write_text("")
    scan = structures.scan_markers(spark, str(tmp_path), "t").withColumn("result", campaign.scan_result())
    assert {(r.frame, r.result) for r in scan.collect()} == {("frame_1", "success"), ("frame_2", "failed")}
    entries = spark.createDataFrame([("system_1", f"frame_{k}", None) for k in (1, 2, 3)], "system string, frame string, target string")
    targets = spark.createDataFrame([("t", True)], "target string, available boolean")
    got = {r.frame: (r.result, r.reason) for r in campaign.reconciled(entries, targets, scan).collect()}
    assert got == {"frame_1": ("success", "success"), "frame_2": ("failed", "failed"), "frame_3": ("pending", "missing_remote_frame")}


def test_recovery(spark):
    e = spark.createDataFrame([("s", "1", "t", "running", "j1"), ("s", "2", "t", "submitted", "j2"), ("s", "3", "t", "Running", "j3"), ("s", "4", "t", "running", "j4"), ("s", "5", "", "running", "j5"), ("s", "6", "t", "planned", "j6"), ("s", "2", "t2", "running", "j2"), ("s", "7", "gone", "running", "j7"), ("s", "8", "lost", "running", "j8")], "system string, frame string, target string, status string, job_id string")
    t = spark.createDataFrame([("t", True), ("t2", True), ("gone", False), ("lost", False)], "target string, available boolean")
    scan = spark.createDataFrame([("t", "s", "1", "success"), ("t", "s", "3", "failed")], "target string, system string, frame string, result string")
    jobs = spark.createDataFrame([("t", "j2", "n")], "target string, job_id string, name string")
    rows = campaign.recovery_plan(e, t, scan, jobs, allow_lost=["lost"], stamp="now").collect()
    got = {(r.frame, r.target): (r.action, r.new_status, r.job_id) for r in rows}
    assert got == {
        ("1", "t"): ("normalized_terminal", "finished", "j1"),
        ("2", "t"): ("preserved_active", "submitted", "j2"),
        ("2", "t2"): ("recovered_for_resubmit", "selected", None),  # its job is another target's
        ("3", "t"): ("normalized_terminal", "failed", "j3"),
        ("4", "t"): ("recovered_for_resubmit", "selected", None),
        ("5", None): ("unresolved", "running", "j5"),
        ("7", "gone"): ("unresolved", "running", "j7"),
        ("8", "lost"): ("recovered_for_resubmit", "selected", None),
    }
    assert {r.recovered_after_outage_at for r in rows if r.action == "recovered_for_resubmit"} == {"now"}
    # one target only is everybody's
    one = campaign.recovery_plan(e.where("frame in ('1', '5')"), t.where("target = 't'"), scan, jobs).collect()
    assert {(r.frame, r.target, r.action) for r in one} == {("1", "t", "normalized_terminal"), ("5", "t", "recovered_for_resubmit")}


def test_job_summary_leaves_out_jobs_without_a_key(spark):
    jobs = spark.createDataFrame([("t", "1", "R", "/run/system_001/frame_000001"), ("t", "2", "Q", "/run/system_001/frame_000001/"), ("t", "3", "Q", "/other/system_002/frame_000002"), ("t", "4", "Q", None), ("t", "5", "Q", "/run/one")], "target string, job_id string, state string, workdir string")
    keyed = jobs.withColumn("task_key", X.task_key_below("workdir", "/run/")).withColumn("status", states.mapped_status("state", "pbs"))
    r = campaign.job_summary(keyed).first()
    assert (r.physical_jobs, r.unique_tasks, r.duplicate_jobs, r.running, r.queued) == (2, 1, 1, 1, 1)


def test_profiles_of_the_controllers(spark):
    df = spark.createDataFrame([("c ", 1), ("S", None), ("BOOT_FAIL", None), ("odd", None), (None, None)], "state string, code int")
    of = lambda p: [r[0] for r in df.select(states.mapped_status("state", p, "code")).collect()]
    assert of("pbs_flow") == ["failed", "submitted", "submitted", "submitted", "submitted"]
    assert of("controller_pbs") == ["finished", "", "", "", ""]
    assert of("controller_slurm") == ["", "", "failed", "", ""]


def test_states_that_schedulers_have_besides(spark):
    df = spark.createDataFrame([(x,) for x in ("RESIZING", "STAGE_OUT", "SIGNALING", "DEADLINE", "NODE_FAIL_X", "RUNNING+")], "state string")
    of = lambda p: [r[0] for r in df.select(states.mapped_status("state", p)).collect()]
    assert of("slurm") == ["running", "unknown", "unknown", "unknown", "unknown", "running"]
    assert of("slurm_submit") == ["submitted", "running", "running", "failed", "failed", "submitted"]


def test_identifiers_in_extras_keep_a_job_alive(spark):
    """Entries read from documents have their identifiers in a map, and no job_id column is needed."""
    e = spark.createDataFrame([("s", str(k), "t", "running", {name: f"j{k}"}) for k, name in enumerate(campaign.IDENTIFIERS)] + [("s", "9", "t", "running", {"other": "j0"}), ("s", "10", "t", "running", None)], "system string, frame string, target string, status string, extras map<string,string>")
    t = spark.createDataFrame([("t", True)], "target string, available boolean")
    scan = spark.createDataFrame([], "target string, system string, frame string, result string")
    jobs = spark.createDataFrame([("t", f"j{k}", "n") for k in range(9)], "target string, job_id string, name string")
    got = {r.frame: r.action for r in campaign.recovery_plan(e, t, scan, jobs).collect()}
    assert got == {str(k): "preserved_active" for k in range(6)} | {"9": "recovered_for_resubmit", "10": "recovered_for_resubmit"}


def test_repeated_scan_rows_count_once(spark):
    e = spark.createDataFrame([("s", "1", "t"), ("s", "2", "t")], "system string, frame string, target string")
    t = spark.createDataFrame([("t", True)], "target string, available boolean")
    scan = spark.createDataFrame([("t", "s", "1", "success", 1), ("t", "s", "1", "pending", 2), ("t", "s", "2", "failed", 4), ("t", "s", "2", "success", 3)], "target string, system string, frame string, result string, line int")
    of = lambda **o: {r.frame: r.result for r in campaign.reconciled(e, t, scan, **o).collect()}
    assert campaign.reconciled(e, t, scan).count() == 2 and of(order="line") == {"1": "pending", "2": "failed"} and of() == {"1": "success", "2": "success"}


def test_a_status_without_a_tag_counts(spark, tmp_path):
    for name, files in {"1": {"task_info.json": {"status": "Failed"}}, "2": {"task_info.json": {"status": ""}, "frame_info.json": {"status": "failed"}}, "3": {"task_info.json": {"status": "running"}, "frame_info.json": {"status": "failed"}}, "4": {"POSCAR": {}}}.items():
        for f, text in files.items():
            p = tmp_path / f"system_1/frame_{name}" / f
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(json.dumps(text, indent=2))
    scan = structures.scan_markers(spark, str(tmp_path), "t").withColumn("result", campaign.scan_result())
    assert {(r.frame[-1], r.status, r.result) for r in scan.collect()} == {("1", "failed", "failed"), ("2", "failed", "failed"), ("3", "running", "pending"), ("4", "", "pending")}


def test_the_first_structures_are_taken_in_natural_order(spark, tmp_path):
    from atomframe.operators import jobs

    for k in (10, 2):
        (tmp_path / f"frame_{k}").mkdir()
        (tmp_path / f"frame_{k}/POSCAR").write_text(POSCAR)
    got, _ = jobs.predicted_structures(spark, str(tmp_path), lambda: (["H", "O"], lambda c, b, t: (c.sum(axis=1), c, b)), ["H", "O"], most=1)
    assert [r.path.split("/")[-2] for r in got.collect()] == ["frame_2"]


def test_scheduler_tables(spark):
    text = lambda x: spark.createDataFrame([("a", x)], "file string, text string")
    r = records.job_rows(text("JOBID PARTITION NAME ST TIME\n123 standard vasp RUNNING 1:00\n\n"), "squeue").collect()
    assert [(x.job_id, x.name, x.state, x.queue) for x in r] == [("123", "vasp", "RUNNING", "standard")]
    r = records.job_rows(text("Job id Name User Time Use S Queue\n----- ---- ---- -------- - -----\n456.server user job R normal\n"), "qstat").collect()
    assert [x.job_id for x in r] == ["456"]
    r = records.job_rows(text("7|n|running\n"), "squeue_pipes").first()
    assert (r.job_id, r.name, r.state) == ("7", "n", "RUNNING")
    full = "Job Id: 456.server\n    Job_Name = vasp\n    job_state = r\n    queue = normal\n    Variable_List = A=1,PBS_O_WORKDIR=/work/run/system_001/frame_000010,\n        B=2\nJob Id: 457.server\n    job_state = Q\n"
    r = records.job_rows(text(full), "qstat_full").orderBy("job_id").collect()
    assert [(x.job_id, x.state, x.workdir) for x in r] == [("456.server", "R", "/work/run/system_001/frame_000010"), ("457.server", "Q", "")]
    r = records.job_rows(text("JobId=789 JobName=vasp JobState=PENDING Partition=compute WorkDir=/work/run/system_002/frame_000020\n"), "scontrol").first()
    assert (r.state, r.queue) == ("PENDING", "compute")


def test_an_item_that_is_no_object_does_not_lose_the_document(spark):
    rows = [("a", '{"entries":[{"system":"s","frame":"f","host_label":"h","deep":{"x":1}},3,null,[1],"t"]}'), ("b", '{"entries":{"x":1}}'), ("c", '{"entries":7,"records":[{"system":"r","frame":"g"}]}')]
    entries, bad = records.campaign_entries(spark.createDataFrame(rows, "file string, text string"))
    assert {(r.file, r.system, r.target, r.extras.get("deep")) for r in entries.collect()} == {("a", "s", "h", '{"x":1}'), ("c", "r", None, None)}
    assert [r.file for r in bad.collect()] == ["b"]


def test_groups_with_a_null_key_stay(spark):
    df = spark.createDataFrame([(None, i) for i in range(6)] + [("g", i) for i in range(3)], "g string, i int")
    assert {(r.g, r.i) for r in index.even_sample(df, ["g"], ["i"], 2).collect()} == {(None, 0), (None, 5), ("g", 0), ("g", 2)}
    assert select.select_frames(df, "g", "i", 2).where("g is null").count() == 3


def test_inference_uses_the_models_order_of_types(spark):
    seen = spark.createDataFrame([(0, 2, [0, 1], ["H", "O"], [0.0] * 6, [1.0] * 9), (1, 2, [0, 1], ["H", "X"], [0.0] * 6, [1.0] * 9)], "id int, natoms int, types array<int>, type_map array<string>, coord array<double>, box array<double>")

    def factory():
        def evaluate(coord, box, types):
            return np.full(len(coord), types[0] * 10 + types[1]), np.ones_like(coord), np.zeros((len(coord), 9))

        return ["O", "H"], evaluate

    got = {r.id: r for r in inference.predict(seen, factory, ["id"]).collect()}
    assert got[0].energy_pred == 10 and got[0].skipped is None
    assert "KeyError" in got[1].skipped and got[1].force_pred is None


def test_split_is_a_disjoint_cover(spark):
    df = spark.range(500).selectExpr("id", "if(id = 499, 'solo', concat('g', id % 3)) as g")
    out = index.train_test_split(df, ["g"], "id", 0.1, seed=2**40).collect()
    assert len({r.id for r in out}) == 500
    assert {r.role for r in out if r.g == "solo"} == {"train"}
    assert sum(r.role == "test" for r in out) == 3 * 17


def test_numbers_of_a_hot_group(spark):
    df = spark.range(2000).selectExpr("id", "if(id % 10 < 8, null, id % 10) as g")
    got = index.numbered_within(df, ["g"], ["id"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.id, r["index"]))
    assert all([i for _, i in sorted(v)] == list(range(len(v))) for v in by.values()) and len(got) == 2000


def test_text_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"entries": [{"system_name": "s", "frame_name": "f", "status": "", "x": "1"}]}))
    (tmp_path / "r.json").write_text(json.dumps({"records": [{"system_name": "s2", "frame_name": "f2"}]}))
    (tmp_path / "bad.json").write_text("{")
    entries, bad = records.read_campaigns(spark, str(tmp_path))
    assert {(r.system, r.status) for r in entries.collect()} == {("s", None), ("s2", None)}
    assert [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["bad.json"]
    full = "Job Id: 12.host\n    Job_Name = run1\n    job_state = R\n    queue = q1\n    Variable_List = PBS_O_HOME=/h,PBS_O_WORKDIR=/runs/sys\n\ttem_1/frame_2,X=1\n"
    job = records.job_rows(spark.createDataFrame([("a", full)], "file string, text string"), "qstat_full").first()
    assert (job.job_id, job.name, job.state, job.workdir) == ("12.host", "run1", "R", "/runs/system_1/frame_2")
    sc = records.job_rows(spark.createDataFrame([("a", "JobId=7 JobName=n\n   JobState=RUNNING Partition=p\n   WorkDir=/w\n")], "file string, text string"), "scontrol").first()
    assert (sc.job_id, sc.state, sc.workdir) == ("7", "RUNNING", "/w")


def test_log_metrics(spark):
    text = "number of test data : 2\nForce RMSE : 9\nnumber of test data : 3\n# weighted average of errors\nEnergy RMSE/Natoms : 2.5e-03 eV\nForce RMSE : 9.4e-02 eV/A"
    rows = spark.createDataFrame([("f", i + 1, v) for i, v in enumerate(text.split("\n"))], "file string, line int, value string")
    r = records.with_mev(records.log_metrics(rows, {"Energy RMSE/Natoms": "e", "Force RMSE": "f"}, "weighted average"), ["e", "f"]).first()
    assert (r.frames, r.groups, round(r.e_meV, 6), round(r.f_meV, 6)) == (5, 2, 2.5, 94.0)


def test_states_and_names(spark):
    one = spark.range(1).select(states.mapped_status(F.lit("CANCELLED+")).alias("a"), states.mapped_status(F.lit("BOOT_FAIL"), "slurm_submit").alias("b"))
    assert tuple(one.first()) == ("failed", "failed")
    p = spark.createDataFrame([("/a/system_3/frame_12/POSCAR",), ("system_3__frame_4",), ("/none",)], "p string").select(X.task_key("p").alias("k"))
    assert [r.k for r in p.collect()] == ["system_3/frame_12", "system_3/frame_4", ""]


def test_exclusion_reasons(spark):
    df = spark.createDataFrame([("a", "p1"), ("b", "p2"), ("c", None)], "task_key string, path string")
    sel = spark.createDataFrame([("a", None), (None, "p2"), (None, None)], "task_key string, path string")
    assert {r.task_key: r.reason for r in select.excluded(df, sel, "task_key", "path").collect()} == {"a": "matched_task_key", "b": "matched_path", "c": None}


def test_publish_rolls_back(spark, tmp_path):
    path = str(tmp_path / "table")
    ok = lambda d: d.where("id < 0")
    assert sinks.publish(spark.range(3), path, ok) is None
    with pytest.raises(ValueError, match="not published"):
        sinks.publish(spark.range(-2, 3), path, ok)
    assert spark.read.parquet(path).count() == 3
    assert sinks.publish(spark.range(5), path, ok).startswith(path)
    assert spark.read.parquet(path).count() == 5


def test_stream_equals_batch(spark, tmp_path):
    df = spark.sql("select id, timestamp_seconds(id * 600) as ts, if(id % 3 = 0, 'finished', 'running') as status from range(200)")
    df.write.parquet(str(tmp_path / "in"))
    stream = S.file_stream(spark, str(tmp_path / "in"), df.schema)
    got = S.drained(S.periodic_counts(stream, "ts", "status", ["finished"], "3 hours", "0 seconds"), "append", str(tmp_path / "out")).collect()
    assert len(got) == 11 and all(r.total == 18 and r.finished == 6 for r in got)


def test_validation_of_a_converted_dataset(spark):
    g = spark.createDataFrame([("a", ["O"], [1], 2, 2, 0), ("b", ["O"], [1], 2, 1, 1)], "group_name string, elements array<string>, counts array<int>, selected int, converted int, skipped int")
    a = spark.createDataFrame([("a", "force", 2, 1)], "group_name string, array string, raw_rows int, npy_rows int")
    codes = {(r.group_name, r.code) for r in dataset.validate_dataset(g, a).collect()}
    assert ("a", "frame count mismatch: force") in codes and ("b", "skipped_frames") in codes and ("a", "duplicate_composition") in codes


@pytest.mark.parametrize("by_blocks", [False, True])
def test_similar_names_equal_brute_force(spark, by_blocks):
    import random
    from difflib import SequenceMatcher

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def score(a, b):
        if by_blocks:
            return SequenceMatcher(None, b, a).ratio()
        return 1 - distance(a, b) / max(len(a), len(b)) if a or b else 1.0

    r = random.Random(2)
    known = {"abc", "/data/a/x", "ab", "a", "", "aaaa", *("".join(r.choice("abc/") for _ in range(r.randrange(1, 9))) for _ in range(60))}
    wrong = {"axbxc", "ba", "b", "aaaaa", "", *("".join(r.choice("abcd/") for _ in range(r.randrange(1, 10))) for _ in range(40))}
    table = lambda names: spark.createDataFrame([(n,) for n in names], "p string")
    out = dataset.similar_names(table(wrong), table(known), "p", best=4, ratio=dataset.matching_ratio() if by_blocks else None).collect()
    want = {}
    for w in wrong:
        rows = sorted(((-score(w, k), k) for k in known if score(w, k) >= 0.72))[:4]
        want.update({(w, k): round(-s, 6) for s, k in rows})
    assert {(x.name, x.suggestion): round(x.score, 6) for x in out} == want and want


def test_candidate_jobs(spark):
    from atomframe.operators import jobs

    found = spark.createDataFrame([("s", "1", "Prepared", None, "a"), ("s", "2", None, {"finished": 3}, "a"), ("s", "2", None, {"failed": 1, "finished": 3}, "b"), ("s", "3", " ", {"finished": 1, "running": 1}, "a")], "system string, frame string, status string, status_counts map<string,int>, source string")
    rows, header = jobs.candidate_manifest(found, ["system", "frame"])
    assert {(r.frame, r.status) for r in rows.collect()} == {("1", "planned"), ("2", "failed"), ("3", "planned")}
    assert header.first().records == 4
    tasks = spark.createDataFrame([("system_007", "frame_12", 12, "/p/1"), ("other", "frame_3", 3, "/p/2"), ("s", "f", 1, None), ("s", "f2", 2, "/p/9")], "system string, frame string, frame_number int, path string")
    heads = spark.createDataFrame([("/p/1", ["O", "H", "Z"], None), ("/p/2", None, "ValueError: x")], "path string, elements array<string>, error string")
    good, bad = jobs.planned_tasks(tasks, heads, ["H", "O"], "run")
    r = good.first()
    assert r.element_order == ["H", "O", "Z"] and r.job_name.startswith("s2") and r.job_name.endswith("_007_000012")
    assert {(x.frame, x.error) for x in bad.collect()} == {("frame_3", "ValueError: x"), ("f", "no structure"), ("f2", "structure not found")}
    pool = spark.createDataFrame([("system_1", f"frame_{k}", f"/new/{k}") for k in range(1, 8)], "system string, frame string, source_structure_path string")
    runs = spark.createDataFrame([("system_1", "frame_1", "/old", "running"), ("system_1", "frame_3", "/old", "planned")], "system string, frame string, source_structure_path string, status string")
    chosen = jobs.selected_candidates(runs, pool, ["system", "frame"], "frame", stride=2, most=2).collect()
    assert [(c.frame, c.source_structure_path) for c in chosen] == [("frame_3", "/new/3"), ("frame_5", "/new/5")]


def test_scheduler_and_recovery_jobs(spark):
    from atomframe.operators import jobs

    text = lambda x: spark.createDataFrame([("a", x)], "file string, text string")
    full = "Job Id: 1.s\n    job_state = R\n    Variable_List = PBS_O_WORKDIR=/run/system_1/frame_1\nJob Id: 2.s\n    job_state = Q\n    Variable_List = PBS_O_WORKDIR=/run/system_1/frame_1\n"
    slurm = "JobId=7 JobState=PENDING WorkDir=/w/system_2/frame_2\nJobId=8 JobState=RUNNING WorkDir=/else\n"
    targets = spark.createDataFrame([("p", True), ("s", True), ("down", False)], "target string, available boolean")
    by_target, total = jobs.scheduler_summary({"p": (text(full), "qstat_full", "/run"), "s": (text(slurm), "scontrol", "/w")}, targets)
    assert {(r.target, r.physical_jobs, r.unique_tasks, r.duplicate_jobs, r.running, r.queued) for r in by_target.collect()} == {("p", 2, 1, 1, 1, 1), ("s", 1, 1, 0, 0, 1)}
    t = total.first()
    assert (t.targets, t.unavailable, t.physical_jobs, t.status) == (3, 1, 3, "partial")
    e = spark.createDataFrame([("s", "1", "t", "running", "j1"), ("s", "2", "t", "submitted", "j2")], "system string, frame string, target string, status string, job_id string")
    one = spark.createDataFrame([("t", True)], "target string, available boolean")
    scan = spark.createDataFrame([("t", "s", "1", "success")], "target string, system string, frame string, result string")
    _, counts = jobs.recovered_campaign(e, one, scan, spark.createDataFrame([], "target string, job_id string, name string"))
    assert counts.first().asDict() == {"recovered_for_resubmit": 1, "preserved_active": 0, "normalized_terminal": 1, "unresolved": 0}
    done = jobs.archived_campaign(e, one, scan)
    assert {(r.frame, r.reason) for r in done.rows.collect()} == {("1", "success"), ("2", "missing_remote_frame")} and done.ready.count() == 0


def test_structure_predictions_leave_out_what_is_excluded(spark, tmp_path):
    from atomframe.operators import jobs

    for k, text in ((1, POSCAR), (2, POSCAR), (3, POSCAR.replace("Cartesian", "Foo"))):
        p = tmp_path / f"system_1/frame_{k}"
        p.mkdir(parents=True)
        (p / "POSCAR").write_text(text)
    left_out = spark.createDataFrame([("task_key", "system_1/frame_2")], "kind string, key string")

    def factory():
        return ["H", "O"], lambda c, b, t: (c.sum(axis=1), c, b)

    got, why = jobs.predicted_structures(spark, str(tmp_path), factory, ["H", "O"], excluded=left_out)
    assert [(r.path[-15:], r.energy_pred) for r in got.collect()] == [("/frame_1/POSCAR", 1.5)]
    assert {(r.path[-8], r.reason.split(":")[0]) for r in why.collect()} == {("2", "matched_task_key"), ("3", "ValueError")}


def test_systems_report(spark):
    listed = spark.createDataFrame([("/r/sysA",), ("/r/sysB",), ("/r/sysB",), ("/r/Tests/sysC",)], "p string")
    scanned = spark.createDataFrame([("/r/sysA", ["O", "H"]), ("/r/sysBB", ["H"])], "p string, type_map array<string>")
    ranges = spark.createDataFrame([("g", 0, 0, 5, 9), ("g", 1, 6, 8, 9)], "`group` string, position int, start int, `end` int, total int")
    got = {(r.code, r.path, r.detail) for r in dataset.systems_report(listed, scanned, "p", "/r", ranges=ranges, expected=["O", "H"]).collect()}
    assert got == {("duplicate", "/r/sysB", None), ("missing", "/r/sysB", None), ("unlisted", "/r/sysBB", None), ("not_scanned", "/r/Tests/sysC", None), ("similar", "/r/sysB", "/r/sysBB"), ("type_map", "/r/sysBB", "H"), ("type_map_count", "O,H", "1"), ("range_gap", "g", "5 6"), ("range_end", "g", "9 8")}


def test_xyz_files_are_in_frame_order(spark, tmp_path):
    write_group(tmp_path / "a, b/g", ["O", "H"], [0, 1], n=9)
    frames = groups.read_frame_groups(spark, [str(tmp_path / "a, b")])
    out = str(tmp_path / "xyz")
    sinks.write_xyz(frames, out, ["system_path", "set_name", "frame_in_set"], digits=1)
    text = "\n".join(open(f"{out}/{n}").read().rstrip("\n") for n in sorted(os.listdir(out)) if n.startswith("part-") and os.path.getsize(f"{out}/{n}"))
    assert [x.split()[0] for x in text.split("\n") if x.startswith("energy=")] == [f"energy={k}.0" for k in range(9)]
    assert structures.parse_xyz(text) and sum(1 for _ in structures.parse_xyz(text)) == 9
