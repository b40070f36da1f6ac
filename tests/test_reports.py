"""Reports, selection, profiles, workflow, inventories and text functions."""

import hashlib
import json
import shutil

import pytest
from pyspark.sql import functions as F

from loomgrid.functions import text
from loomgrid.operators import inventory, reports, schema_checks, selection
from loomgrid.plans import history, workflow
from loomgrid.plans.profile import load_profile
from loomgrid.sources import datasets


@pytest.mark.parametrize(
    ("message", "wanted"),
    [("Episode 3 has NaN; see episode 12", [3, 12]), ("gaps in episode(s) 1st pass: [1, 4]", [1, 4]), ("episode(s): [7]", [7]), ("episodes 5 bad", []), ("", [])],
)
def test_message_episodes(spark, message, wanted):
    row = spark.createDataFrame([(message,)], "m string").select(text.message_episodes(F.col("m"))).first()
    assert row[0] == wanted


@pytest.mark.parametrize(
    ("overall", "indices", "code", "status"),
    [("PASS", [], 0, "pass"), ("FAIL", [2, 5], 1, "findings"), ("FAIL", [], 1, "blocked"), ("WARN", [], 1, "blocked"), ("WARN", [3], 0, "blocked")],
)
def test_evaluation_status(spark, overall, indices, code, status):
    result = reports.evaluation_result("check", "/d", "fail", overall, indices, code)
    assert result["status"] == status and not reports.contract_violations(result, "fail", "/d")
    run = spark.createDataFrame([(None, True, overall, len(indices), code)], "run_error string, has_report boolean, overall_severity string, n_indices int, return_code int")
    assert reports.normalized(run, "fail").first().status == status


def test_contract_violations():
    good = reports.evaluation_result("check", "/d", "fail", "FAIL", [1, 2], 1)
    broken = {"contract": "x", "status": "y", "fail_on": "no", "evaluator": "", "overall_severity": "bad", "deletable_episode_indices": [True], "non_episode_blockers": None, "findings": None, "artifacts": [], "evaluator_return_code": True}
    for key, value in broken.items():
        assert reports.contract_violations(good | {key: value}, "fail"), key
    assert reports.contract_violations(good | {"deletable_episode_indices": [2, 1]}, "fail")
    assert reports.contract_violations(good, "fail", "/other") == ["another dataset"]
    assert reports.contract_violations(good | {"status": "pass"}, "fail")


DOCUMENT = {"a": 1, "checks": [{"messages": [{"severity": "FAIL", "message": "x } ]"}]}], "deletable_episode_indices": [3, True, 1], "n": {"deletable_episode_indices": [9]}}


def test_flatten(spark):
    def walk(node, path="$"):
        items = node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ()
        for key, value in items:
            if isinstance(node, dict):
                yield path, key, value
            yield from walk(value, f"{path}.{key}" if isinstance(node, dict) else f"{path}[{key}]")

    deep = {"x": 1}
    for k in range(20):
        deep = {"k": [deep, k]} if k % 2 else {"d": deep, "e": None}
    documents = [DOCUMENT, deep, {}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "report_id int, report string")
    found = sorted((r.report_id, r.path, r.key, json.loads(r.value)) for r in reports.flatten(df).collect() if r.key != "k")
    assert [x[:3] for x in found] == sorted((i, p, k) for i, d in enumerate(documents) for p, k, _ in walk(d) if k != "k")
    for i, path, key, value in found:
        assert value == next(v for p, k, v in walk(documents[i]) if (p, k) == (path, key))
    assert sorted(r.episode_index for r in reports.deletable_indices(df).collect()) == [1, 3]


@pytest.mark.parametrize("text", ["not json", "[1]", "3", None])
def test_what_is_no_report(spark, text):
    df = spark.createDataFrame([(1, json.dumps(DOCUMENT)), (2, text)], "report_id int, report string")
    for f in (reports.flatten, reports.deletable_indices, lambda x: reports.episode_selection(x, "fail"), lambda x: reports.report_states(x, "fail")):
        with pytest.raises(Exception, match="report 2 is not a JSON object"):
            f(df).collect()
    assert reports.flatten(df, strict=False).count() == 8


def test_selection_by_severity(spark):
    finding = lambda i, level: {"episode_index": i, "severity": level}
    documents = [
        {"checks": [{"findings": [finding(3, "FAIL"), finding(4, "warn"), finding("5", "FAIL"), finding(6, "odd"), finding(True, "FAIL"), {"severity": "FAIL"}]}], "n": {"deletable_episode_indices": [9]}},
        {"overall_severity": "fail", "checks": []},
        {"overall_severity": "FAIL", "deletable_episode_indices": [2, 2, "x"], "non_episode_blockers": ["no \"meta\"", 3]},
        {"overall_severity": "PASS", "deletable_episode_indices": "all", "non_episode_blockers": "many"},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "report_id int, report string")
    picked = lambda level: sorted((r.report_id, r.episode_index) for r in reports.episode_selection(df, level).collect())
    assert picked("fail") == [(0, 3), (2, 2)] and picked("warn") == [(0, 3), (0, 4), (2, 2)]
    states = {r.report_id: (r.n_indices, r.blockers, r.problem) for r in reports.report_states(df, "fail").collect()}
    assert states == {0: (1, [], None), 1: (0, [], "threshold reached without episodes"), 2: (1, ['no "meta"', "3"], "blockers that concern no episode"), 3: (0, [], None)}
    rows = spark.createDataFrame([(e,) for e in range(8)], "episode_index int")
    for number, match in ((1, "without episodes"), (2, "meta")):
        with pytest.raises(ValueError, match=match):
            selection.remove_failed(rows, reports.episode_selection(df, "fail"), 8, states=reports.report_states(df.where(f"report_id = {number}"), "fail"))
    kept = selection.remove_failed(rows, reports.episode_selection(df, "fail"), 8, states=reports.report_states(df.where("report_id IN (0, 3)"), "fail"))
    assert kept[0] == "filtered" and kept[1].count() == 6


def test_combined(spark):
    rows = spark.createDataFrame([(1, "WARN", None, 0, 0), (1, "FAIL", None, 2, 1), (2, None, "no report", 0, 1)], "d int, overall_severity string, blocker string, n_indices int, return_code int")
    out = {r.d: (r.overall_severity, r.status) for r in reports.combined(rows, ["d"]).collect()}
    assert out == {1: ("FAIL", "findings"), 2: ("FAIL", "blocked")}


def test_removal(spark):
    rows = spark.createDataFrame([(e, f) for e in range(4) for f in range(2)], "episode_index int, frame_index int")
    pick = lambda *i: spark.createDataFrame([(x,) for x in i], "episode_index int")
    status, kept, removed = selection.remove_failed(rows, pick(1), 4)
    assert status == "filtered" and [r[0] for r in removed.collect()] == [1] and sorted({r.episode_index for r in kept.collect()}) == [0, 1, 2]
    assert selection.remove_failed(rows, pick(), 4)[0] == "no_change"
    assert selection.remove_failed(rows, pick(2), 4, dry_run=True)[0] == "dry_run"
    for bad in ((0, 1, 2, 3), (4,)):
        with pytest.raises(ValueError):
            selection.remove_failed(rows, pick(*bad), 4)


def test_policy(spark):
    episodes = spark.createDataFrame([(0,), (1,), (2,)], "episode_index int")
    found = spark.createDataFrame([(0, "FAIL"), (2, "WARN")], "episode_index int, severity string")
    out = {r.episode_index: (r.severity, r.status, r.dataset_episode_index) for r in selection.policy_outcome(episodes, found, "drop", "fail").collect()}
    assert out == {0: ("FAIL", "rejected", None), 1: ("PASS", "converted", 0), 2: ("WARN", "converted", 1)}
    with pytest.raises(ValueError):
        selection.enforce(selection.policy_outcome(episodes, found, "fail", "fail"))
    with pytest.raises(ValueError):
        selection.enforce(selection.policy_outcome(episodes.where("episode_index <> 1"), found, "drop", "warn"))
    assert {r.severity for r in selection.policy_outcome(episodes, found, "off", "fail").collect()} == {"NOT_RUN"}


def test_profile():
    assert load_profile()["input.policy"] == "drop"
    profile = load_profile({"version": "1.0", "video": {"features": [" a ", "b"]}}, {"input.max_findings": 3})
    assert profile["video.features"] == ["a", "b"] and profile.document()["input"]["max_findings"] == 3
    for bad in ({"version": "2"}, {"version": "1.0", "x": 1}, {"version": "1.0", "input": {"max_findings": True}}, {"version": "1.0", "video": {"jump_percentile": 0}}, {"version": "1.0", "video": {"features": ["a", "a"]}}, {"version": "1.0", "video": {"max_episodes": 0}}, {"version": "1.0", "input": 3}):
        with pytest.raises(ValueError):
            load_profile(bad)


def test_workflow(spark):
    rows = spark.createDataFrame([(e, 0) for e in range(3)], "episode_index int, frame_index int")

    def once(frames, profile):
        bad = frames.select("episode_index").distinct().count() == 3
        return reports.evaluation_result("once", "/d", profile["dataset.fail_on"], "FAIL" if bad else "PASS", [1] if bad else [], int(bad))

    state = workflow.run_workflow(rows, [("once", once)], load_profile(), 3)
    assert workflow.exit_code(state) == 0 and [s["name"] for s in state.stages] == ["evaluation:once", "filter:once", "post-filter:once"]
    stuck = workflow.run_workflow(rows, [("b", lambda f, p: reports.evaluation_result("b", "/d", "fail", "FAIL", [], 1))], load_profile(), 3)
    assert workflow.exit_code(stuck) == 20


def test_inventory(spark, tmp_path):
    for root, files in (("a", {"x": "1", "s/y": "2"}), ("b", {"x": "1", "s/y": "3", "z": "4"})):
        for name, content in files.items():
            path = tmp_path / root / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(content)
    a, b = (inventory.file_inventory(spark, str(tmp_path / r)) for r in "ab")
    difference = inventory.inventory_difference(a, b, "relative_path", ["size", "sha256"])
    assert {(r.relative_path, r.problem) for r in difference.collect()} == {("s/y", "different"), ("z", "unexpected")}
    bags = spark.createDataFrame([("/c/one", "/c"), ("/d/one", "/d/one"), ("/x/two", None), ("/y/two", None)], "path string, collection string")
    plan = {r.path: (r.destination, r.problem) for r in inventory.archive_plan(bags, "/arc").collect()}
    assert plan["/c/one"] == ("/arc/c/one", None) and plan["/d/one"][0] == "/arc/one" and plan["/x/two"][1] == "duplicate destination"


def test_history_and_dataset(spark, tmp_path):
    frames = spark.createDataFrame([(0, 0, [1.0]), (1, 0, [2.0])], "episode_index int, frame_index int, x array<double>")
    target = str(tmp_path / "set")
    datasets.write_dataset(frames, target, {"fps": 10})
    assert spark.read.parquet(f"{target}/data").count() == 2 and not list(tmp_path.glob(".set*"))
    with pytest.raises(FileExistsError):
        datasets.write_dataset(frames, target, {})
    log = str(tmp_path / "log")
    for operation in ("validation", "episode_selection"):
        history.append_history(spark, log, [history.history_entry(operation, history.dataset_identity(spark, target), {"ok": True})])
    assert {r.operation for r in history.read_history(spark, log).collect()} == {"validation", "episode_selection"}
    path = tmp_path / "r.json"
    datasets.write_json({"a": 1}, str(path))
    assert path.read_text() == '{\n  "a": 1\n}\n' and datasets.read_json(spark, str(path)) == {"a": 1}


def test_paths_tasks_text(spark):
    paths = spark.createDataFrame([("/a",), ("/a/b",), ("/ab",), ("/c/",), ("/c",)], "path string")
    assert {(r.outer_path, r.inner_path) for r in schema_checks.nested_paths(paths).collect()} == {("/a", "/a/b"), ("/c", "/c")}
    tasks = spark.createDataFrame([("/in/x", "full"), ("y", "base"), ("nope", "z")], "key string, task string")
    inputs = spark.createDataFrame([("/in/x",), ("/in/y",), ("/in/z/",)], "path string")
    assert {r.path: r.task for r in schema_checks.assign_tasks(inputs, tasks, "default").collect()} == {"/in/x": "full", "/in/y": "base", "/in/z/": "default"}
    assert [r.key for r in schema_checks.unknown_task_keys(inputs, tasks).collect()] == ["nope"]
    row = spark.range(1).select(
        text.repository_slug(F.lit("..my data!-")).alias("slug"),
        text.repository_slug(F.lit("---")).alias("empty"),
        text.topic_path(F.lit("/a//b"), F.lit("c"), F.lit("/d/")).alias("topic"),
        text.assignment(F.lit(" k = v=w ")).alias("pair"),
        text.video_path("v/{video_key}/c-{chunk_index:03d}_{file_index}", F.lit("cam"), F.lit(7), F.lit(12)).alias("path"),
    ).first()
    assert tuple(row)[:3] == ("local/my-data", "local/dataset", "/a/b/c/d") and tuple(row.pair) == ("k", "v=w") and row.path == "v/cam/c-007_12"
    assert text.parse_command("n=run --x 'a b'") == ("n", ["run", "--x", "a b"])
    with pytest.raises(ValueError):
        text.parse_command("n=run --fail-on=x")


def test_renumbering_in_spans(spark):
    rows = spark.createDataFrame([(i * i,) for i in range(60)], "episode_index int")
    assert sorted((r.episode_index, r.new_index) for r in selection.renumbered(rows, span=100).collect()) == [(i * i, i) for i in range(60)]


def test_inventory_of_hidden_and_large_files(spark, tmp_path):
    for name, content in ((".hidden", b"1"), ("_under/x", b"22"), ("plain", b"a" * 100_001)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content)
    found = {r.relative_path: (r.size, r.sha256) for r in inventory.file_inventory(spark, str(tmp_path), block=1000).collect()}
    assert found == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in ((".hidden", b"1"), ("_under/x", b"22"), ("plain", b"a" * 100_001))}
    (tmp_path / "link").symlink_to("plain")
    with pytest.raises(ValueError):
        inventory.file_inventory(spark, str(tmp_path))


def test_dataset_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(e, f, [float(e), float(f)]) for e in range(3) for f in range(4)], "episode_index bigint, frame_index bigint, `observation.state` array<double>")
    path = str(tmp_path / "set")
    datasets.write_dataset(rows, path, {"fps": 10, "features": {"observation.state": {"dtype": "float32"}, "cam": {"dtype": "video"}}, "video_path": "v"})
    meta = datasets.read_metadata(spark, path)
    assert (meta["video_features"], meta["info"]["total_episodes"], meta["info"]["total_frames"]) == (["cam"], 3, 12)
    assert sorted((r.episode_index, r.length) for r in datasets.read_episodes(spark, path).collect()) == [(e, 4) for e in range(3)]
    assert sorted(map(tuple, datasets.read_states(spark, path).collect())) == sorted(map(tuple, rows.collect()))
    with pytest.raises(FileExistsError):
        datasets.write_dataset(rows, path, {})
    shutil.rmtree(f"{path}/data")
    assert datasets.read_states(spark, path).collect() == []
