"""Archives and video reports."""

import json

import pytest

from loomgrid.operators import signatures
from loomgrid.sources import archive, video_reports


def bag(folder, name, content):
    path = folder / name
    path.mkdir(parents=True)
    (path / "metadata.yaml").write_text(content)
    return str(path)


def test_copy_verify_move(tmp_path):
    one, two = bag(tmp_path / "c", "one", "1"), bag(tmp_path, "two", "22")
    target, manifest = str(tmp_path / "archive"), str(tmp_path / "m.json")
    done = archive.archive_recordings([(one, str(tmp_path / "c")), (two, None)], target, manifest=manifest)
    assert done["status"] == "complete" and [r["bytes"] for r in done["bags"]] == [1, 2] and json.load(open(manifest)) == done
    assert (tmp_path / "archive/c/one/metadata.yaml").read_text() == "1"
    with pytest.raises(FileExistsError):
        archive.archive_recordings([(two, None)], target)
    moved = archive.archive_recordings([(two, None)], target, move=True, verify_existing=True)
    assert moved["bags"][0]["status"] == "verified" and not (tmp_path / "two").exists()
    (tmp_path / "archive/c/one/metadata.yaml").write_text("changed")
    with pytest.raises(FileExistsError):
        archive.archive_recordings([(one, str(tmp_path / "c"))], target, verify_existing=True, manifest=manifest)
    assert json.load(open(manifest))["status"] == "failed"


def test_refusals(tmp_path):
    one = bag(tmp_path, "one", "1")
    (tmp_path / "one" / "link").symlink_to("metadata.yaml")
    with pytest.raises(ValueError):
        archive.archive_recordings([(one, None)], str(tmp_path / "a"))
    with pytest.raises(ValueError):
        archive.destinations([("/x/b", None), ("/y/b", None)], "/a")
    with pytest.raises(ValueError):
        archive.destinations([("/a/b", None)], "/a/b/c")
    with pytest.raises(ValueError, match="already"):
        archive.destinations([("/a/x/b", None)], "/a")


def test_video_report(spark):
    rows = [(0, "cam", i, [float(p + v) for p in range(64)]) for i, v in enumerate([0, 5, 5, 5, 5, 9, 12])]
    frames = spark.createDataFrame(rows, "episode_index int, feature string, frame_index bigint, sig array<double>")
    segments = spark.createDataFrame([(0, "cam", 7), (1, "cam", 5)], "episode_index int, feature string, length bigint")
    config = signatures.AnalysisConfig(max_findings=1)
    found = signatures.analyze(frames, ["episode_index", "feature"], 4, 8, config)
    report = video_reports.video_report(found, segments, "/d", 4, config)
    assert report["overall_severity"] == "FAIL" and report["deletable_episode_indices"] == [0] and report["total_frames"] == 12
    assert [c["name"] for c in report["checks"]][:3] == ["metadata and boundaries", "decode and frame counts", "frozen frames"] and len(report["checks"]) == 6
    assert "freeze_then_jump" in video_reports.report_markdown(report) and video_reports.report_lines(report)[-1] == "overall: FAIL"
