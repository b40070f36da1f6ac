"""Reports of the signature detectors: a document, Markdown and lines for a console."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrid.operators.severity import RANKS
from loomgrid.operators.signatures import EMISSION, AnalysisConfig, check_rollup


def video_report(findings: DataFrame, segments: DataFrame, path: str, fps: float, config: AnalysisConfig, decode_error: str | None = None, features: list[str] | None = None) -> dict:
    """Checks are decided on all findings; then the first ``max_findings`` of them are listed: by file (``video_path`` of the
    segments) and place in it (``start_frame``) where segments have those, else by episode and feature; then by kind and start.

    Frames are counted over the first of ``features`` (as the metadata list them; without it the first by name). Only what is
    listed and one row a check come to the driver.
    """
    first_feature = features[0] if features else segments.agg(F.min("feature")).first()[0]
    totals = segments.agg(F.countDistinct("episode_index").alias("episodes"), F.coalesce(F.sum(F.when(F.col("feature") == F.lit(first_feature), F.col("length"))), F.lit(0)).alias("frames")).first()
    checks = [{"name": r["check"], "severity": r["severity"], "messages": [{"severity": r["severity"], "message": f"{r['n']} {'boundaries skipped' if k == 0 else 'findings'}"}]} for k, r in enumerate(check_rollup(findings, segments).collect())]
    checks.insert(1, {"name": "decode and frame counts", "severity": "FAIL" if decode_error else "PASS", "messages": [{"severity": "FAIL", "message": decode_error}] if decode_error else []})
    order = F.array_position(F.array(*map(F.lit, EMISSION)), F.col("kind"))
    if {"video_path", "start_frame"} <= set(segments.columns):
        places = segments.select("episode_index", "feature", F.col("video_path").alias("__file"), F.col("start_frame").alias("__place"))
        ordered = findings.join(places, ["episode_index", "feature"], "left").orderBy("__file", "__place", "episode_index", "feature", order, "start_frame").drop("__file", "__place")
    else:
        ordered = findings.orderBy("episode_index", "feature", order, "start_frame")
    first = ordered.limit(config.max_findings + 1).collect()
    listed = [r.asDict() | {"start_time_s": r["start_frame"] / fps, "end_time_s": r["end_frame"] / fps} for r in first[: config.max_findings]]
    if len(first) > config.max_findings:
        last = checks[-1]
        last["messages"].append({"severity": "WARN", "message": f"only the first {config.max_findings} findings are listed"})
        last["severity"] = max(last["severity"], "WARN", key=RANKS.__getitem__)
    levels = [c["severity"] for c in checks]
    return {  # fixed keys of the report
        "version": "1.0",
        "dataset_path": path,
        "total_episodes": totals["episodes"],
        "total_frames": int(totals["frames"]),
        "fps": fps,
        "overall_severity": max(levels, key=RANKS.__getitem__),
        "checks": checks,
        "summary": {level: levels.count(level) for level in RANKS},
        "findings": listed,
        "deletable_episode_indices": sorted({r["episode_index"] for r in listed if r["severity"] == "FAIL"}),
        "config": asdict(config),
    }


def report_markdown(report: dict) -> str:
    lines = ["# Video check", "", f"- Dataset: `{report['dataset_path']}`", f"- Episodes: {report['total_episodes']:,}", f"- Frames: {report['total_frames']:,}", f"- Severity: **{report['overall_severity']}**", "", "| Check | Severity | Messages |", "| --- | --- | --- |"]
    lines += [f"| {c['name']} | {c['severity']} | {'; '.join(m['message'] for m in c['messages'])} |" for c in report["checks"]]
    if report["findings"]:
        lines += ["", "| Episode | Feature | Kind | Severity | Frames | Seconds | Score | Threshold |", "| --- | --- | --- | --- | --- | --- | --- | --- |"]
        lines += [f"| {f['episode_index']} | {f['feature']} | {f['kind']} | {f['severity']} | {f['start_frame']}-{f['end_frame']} | {f['start_time_s']:.3f}-{f['end_time_s']:.3f} | {f['score']:.4f} | {f['threshold']:.4f} |" for f in report["findings"]]
    return "\n".join(lines) + "\n"


def report_lines(report: dict) -> list[str]:
    """One line a check, for a console."""
    return [f"[{c['severity']}] {c['name']}" for c in report["checks"]] + [f"overall: {report['overall_severity']}"]
