"""Frame datasets on disk, and report files."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json(spark: SparkSession, path: str) -> dict:
    """A JSON object; anything else is a ValueError."""
    row = spark.read.format("binaryFile").load(path).select(F.decode("content", "UTF-8")).first()
    try:
        value = json.loads(row[0])
    except ValueError as error:
        raise ValueError(f"{path}: {error}") from error
    if not isinstance(value, dict):
        raise ValueError(f"{path}: not an object")
    return value


def read_metadata(spark: SparkSession, root: str) -> dict:
    """``fps``, ``video_features`` and ``video_path`` of a dataset."""
    info = read_json(spark, f"{root}/meta/info.json")
    fps, features = info.get("fps"), info.get("features")
    if isinstance(fps, bool) or not isinstance(fps, int | float) or fps <= 0 or not isinstance(features, dict):
        raise ValueError(f"{root}: the metadata lack a frame rate or features")
    videos = [name for name, f in features.items() if isinstance(f, dict) and f.get("dtype") == "video"]
    return {"fps": fps, "features": features, "video_features": videos, "video_path": info.get("video_path"), "info": info}


def chosen_features(available: list[str], wanted: list[str] | None) -> list[str]:
    if unknown := sorted(set(wanted or []) - set(available)):
        raise ValueError(f"unknown video features: {', '.join(unknown)}")
    return [f for f in available if wanted is None or f in wanted]


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/meta/episodes")


def read_states(spark: SparkSession, root: str, feature: str = "observation.state") -> DataFrame | None:
    """``episode_index, frame_index, state``; None if the dataset has no such feature, no rows if it has no files."""
    meta = read_metadata(spark, root)
    if meta["features"].get(feature, {}).get("dtype", "video") == "video":
        return None
    place, fs = _filesystem(spark, f"{root}/data")
    if not (fs.exists(place) and spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/data").select("path").take(1)):
        return spark.createDataFrame([], "episode_index bigint, frame_index bigint, state array<double>")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data")
    return rows.select("episode_index", "frame_index", F.col(f"`{feature}`").alias("state")) if feature in rows.columns else None


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_dataset(frames: DataFrame, path: str, info: dict) -> None:
    """All or nothing: frames, one row an episode and metadata are written beside the target, which then gets its name in one step.

    The episode index stays a column of the frames' files, which are sorted by it. ``info`` gets the totals.
    """
    spark = frames.sparkSession
    target, fs = _filesystem(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    parent, name = os.path.split(path.rstrip("/"))
    partial = f"{parent}/.{name}.partial-{uuid.uuid4().hex}"
    staging, _ = _filesystem(spark, partial)
    try:
        frames.repartitionByRange("episode_index", "frame_index").sortWithinPartitions("episode_index", "frame_index").write.parquet(f"{partial}/data")
        written = spark.read.schema(frames.schema).parquet(f"{partial}/data")
        written.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length")).write.parquet(f"{partial}/meta/episodes")
        episodes = spark.read.parquet(f"{partial}/meta/episodes").agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        whole = info | {"total_episodes": episodes[0], "total_frames": episodes[1]}
        stream = fs.create(_filesystem(spark, f"{partial}/meta/info.json")[0])
        try:
            stream.write((json.dumps(whole, indent=2) + "\n").encode())
        finally:
            stream.close()
        if not fs.rename(staging, target):
            raise OSError(f"can't rename {partial}")
    except BaseException:
        fs.delete(staging, True)
        raise


def write_json(value: dict, path: str) -> None:
    """A document on the driver's disk, whole or not at all: two spaces, a newline at the end."""
    partial = f"{path}.{uuid.uuid4().hex}.tmp"
    try:
        with open(partial, "w") as file:
            file.write(json.dumps(value, indent=2) + "\n")
        os.replace(partial, path)
    finally:
        if os.path.exists(partial):
            os.unlink(partial)


def conversion_manifest(output: str, fps: float, policy: str, drop_on: str, episodes: list[dict], validation: dict | None = None, **more) -> dict:
    done = [e for e in episodes if e["status"] == "converted"]
    return {
        "version": "1.0",
        "output": output,
        "fps": fps,
        "policy": policy,
        "drop_on": drop_on,
        "input_episodes": len(episodes),
        "converted_episodes": len(done),
        "rejected_episodes": len(episodes) - len(done),
        "total_frames": sum(e["frames"] for e in done),
        "episodes": episodes,
        "input_validation": validation,
    } | more


def statistics_markdown(rows: list[dict]) -> str:
    """Camera statistics as a table; ``-`` where there is no median."""
    heads = ["episode", "topic", "frames in", "frames out", "held again", "repeats", "median step, ms", "oldest held, ms"]
    lines = ["| " + " | ".join(heads) + " |", "|" + " --- |" * len(heads)]
    for r in rows:
        median = r["median_source_period_ms"]
        cells = [r["episode_index"], r["topic"], r["source_frames"], r["output_frames"], r["resampled_reuses"], r["duplicate_source_transitions"], "-" if median is None else f"{median:.3f}", f"{r['max_source_age_ms']:.3f}"]
        lines.append("| " + " | ".join(map(str, cells)) + " |")
    return "\n".join(lines) + "\n"


def findings_markdown(findings: list[dict]) -> str:
    """Findings as a list, one line each with whatever a finding has beside its severity and kind."""
    lines = ["## Findings", ""] if findings else ["No findings."]
    for f in findings:
        rest = ", ".join(f"{k} {v:.3f}" if isinstance(v, float) else f"{k} {v}" for k, v in f.items() if k not in ("severity", "kind") and v is not None)
        lines.append(f"- **{f.get('severity', 'WARN')}** {f.get('kind', 'finding')}: {rest}")
    return "\n".join(lines) + "\n"


def write_report(value: dict, path: str, rows: list[dict] | None = None) -> None:
    """JSON, or Markdown if the name ends in ``.md``."""
    if path.lower().endswith(".md"):
        with open(path, "w") as file:
            file.write(f"# Report\n\nSeverity: {value.get('overall_severity', 'PASS')}\n\n{statistics_markdown(rows or [])}\n{findings_markdown(value.get('findings') or [])}")
    else:
        write_json(value, path)
