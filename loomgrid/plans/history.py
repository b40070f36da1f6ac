"""Lineage: dataset identities and an append-only log."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "run_id string, timestamp_utc string, operation string, dataset string, result string, config string, config_source string, details string"


def dataset_identity(spark: SparkSession, path: str) -> dict:
    """Path, state of the metadata, its digest, and the totals that it names."""
    out = {"path": path, "metadata_status": "missing"}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/meta/info.json")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return out
    row = spark.read.format("binaryFile").load(f"{path}/meta/info.json").select(F.sha2("content", 256), F.decode("content", "UTF-8")).first()
    out["info_sha256"] = row[0]
    try:
        info = json.loads(row[1])
        assert isinstance(info, dict)
    except (ValueError, AssertionError):
        return out | {"metadata_status": "invalid"}
    return out | {"metadata_status": "available"} | {k: info.get(k) for k in ("codebase_version", "total_episodes", "total_frames", "fps")}


def history_entry(operation: str, dataset: dict, result: dict, config: dict | None = None, config_source: dict | None = None, details: dict | None = None) -> tuple:
    text = lambda x: None if x is None else json.dumps(x, sort_keys=True)
    return (str(uuid.uuid4()), datetime.now(timezone.utc).isoformat(), operation, text(dataset), text(result), text(config), text(config_source), text(details))


def append_history(spark: SparkSession, path: str, entries: list[tuple]) -> None:
    """Entries are added to the log's files; earlier ones are never rewritten."""
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("append").json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTRY).json(path)
