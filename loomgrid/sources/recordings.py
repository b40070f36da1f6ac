"""Recordings: discovery, a data source for SQLite recordings, and message decoding.

A recording is a folder with ``metadata.yaml`` and storage files. The ``recording`` data source reads those with
``sqlite3`` storage, one partition per file; the payloads stay binary (``decode_vectors`` and
``functions.images`` take them apart).
"""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "episode_index int, seq bigint, topic string, type string, bag_stamp_ns bigint, payload binary"


def is_recording(path: Path) -> bool:
    return path.is_dir() and (path / "metadata.yaml").is_file()


def discover(explicit: list[str], folders: list[str], recursive: bool = False) -> list[tuple[str, str | None]]:
    """``(path, collection)`` of recordings: explicit ones first, then those of each folder in order; each path once."""
    found: dict[str, str | None] = {}
    for item in explicit:
        path = Path(item).resolve()
        if not is_recording(path):
            raise ValueError(f"not a recording: {item}")
        found.setdefault(str(path), None)
    for item in folders:
        root = Path(item).resolve()
        if is_recording(root):
            inside = [root]
        elif recursive:
            inside = sorted(p.parent for p in root.rglob("metadata.yaml"))
        else:
            inside = sorted(p for p in root.iterdir() if is_recording(p)) if root.is_dir() else []
        if not inside:
            raise ValueError(f"no recording in {item}")
        for path in inside:
            found.setdefault(str(path), str(root))
    if not found:
        raise ValueError("no recordings")
    return list(found.items())


def storage_of(path: str) -> str:
    """The storage named by a recording's metadata."""
    import yaml

    with open(os.path.join(path, "metadata.yaml")) as file:
        document = yaml.safe_load(file)
    info = document.get("rosbag2_bagfile_information") if isinstance(document, dict) else None
    storage = info.get("storage_identifier") if isinstance(info, dict) else None
    if not isinstance(storage, str) or not storage.strip():
        raise ValueError(f"{path}: the metadata name no storage")
    return storage.strip()


class RecordingReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]

    def partitions(self) -> list[InputPartition]:
        parts = []
        for index, path in enumerate(self.paths):
            if (storage := storage_of(path)) != "sqlite3":
                raise ValueError(f"{path}: storage {storage!r} isn't supported")
            files = sorted(str(p) for p in Path(path).glob("*.db3"))
            parts += [InputPartition((index, number, file)) for number, file in enumerate(files)]
        return parts or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        index, number, file = partition.value
        with sqlite3.connect(f"file:{file}?mode=ro", uri=True) as db:
            query = "SELECT m.id, t.name, t.type, m.timestamp, m.data FROM messages m JOIN topics t ON m.topic_id = t.id ORDER BY m.timestamp, m.id"
            for k, (_, topic, kind, stamp, data) in enumerate(db.execute(query)):
                yield index, (number << 40) + k, topic, kind, stamp, data


class RecordingSource(DataSource):
    """``spark.read.format("recording").option("paths", "a,b")`` after ``register(spark)``."""

    @classmethod
    def name(cls) -> str:
        return "recording"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RecordingReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordingSource)


class Cdr:
    """A reader of CDR-encoded messages: a four-byte header, then aligned little- or big-endian values."""

    def __init__(self, data: bytes) -> None:
        if len(data) < 4:
            raise ValueError("a message is too short")
        self.data, self.at, self.order = data, 4, "<" if data[1] & 1 else ">"

    def number(self, code: str) -> float:
        size = struct.calcsize(code)
        self.at += -(self.at - 4) % size
        (value,) = struct.unpack_from(self.order + code, self.data, self.at)
        self.at += size
        return value

    def text(self) -> str:
        n = int(self.number("I"))
        value = self.data[self.at : self.at + max(n - 1, 0)].decode()
        self.at += n
        return value

    def numbers(self, code: str) -> list[float]:
        return [self.number(code) for _ in range(int(self.number("I")))]

    def blob(self) -> bytes:
        n = int(self.number("I"))
        value = self.data[self.at : self.at + n]
        self.at += n
        return value

    def header(self) -> int:
        seconds, nanos = int(self.number("i")), int(self.number("I"))
        self.text()
        return seconds * 1_000_000_000 + nanos


def decode(kind: str, data: bytes) -> dict:
    """A message's fields by its type: arrays of doubles, joint states, images."""
    cdr, name = Cdr(data), kind.rpartition("/")[2]
    if name == "Float64MultiArray":
        for _ in range(int(cdr.number("I"))):  # the layout's dimensions
            cdr.text()
            cdr.number("I")
            cdr.number("I")
        cdr.number("I")
        return {"vec": cdr.numbers("d")}
    if name == "JointState":
        stamp = cdr.header()
        names = [cdr.text() for _ in range(int(cdr.number("I")))]
        return {"source_stamp_ns": stamp, "names": names, "vec": cdr.numbers("d")}
    if name == "Image":
        stamp, height, width = cdr.header(), int(cdr.number("I")), int(cdr.number("I"))
        encoding, _, step = cdr.text(), cdr.number("B"), int(cdr.number("I"))
        return {"source_stamp_ns": stamp, "height": height, "width": width, "encoding": encoding, "step": step, "image": cdr.blob()}
    raise ValueError(f"unsupported message type {kind!r}")


DECODED = (
    T.StructType()
    .add("source_stamp_ns", T.LongType())
    .add("vec", T.ArrayType(T.FloatType()))
    .add("names", T.ArrayType(T.StringType()))
    .add("image", T.BinaryType())
    .add("height", T.IntegerType())
    .add("width", T.IntegerType())
    .add("encoding", T.StringType())
    .add("step", T.IntegerType())
)


@F.pandas_udf(DECODED)
def decoded(kinds: pd.Series, payloads: pd.Series) -> pd.DataFrame:
    rows = [decode(k, bytes(p)) for k, p in zip(kinds, payloads, strict=True)]
    whole = {"source_stamp_ns": "Int64", "height": "Int32", "width": "Int32", "step": "Int32"}
    return pd.DataFrame({f: pd.Series([r.get(f) for r in rows], dtype=whole.get(f, "object")) for f in DECODED.names})


def decoded_events(messages: DataFrame, topics: DataFrame) -> DataFrame:
    """Messages of the required topics (``topics(category, ordinal, id, topic)``), decoded, with
    fingerprints of images."""
    from loomgrid.functions.images import pixel_fingerprint, rgb_pixels

    rows = messages.join(topics, "topic").withColumn("d", decoded("type", "payload"))
    is_image: Column = F.col("d.image").isNotNull()
    pixels = rgb_pixels(F.col("d.image"), F.col("d.encoding"), F.col("d.height"), F.col("d.width"), F.col("d.step"))
    rows = rows.select("episode_index", "seq", "topic", "category", "bag_stamp_ns", F.col("d.source_stamp_ns").alias("source_stamp_ns"), F.col("d.vec").alias("vec"), F.col("d.names").alias("names"), F.col("d.height").alias("height"), F.col("d.width").alias("width"), "d")
    images = rows.where(is_image).withColumn("image", pixels).withColumn("fingerprint", pixel_fingerprint(F.col("image")))
    others = rows.where(~is_image).withColumns({"image": F.lit(None).cast("binary"), "fingerprint": F.lit(None).cast("string")})
    return images.unionByName(others).drop("d")
