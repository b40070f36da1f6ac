"""Recordings, message decoding, images, signals and streams."""

import math
import sqlite3
import struct

import numpy as np
from pyspark.sql import functions as F

from loomgrid.functions.images import area_thumbnail, to_rgb
from loomgrid.sources import recordings, synthetic
from loomgrid.streaming import live


class Writer:
    def __init__(self):
        self.data = bytearray(b"\x00\x01\x00\x00")

    def number(self, code, value):
        size = struct.calcsize(code)
        self.data += b"\0" * (-(len(self.data) - 4) % size) + struct.pack("<" + code, value)
        return self

    def text(self, value):
        raw = value.encode() + b"\0"
        self.number("I", len(raw)).data.extend(raw)
        return self


def joint_state(values):
    w = Writer().number("i", 1).number("I", 5).text("base").number("I", len(values))
    for i in range(len(values)):
        w.text(f"j{i}")
    w.number("I", len(values))
    for v in values:
        w.number("d", v)
    return bytes(w.number("I", 0).number("I", 0).data)


def test_recording(spark, tmp_path):
    bag = tmp_path / "bag"
    bag.mkdir()
    (bag / "metadata.yaml").write_text("rosbag2_bagfile_information:\n  storage_identifier: sqlite3\n")
    with sqlite3.connect(bag / "bag_0.db3") as db:
        db.execute("CREATE TABLE topics (id INTEGER, name TEXT, type TEXT)")
        db.execute("CREATE TABLE messages (id INTEGER PRIMARY KEY, topic_id INTEGER, timestamp INTEGER, data BLOB)")
        db.execute("INSERT INTO topics VALUES (1, '/r/state', 'sensor_msgs/msg/JointState')")
        db.executemany("INSERT INTO messages VALUES (?, 1, ?, ?)", [(i, 100 - i, joint_state([float(i)] * 7)) for i in range(3)])
    assert recordings.discover([], [str(tmp_path)]) == [(str(bag.resolve()), str(tmp_path.resolve()))]
    recordings.register(spark)
    rows = spark.read.format("recording").option("paths", str(bag)).load()
    topics = spark.createDataFrame([("state", 0, "r", "/r/state")], "category string, ordinal int, id string, topic string")
    out = recordings.decoded_events(rows, topics).orderBy("seq").collect()
    assert [(r.bag_stamp_ns, r.source_stamp_ns, r.vec[0]) for r in out] == [(98, 1_000_000_005, 2.0), (99, 1_000_000_005, 1.0), (100, 1_000_000_005, 0.0)]
    assert out[0].names[:2] == ["j0", "j1"]


def test_images():
    data = bytes(range(1, 13)) + b"\0"
    assert to_rgb(bytes([3, 2, 1, 9, 6, 5, 4, 9]), "BGR8", 2, 1, 4) == bytes([1, 2, 3, 4, 5, 6])
    assert to_rgb(data, "rgba8", 1, 3, 12) == bytes([1, 2, 3, 5, 6, 7, 9, 10, 11])
    assert to_rgb(b"\x05", "mono8", 1, 1, 1) == b"\x05\x05\x05"
    flat = np.full((10, 12, 3), 100, np.uint8).tobytes()
    assert np.allclose(area_thumbnail(flat, 10, 12, 4), 100, atol=1e-3)


def test_signal(spark):
    rows = synthetic.robot_messages(spark, ["a", "b"], 20.0, 0.1, [1.0] * 7, [0.5] * 7, 0.25).collect()
    assert len(rows) == 6
    for r in rows:
        entity = {"/a/state": 0, "/b/state": 1}[r.topic]
        for axis, value in enumerate(r.vec):
            assert math.isclose(value, 0.5 + math.sin(2 * math.pi * 0.25 * r.t + 0.61 * entity + 0.37 * axis), abs_tol=1e-12)


def test_sessions(spark):
    s = 1_000_000_000
    rows = spark.createDataFrame([("r", t * s) for t in range(0, 30)], "recorder string, bag_stamp_ns bigint")
    numbers = rows.select(live.session_number(F.col("bag_stamp_ns"), 5 * s, 6, 4).alias("n")).collect()
    assert [r.n for r in numbers] == [None if t < 5 or (t - 5) % 10 >= 6 else (t - 5) // 10 for t in range(30)]
    commands = spark.createDataFrame([("r", 2 * s, "start"), ("r", 4 * s, "start"), ("r", 6 * s, "stop"), ("r", 10 * s, "start"), ("r", 12 * s, "discard"), ("r", 20 * s, "start")], "recorder string, at_ns bigint, command string")
    kept = lambda **more: sorted(r.bag_stamp_ns // s for r in live.with_sessions(rows, commands, **more).collect())
    # the second start is refused, the session that is open at the end discarded unless it is to be kept
    assert kept() == [2, 3, 4, 5] and kept(keep_open=True) == [2, 3, 4, 5, *range(20, 30)]


def test_stream_counts_and_hold(spark, tmp_path):
    ms = 1_000_000
    rows = [(0, i, t, at * ms, float(i)) for i, (t, at) in enumerate([("a", 0), ("b", 50), ("a", 100), ("b", 200), ("a", 260)])]
    schema = "episode_index int, seq bigint, topic string, bag_stamp_ns bigint, value double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = live.online_hold(stream, ["a", "b"], 10).writeStream.format("memory").queryName("held").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    out = [(r.frame_index, r.tick_ns // ms, r["values"]["a"], r["values"]["b"]) for r in spark.table("held").orderBy("frame_index").collect()]
    assert out == [(0, 50, 0.0, 1.0), (1, 150, 2.0, 1.0), (2, 250, 2.0, 3.0)]
    live.record(stream, str(tmp_path / "out"), str(tmp_path / "c2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
