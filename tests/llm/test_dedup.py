"""Exact, SimHash and line de-duplication against brute force."""

import hashlib
import itertools
import random
import re

import pytest

from loomgrid.llm import components as cc
from loomgrid.llm import exact_dedup, simhash
from loomgrid.llm.common import checkpoint_root, materialize
from pyspark.sql import functions as F

from .conftest import components


def exact_brute(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        same = [j for (j, _), u in zip(rows, texts, strict=True) if u == t]
        ids = [j for j in same if j is not None]
        out.append((i, min(ids) if ids else None, len(same), hashlib.sha256(t.encode()).hexdigest()))
    return out


def key(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact(documents, odd, empty, fan_in):
    for table in (documents.repartition(5), odd):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        out = exact_dedup.exact_dedup(table, fan_in=fan_in).collect()
        found = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out]
        assert sorted(found, key=key) == sorted(exact_brute(rows), key=key)
        assert sum(r.kept for r in out) == len({r.text_sha256 for r in out})
        assert all(r.doc_id == r.keep_id for r in out if r.kept)
    assert exact_dedup.exact_dedup(empty).collect() == []
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(empty, fan_in=3)


def test_hub_rows_are_split(spark):
    """A hub's rows in the join with the written minima are dealt to several tasks."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(20_000, numPartitions=8).selectExpr("IF(id % 3 < 2, 7, id) AS a", "id AS b")
        least = materialize(rows.groupBy("a").agg(F.min("b").alias("m")))
        joined = cc.with_least(rows, least)
        assert joined.count() == 20_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shared_folder(spark):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("Conf", (), {"get": staticmethod(lambda k, d: d)}))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(type("Session", (), {"sparkContext": Context}))


def test_components(spark):
    dice = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(dice.randrange(100, 400), dice.randrange(100, 400)) for _ in range(200)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (3, 2)]
    out = {r.node: r.component for r in cc.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    proper = [(a, b) for a, b in edges if a != b]
    assert out == components({x for e in proper for x in e}, proper)
    assert cc.connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def fingerprint_brute(text, k):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [20_000, 2])
def test_simhash(documents, odd, bucket):
    for table in (documents, odd.where("doc_id IS NOT NULL")):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        marks = {i: fingerprint_brute(t, 3) for i, t in rows}
        near = [(a, b) for a, b in itertools.combinations(marks, 2) if (marks[a] ^ marks[b]).bit_count() <= 3]
        wanted = components(marks, near)
        found = simhash.simhash_groups(table, bucket=bucket).collect()
        assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted((i, f"{marks[i]:016x}", wanted[i]) for i, _ in rows)


def test_simhash_edges(spark, odd, empty):
    assert simhash.simhash_groups(odd).count() == odd.count()
    assert simhash.simhash_groups(empty).collect() == [] and simhash.similar_groups(empty).collect() == []
    # Spark's own xxhash64 is the same function
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert row & (1 << 64) - 1 == simhash.fingerprint("one two three", 3)


def test_links_within_three_bits(spark):
    dice = random.Random(1)
    base = [dice.getrandbits(64) for _ in range(40)]
    marks = set(base)
    for x in base:
        for _ in range(12):
            y = x
            for bit in dice.sample(range(64), dice.randrange(1, 6)):
                y ^= 1 << bit
            marks.add(y)
    marks = sorted(marks)
    rows = spark.createDataFrame([(i, 0, simhash.signed(m)) for i, m in enumerate(marks)], "node bigint, t int, fp bigint")
    near = [(a, b) for a, b in itertools.combinations(range(len(marks)), 2) if (marks[a] ^ marks[b]).bit_count() <= 3]
    for bucket in (20_000, 3):
        links = [(r.a, r.b) for r in simhash.fingerprint_links(rows, 3, simhash.Forest(3), bucket).collect()]
        assert components(range(len(marks)), links) == components(range(len(marks)), near)


@pytest.mark.parametrize("bucket", [20_000, 2])
def test_similar_groups(documents, odd, bucket):
    rows = {r.doc_id: r.text for r in documents.collect()}
    near = [(a, b) for a, b in itertools.combinations(rows, 2) if simhash.similarity(rows[a], rows[b], 5) >= 0.8]
    found = simhash.similar_groups(documents, bucket=bucket).collect()
    assert {r.doc_id: r.component_id for r in found} == components(rows, near) and near
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    out = simhash.similar_groups(odd, bucket=bucket).collect()
    assert len(out) == odd.count() and sum(r.kept for r in out) == len({(r.component_id) for r in out})
