"""Groups of near copies that SimHash candidates alone miss."""

import itertools
import random

import numpy as np
import pyarrow as pa

from loomgrid.llm import simhash

from .conftest import components


def brute(rows):
    sets = {i: simhash.shingles(t, 5) for i, t in rows.items()}
    return components(rows, [(a, b) for a, b in itertools.combinations(rows, 2) if (sets[a] or sets[b]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])


def check(spark, rows):
    table = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").repartition(4)
    found = simhash.similar_groups(table, seeds=3).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows)


def test_blocks(spark):
    """Texts appended and tails cut, at similarities of 0.8 and more."""
    dice, rows = random.Random(11), {}
    for i in range(150):
        words = [f"w{dice.randrange(3000)}" for _ in range(dice.randrange(60, 300))]
        more = int(len(words) * dice.uniform(0.1, 0.24))
        rows[10 * i] = " ".join(words)
        rows[10 * i + 1] = " ".join(words + [f"v{dice.randrange(3000)}" for _ in range(more)])
        rows[10 * i + 2] = " ".join(words[: len(words) - int(len(words) * dice.uniform(0.1, 0.2))])
    check(spark, rows)


def test_large_group(spark):
    """Several hundred copies of one text with single-word edits, of which many are below 0.8 of their hub."""
    dice = random.Random(12)
    words, rows = [f"w{dice.randrange(3000)}" for _ in range(200)], {}
    for i in range(400):
        copy = list(words)
        for _ in range(dice.randrange(2, 8)):
            copy[dice.randrange(len(copy))] = f"v{dice.randrange(10**6)}"
        rows[i] = " ".join(copy)
    check(spark, rows)


def test_shared_pairs_by_chunks():
    keys = np.array([1, 1, 1, 2, 2, 3, 3, 3, 3])
    labels = np.array([0, 0, 1, 2, 2, 4, 5, 6, 6])
    nodes = np.arange(9)
    size, place, bits = np.full(9, 10, np.int32), np.zeros(9, np.int32), np.zeros(9, np.int64)
    wanted = {(0, 2), (1, 2), (5, 6), (5, 7), (5, 8), (6, 7), (6, 8)}

    def found(chunk, size, bits):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[at : at + 4]) for c in (keys, size, labels, nodes, place, bits)], list("kslnpb")) for at in (0, 4, 8)]
        return sorted(tuple(p.values()) for b in simhash.shared_pairs(0.8, chunk)(iter(batches)) for p in b.to_pylist())

    for chunk in (1, 3, 1000):
        assert found(chunk, size, bits) == sorted(wanted)
    # 20 shingles may differ by two at most; 10 and 13 are too different
    assert found(1000, size, np.array([0, 0, 7, 0, 0, 0, 3, 7, 0])) == [(5, 6), (5, 8), (6, 7), (6, 8)]
    assert found(1000, np.array([10, 10, 13, 5, 5, 8, 10, 10, 13], np.int32), bits) == [(5, 6), (5, 7), (6, 7)]


def test_parity_bounds_the_difference():
    dice = np.random.default_rng(4)
    for _ in range(300):
        a = dice.integers(-(1 << 63), 1 << 63, dice.integers(1, 80))
        b = np.concatenate([a[dice.random(len(a)) < 0.9], dice.integers(-(1 << 63), 1 << 63, dice.integers(0, 9))])
        bits = (simhash.parity(a) ^ simhash.parity(b)) & (1 << 64) - 1
        assert bits.bit_count() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_sketches_bound_the_difference():
    """Of sets of any two sizes, by at least as many bits as 64 give, and close for sets that share little."""
    dice = np.random.default_rng(5)
    for _ in range(300):
        a = dice.integers(-(1 << 63), 1 << 63, dice.integers(0, 900))
        b = np.concatenate([a[dice.random(len(a)) < dice.random()], dice.integers(-(1 << 63), 1 << 63, dice.integers(0, 900))])
        left, right = simhash.sketch(a), simhash.sketch(b)
        assert simhash.apart(left, right) == simhash.apart(right, left) <= len(set(a.tolist()) ^ set(b.tolist()))
    a, b = (dice.integers(-(1 << 63), 1 << 63, 700) for _ in range(2))
    assert simhash.apart(simhash.sketch(a), simhash.sketch(a)) == 0 and 350 < simhash.apart(simhash.sketch(a), simhash.sketch(b)) <= 1400
    assert len(simhash.sketch(a)) == 128 and len(simhash.sketch(a[:0])) == 8


def test_dense_clusters(spark):
    """Clusters whose members share a key by the hundred, many of them below 0.8 of the member they are linked to first."""
    dice, rows = random.Random(13), {}
    for c, changes in enumerate((3, 4, 6, 8)):
        words = [f"w{dice.randrange(10**6)}" for _ in range(200)]
        for i in range(150):
            copy = list(words)
            for k in dice.sample(range(200), changes):
                copy[k] = f"v{dice.randrange(10**9)}"
            rows[1000 * c + i] = " ".join(copy)
    check(spark, rows)
    table = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string").repartition(4)
    dealt_again = simhash.similar_groups(table, seeds=3, bucket=20).collect()
    assert {r.doc_id: r.component_id for r in dealt_again} == brute(rows)
