import os

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key bigint, node bigint, id string, fp bigint, part int, kind string"


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no driver tables")
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    long = " ".join(f"word{i % 997} some {i % 13}." for i in range(30_000))
    texts = [None, "", " \t\n", "a", "A", "a b\n\n\nc", "same text here", "same  text\there", long, long, "x@y.zz +1 (988) 555-2485", "é" * 50, "\u0000 nul", "1.2.3.4 4111 1111 1111 1111"]
    rows = [(i, t, "en" if i % 2 else None, None, None, 7, 7, "clash", 7, 7, "clash") for i, t in enumerate(texts)]
    rows += [(None, "a", None, None, None, 7, 7, None, 7, 7, None), (6, "same text here", "en", None, None, 7, 7, None, 7, 7, None), (None, None, None, None, None, 7, 7, None, 7, 7, None)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(nodes, links):
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
