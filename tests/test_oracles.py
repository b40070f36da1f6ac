"""Each catalogue query against its SQL over the smallest driver tables."""

import os

import duckdb
import pytest

from loomgrid.plans import queries as catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    found = catalogue.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    rows = [tuple(r) for r in found.select(*columns).collect()]
    result = db.execute(catalogue.oracle_sql()[name])
    places = [[d[0] for d in result.description].index(c) for c in columns]
    assert len(places) == len(result.description)
    wanted = [tuple(r[i] for i in places) for r in result.fetchall()]
    key = lambda r: tuple(map(str, r))
    assert sorted(rows, key=key) == sorted(wanted, key=key)


def test_repeated_motion_equals_loop(spark):
    from loomgrid.operators import signatures

    frames = catalogue.stepped(spark, DATA)
    keys = ["user_id"]
    candidates = signatures.repeat_candidates(frames, signatures.frame_scores(frames, keys), keys, 4, catalogue.STEPPED)
    rows = sorted((r.user_id, r.terminal, r.period, r.start, r.end) for r in candidates.collect())
    wanted, spans = [], {}
    for user, terminal, period, start, end in rows:
        own = spans.setdefault((user, terminal), [])
        if not any(a <= start <= b or start <= a <= end for a, b in own):
            own.append((start, end))
            wanted.append((user, start, end, period))
    found = catalogue.repeated_motion(spark, DATA).collect()
    assert sorted((r.user_id, r.start_frame, r.end_frame, r.period) for r in found) == sorted(wanted) and wanted


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
