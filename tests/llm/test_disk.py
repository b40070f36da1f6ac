"""What the operators write on the way: no more than is needed, and deleted when it is read."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomgrid.llm import line_dedup, simhash
from loomgrid.llm.common import gathered

from .conftest import DATA
from .test_passages import passages_brute


def left(tables):
    return [t for t in tables if os.path.exists(t.written_path.removeprefix("file:"))]


def passages(dice):
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    shared = fresh(60)
    return [(i, " ".join([*fresh(500), *(shared if i % 2 else []), *fresh(500)])) for i in range(40)]


def test_only_windows_of_shared_fingerprints_are_written(spark, monkeypatch):
    """Texts of 1060 words of which 60 are shared: the other windows neither move nor are written."""
    written = []

    def spy(df, real=line_dedup.materialize):
        out = real(df)
        if "keys" in out.columns:
            written.append(out.selectExpr("coalesce(sum(size(keys)), 0) AS n").first().n)
        return out

    monkeypatch.setattr(line_dedup, "materialize", spy)
    rows = passages(random.Random(21))
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == passages_brute(rows, 40) and sum(n for _, n in out.values()) == 19 * 60
    assert written and max(written) <= 20 * 21 * 5  # 21 windows of a passage; runs at its ends reach beyond it


def test_windows_that_occur_once_are_not_sorted(spark, monkeypatch):
    """Those of fingerprints with several runs are counted by hash first: the least place is taken of the others only."""
    written = []

    def spy(df, real=line_dedup.materialize):
        out = real(df)
        if {"mark", "key", "doc", "at"} <= set(out.columns):
            written.append(out.groupBy("mark", "key").count().groupBy().agg(F.min("count"), F.sum("count")).first())
        return out

    monkeypatch.setattr(line_dedup, "materialize", spy)
    rows = passages(random.Random(23))
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == passages_brute(rows, 40)
    assert written[0][0] == 1 and written[-1][0] > 1 and written[-1][1] < written[0][1]


@pytest.mark.parametrize("most", [0, 1])
def test_more_shared_fingerprints_than_are_looked_up(spark, monkeypatch, most):
    monkeypatch.setattr(line_dedup, "LOOKED_UP", most)
    rows = passages(random.Random(22))
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == passages_brute(rows, 40)


def test_windows_of_runs_that_are_alike_are_not_compared(spark, monkeypatch):
    """A passage of 600 words in 20 texts: its inner runs are told by one hash each, so only windows at its ends are hashed one by one."""
    written = []

    def spy(df, real=line_dedup.materialize):
        out = real(df)
        if "keys" in out.columns:
            written.append(out.selectExpr("coalesce(sum(size(keys)), 0) AS n").first().n)
        return out

    monkeypatch.setattr(line_dedup, "materialize", spy)
    dice = random.Random(24)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    shared = fresh(600)
    rows = [(i, " ".join([*fresh(100), *shared, *fresh(100)])) for i in range(20)]
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == passages_brute(rows, 40) and sum(n for _, n in out.values()) == 19 * 600
    assert written and sum(written) < 20 * 561 / 2


@pytest.mark.parametrize("least", [0, 30, 10**6])
def test_windows_are_hashed_alike_in_any_text(spark, monkeypatch, least):
    """Run by run in long texts with few runs, all at once in short ones: equal windows of both are found."""
    monkeypatch.setattr(line_dedup, "LOOKED_UP", least)
    dice = random.Random(25)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    rows = []
    for k in range(10):
        passage = fresh(45)
        rows += [(10 * k + j, " ".join([*fresh(n), *passage, *fresh(n)])) for j, n in enumerate((600, 2, 700, 1))]
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == passages_brute(rows, 40) and sum(n for _, n in out.values()) == 30 * 45


def test_seeds_are_dealt_one_at_a_time(spark, documents, monkeypatch):
    seeds = []

    def spy(rows, *more, real=simhash.fingerprint_links):
        seeds.append({r.t for r in rows.select("t").distinct().collect()})
        return real(rows, *more)

    monkeypatch.setattr(simhash, "fingerprint_links", spy)
    with gathered() as tables:
        groups = simhash.similar_groups(documents, seeds=3)
    assert seeds == [{0}, {1}, {2}]
    assert groups.count() == documents.count()
    wide = [t for t in left(tables) if {"prefix", "text", "fps", "key"} & set(t.columns)]
    assert not wide


def test_texts_that_only_share_a_passage_do_not_move(spark, monkeypatch):
    """30 pairs of texts of 400 words that share 40, and 5 near copies: the texts of the copies move for verification; the prefixes are dealt in parts."""
    written, dealt = [], []

    def spy(df, real=simhash.materialize):
        out = real(df)
        if out.columns == ["node", "text"]:
            written.append(out.count())
        return out

    def parts(*more, real=simhash.shared_pairs):
        dealt.append(more)
        return real(*more)

    monkeypatch.setattr(simhash, "materialize", spy)
    monkeypatch.setattr(simhash, "shared_pairs", parts)
    dice = random.Random(24)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    texts = [[*shared, *fresh(360)] for shared in map(fresh, [40] * 30) for _ in range(2)]
    texts += [[*text, *fresh(40)] for text in texts[:5]]
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in simhash.similar_groups(table, seeds=3).collect()}
    assert found == {i: i if i < 60 else i - 60 for i in range(65)}
    assert sum(written) <= 20
    assert len(dealt) == simhash.PARTS > 1


def test_pipeline_deletes_what_it_has_read(spark, documents):
    with gathered() as tables:
        packed = corpus_pipeline.run(spark, DATA)
    assert len(left(tables)) == 1 and packed.count() > 0
