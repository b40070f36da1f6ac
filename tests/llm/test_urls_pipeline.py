"""URL filters, the registered queries and the pipeline."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomgrid.llm import queries, simhash, url_filter

from .conftest import DATA, components
from .test_passages import passages_brute
from .test_text_models import check_packing, spans_brute

RULES = queries.RULES


def judge(spark, pages, edges=()):
    table = spark.createDataFrame(pages, "page_id bigint, url string, host string, node bigint")
    links = spark.createDataFrame(list(edges), "source string, target string")
    return {r.page_id: r for r in url_filter.judge_urls(table, RULES, links).collect()}


def test_rules(spark):
    urls = ["http://a.EXAMPLE.net/en/1?q#f", "http://example.net/de/", "HTTP://x.com://y", "no scheme", None, "", "http://example.com/de/x", "https://www.example.com/fr/", "http://b.org/fr/x", "http://net", "http://net/", "http://badexample.com/de/", "http://x.net?a=/en/", "http://u:p@h.com:80/p"]
    out = judge(spark, [(i, u, "clash", 1) for i, u in enumerate(urls)])
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(len(urls))] == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/de/", "net/", "block"),
        ("x.com:", "//y", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("example.com", "/de/x", "example.com/de/", "block"),
        ("www.example.com", "/fr/", None, "allow"),
        ("b.org", "/fr/x", "org/fr/", "allow"),
        ("net", "", None, "allow"),
        ("net", "/", "net/", "block"),
        ("badexample.com", "/de/", None, "allow"),
        ("x.net", "", None, "allow"),
        ("u:p@h.com:80", "/p", None, "allow"),
    ]


def test_many_rules(spark):
    """The joins of a large table of rules against the expression."""
    dice = random.Random(8)
    word = lambda: dice.choice(["a", "b", "net", "org", "x-y"])
    path = lambda n: "".join("/" + word() for _ in range(dice.randrange(n))) + dice.choice(["", "/"])
    rules = list({".".join(word() for _ in range(dice.randrange(1, 4))) + path(3): dice.choice(["allow", "block"]) for _ in range(150)}.items())
    rows = [(i, f"http://{'.'.join(word() for _ in range(dice.randrange(1, 5)))}{path(5)}") for i in range(2000)] + [(5000, None), (5001, "no"), (5002, "http:///a")]
    table = spark.createDataFrame(rows, "page_id bigint, url string")
    named = table.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    found = {r.page_id: r.own for r in url_filter.with_rules(named, rules, most=10).collect()}
    wanted = {r.page_id: r.own for r in url_filter.with_rules(named, rules).collect()}
    assert found == wanted and len(found) == len(rows) and any(found.values()) and not all(found.values())


@pytest.mark.parametrize(("path", "wanted"), [("/a/../b", "/b"), ("/a/./b/..", "/a/"), ("/../..", "/"), ("/a/b/../../c?x=/../y", "/c?x=/../y"), ("/a..b/.c", "/a..b/.c"), ("/.", "/"), ("/a//../b", "/a/b"), ("/", "/"), ("", "")])
def test_dot_segments(spark, path, wanted):
    assert spark.createDataFrame([(path,)], "p string").select(url_filter.without_dots(F.col("p"))).first()[0] == wanted


def test_aliases(spark):
    pages = [(1, "http://a.com/1", "", 1), (2, "https://a.com/1#x", "", 1), (3, "http://b.com/", "", 1), (4, "http://c.com/", "", 1), (5, "http://d.org/fr/1", "", 1), (6, "http://e.com/", "", 1), (7, "http://spam.net/", "", 1), (8, "http://f.com/", "", 1), (8, "http://f.com/", "", 1)]
    edges = [("http://a.com/1", "http://b.com"), ("http://b.com/", "http://unseen.net/x"), ("http://c.com/", "http://d.org/fr/1"), ("http://e.com/", "http://d.org/fr/1"), ("http://e.com/", "http://spam.net/"), ("http://a.com/1", "http://a.com/1")]
    out = judge(spark, pages, edges)
    assert {i: (r.verdict, r.propagated) for i, r in out.items()} == {1: ("block", True), 2: ("block", True), 3: ("block", True), 4: ("allow", True), 5: ("allow", False), 6: ("allow", True), 7: ("block", False), 8: ("allow", False)}


def test_link_edges(spark):
    html = [
        """<head><LINK href='/x?a=1&amp;b=2' rel="Canonical"><meta http-equiv=refresh content="0; URL='http://other.org/'"></head>""",
        """<link rel=canonical href=page.html><link rel="stylesheet canonicals" href="/no">""",
        "<link rel='canonical' href='//cdn.com/y'><link rel=canonical href='#top'><link rel=canonical href='mailto:x'>",
        "canonical refresh <p>",
        None,
    ]
    rows = [(i, f"https://h.com/dir/p{i}", h) for i, h in enumerate(html)] + [(9, None, html[0])]
    found = url_filter.link_edges(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {(r.source[-1], r.target) for r in found} == {("0", "http://h.com/x?a=1&b=2"), ("0", "http://other.org/"), ("1", "http://h.com/dir/page.html"), ("2", "http://cdn.com/y")}


def test_sql_follows_links(spark, tmp_path):
    canon = lambda t: f'<head><link rel="canonical" href="{t}"></head>'
    rows = [
        (1, "http://a.com/1", canon("http://b.com")),
        (2, "https://a.com/1#x", "<p>"),
        (3, "http://b.com/", "<meta http-equiv='Refresh' content='0;url=http://unseen.net/x'>"),
        (4, "http://c.com/x/y", canon("../z")),
        (5, "http://d.org/fr/1", canon("http://c.com/x/y")),
        (6, "http://e.net/a", canon("/b")),
        (7, "http://e.net/b", None),
        (8, None, canon("/q")),
        (9, "http://f.com", canon("")),
        (10, "http://g.com/p?x=1", canon("/p?x=1&amp;y=2")),
        (11, "http://g.com/p?x=1&y=2", canon("http://block.net/")),
        (12, "http://c.com/z", canon("http://h.net/")),  # row 4 links here
        (13, "http://i.com/a/./b/../c", "<!-- " + canon("http://h.net/") + " -->"),
        (14, "http://i.com/q/", canon("../a/c?x=../y")),
        (15, "http://i.com/a/c?x=../y", canon("http://spam.net/1/..")),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    result = db.execute(queries.oracle_sql()["op1_url_filter"])
    columns = [d[0] for d in result.description]
    found = queries.op1_url_filter(spark, str(tmp_path))
    key = lambda r: tuple(map(str, r))
    wanted = sorted(result.fetchall(), key=key)
    assert sorted(map(tuple, found.select(*columns).collect()), key=key) == wanted
    assert sum(r[columns.index("propagated")] for r in wanted) >= 5


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, documents, name):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = queries.queries()[name](spark, DATA)
    result = db.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.select(*columns).collect()), key=key) == sorted(result.fetchall(), key=key)


def test_query_columns(spark, documents):
    wanted = {
        "op1_url_filter": "page_id host path rule verdict",
        "op2_exact_dedup": "doc_id keep_id group_size kept text_sha256",
        "op3_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op4_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op5_simhash": "doc_id fingerprint component_id",
        "op6_language_id": "doc_id held_out lang_pred score",
        "op7_line_dedup": "doc_id text",
        "op8_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op9_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op10_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    }
    for name, f in queries.queries().items():
        assert set(wanted[name].split()) <= set(f(spark, DATA).columns), name


def test_pipeline(spark, documents, tmp_path):
    """Each stage against a plain version of it, on what the stage before it kept."""
    docs, after = documents, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, DATA).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == corpus_pipeline.COLUMNS and after.where("n_chars <> length(text)").count() == 0
        before, now = ({r.doc_id: r.text for r in table.collect()} for table in (docs, after))
        if name == "language_id":
            assert len(now) >= 0.99 * len(before) and all(before[i] == t for i, t in now.items())
        elif name == "line_dedup":
            wanted = passages_brute(before.items(), 40)
            assert now == {i: t for i, (t, n) in wanted.items() if t.strip() or not n} and any(n for _, n in wanted.values())
        elif name == "simhash":
            near = [(a, b) for a, b in itertools.combinations(before, 2) if simhash.similarity(before[a], before[b], 5) >= 0.8]
            assert now == {i: before[i] for i, c in components(before, near).items() if i == c}
        else:
            assert now.keys() == before.keys() and not any(spans_brute(t) for t in now.values())
            assert all(now[i] == t for i, t in before.items() if not any(c.isdigit() or c == "@" for c in t))
        docs = after
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    padding, _ = check_packing(rows, corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect())
    assert padding == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()} == {i for i, _ in rows}


def test_pipeline_on_odd_rows(spark, odd, empty):
    for table in (odd, empty):
        docs = table
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            docs = stage(spark, docs, DATA)
            assert docs.columns == corpus_pipeline.COLUMNS
        corpus_pipeline.pack(spark, docs, DATA).collect()
