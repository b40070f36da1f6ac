"""Repeated passages at any word, against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from loomgrid.llm import line_dedup

SPACE = re.compile(r"(?<=[ \t\n\r\x0b\x0c])(?![ \t\n\r\x0b\x0c])|(?<=[一-鿿])(?![ \t\n\r\x0b\x0c])|(?<!^)(?=[一-鿿])")


def passages_brute(rows, min_words):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        pieces = SPACE.split(text or "")
        lead = int(not pieces[0].strip())
        words = [p.strip() for p in pieces[lead:]]
        gone = set()
        for at in range(len(words) - min_words + 1):
            key = tuple(words[at : at + min_words])
            if key in seen:
                gone.update(range(lead + at, lead + at + min_words))
            seen.add(key)
        out[i] = None if text is None else ("".join(p for k, p in enumerate(pieces) if k not in gone), len(gone))
    return out


@pytest.mark.parametrize("min_words", [5, 40])
def test_passages(spark, documents, min_words):
    dice = random.Random(5)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for k, n in enumerate((39, 40, 51, 60, 100)):  # pasted inside sentences that have no ends of lines
        passage = fresh(n)
        rows += [(10_000 + 10 * k + j, " ".join([*fresh(20 + j), *passage, *fresh(7 * j)])) for j in range(3)]
    tabs, han = fresh(60), "".join(chr(0x4E00 + dice.randrange(5000)) for _ in range(60))
    rows += [(11_000, "x " + "\t".join(tabs)), (11_001, " \n" + "\n\n".join(tabs) + " y"), (11_002, "a" + han), (11_003, han + "。b")]
    rows += [(11_010, " ".join(fresh(10) * 6)), (11_011, None), (11_012, ""), (11_013, " \t"), (11_014, "c " * 90)]
    out = line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), min_words=min_words).collect()
    assert len(out) == len(rows)
    wanted = passages_brute(rows, min_words)
    for r in out:
        assert (None if r.text is None else (r.text, r.n_removed)) == wanted[r.doc_id], r.doc_id
    if min_words == 40:
        gone = {r.doc_id: r.n_removed for r in out}
        assert [gone[10_001 + 10 * k] for k in range(5)] == [0, 40, 51, 60, 100] and gone[11_001] == 60 and gone[11_003] == 60


def test_passages_edges(spark, odd, empty):
    out = line_dedup.dedup_passages(odd)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "n_removed", "removed"]
    assert line_dedup.dedup_passages(empty).collect() == []
    text = " ".join(map(str, range(50)))
    twice = spark.createDataFrame([(1, text), (1, text), (None, "x " + text), (None, "x " + text)], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in line_dedup.dedup_passages(twice).collect()) == [(0, 0), (0, 0), (1, 50), (1, 50)]


def test_very_long_texts(spark):
    """Two texts of 64,000 lines that are alike but for an edit and what is before it; one text that repeats itself throughout."""
    dice = random.Random(6)
    lines = [" ".join(f"w{dice.randrange(10**6)}" for _ in range(5)) for _ in range(64_000)]
    other = ["one more line", *lines]
    other[32_000] = "something else altogether"
    rows = [(1, "\n".join(lines)), (2, "\n".join(other)), (3, "again and again " * 20_000)]
    out = {r.doc_id: r for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "one more line\nsomething else altogether\n"
    assert out[2].n_removed == 63_999 * 5 and out[3].text.split() == ["again", "and", "again"] and out[3].n_removed == 59_997


def test_one_common_passage(spark):
    """A passage in very many texts, each with other words around it, and copies of one text."""
    dice = random.Random(7)
    fresh = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    passage, text = fresh(60), " ".join(fresh(100))
    rows = [(i, " ".join([*fresh(30), *passage, *fresh(30)])) for i in range(500)] + [(i, text) for i in range(500, 900)]
    out = {r.doc_id: r.n_removed for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()}
    assert out == {i: 0 if i in (0, 500) else 60 if i < 500 else 100 for i in range(900)}


def test_clashing_names(spark):
    rows = [(i, f"x{i} " + " ".join(map(str, range(50))), 1, 2, 3, 4, 5) for i in range(2)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, row int, doc int, some int, runs int, `a.b` int")
    out = sorted(line_dedup.dedup_passages(table).collect())
    assert [tuple(r) for r in out] == [(*rows[0], 0, ""), (1, "x1 ", 1, 2, 3, 4, 5, 50, "1-50")]


def test_least_lines_of_all_windows(spark):
    """The least line of every window stays, also where no word of a window is in the lowest quarter and where words repeat; of fresh
    words few others stay."""
    dice = random.Random(8)
    texts = [" ".join(f"w{dice.randrange(10**9)}" for _ in range(n)) for n in (40, 41, 75, 3000)]
    texts += [" ".join(f"w{dice.randrange(3)}" for _ in range(300)), "one " * 100, " ".join(f"w{k}" for k in range(50)) + " same" * 90]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    number = "(xxhash64(w) & -2147483648L) | i"
    for r in frame.selectExpr("i", f"transform(split(trim(text), ' '), (w, i) -> {number}) AS all").join(
        frame.select("i", line_dedup._winnowed(F.col("text"), 40, 8, lambda w, m: m).alias("least")), "i"
    ).collect():
        lines = r["all"][: len(r["all"]) - 7]
        wanted = {min(lines[s : s + 33]) for s in range(len(lines) - 32)}
        assert wanted <= set(r.least) and r.least == [x for x in lines if x in set(r.least)]
        assert r.i > 3 or len(r.least) <= 1.3 * len(wanted) + 3


def test_pieces_without_patterns(spark):
    """Pieces and words are cut as by the patterns, also of texts with any white space, or with the character that stands for a cut."""
    dice = random.Random(9)
    texts = ["".join(dice.choice(" \t\n\r\x0b\x0cab\u00e9\u00a0") for _ in range(n)) for n in range(60)] + ["a\x01 b \x01c", "\x01", "", " ", "a", None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in frame.select("text", line_dedup.pieces(F.col("text")).alias("p"), F.split("text", line_dedup.SPACE_END).alias("q"), line_dedup.words(F.col("text")).alias("w")).collect():
        assert r.p == r.q and r.w == (None if r.text is None else [x for x in re.split(r"[ \t\n\r\x0b\x0c]+", r.text) if x])


def test_stretches_without_low_words(spark):
    """Long texts of few words, so that many windows have no word of the lowest hashes."""
    dice = random.Random(10)
    some = lambda k, n: [f"v{k}{dice.randrange(4)}" for _ in range(n)]
    part = [w for k in range(12) for w in some(k, 120)]
    rows = [(1, " ".join(part)), (2, " ".join([*some("x", 90), *part[300:700], *some("y", 200)])), (3, " ".join(some("z", 3000)))]
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert out == passages_brute(rows, 40) and out[2][1] >= 400
