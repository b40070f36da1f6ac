"""Removal of repeated passages by winnowing over line hashes, in DataFrame operations only.

Passages are pasted anywhere, also into the middle of a physical line, so the lines that are hashed are the ``gram`` words from
each word on: they are cut alike wherever they stand. From every word starts a window of ``min_words`` words; that of
its lines whose first word has the least hash is its fingerprint. Two equal windows have the same fingerprint, so nothing of that length is missed, and as
windows beside each other mostly share theirs, few are selected: about two in ``min_words - gram + 2`` words.

The fingerprints are the join keys. Those that occur at one place only, as nearly all do, are settled by a count, and so are the
texts that have no other: they pass through. The windows around a place that have it as their fingerprint are a run, whose words are
hashed along with the fingerprint: runs are first compared whole; only where a fingerprint has several different runs are the
texts read again, and the windows of the first of each kind compared one by one, so an occurrence is held against all
earlier ones, not only against the first. Windows that also occur earlier are united to runs of words, which are deleted.

What moves: the fingerprints with their runs, and the texts twice, for those windows and for the result. Every join by a fingerprint
or window is against a written table of one row a key, so Spark can split the rows of a frequent one; that table is hashed, so the
other side needs no sort.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrid.llm.common import SPACE_CLASS, drop_shuffles, materialize, release

BLANKS = " \t\n\r\x0b\x0c"
#: Put where words end, so that a split needs no pattern; texts that have it are split by one.
CUT = "\x01"
#: Scripts that don't part words: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han.
ALONE = r"[฀-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}]"
#: Texts without such scripts whose only white space are spaces and line feeds, and without the character above: most need nothing else.
PLAIN = r"\A[\n\x0E-\u0DFF]*\z"
#: Texts that have nothing beyond the first of those scripts, found at less cost.
LOW = r"^[\x00-\u0DFF]*+\z"
#: Where words end: before what follows white space, and on both sides of each character of those scripts.
SPACE_END = r"(?<=[\x20\x09-\x0D])(?![\x20\x09-\x0D])"
WORD_END = rf"{SPACE_END}|(?<={ALONE})(?![\x20\x09-\x0D])|(?={ALONE})"
#: Low bits of a word's number that are its place: more than an array can have.
PLACE_BITS = 31
#: Hashes below this are about a seventh of all; its place bits are zero, so numbers compare with it as their hashes do.
LOW_SEVENTH = (-(1 << 63) + (1 << 64) // 7) >> PLACE_BITS << PLACE_BITS
#: After so many, what stays is about a tenth more than the least of the windows.
PASSES = 5
#: Neighbours that are tried for a lesser one before all that a window may have.
NEAR = 4
#: Words a run from which on lines are hashed run by run, not all of a text.
LOOKED_UP = 30


def _doc(id_column: str, text_column: str) -> Column:
    """A document's place in the corpus: by identifier, null ones first. Rows that repeat both identifier and
    text are one document."""
    return F.struct(F.col(f"`{id_column}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))).alias("content"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _alone(text: Column) -> Column:
    return (F.octet_length(text) > F.length(text)) & ~text.rlike(LOW) & text.rlike(ALONE)


def pieces(text: Column) -> Column:
    """A text's words, each with the white space after it; what is blank before the first is a piece too."""

    def ended(blanks: str) -> Column:
        each = functools.reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(blank + CUT)), blanks, text)
        return F.split(functools.reduce(lambda t, blank: F.replace(t, F.lit(CUT + blank), F.lit(blank)), blanks, each), CUT)

    other = F.when(_alone(text), F.split(text, WORD_END)).when(F.contains(text, F.lit(CUT)), F.split(text, SPACE_END))
    return F.when(text.rlike(PLAIN), ended(" \n")).otherwise(other.otherwise(ended(BLANKS)))


def lead(text: Column) -> Column:
    """How many pieces at the beginning are blank."""
    return F.when(F.instr(F.lit(BLANKS), F.substring(text, 1, 1)) > 0, 1).otherwise(0)


def words(text: Column) -> Column:
    """A text's words without white space. The costly expression is only for texts with the scripts that need it; a split at one
    plain character needs no pattern."""
    cut = F.filter(F.transform(F.split(text, WORD_END), lambda x: F.rtrim(x, F.lit(BLANKS))), lambda x: x != "")

    def spaced(blanks: str) -> Column:
        return F.array_remove(F.split(functools.reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(" ")), blanks, text), " "), "")

    return F.when(text.rlike(PLAIN), spaced("\n")).when(_alone(text), cut).otherwise(spaced(BLANKS[1:]))


def _place(number: Column) -> Column:
    return number.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _number(word: Column, at: Column) -> Column:
    """The hash of a line's first word above its place, so of equal words the first is less."""
    return F.xxhash64(word).bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(at.cast("bigint"))


def _least(w: Column, count: Column, lines: int) -> Column:
    """Of the ``count`` lines of a text's words, in order of place, the numbers of those that are the least of ``lines`` in a row, and
    few others.

    One that stands between two lesser ones (or the ends) that leave no room for a window is the least of none, and every window's least stays.
    The passes begin with the lowest seventh, and with all lines of the stretches where some window has none of it."""
    last = lambda c: F.coalesce(_place(F.get(c, F.size(c) - 1)), F.lit(-1))
    before = lambda c, i: F.coalesce(_place(F.get(c, i - 1)), F.lit(-1))
    stretch = lambda begin, end: F.transform(F.sequence(begin, end), lambda at: _number(F.get(w, at), at))
    apart = lambda c, x, i: _place(x) - before(c, i) > lines
    filled = lambda c: F.transform(c, lambda x, i: F.when(apart(c, x, i), F.concat(stretch(before(c, i) + 1, _place(x) - 1), F.array(x))).otherwise(F.array(x)))
    inner = lambda c: F.when(F.size(F.filter(c, lambda x, i: apart(c, x, i))) > 0, F.flatten(filled(c))).otherwise(c)
    whole = lambda c: F.when(count - last(c) > lines, F.concat(inner(c), stretch(last(c) + 1, count - 1))).otherwise(inner(c))
    low = F.transform(w, lambda x, i: F.when(F.xxhash64(x) < LOW_SEVENTH, _number(x, i)))
    between = lambda c, i: F.coalesce(_place(F.get(c, i + 1)), count) - before(c, i)
    lesser = lambda y, x: F.coalesce(y < x, F.lit(True))
    kept = lambda c: F.filter(c, lambda x, i: ~(lesser(F.get(c, i - 1), x) & lesser(F.get(c, i + 1), x) & (between(c, i) <= lines)))
    out = _let(F.filter(low, lambda x: x.isNotNull() & (_place(x) < count)), whole)
    for _ in range(PASSES):
        out = _let(out, kept)
    return out


def _winnowed(text: Column, min_words: int, gram: int, body) -> Column:
    """``body`` of a text's words and the least numbers of its windows; null for less than a window. Where windows are
    alike, so are their least lines: what decides is the hash of the window."""
    inner = lambda w: _let(_least(w, F.size(w) - gram + 1, min_words - gram + 1), lambda m: body(w, m))
    return _let(words(text), lambda w: F.when(F.size(w) >= min_words, inner(w)))


def _line(w: Column, at: Column, gram: int) -> Column:
    """The hash of ``gram`` words; a slice of an array would cost as much as all of it."""
    return F.xxhash64(*(F.get(w, at + k) for k in range(gram)))


def window_runs(text: Column, min_words: int, gram: int) -> Column:
    """Arrays of ``mark, whole, at, n``: the hash of a line, and of all words of the windows one after the other whose least line
    it is: ``n`` of them, from word ``at`` on."""
    lines = min_words - gram + 1

    def runs(w: Column, m: Column) -> Column:
        def lesser(x: Column, k: Column, side: int) -> Column:
            """The place of the nearest lesser one on a side, of as many as a window may have; most often it is among the first."""
            far = F.filter(F.sequence(F.lit(NEAR + 1), F.lit(max(lines, NEAR + 1))), lambda d: F.get(m, k + side * d) < x)
            out = _place(F.get(m, k + side * F.get(far, F.lit(0))))
            for d in range(NEAR, 0, -1):
                y = F.get(m, k + side * d)
                beyond = F.coalesce((_place(y) - _place(x)) * side >= lines, F.lit(True))
                out = F.when(y < x, _place(y)).when(beyond, F.lit(None)).otherwise(out)
            return out

        begin = lambda x, k: F.greatest(F.coalesce(lesser(x, k, -1) + 1, F.lit(0)), _place(x) - lines + 1)
        last = lambda x, k: F.least(F.coalesce(lesser(x, k, 1) - lines, _place(x)), _place(x), F.size(w) - min_words)
        spans = F.transform(m, lambda x, k: F.struct(_place(x).alias("p"), begin(x, k).alias("at"), last(x, k).alias("last")))
        end = lambda x: x["last"] + (min_words - gram)
        whole = lambda x: F.xxhash64(F.transform(F.sequence(x["at"], end(x), F.lit(gram)), lambda at: _line(w, at, gram)), _line(w, end(x), gram))
        run = lambda x: F.struct(_line(w, x["p"], gram).alias("mark"), whole(x).alias("whole"), x["at"].alias("at"), (x["last"] - x["at"] + 1).alias("n"))
        return F.transform(F.filter(spans, lambda x: x["at"] <= x["last"]), run)

    return _winnowed(text, min_words, gram, runs)


def window_keys(text: Column, min_words: int, gram: int, runs: Column) -> Column:
    """Arrays of ``mark, at, keys``: the hashes of all windows of ``runs`` (``mark, at, n``)."""
    starts = [*range(0, min_words - gram, gram), min_words - gram]  # lines that cover a window
    keys = lambda g, at, n: F.transform(F.sequence(at, at + n - 1), lambda i: F.xxhash64(*(F.get(g, i + k) for k in starts)))
    run = lambda x, keys: F.struct(x["mark"].alias("mark"), x["at"].alias("at"), keys.alias("keys"))
    own = lambda w, x: F.transform(F.sequence(x["at"], x["at"] + x["n"] - 1 + min_words - gram), lambda at: _line(w, at, gram))
    each = lambda w: F.transform(runs, lambda x: run(x, _let(own(w, x), lambda g: keys(g, F.lit(0), x["n"]))))
    once = lambda w: _let(F.transform(w, lambda x, at: _line(w, at, gram)), lambda g: F.transform(runs, lambda x: run(x, keys(g, x["at"], x["n"]))))
    return _let(words(text), lambda w: F.when(F.size(w) >= LOOKED_UP * F.size(runs), each(w)).otherwise(once(w)))


def repeated_windows(texts: DataFrame, runs: DataFrame, min_words: int, gram: int) -> tuple[DataFrame, list[DataFrame]]:
    """``doc, s, e``: the first words (first and last in a row) of windows of ``texts(doc, text)`` that also occur earlier; ``runs(mark,
    whole, doc, at, n)`` are all runs of shared fingerprints, a written table that is deleted on the way. Second, the written tables that it reads."""
    place = F.struct("doc", "at")
    distinct = materialize(runs.groupBy("mark", "whole", "n").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows")))
    more = distinct.where("rows > 1").select("mark", "whole", "n", "first").hint("shuffle_hash")
    whole = runs.join(more, ["mark", "whole", "n"]).where(place > F.col("first"))
    whole = materialize(whole.select("doc", F.col("at").alias("s"), (F.col("at") + F.col("n") - 1).alias("e")))
    release(runs)
    several = materialize(distinct.groupBy("mark").count().where("count > 1").select("mark"))
    firsts = distinct.join(several.hint("shuffle_hash"), "mark").select("first.doc", F.struct("mark", "first.at", "n").alias("run"))
    wanted = materialize(firsts.groupBy("doc").agg(F.collect_list("run").alias("runs")))
    release(distinct, several)
    # a condition on the array, also one that explode infers, would have it computed twice
    keys = texts.join(wanted.hint("shuffle_hash"), "doc").select("doc", F.explode_outer(window_keys(F.col("text"), min_words, gram, F.col("runs"))).alias("run"))
    keys = materialize(keys.where("run IS NOT NULL").select("doc", "run.*"))
    release(wanted)
    each = materialize(keys.select("mark", F.posexplode("keys").alias("k", "key"), "doc", "at").select("mark", "key", "doc", (F.col("at") + F.col("k")).alias("at")))
    # nearly all occur once, which a count by hash tells at less cost than the least place, which needs a sort
    repeated = materialize(each.groupBy("mark", "key").count().where("count > 1").select("mark", "key"))
    again = materialize(each.join(repeated.hint("shuffle_hash"), ["mark", "key"]))
    release(keys, each, repeated)
    firsts = materialize(again.groupBy("mark", "key").agg(F.min(place).alias("first")))
    drop_shuffles(texts.sparkSession)
    single = again.join(firsts.hint("shuffle_hash"), ["mark", "key"]).where(place > F.col("first")).select("doc", F.col("at").alias("s"), F.col("at").alias("e"))
    return whole.union(single), [whole, again, firsts]


def dedup_passages(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = 40, gram: int = 8) -> DataFrame:
    """The rows and columns of ``documents``, repeated passages deleted from the text, and ``n_removed, removed``
    (how many words are deleted, and which: first-last pairs from 0).

    A word is deleted if it belongs to ``min_words`` words in a row that also occur earlier, in a document with a smaller
    identifier (null ones first) or earlier in the same text, wherever they start and end; shorter repeats stay, and a smaller
    ``min_words`` finds them as exactly (down to 1: every word that occurred before). Words are parted by white space; each character of
    a script without spaces is one. The white space after a deleted word goes with it. A null text stays null, an empty or blank one as
    it is; rows that repeat an identifier and a text are treated alike, as one document; of equal texts under different identifiers the
    first stays. A text is held by one task as arrays of its words' hashes, whatever its length; nothing holds two texts. Other columns pass
    through, whatever their names; columns named ``n_removed`` or ``removed`` are replaced. An empty table gives an empty one.
    """
    gram = min(gram, min_words)
    kept = [c for c in documents.columns if c not in ("n_removed", "removed")]
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), _doc(id_column, text_column).alias("doc"))
    text = F.col("row").getField(text_column)
    # n spares the exchanges below the longer place of a document
    marked = rows.where(F.length(text) >= min_words).select(F.monotonically_increasing_id().alias("n"), "doc", F.unhex(F.md5(text)).alias("content"), window_runs(text, min_words, gram).alias("runs"))
    marked = materialize(marked)
    # equal texts have equal runs throughout: the first stands for all, and of the others everything is repeated
    heads = materialize(marked.groupBy("content").agg(F.min(F.struct("doc", "n")).alias("head"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("content", "head"))
    copies = marked.where("runs IS NOT NULL").select("n", "doc", "content").join(heads, "content").where(F.col("n") != F.col("head.n"))
    copies = materialize(copies.select("n", "doc", (F.col("doc") != F.col("head.doc")).alias("copy")))
    each = marked.join(copies.select("n").hint("shuffle_hash"), "n", "left_anti")
    shared = materialize(each.select(F.explode("runs.mark").alias("mark")).groupBy("mark").count().where("count > 1").select("mark"))
    runs = materialize(each.select("doc", F.inline("runs")).join(shared.hint("shuffle_hash"), "mark"))
    release(marked, heads, shared)

    found, written = repeated_windows(rows.select("doc", text.alias("text")), runs, min_words, gram)
    found = found.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("w"))
    ends = F.filter("w", lambda x, i: F.coalesce(F.get("w", i + 1)["s"] > x["e"] + min_words, F.lit(True)))
    starts = F.filter("w", lambda x, i: F.coalesce(F.get("w", i - 1)["e"] + min_words < x["s"], F.lit(True)))
    found = found.select("doc", F.zip_with(starts, ends, lambda x, y: F.struct(x["s"].alias("first"), (y["e"] + min_words - 1).alias("last"))).alias("runs"))
    fate = materialize(found.withColumn("copy", F.lit(False)).unionByName(copies.where("copy").select("doc", "copy").distinct(), allowMissingColumns=True))
    release(copies, *written)

    def left(p: Column) -> Column:
        """What stands before, between and after the runs."""
        r = F.col("runs")
        begin = lambda i: F.coalesce(F.get(r, i - 1)["last"] + 1, F.lit(0))
        until = lambda i: F.coalesce(F.get(r, i)["first"], F.size(p))
        part = lambda i: F.array_join(F.transform(F.sequence(begin(i), until(i) - 1), lambda at: F.get(p, at)), "")
        return F.transform(F.sequence(F.lit(0), F.size(r)), lambda i: F.when(until(i) > begin(i), part(i)).otherwise(""))  # a slice would cost as much as all pieces

    first = lead(text)
    shifted = F.transform("runs", lambda r: F.struct((r["first"] + first).alias("first"), (r["last"] + first).alias("last")))  # by words until here
    out = rows.join(fate.hint("shuffle_hash"), "doc", "left").withColumn("runs", shifted)
    removed = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    named = F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"], r["last"])), ",")
    blank = F.when(first == 1, F.get(pieces(text), F.lit(0))).otherwise("")
    every = _let(F.size(words(text)), lambda n: F.struct(n.alias("n"), F.concat_ws("-", first, first + n - 1).alias("named")))
    by = lambda copied, cut, whole: F.when(F.col("copy"), copied).when(F.col("copy").isNotNull(), cut).otherwise(whole)
    kinds = by(
        F.struct(blank.alias("text"), every["n"].alias("n"), every["named"].alias("named")),
        F.struct(F.array_join(_let(pieces(text), left), "").alias("text"), removed.alias("n"), named.alias("named")),
        F.struct(text.alias("text"), F.lit(0).alias("n"), F.lit("").alias("named")),
    )
    out = out.select("row", kinds.alias("kind"))
    columns = [(F.col("kind.text") if c == text_column else F.col("row").getField(c)).alias(c) for c in kept]
    return out.select(*columns, F.col("kind.n").cast("bigint").alias("n_removed"), F.col("kind.named").alias("removed"))
