"""Document fingerprints: Merkle trees over sections, paragraphs and blocks of words.

A text is cut into sections (at blank lines, or after ``SECTION_PARAGRAPHS`` paragraphs), sections into
paragraphs (lines), paragraphs into sentences and those into blocks of at most ``BLOCK_WORDS`` words. A block's
hash covers its exact characters, a parent's hash the hashes below it in order. Since every character belongs
to one block, equal roots mean equal texts, and where roots differ the branches that differ show where.

The fingerprint string is ``root:section;section;...`` with paragraphs of a section joined by ``,`` and each
paragraph written as the 6-digit hashes of its blocks, so each branch of the tree stands in it as a whole. Two fingerprints are compared
from the root down: equal branches are settled as such, and only those that differ are entered. Likeness is 2 * common
blocks / all blocks, counted with repeats. ``edited_place`` names the first and the last block of a text that an edit touches.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrid.llm.common import materialize

BLOCK_WORDS, SECTION_PARAGRAPHS = 8, 16
#: Longer ones are cut, as base64 and scripts without spaces have.
WORD_CHARS = 32
SENTENCE = regex.compile(r"[^.!?。！？]+[.!?。！？]*\s*|[.!?。！？]+\s*")
WORDS = regex.compile(r"(?:\s*+\S{1,%d}+\s*+){1,%d}+|\s+" % (WORD_CHARS, BLOCK_WORDS))


def _hash(data: bytes) -> str:
    return hashlib.blake2b(data, digest_size=16).hexdigest()


def blocks(paragraph: str) -> list[str]:
    """The blocks of a paragraph, whose concatenation is the paragraph."""
    return [b for sentence in SENTENCE.findall(paragraph) for b in WORDS.findall(sentence)]


def tree(text: str) -> tuple[str, list[tuple[str, list[tuple[str, list[str]]]]]]:
    """(root, [(section hash, [(paragraph hash, [block hash, ...]), ...]), ...])."""
    sections: list[list[str]] = [[]]
    for line in text.split("\n"):
        if len(sections[-1]) >= SECTION_PARAGRAPHS or (sections[-1] and not sections[-1][-1].strip() and line.strip()):
            sections.append([])
        sections[-1].append(line)
    out = []
    for lines in sections:
        paragraphs = []
        for line in lines:
            leaves = [_hash(b.encode()) for b in blocks(line)]
            paragraphs.append((_hash(b"p" + "".join(leaves).encode()), leaves))
        out.append((_hash(b"s" + "".join(p for p, _ in paragraphs).encode()), paragraphs))
    return _hash(b"r" + "".join(s for s, _ in out).encode()), out


def fingerprint(text: str) -> str:
    root, sections = tree(text)
    return root + ":" + ";".join(",".join("".join(h[:6] for h in leaves) for _, leaves in paragraphs) for _, paragraphs in sections)


def _apart(left: list[str], right: list[str]) -> tuple[list[str], list[str]]:
    """What is left of both when equal branches are paired off."""
    both = Counter(left) & Counter(right)
    out = []
    for side in (left, right):
        todo = dict(both)
        rest = []
        for branch in side:
            if todo.get(branch):
                todo[branch] -= 1
            else:
                rest.append(branch)
        out.append(rest)
    return out[0], out[1]


def _blocks_of(paragraphs: list[str]) -> list[str]:
    return [p[i : i + 6] for p in paragraphs for i in range(0, len(p), 6)]


def _count(branches: str) -> int:
    return (len(branches) - branches.count(",") - branches.count(";")) // 6


def likeness(left: str, right: str) -> float:
    """1 for equal roots; else the share of common blocks, 0 to 1, found from the sections down."""
    (root_a, _, a), (root_b, _, b) = left.partition(":"), right.partition(":")
    if root_a == root_b:
        return 1.0
    total = _count(a) + _count(b)
    sections = _apart(a.split(";"), b.split(";"))
    paragraphs = _apart(*([p for s in side for p in s.split(",")] for side in sections))
    rest = _apart(*(_blocks_of(side) for side in paragraphs))
    return (total - len(rest[0]) - len(rest[1])) / total if total else 0.0


def edited_place(left: str, right: str) -> str:
    """``section.paragraph.block-section.paragraph.block``: the first and the last block of the left text that differ, by the branches
    from the root down; empty for equal roots. If nothing of the left text is missing in the right one, the two blocks beside
    the insertion (or the text's end)."""
    (root_a, _, a), (root_b, _, b) = left.partition(":"), right.partition(":")
    if root_a == root_b:
        return ""

    def alike(x: list, y: list, most: int) -> int:
        n = 0
        while n < most and x[n] == y[n]:
            n += 1
        return n

    def descend(x: str, y: str, level: int, end: bool) -> list[int]:
        """The path to the first branch that differs, or from the end the last."""
        one, two = (s.split(";,"[level]) if level < 2 else _blocks_of([s]) for s in (x, y))
        if end:
            n = alike(one[::-1], two[::-1], min(len(one), len(two)))
            at, other = len(one) - 1 - n, len(two) - 1 - n
        else:
            at = other = alike(one, two, min(len(one), len(two)))
        inside = max(0, min(at, len(one) - 1))
        if level == 2 or at != inside or not 0 <= other < len(two):
            return [inside] + [0 if not end else -1] * (2 - level) if at == inside else [inside] + [-1 if not end else 0] * (2 - level)
        return [inside, *descend(one[at], two[other], level + 1, end)]

    def named(path: list[int]) -> str:
        """Counted from the end where the path says so."""
        sections = a.split(";")
        paragraphs = sections[path[0]].split(",")
        p = path[1] % len(paragraphs)
        n = max(1, len(paragraphs[p]) // 6)
        return f"{path[0]}.{p}.{path[2] % n}"

    return f"{named(descend(a, b, 0, False))}-{named(descend(a, b, 0, True))}"


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) of the code points replaced by as many first ones of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut] if cut else text


def document_fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, fingerprint``, one row per document; a null text counts as empty; other columns are ignored."""
    id_type = dict(documents.dtypes)[id_column]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [id_column, "fingerprint"])

    return documents.select(id_column, text_column).mapInArrow(marks, f"`{id_column}` {id_type}, fingerprint string")


RESULT = "doc_id {0}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_place string"


def _compare(doc: tuple, text: str, mark: str, following: str, next_mark: str) -> tuple:
    changed = edited(text, following)
    changed_mark = mark if changed == text else fingerprint(changed)
    return (*doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), mark, changed_mark, likeness(mark, changed_mark), likeness(mark, next_mark), edited_place(mark, changed_mark))


def edit_trial(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", partitions: int | None = None) -> DataFrame:
    """Each document against its edited text and against the next document, in the order of identifiers.

    The documents are dealt out by ranges of the identifier and sorted, so that nearly every document is
    beside the next one; each partition hands on its first and its last text, and those few are paired by
    partition number. The texts move once. ``edited_place`` locates the edit in the document's tree. Null identifiers come first, ties go by text, a null text is
    an empty one; a single document follows itself. Other columns are ignored; an empty table gives no rows.
    """
    spark = documents.sparkSession
    id_type = dict(documents.dtypes)[id_column]
    n = partitions or max(1, documents.rdd.getNumPartitions())
    source = documents.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ordered = source.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    schema = RESULT.format(id_type) + ", kind string, part int, text string"
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_place", "kind", "part", "text"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: tuple | None = None
        types = None

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.int32(), pa.string()]
            for at in range(0, batch.num_rows, 500):
                rows = []
                piece = batch.slice(at, 500)
                for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    mark = fingerprint(text)
                    if last is None:
                        rows.append((key, None, None, mark, None, None, None, None, "first", part, text))
                    else:
                        rows.append((*_compare((last[0],), last[1], last[2], text, mark), "whole", part, None))
                    last = (key, text, mark)
                if rows:
                    yield packed(rows)
        if last is not None:
            yield packed([(last[0], None, None, last[2], None, None, None, None, "last", part, last[1])])

    walked = materialize(ordered.mapInArrow(walk, schema))
    ends = walked.where(F.col("kind") != "whole")
    # partition numbers only: one row per partition
    chain = ends.where(F.col("kind") == "last").select("part").withColumn("after", F.lead("part").over(Window.orderBy("part")))
    lowest = ends.agg(F.min("part")).first()[0]
    chain = chain.select("part", F.coalesce("after", F.lit(lowest)).alias("after"))
    firsts = ends.where(F.col("kind") == "first").select(F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark"))
    pairs = ends.where(F.col("kind") == "last").select("part", "doc_id", "text", "fingerprint").join(chain, "part").join(firsts, "after")

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_compare((k,), t, m, t2, m2) for k, t, m, t2, m2 in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names[:8])

    rest = pairs.select("doc_id", "text", "fingerprint", "next_text", "next_mark").mapInArrow(border, RESULT.format(id_type))
    out = walked.where(F.col("kind") == "whole").select(*names[:8]).union(rest)
    return out.withColumnRenamed("doc_id", id_column)
