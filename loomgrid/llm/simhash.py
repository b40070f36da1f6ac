"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. If two fingerprints differ in at most three bits, one of the
halves differs in at most one. Each distinct fingerprint is therefore indexed under both halves as they are and
under each half with one bit left out (66 keys): any two that must be linked meet under an equal key, by an
equality of keys alone, and every meeting is verified over all 64 bits.

Copies collapse to one fingerprint first. Keys are dealt out and sorted by Spark; a kernel walks each
partition's sorted keys, drops those that occur once, and for the rest links members within three bits as a
spanning forest, so that a key of m fingerprints gives at most m - 1 links, never its pairs. A key with
more than ``BUCKET`` fingerprints passes through unbuffered and is dealt again by four parts of its other
half (three bits can't touch all four), which leaves at most 2^25 fingerprints under a key whatever the
corpus. Connected components over the links give the groups.

``similar_groups`` groups texts by the Jaccard similarity of their word shingles instead. Three bits of 64 are
too close for a similarity of 0.8, so it takes fingerprints of the distinct words, which near-copies share more
of than they share shingles, several of them with independent seeds, and a wider radius (with 5 bits, three
segments); the candidates that these find are then verified by the exact similarity of the whole texts.

That sees most pairs, not all: copies that differ by a block are missed, and so are members of a key whose link in its forest
fails the verification. A second round therefore is exact. Two sets with a similarity of t share an element of their prefixes, the first
n - ceil(t n) + 1 of n shingles in an order that is the same for all texts; texts that share one and aren't yet in one group are
verified as well, unless sizes, places or parities rule them out. Parities are bits that each shingle toggles one of: two sets
differ by at least as many shingles as their parities differ in bits. 64 of them move with the prefixes; of the pairs that these leave, a parity of
about a bit a shingle rules out nearly all that aren't similar, so that few whole texts move.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrid.llm.common import arrow_rows, drop_shuffles, gathered, materialize, release
from loomgrid.llm.components import connected_components

SEED, RADIUS = 42, 3
#: Fingerprints under one key that are compared in place; keys with more are dealt again.
BUCKET = 20_000
#: The prefixes of the second round are dealt in so many parts, one after the other: only one of them is on disk.
PARTS = 4


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of a text as an unsigned number; 0 if it has no words."""
    words = (text or "").encode().lower().split()  # bytes: lower-cases A-Z only, splits at the six white spaces
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, fp`` (the 64 bits as a bigint), one row per document; a null text has no words."""
    id_type = dict(documents.dtypes)[id_column]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], [id_column, "fp"])

    return documents.select(id_column, text_column).mapInArrow(marks, f"`{id_column}` {id_type}, fp bigint")


class Forest:
    """Links that connect what chains of steps of at most ``radius`` bits connect: a spanning forest of each key's members."""

    def __init__(self, radius: int) -> None:
        self.radius = radius

    def many(self, fps: np.ndarray, nodes: np.ndarray, key: int) -> tuple[list, list]:
        left, right = [], []
        places = np.arange(len(fps))
        while len(places) > 1:
            root, places, todo = places[0], places[1:], [places[0]]
            while todo and len(places):
                near = np.bitwise_count(fps[places] ^ fps[todo.pop()]) <= self.radius
                if near.any():
                    new, places = places[near], places[~near]
                    right.append(nodes[new])
                    left.append(np.full(len(new), nodes[root]))
                    todo.extend(new)
        return left, right


def _links(kernel, bucket: int | None):
    """Runs a kernel over (key, fp, node, v) sorted by key: rows (0, a, b) are links, rows (1, fp, node, v, key) belong to keys of
    over ``bucket`` rows and are passed on as they come."""

    def row(kind: int, a: np.ndarray, b: np.ndarray, v: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        columns = [np.full(len(a), kind, np.int32), a.view(np.int64), b.view(np.int64), v.astype(np.int32), key]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "a", "b", "v", "key"])

    def solve(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, fps, nodes, v = rows
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        if bucket is not None and (sizes > bucket).any():
            big = np.repeat(sizes > bucket, sizes)
            yield row(1, fps[big], nodes[big], v[big], keys[big])
            yield from solve([x[~big] for x in rows])
            return
        two = starts[sizes == 2]
        near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= kernel.radius]
        left, right = [nodes[near]], [nodes[near + 1]]
        for at, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            a, b = kernel.many(fps[at : at + size], nodes[at : at + size], int(keys[at]))
            left += a
            right += b
        a, b = np.concatenate(left), np.concatenate(right)
        if len(a):
            a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield row(0, a, b, np.zeros(len(a)), np.zeros(len(a), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        over = None  # the key that is being passed on
        for batch in batches:
            more = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            more[1] = more[1].view(np.uint64)
            if over is not None:
                n = int(np.searchsorted(more[0], over, side="right"))
                if n:
                    yield row(1, *(more[k][:n] for k in (1, 2, 3, 0)))
                more = [x[n:] for x in more]
                if not len(more[0]):
                    continue
                over = None
            held = [np.concatenate(x) for x in zip(held, more, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last key may go on
            if cut:
                yield from solve([x[:cut] for x in held])
                held = [x[cut:] for x in held]
            if bucket is not None and len(held[0]) > bucket:
                over = int(held[0][-1])
                yield row(1, *(held[k] for k in (1, 2, 3, 0)))
                held = [x[:0] for x in held]
        if len(held[0]):
            yield from solve(held)

    return run


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def variant_masks(radius: int) -> tuple[list[int], list[list[int]]]:
    """The bits that each signature keeps: of every segment all, then all but one. With radius // 2 + 1 segments, one of
    them differs by at most one bit. Second, for each signature the radius + 1 parts of the bits
    outside its segment, one of which must be equal; they split a key with too many members."""
    segments = radius // 2 + 1
    masks, parts = [], []
    for s in range(segments):
        low, high = 64 * s // segments, 64 * (s + 1) // segments
        full = (1 << high) - (1 << low)
        outside = [b for b in range(64) if not low <= b < high]
        split = [sum(1 << b for b in outside[len(outside) * k // (radius + 1) : len(outside) * (k + 1) // (radius + 1)]) for k in range(radius + 1)]
        for mask in (full, *(full & ~(1 << b) for b in range(low, high))):
            masks.append(mask)
            parts.append(split)
    return masks, parts


def variant_index(rows: DataFrame, radius: int) -> DataFrame:
    """``key, fp, node``: each row (``node, t, fp``) under all its signatures; ``t`` tells apart fingerprints that
    don't compare. Keys are hashes, whose collisions only cost a comparison."""
    masks = F.array(*(F.lit(signed(m)) for m in variant_masks(radius)[0]))
    each = rows.select("node", "t", "fp", F.posexplode(masks).alias("v", "mask"))
    return each.select(F.xxhash64("t", "v", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp", "node", "v")


def fingerprint_links(rows: DataFrame, radius: int, kernel, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: links of a kernel over all signatures of ``rows(node, t, fp)``."""
    schema = "kind int, a bigint, b bigint, v int, key bigint"
    dealt = variant_index(rows, radius).repartition("key").sortWithinPartitions("key")
    first = materialize(dealt.mapInArrow(_links(kernel, bucket), schema))
    parts = F.array(*(F.array(*(F.lit(signed(m)) for m in split)) for split in variant_masks(radius)[1]))
    again = (
        first.where("kind = 1")
        .select("a", "b", "v", "key", F.posexplode(F.element_at(parts, F.col("v") + 1)).alias("k", "mask"))
        .select(F.xxhash64("key", "k", F.col("a").bitwiseAND(F.col("mask"))).alias("key"), F.col("a").alias("fp"), F.col("b").alias("node"), "v")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_links(kernel, None), schema)
    )
    return first.where("kind = 0").union(again).select("a", "b").distinct()


def simhash_groups(documents: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text", bucket: int = BUCKET) -> DataFrame:
    """One row per document: ``<id>, fingerprint`` (16 hexadecimal digits) and ``component_id``.

    ``component_id`` is the smallest identifier that links reach, the document's own included (null only if
    all identifiers of the group are null). Texts of fewer words than a shingle have one shingle; a null,
    empty or blank text has fingerprint zero, which links like any other. Rows that repeat are kept. Other
    columns are ignored; an empty table gives an empty result.
    """
    marks = materialize(fingerprints(documents, shingle, id_column, text_column))
    least = materialize(marks.groupBy("fp").agg(F.min(id_column).alias("least")))
    rows = least.select(F.col("fp").alias("node"), F.lit(0).alias("t"), "fp")
    parts = connected_components(fingerprint_links(rows, RADIUS, Forest(RADIUS), bucket))
    joined = least.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(joined.join(smallest, "component").select("fp", "component_id"))
    return marks.join(named, "fp").select(id_column, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def word_marks(text: str | None, seeds: int) -> tuple[bytes, list[int]]:
    """The digest of a text's words in order, and the fingerprints of its distinct words."""
    words = (text or "").encode().lower().split()
    distinct = set(words)
    marks = []
    for seed in range(SEED, SEED + seeds):
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), dtype="<u8", count=len(distinct))
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 8192):
            part = hashes[at : at + 8192]
            ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        marks.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0]))
    return xxhash.xxh3_128_digest(b" ".join(words)), marks


def shingles(text: str | None, k: int) -> set[bytes]:
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def similarity(left: str | None, right: str | None, k: int) -> float:
    """Jaccard similarity of the sets of word k-shingles; 1 for two texts without words."""
    a, b = shingles(left, k), shingles(right, k)
    return len(a & b) / len(a | b) if a or b else 1.0


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, in ascending order."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, k)), dtype="<u8")).view("<i8")


def common_shingles(source: DataFrame, k: int, documents: int = 20_000, times: int = 4, most: int = 100_000) -> np.ndarray:
    """Hashes of shingles that occur in ``times`` or more texts of a sample, in ascending order."""
    rows = source.count()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, k) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], ["h"])

    with arrow_rows(source.sparkSession, 1000):
        counted = source.sample(min(1.0, documents / max(rows, 1)), 1).select("text").mapInArrow(hashes, "h bigint").groupBy("h").count()
        return np.sort(np.array([r.h for r in counted.where(F.col("count") >= times).orderBy(F.desc("count"), "h").limit(most).collect()], dtype=np.int64))


def prefix(text: str | None, k: int, least: float, common: np.ndarray) -> tuple[list[int], int, int, bytes]:
    """The first hashes of a text's shingles, as many as must hold one that any text as similar as ``least`` also has
    among its own, the number of shingles, their parity and their sketch. They are in one order for all texts, which is all that it takes: common ones
    last, so that few texts meet under a hash without being similar."""
    hashes = shingle_hashes(text, k)
    n, bits, wide = len(hashes), parity(hashes), sketch(hashes)
    if len(common):
        known = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
        hashes = np.concatenate([hashes[~known], hashes[known]])
    return hashes[: n - math.ceil(least * n - 1e-9) + 1].tolist() if n else [], n, bits, wide


def parity(hashes: np.ndarray) -> int:
    """64 bits, each set if an odd number of the hashes belongs to it."""
    odd = np.bincount((hashes.view(np.uint64) >> np.uint64(58)).astype(np.int64), minlength=64) & 1
    return int(np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")[0])


def sketch(hashes: np.ndarray) -> bytes:
    """The parity of the hashes in as many bits as their number, rounded up to a power of two (64 at least)."""
    width = max(64, 1 << (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes.view(np.uint64) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(left: bytes, right: bytes) -> int:
    """By how many hashes two sets of these sketches differ at least. A sketch folds to one of half its bits."""
    x, y = sorted((np.frombuffer(left, "<u8"), np.frombuffer(right, "<u8")), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def shared_pairs(least: float, chunk: int = 1_000_000):
    """Runs over (key, size, label, node, place, bits) sorted by key and size: pairs (a, b) of nodes of different labels under a key
    that may be as similar as ``least``, going by their sizes, the key's places in them and their parities."""

    def solve(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, sizes, labels, nodes, places = rows[:5]
        bits, n = rows[5].view(np.uint64), len(keys)  # numpy counts the bits of a signed number's absolute value
        # the key's number and the size as one ascending number; a node meets those after it that aren't too large
        number = np.cumsum(np.append(False, keys[1:] != keys[:-1])).astype(np.int64) << 32
        most = np.minimum(np.floor(sizes / least + 1e-6), (1 << 32) - 1).astype(np.int64)
        count = np.searchsorted(number + sizes, number + most, side="right") - np.arange(n) - 1
        active = np.flatnonzero(count > 0)
        total = np.cumsum(count[active])
        at = 0
        while at < len(active):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + chunk, side="right")))
            part = active[at:to]
            x = np.repeat(part, count[part])
            y = np.arange(len(x)) - np.repeat(np.cumsum(count[part]) - count[part], count[part]) + x + 1
            at = to
            both = sizes[x].astype(np.int64) + sizes[y]
            good = (labels[x] != labels[y]) & (np.bitwise_count(bits[x] ^ bits[y]) * (1 + least) <= (1 - least) * both + 1e-6)
            # at the first hash that two texts share, no more than it and what follows is common
            x, y, both = x[good], y[good], both[good]
            good = np.minimum(sizes[x] - places[x], sizes[y] - places[y]) * (1 + least) >= least * both - 1e-6
            if good.any():
                a, b = nodes[x[good]], nodes[y[good]]
                a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            more = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = more if held is None else [np.concatenate(x) for x in zip(held, more, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last key may go on
            if cut:
                yield from solve([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield from solve(held)

    return run


def similar_groups(
    documents: DataFrame, shingle: int = 5, least_similarity: float = 0.8, radius: int = 5, seeds: int = 2, id_column: str = "doc_id", text_column: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """One row per document: ``<id>, component_id, kept, text_hash``: groups of texts that chains of similarities of at least
    ``least_similarity`` connect, named by their smallest identifier; ``kept`` is true for one row of a group, and
    ``text_hash`` (``xxhash64``) tells apart rows that repeat an identifier.

    Texts with the same words in order are one node. ``radius`` and ``seeds`` set how many pairs the first round sees: every
    pair that is seen is verified, and the second round finds all that it missed (texts that share a shingle of
    their prefixes are compared, so a short passage in very many of them costs the square of their number). A key of 64 / (radius // 2 + 1) bits should
    stay longer than the logarithm of the number of documents (radius 3 for the largest corpora).
    A null text has no words; null identifiers are larger than all others; other columns are ignored.
    """
    id_type = dict(documents.dtypes)[id_column]

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [word_marks(t, seeds) for t in part.column(2).to_pylist()]
                heads = [prefix(t, shingle, least_similarity, common) for t in part.column(2).to_pylist()]
                content = pa.array([c for c, _ in found], pa.binary())
                lists = [pa.array(x, pa.list_(pa.int64())) for x in ([m for _, m in found], [h for h, *_ in heads])]
                columns = [*lists, *(pa.array(x, kind) for x, kind in zip(list(zip(*heads, strict=True))[1:], (pa.int32(), pa.int64(), pa.binary()), strict=True))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), content, *columns], ["id", "text_hash", "content", "fps", "prefix", "size", "bits", "sketch"])

    spark = documents.sparkSession
    source = documents.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"), F.col(text_column).alias("text"))
    common = common_shingles(source, shingle)
    with arrow_rows(spark, 1000):
        marked = materialize(source.mapInArrow(marks, f"id {id_type}, text_hash bigint, content binary, fps array<bigint>, prefix array<bigint>, size int, bits bigint, sketch binary").withColumn("rid", F.monotonically_increasing_id()))
    drop_shuffles(spark)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid", "text_hash")).alias("first")
    nodes = materialize(marked.groupBy("content").agg(first, *(F.first(c).alias(c) for c in ("fps", "size", "sketch"))).withColumn("node", F.col("first.rid")))
    # fingerprints of one seed only compare with each other, and their index is the widest exchange: one seed at a time
    seen = []
    for t in range(seeds):
        with gathered() as index:
            seen.append(materialize(fingerprint_links(nodes.select("node", F.lit(t).alias("t"), F.get("fps", F.lit(t)).alias("fp")), radius, Forest(radius), bucket)))
        release(*index[:-1])
    pairs = materialize(functools.reduce(DataFrame.union, seen).distinct())
    release(*seen)

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy().astype(np.int64)
            differ = [apart(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            good = np.array(differ, np.int64) * (1 + least_similarity) <= (1 - least_similarity) * both + 1e-6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(x, y, shingle) >= least_similarity for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    def similar(pairs: DataFrame) -> DataFrame:
        drop_shuffles(spark)
        side = lambda end: nodes.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("sketch").alias(f"sketch_{end}"))
        sketched = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
        with arrow_rows(spark, 1000):
            near = materialize(sketched.mapInArrow(may, "a bigint, b bigint"))
        release(pairs)
        pairs = near
        # the texts of the nodes that have a candidate, and only those
        wanted = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "first"), "node"))
        found = source.join(wanted.select("node", F.col("first.id").alias("wanted_id"), F.col("first.text_hash").alias("wanted_hash")), F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash")))
        texts = materialize(found.select("node", "text").dropDuplicates(["node"]))
        release(wanted)
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
        with arrow_rows(spark, 200):
            good = materialize(both.select("a", "b", "left", "right").mapInArrow(verify, "a bigint, b bigint"))
        release(pairs, texts)
        return good

    links = similar(pairs)
    labels = connected_components(links).select("node", F.col("component").alias("label"))
    labelled = nodes.select("node").join(labels, "node", "left").select(F.col("node").alias("rid"), F.coalesce("label", "node").alias("label"))
    heads = materialize(marked.select("rid", "size", "bits", "prefix").join(labelled, "rid").select("label", F.col("rid").alias("node"), "size", "bits", "prefix"))
    rows = materialize(marked.select("id", "text_hash", "content", "rid"))
    release(marked)  # the prefixes, most of it, are in heads again
    met = []
    for part in range(PARTS):
        each = heads.select("label", "node", "size", "bits", F.posexplode("prefix").alias("place", "key")).where(F.pmod("key", F.lit(PARTS)) == part)
        dealt = each.select("key", "size", "label", "node", "place", "bits").repartition("key").sortWithinPartitions("key", "size")
        met.append(materialize(dealt.mapInArrow(shared_pairs(least_similarity), "a bigint, b bigint").distinct()))
        drop_shuffles(spark)
    pairs = materialize(functools.reduce(DataFrame.union, met).distinct())
    release(heads, *met)
    missed = similar(pairs)
    links = materialize(links.union(missed))
    parts = connected_components(links)
    joined = nodes.select("content", "first", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = joined.groupBy("component").agg(F.min("first").alias("head"))
    named = materialize(joined.join(firsts, "component").select("content", "head"))
    out = rows.join(named, "content").select(F.col("id").alias(id_column), F.col("head.id").alias("component_id"), (F.col("rid") == F.col("head.rid")).alias("kept"), "text_hash")
    out = materialize(out)  # without what it is made of
    release(rows, nodes, links, missed, named)
    return out
