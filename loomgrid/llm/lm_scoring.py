"""Language-model scores by a weighted backoff automaton.

The model is a bigram model with Dirichlet smoothing over the add-one unigram model, as an automaton. Every
history (a word, or the start of a text) is a state. A bigram seen in training is an arc of weight
log10((c(hw) + mu p(w)) / (c(h) + mu)). Every state has a failure arc of weight log10(mu / (c(h) + mu)) to the
root, whose arcs are the unigrams p(w) = (c(w) + 1) / (N + V + 1). Reading a word takes the state's arc or
else the failure arc and the root's; either way the next state is the word's. A state's probabilities sum to
1 (up to the add-one mass of unseen words).

Training and scoring share one exchange of counts, of which neither side is ever gathered in one place.
Documents are dealt into blocks. A block sends the sorted 64-bit hashes of its distinct unigrams and bigrams,
with their training counts, to the owners of the hash ranges, packed as byte planes of differences (about six
bytes an n-gram). An owner sums over blocks and answers each block's hashes in the order in which they were
asked, so an answer is only counts. A block then has its slice of the automaton and reads its texts.
A frequent word is one entry per block, so no key is hot. Blocks and ranges grow in number with the input: two for
each partition, and from 16,384 partitions on with the square root, so that the packets between them, whose number is
the square, stay worth packing (blocks are then larger, and want executors that hold one).
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrid.llm.common import hash_remainder, materialize

#: Hashes of what isn't a word: the end of a text and the start of one (words hold no space and aren't empty).
END_HASH, START_HASH = xxhash.xxh64_intdigest(b""), xxhash.xxh64_intdigest(b" ")
UNIGRAM, BIGRAM = 0, 1


#: The planes of the low bytes of hashes' differences are noise: only those above are compressed.
NOISE = 4


def _planes(numbers: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as byte planes of their differences, the high ones compressed."""
    planes = _planes(np.diff(keys, prepend=np.uint64(0)))
    return len(keys).to_bytes(4, "little") + planes[:NOISE].tobytes() + zlib.compress(planes[NOISE:].tobytes(), 1)


def unpack_sorted(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(data, np.uint8, NOISE * n, 4).reshape(NOISE, n)
    rest = np.frombuffer(zlib.decompress(data[4 + NOISE * n :]), np.uint8).reshape(8 - NOISE, n)
    return np.cumsum(_numbers(np.concatenate([raw, rest])), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts as the smallest unsigned type that holds them, compressed."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(counts) or counts.max() <= np.iinfo(k).max)
    return kind[-1:].encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"<u{data[:1].decode()}").astype(np.int64)


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(29))) & ~np.uint64(1)  # the last bit is free for a mark


class Block:
    """The tokens of a block's texts as numbers of its vocabulary (0: the end), and the hashes of both n-gram streams."""

    def __init__(self, texts: list[str | None]) -> None:
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[b""]
        ids, self.lengths = [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words = text.encode().lower().split() if text else []
            words.append(b"")
            ids.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
            self.lengths[i] = len(words)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(map(digest, numbers), dtype=np.uint64, count=len(numbers))
        self.order = np.argsort(hashes)
        self.vocabulary = hashes[self.order]  # the unigrams, sorted
        history = hashes[np.roll(self.ids, 1)]
        history[self.starts] = np.uint64(START_HASH)
        self.bigrams = _mix(history, hashes[self.ids])

    def unigram_counts(self, where: np.ndarray) -> np.ndarray:
        """In the order of the sorted vocabulary."""
        return np.bincount(self.ids[where], minlength=len(self.order))[self.order]

    def bigram_counts(self, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sorted bigrams, and the counts of those at the places ``where``: one sort, with the place's kind as the last bit."""
        marked = np.sort(self.bigrams | where)
        keys = marked & ~np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first) if len(keys) else first
        return keys[first], counts

    def bigram_places(self) -> np.ndarray:
        """For each place its bigram's number among the sorted ones."""
        order = np.argsort(self.bigrams)
        keys = self.bigrams[order]
        out = np.empty(len(keys), dtype=np.int64)
        out[order] = np.cumsum(np.concatenate([[False], keys[1:] != keys[:-1]])) if len(keys) else 0
        return out


def _bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range starts in sorted keys, and the end."""
    owner = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(owner, np.arange(ranges + 1, dtype=np.uint64))


REQUEST = "owner int, block int, kind int, asked binary, counted binary"
ANSWER = "block int, owner int, kind int, counted binary, n bigint, v bigint, ends bigint"


def count_requests(blocks: DataFrame, ranges: int) -> DataFrame:
    """Per block and range: its distinct n-grams and their counts over its training texts."""

    def count(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        block = Block(table.column("text").to_pylist())
        training = np.repeat(~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool), block.lengths)
        rows = []
        streams = ((UNIGRAM, block.vocabulary, block.unigram_counts(training)), (BIGRAM, *block.bigram_counts(training)))
        for kind, keys, counts in streams:
            bounds = _bounds(keys, ranges)
            for owner in range(ranges):
                a, b = bounds[owner], bounds[owner + 1]
                if b > a:
                    rows.append((owner, number, kind, pack_sorted(keys[a:b]), pack_counts(counts[a:b])))
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(["owner", "block", "kind", "asked", "counted"], types, strict=True))})

    return blocks.groupBy("block").applyInArrow(count, REQUEST)


def answer_requests(requests: DataFrame) -> DataFrame:
    """Per block and range: the corpus counts of what it asked, in its order. On one row of each range stand
    the range's tokens and distinct tokens in training, and the count of text ends."""

    def answer(table: pa.Table) -> pa.Table:
        owner = table.column("owner")[0].as_py()
        out = {k: [] for k in ("block", "owner", "kind", "counted", "n", "v", "ends")}
        kinds = table.column("kind").to_numpy()
        for kind in (UNIGRAM, BIGRAM):
            part = table.filter(pa.array(kinds == kind))
            if not part.num_rows:
                continue
            asked = [unpack_sorted(x) for x in part.column("asked").to_pylist()]
            counts = np.concatenate([unpack_counts(x) for x in part.column("counted").to_pylist()])
            keys, at = np.unique(np.concatenate(asked), return_inverse=True)
            totals = np.zeros(len(keys), dtype=np.int64)
            np.add.at(totals, at, counts)
            ends = int(totals[keys == np.uint64(END_HASH)].sum()) if kind == UNIGRAM else 0
            stats = (int(totals.sum()), int((totals > 0).sum()), ends) if kind == UNIGRAM else (0, 0, 0)
            begin = 0
            for block, own in zip(part.column("block").to_pylist(), asked, strict=True):
                out["block"].append(block)
                out["owner"].append(owner)
                out["kind"].append(kind)
                out["counted"].append(pack_counts(totals[at[begin : begin + len(own)]]))
                for name, value in zip(("n", "v", "ends"), stats, strict=True):
                    out[name].append(value)
                stats = (0, 0, 0)
                begin += len(own)
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)})

    return requests.groupBy("owner").applyInArrow(answer, ANSWER)


class Automaton:
    """A block's slice of the automaton: counts of its words (as states and as the root's arcs) and of its bigrams (arcs)."""

    def __init__(self, words: np.ndarray, arcs: np.ndarray, totals: tuple[int, int, int], mu: float) -> None:
        tokens, kinds, self.texts = totals
        self.words, self.arcs, self.mu = words, arcs, mu
        self.root = np.log10((words + 1.0) / (tokens + kinds + 1.0))

    def traverse(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights along the texts: the model's and the root's, and whether each token is known.

        The state after a token is that token's, so the states that the pass carries are the tokens one
        place before; at a text's start it is the start state, which training left once a text.
        """
        visits = self.words[np.roll(block.ids, 1)]
        visits[block.starts] = self.texts
        arc, root = self.arcs[block.bigram_places()], self.root[block.ids]
        own = np.log10((arc + self.mu * (10.0**self.root)[block.ids]) / (visits + self.mu))
        failure = np.log10(self.mu / (visits + self.mu)) + root
        return np.where(arc > 0, own, failure), root, self.words[block.ids] > 0


def score_documents(documents: DataFrame, held_out: str | None = None, id_column: str = "doc_id", text_column: str = "text", mu: float = 100.0, blocks: int | None = None) -> DataFrame:
    """One row per document: ``<id>, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of the text with A-Z lower-cased, then one end. Documents for which the SQL condition
    ``held_out`` holds (default: crc32 of the identifier as text mod 7 is 2) are scored but not learned from.
    ``base_score`` is the add-one unigram log10 probability, ``score`` the automaton's. A null text has
    only the end. Rows that repeat count each time; other columns are ignored; an empty table gives no rows.
    """
    condition = F.expr(held_out) if held_out else hash_remainder(F.col(id_column), 7) == 2
    parts = documents.rdd.getNumPartitions()
    n = blocks or max(2, min(2 * parts, int(256 * math.sqrt(parts))))
    dealt = documents.select(
        F.pmod(F.xxhash64(id_column, F.octet_length(text_column)), F.lit(n)).cast("int").alias("block"),
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.coalesce(condition, F.lit(False)).alias("held_out"),
    )
    answers = materialize(answer_requests(count_requests(dealt, n)))
    row = answers.agg(F.sum("n"), F.sum("v"), F.sum("ends")).first()
    totals = tuple(int(x or 0) for x in row)
    id_type = dict(documents.dtypes)[id_column]

    def score(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(table.column("text").to_pylist())
        found = []
        for kind in (UNIGRAM, BIGRAM):
            rows = [(o, c) for o, k, c in zip(replies.column("owner").to_pylist(), replies.column("kind").to_pylist(), replies.column("counted").to_pylist(), strict=True) if k == kind]
            found.append(np.concatenate([unpack_counts(c) for _, c in sorted(rows)]))
        words = np.empty(len(found[0]), dtype=np.int64)
        words[block.order] = found[0]  # from the order of hashes to the block's numbers
        automaton = Automaton(words, found[1], totals, mu)
        weights, base, known = automaton.traverse(block)
        add = lambda x: np.add.reduceat(x, block.starts)
        return pa.table(
            {
                id_column: table.column("id"),
                "held_out": table.column("held_out"),
                "n_tokens": pa.array(block.lengths),
                "n_known": pa.array(add(known.astype(np.int64))),
                "train_tokens": pa.array(np.full(len(block.lengths), totals[0])),
                "base_score": pa.array(add(base)),
                "score": pa.array(add(weights)),
            }
        )

    schema = f"`{id_column}` {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return dealt.groupBy("block").cogroup(answers.select("block", "owner", "kind", "counted").groupBy("block")).applyInArrow(score, schema)
