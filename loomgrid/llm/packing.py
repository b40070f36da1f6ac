"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

A sequence costs ``linear * n + quadratic * n * n`` summed over the document pieces in it (attention does not
cross documents). Full-length pieces of long documents are sequences of their own. What remains of each
document is packed in windows of ``window_sequences`` sequences: pieces go in descending cost to the sequence
of the lowest cost that still has room for them; a piece that fits nowhere whole is cut to fill the
lowest-cost sequence that has any room. A window opens exactly as many sequences as its tokens fill, so all
of them end up full; pieces left over go on to the next window, and the last ones of a partition fill
sequences whose lengths are powers of two, which need no padding either.

A partition is packed on its own while it streams by: memory is bounded by a window and one Arrow batch, there
is no shuffle, and a lost executor costs only its partitions. Sequence numbers are (partition << 33) + running
number, so that they are unique and come out the same when a task is run again.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Words whose ids a worker keeps in each of two generations of its memo, by default; this changes no result.
MEMO_WORDS = 400_000


class WordTokenizer:
    """Ids of whole texts by a ``tokenizers`` file that lower-cases and whose pre-tokeniser never joins what
    ASCII white space parts, nor an ASCII letter or digit and the punctuation after it (but for apostrophes).

    Such a tokeniser gives for a text the concatenation of what it gives for its words, A-Z lower-cased and cut before
    punctuation, so ids are memoised by those; words that the memo lacks are encoded together, parted by
    a one-id mark. Texts that might name a special token aren't cut.
    """

    MARK, SPECIAL = b"|", b"<|"
    CUT = re.compile(rb"([!-&(-/:-@\[-`{-~])(?<=[a-z0-9].)")

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        from tokenizers import Tokenizer

        self.most = memo_words
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        mark = self._ids(self.MARK.decode())
        self.mark = mark[0] if len(mark) == 1 else None

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids  # without offsets

    def _learn(self, words: list[bytes]) -> None:
        plain = [w for w in words if self.mark is not None and self.MARK not in w]
        for at in range(0, len(plain), 2000):
            part = plain[at : at + 2000]
            ids = np.array(self._ids((b" " + self.MARK + b" ").join(part).decode()), dtype="<u4")
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == len(part) - 1:
                starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
                for word, a, b in zip(part, starts, ends, strict=True):
                    self.memo[word] = ids[a:b].tobytes()
        for word in words:
            if word not in self.memo:
                self.memo[word] = np.array(self._ids(word.decode()), dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return self.encode_bytes([t.encode() for t in texts])

    def encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """The same for texts in UTF-8."""
        raw = [t.lower() for t in texts]
        split = [(t if self.SPECIAL in t else self.CUT.sub(rb" \1", t)).split() for t in raw]
        if len(self.memo) > self.most:
            self.memo, self.older = {}, self.memo
        fresh = set().union(*split).difference(self.memo)
        if self.older and fresh:
            known = fresh & self.older.keys()  # what is still used moves on
            self.memo.update((w, self.older[w]) for w in known)
            fresh -= known
        if fresh:
            self._learn(list(fresh))
        get = self.memo.__getitem__
        return [b"".join(map(get, words)) for words in split]


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str, memo_words: int) -> WordTokenizer:
    return WordTokenizer(path, memo_words)


class Packer:
    """Packs (document, start, length) pieces; ``closed`` collects (piece, sequence, offset)."""

    def __init__(self, capacity: int, window_sequences: int, linear: float, quadratic: float, first_sequence: int) -> None:
        self.capacity, self.window = capacity, window_sequences * capacity
        self.linear, self.quadratic = linear, quadratic
        self.next_sequence = first_sequence
        self.waiting: list[tuple[int, int, int]] = []  # document, start, length
        self.tokens = 0
        self.closed: list[tuple[int, int, int, int, int]] = []

    def add(self, document: int, length: int) -> None:
        start = 0
        while length - start >= self.capacity:
            self.closed.append((document, start, self.capacity, self.next_sequence, 0))
            self.next_sequence += 1
            start += self.capacity
        if length > start:
            self.waiting.append((document, start, length - start))
            self.tokens += length - start
        if self.tokens >= self.window:
            self._pack([self.capacity] * (self.tokens // self.capacity))

    def finish(self) -> None:
        """Pack what waits: full sequences, then powers of two."""
        rest = self.tokens % self.capacity
        rooms = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
        self._pack([self.capacity] * (self.tokens // self.capacity) + rooms)

    def _pack(self, rooms: list[int]) -> None:
        room, cost = np.array(rooms, dtype=np.int64), np.zeros(len(rooms))
        filled = np.zeros(len(rooms), dtype=np.int64)
        left: list[tuple[int, int, int]] = []
        total = int(room.sum())
        for document, start, length in sorted(self.waiting, key=lambda x: -x[2]):
            while length:
                if not total:
                    left.append((document, start, length))
                    break
                fits = room >= length
                at = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
                n = min(length, int(room[at]))
                self.closed.append((document, start, n, self.next_sequence + at, int(filled[at])))
                room[at] -= n
                filled[at] += n
                cost[at] += self.linear * n + self.quadratic * n * n
                start, length, total = start + n, length - n, total - n
        self.next_sequence += len(rooms)
        self.waiting, self.tokens = left, sum(x[2] for x in left)


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
    window_sequences: int = 256,
    linear: float = 1.0,
    quadratic: float = 1.0 / 24576,
    with_ids: bool = False,
    memo_words: int = MEMO_WORDS,
) -> DataFrame:
    """One row per piece: ``<id>, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document is the ids of its text and ``end_id``; a null or empty text is ``end_id`` alone. Every id of
    every document is in exactly one piece; pieces of a sequence follow each other without gaps from offset 0.
    Rows that repeat a document are packed once each. Other columns are ignored; an empty table gives none.
    The default costs are those of a transformer of width 4096 (quadratic share n / 6 width).
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    id_type = dict(documents.dtypes)[id_column]
    end = int(end_id).to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path, memo_words)
        packer = Packer(capacity, window_sequences, linear, quadratic, TaskContext.get().partitionId() << 33)
        held: dict[int, tuple[object, bytes]] = {}  # documents with pieces that aren't closed
        number = 0

        def closed() -> pa.RecordBatch:
            rows = packer.closed
            packer.closed = []
            pieces = [held[d][1][4 * s : 4 * (s + n)] for d, s, n, _, _ in rows]
            columns = [
                pa.array([held[d][0] for d, *_ in rows], type=id_arrow),
                pa.array([s for _, s, *_ in rows], pa.int64()),
                pa.array([n for _, _, n, *_ in rows], pa.int64()),
                pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
                pa.array([len(held[d][1]) // 4 for d, *_ in rows], pa.int64()),
                pa.array([q for *_, q, _ in rows], pa.int64()),
                pa.array([o for *_, o in rows], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in pieces], pa.list_(pa.int32())))
            names = [id_column, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            waiting = {d for d, _, _ in packer.waiting}
            for d in [d for d in held if d not in waiting]:
                del held[d]
            return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

        id_arrow = pa.int64()
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                for key, ids in zip(part.column(0).to_pylist(), tokenizer.encode_bytes(texts), strict=True):
                    held[number] = (key, ids + end)
                    packer.add(number, len(ids) // 4 + 1)
                    number += 1
                if packer.closed:
                    yield closed()
        packer.finish()
        if packer.closed:
            yield closed()

    schema = f"`{id_column}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return documents.select(id_column, text_column).mapInArrow(pack, schema + (", ids array<int>" if with_ids else ""))
