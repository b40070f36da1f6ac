"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A sequence of tokens is what BPE makes of a piece exactly if each token is what BPE makes of its own
bytes and each neighbouring pair is what BPE makes of that pair's bytes. So the encoding of every prefix of a
piece ends in one known token, found from the encodings of shorter prefixes. A state of the transducer holds
just what the rest of the piece can depend on: the longest suffix that begins some token, and for each place
where a token that isn't finished may have begun the tokens that lead there. All of those share their first
tokens, which no later byte can change: they are emitted, so output lags by less than the longest token.
States and transitions are made when first needed and memoised (the memo is emptied at a bound, which changes
no output).

Decoding is a table from ids to bytes; text comes from a UTF-8 state machine over ids: an id whose bytes are
whole characters leaves the start state where it is, any other id moves the machine byte by byte.
"""

from __future__ import annotations

import base64
import contextlib
import functools
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Bounds of a worker's memos.
MEMO_CHUNKS, MEMO_STATES = 600_000, 600_000


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """BPE by its definition: join the neighbours of the lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(1 << 60, 0))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """The transducer of one vocabulary. A state is a number; 0 is the start of a piece.

    A state is (suffix, last emitted id, chains): ``suffix`` is the longest end of the input that begins a
    longer token, ``chains`` has for every such end, longest first and down to the empty one, the ids between
    the last emitted one and the place where it starts.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {b: a for a, b in ranks.items()}
        self.written = {n: n.to_bytes(4, "little") for n in self.tokens}
        self.begins = {t[:n] for t in ranks for n in range(len(t))}  # what a longer token can continue
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, bool] = {}
        self.moves: dict[tuple[bytes, int], tuple[list, list, bytes]] = {}
        self._clear()

    def _clear(self) -> None:
        start = (b"", -1, ((),))
        self.states = [start]
        self.numbers = {start: 0}
        self.steps: dict[int, int] = {}  # state << 8 | byte: the next state << 8, its bits inverted where ids are emitted
        self.outs: dict[int, bytes] = {}  # by the same key, where ids are emitted
        self.ends: dict[int, bytes] = {}  # by the same key: the ids that are left if the piece ends with that byte

    def _halves(self, token: int) -> tuple[int, int]:
        """The two ids whose merge makes the token; the token twice for a byte, (-1, -1) if merges don't make it."""
        if token not in self.halves:
            data = self.tokens[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best == 1 << 60:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = (token, token) if len(data) == 1 else (-1, -1) if len(parts) > 2 else (self.ranks[parts[0]], self.ranks[parts[1]])
        return self.halves[token]

    def _pair(self, left: int, right: int) -> bool:
        """Whether BPE leaves the bytes of two neighbouring ids as those ids.

        Merges across the border happen only if at some time the parts that touch there make a token of a
        lower rank than both sides' next merges: undo the merges from the last to the first and look.
        """
        limit, tokens, ranks = 1 << 60, self.tokens, self.ranks
        while True:
            if ranks.get(tokens[left] + tokens[right], 1 << 60) < limit:
                return False
            inner_left, inner_right = self._halves(left)[1], self._halves(right)[0]
            if (left > right or inner_right == right) and inner_left != left:
                limit, left = left, inner_left
            elif inner_right != right:
                limit, right = right + 1, inner_right
            else:
                return True

    def _move(self, suffix: bytes, byte: int) -> tuple[list, list, bytes]:
        """What a byte does to a suffix: (chain, id) of the tokens that may end, the chains that go on, the new suffix."""
        lengths = [n for n in range(len(suffix), -1, -1) if suffix[len(suffix) - n :] in self.begins]
        after = suffix + bytes([byte])
        ends = []
        for k, n in enumerate(lengths):
            token = self.ranks.get(after[len(after) - n - 1 :])
            if token is not None and self._halves(token)[0] >= 0:
                ends.append((k, token))
        on = [k for k, n in enumerate(lengths) if after[len(after) - n - 1 :] in self.begins]
        self.moves[suffix, byte] = out = (ends, on, after[len(after) - lengths[on[0]] - 1 :] if on else b"")
        return out

    def _chain(self, state: int, byte: int) -> tuple[tuple, list, bytes]:
        """The ids since the last emitted one if a token ends with this byte, the chains that go on, the new suffix."""
        suffix, emitted, chains = self.states[state]
        ends, on, after = self.moves.get((suffix, byte)) or self._move(suffix, byte)
        pairs = self.pairs
        for k, token in ends:  # the longest token that may end here first
            chain = chains[k]
            last = chain[-1] if chain else emitted
            if last >= 0:
                key = last << 32 | token
                good = pairs.get(key)
                if good is None:
                    if len(pairs) > 2 * MEMO_STATES:
                        pairs.clear()
                    good = pairs[key] = self._pair(last, token)
                if not good:
                    continue
            return (*chain, token), on, after
        raise ValueError("the vocabulary lacks a byte")

    def _end(self, key: int) -> bytes:
        """What a piece's last byte emits: no state is made for it."""
        self.ends[key] = out = b"".join([self.written[t] for t in self._chain(key >> 8, key & 255)[0]])
        return out

    def _step(self, state: int, byte: int) -> int:
        chain, on, after = self._chain(state, byte)
        _, emitted, chains = self.states[state]
        going = [chains[k] for k in on]
        key = state << 8 | byte
        first, emits = chain[0], False
        for c in going:
            if not c or c[0] != first:
                going.append(chain)
                break
        else:  # ids that every way has begun with are sure
            going.append(chain)
            least, sure, emits = min(map(len, going)), 1, True
            while sure < least and all(c[sure] == chain[sure] for c in going):
                sure += 1
            self.outs[key] = b"".join([self.written[t] for t in chain[:sure]])
            emitted, going = chain[sure - 1], [c[sure:] for c in going]
        target = (after, emitted, tuple(going))
        number = self.numbers.get(target)
        if number is None:
            number = self.numbers[target] = len(self.states)
            self.states.append(target)
        self.steps[key] = number = ~(number << 8) if emits else number << 8
        return number

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids (32-bit, little-endian) of one piece, in a single left-to-right pass."""
        if not piece:
            return b""
        if len(self.states) > MEMO_STATES or len(self.ends) > MEMO_STATES:
            self._clear()
        step, state, out = self.steps.get, 0, []
        for byte in piece[:-1]:
            key = state | byte
            state = step(key)
            if state is None:
                state = self._step(key >> 8, byte)
            if state < 0:
                state = ~state
                out.append(self.outs[key])
        key = state | piece[-1]
        end = self.ends.get(key)
        out.append(self._end(key) if end is None else end)
        return b"".join(out)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    #: Where the pattern surely begins a match: at ASCII punctuation (but for the apostrophe) after an ASCII
    #: letter or digit. Texts with other white space than single spaces and line feeds are split by the pattern itself.
    CUT = re.compile(r"([!-&(-/:-@\[-`{-~])(?<=[A-Za-z0-9].)")
    ODD = re.compile(r"[\0\t\r\v\f\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.transducer = Transducer(self.ranks)
        self.tokens = {b: a for a, b in self.ranks.items()}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the memo before: what is still used moves on to the new one
        self.clean = np.zeros(max(self.tokens) + 1, dtype=bool)  # ids that are whole characters
        for number, token in self.tokens.items():
            try:
                token.decode()
                self.clean[number] = True
            except UnicodeDecodeError:
                pass

    def _piece(self, piece: bytes) -> bytes:
        number = self.ranks.get(piece)  # a piece that is a token is that token
        return self.transducer.encode_piece(piece) if number is None else self.transducer.written[number]

    def _chunk(self, text: str) -> bytes:
        if text[1:].isalpha() and text[0] == " ":
            return self._piece(text.encode())
        return b"".join([self._piece(piece.encode()) for piece in self.pattern.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids of a text (32-bit, little-endian).

        A match of the pattern holds a space only at its start or within white space, so a text is cut before
        each single space that stands between other characters, around single line feeds and before punctuation, and
        ids are memoised by such chunks.
        """
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " " or text[-1:] == " " or self.ODD.search(text):
            chunks = self.pattern.findall(text)
        else:
            chunks = self.CUT.sub("\0\\1", text).replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        if len(self.memo) > MEMO_CHUNKS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        for chunk in [c for c in set(chunks) if c not in memo]:
            ids = older.get(chunk)
            memo[chunk] = (self._chunk(chunk) if chunk else b"") if ids is None else ids
        out = b"".join(map(memo.__getitem__, chunks))
        if len(text) > 100_000:  # a long text may be one chunk
            self.memo = {c: i for c, i in memo.items() if len(c) <= 1000}
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of a stream of ids, chunk by chunk: only whole characters come out; malformed bytes come out
        as U+FFFD, as does a character that is unfinished at the end."""
        machine = Utf8Machine()
        for ids in chunks:
            out, at = [], 0
            for odd in [*np.flatnonzero(~self.clean[ids]).tolist(), len(ids)]:
                if odd > at:
                    out.append(machine.broken() if machine.need else "")
                    out.append(self.decode(ids[at:odd]).decode())
                if odd < len(ids):
                    out.append(machine.feed(self.tokens[int(ids[odd])]))
                at = odd + 1
            yield "".join(out)
        yield machine.broken() if machine.need else ""


class Utf8Machine:
    """Incremental UTF-8: ``need`` bytes are missing of the character whose bytes so far are in ``held``."""

    def __init__(self) -> None:
        self.need, self.held, self.low, self.high = 0, b"", 0x80, 0xBF

    def broken(self) -> str:
        self.need, self.held = 0, b""
        return "�"

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.need and not self.low <= byte <= self.high:
                out.append(self.broken())
            if self.need:
                self.held += bytes([byte])
                self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                if not self.need:
                    out.append(self.held.decode())
                    self.held = b""
            elif byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.need = 1 + (byte >= 0xE0) + (byte >= 0xF0)
                self.held = bytes([byte])
                # the second byte's range excludes overlong forms, surrogates and values past U+10FFFF
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("�")
        return "".join(out)


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Within this no cycles are looked for: none are made, and each search would walk the memos."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(documents: DataFrame, rank_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``<id>, ids array<int>``. A null text is an empty one; other columns are ignored."""
    id_type = dict(documents.dtypes)[id_column]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(rank_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                with uncollected():
                    ids = [np.frombuffer(codec.encode(t or ""), "<u4").astype(np.int32) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_column, "ids"])

    return documents.select(id_column, text_column).mapInArrow(encode, f"`{id_column}` {id_type}, ids array<int>")


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str, id_column: str = "doc_id", ids_column: str = "ids", chunk: int = 4096) -> DataFrame:
    """One row per document: ``<id>, text``, decoded in chunks of ids. Null ids give a null text."""
    id_type = dict(encoded.dtypes)[id_column]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(rank_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = []
                for ids in part.column(1):
                    if not ids.is_valid:
                        texts.append(None)
                        continue
                    array = np.asarray(ids.values)
                    texts.append("".join(codec.stream(array[i : i + chunk] for i in range(0, len(array), chunk))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    return encoded.select(id_column, ids_column).mapInArrow(decode, f"`{id_column}` {id_type}, text string")


def round_trip(documents: DataFrame, rank_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = 4096) -> DataFrame:
    """Encode every text, decode the ids as a stream, and give the digests of both:
    ``<id>, n_tokens, ids_sha256, decoded_sha256``. A null text is an empty one; other columns are ignored."""
    id_type = dict(documents.dtypes)[id_column]

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(rank_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, shas, decoded = [], [], []
                with uncollected():
                    for text in part.column(1).to_pylist():
                        raw = codec.encode(text or "")
                        ids = np.frombuffer(raw, "<u4")
                        counts.append(len(ids))
                        shas.append(hashlib.sha256(raw).hexdigest())
                        back = hashlib.sha256()
                        for piece in codec.stream(ids[i : i + chunk] for i in range(0, len(ids), chunk)):
                            back.update(piece.encode())
                        decoded.append(back.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(shas), pa.array(decoded)],
                    [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents.select(id_column, text_column).mapInArrow(both, f"`{id_column}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
