"""Personal data: patterns, and a skip-chain conditional random field that spreads labels to look-alikes.

Patterns find e-mail addresses, IPv4 addresses, card numbers and phone numbers; those spans are always
reported. The field looks at all mentions, i.e. number-like strings and strings with an at sign. Its nodes
are a document's mentions, its labels "none" and the four kinds. Each node has log-linear potentials over its
shape; neighbours in the text have transition potentials; and mentions that are equal or end in the same
digits, wherever they stand, share a skip potential that favours equal labels. Mentions which a pattern has
found are fixed to its kind. Loopy sum-product passes messages along both kinds of edges; a free mention whose
most likely label is a kind, with enough of the probability, is added. Skip edges run from each free mention of a group to
one that a pattern has found, if there is one, else to the next of its group, so a string that occurs n times has at most n - 1 of them
and what is known of it is one step away from all of them. Neighbours that are also linked by a skip edge share one factor.

All weights, of shapes, transitions and the skip potential, are fitted together by pseudo-likelihood (each label given its
neighbours' along both kinds of edges), on mentions of a bounded sample of documents. They are labelled by the patterns; a free mention
has the label of its group's mentions that a pattern found.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]

# The starts are pinned to the start of a run: a match from within one would have matched from its start.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
MENTION = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}|(?<![0-9A-Za-z])[+(]?[0-9](?:[\x20().-]{0,2}[0-9])++(?![0-9A-Za-z])")

Span = tuple[int, int, int]  # number of the kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at signs in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """All pattern spans, by kind, then start."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(x := p.lstrip("0")) <= 3 and int(x or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


class Mention:
    """A node: its span, shape features, group for skip edges, and the label a pattern gave it (or -1)."""

    __slots__ = ("end", "features", "group", "label", "start")

    def __init__(self, text: str, start: int, end: int, label: int) -> None:
        self.start, self.end, self.label = start, end, label
        body = text[start:end]
        digits = "".join(c for c in body if "0" <= c <= "9")
        at = "@" in body
        self.group = body.lower().strip(".,;:()<>\"'") if at else digits[-7:] if len(digits) >= 7 else None
        self.features = (
            "at" if at else "no_at",
            f"digits{min(len(digits), 20) // 2}" if not at else "digits_at",
            f"dots{min(body.count('.'), 4)}" if not at else f"domain_dots{min(body.rpartition('@')[2].strip('.').count('.'), 2)}",
            f"plus{int(body.startswith('+'))}",
            f"parens{int('(' in body)}",
            f"gaps{min(body.count(' ') + body.count('-'), 4)}",
        )


def mentions(text: str, found: list[Span]) -> list[Mention]:
    """The pattern spans and the mentions that overlap none of them, in order of start."""
    out, end = [], -1
    spans = sorted((a, b, k) for k, a, b in found)
    for a, b, k in spans:
        if a >= end:  # of overlapping kinds the first stands for all as a node
            out.append(Mention(text, a, b, k + 1))
        end = max(end, b)
    j, covered = 0, 0
    for m in MENTION.finditer(text):
        a, b = m.span()
        while j < len(spans) and spans[j][0] < b:
            covered = max(covered, spans[j][1])
            j += 1
        if covered <= a and not any(spans[i][0] < b and spans[i][1] > a for i in range(max(0, j - 4), j)):
            out.append(Mention(text, a, b, -1))
    out.sort(key=lambda x: x.start)
    return out


def skip_edges(nodes: list[Mention]) -> list[tuple[int, int]]:
    groups: dict[str, list[int]] = {}
    for i, node in enumerate(nodes):
        if node.group is not None:
            groups.setdefault(node.group, []).append(i)
    edges = []
    for own in groups.values():
        known = [i for i in own if nodes[i].label >= 0]
        if known:
            edges += [(min(known[0], i), max(known[0], i)) for i in own if nodes[i].label < 0]
        else:
            edges += list(zip(own, own[1:], strict=False))
    return edges


#: What a label's neighbours are: features, own label, labels before and after (-1: none), and those over skip edges, in order.
Setting = tuple[tuple[str, ...], int, int, int, tuple[int, ...]]


def settings(nodes: list[Mention]) -> Iterator[Setting]:
    """Each node's, for the fit."""
    by_group = {x.group: x.label for x in nodes if x.label >= 0 and x.group is not None}
    labels = [x.label if x.label >= 0 else by_group.get(x.group, 0) for x in nodes]
    linked: list[list[int]] = [[] for _ in nodes]
    for i, j in skip_edges(nodes):
        linked[i].append(labels[j])
        linked[j].append(labels[i])
    for i, x in enumerate(nodes):
        # of many equal ones, as of a mention that a hundred free ones refer to, three tell as much
        few = [k for label in sorted(set(linked[i])) for k in [label] * min(3, linked[i].count(label))]
        yield x.features, labels[i], labels[i - 1] if i else -1, labels[i + 1] if i + 1 < len(nodes) else -1, tuple(few)


class SkipChainField:
    """Weights and inference."""

    def __init__(self, counts: Counter, penalty: float = 1.0, rounds: int = 300, prior_skip: float = 4.0) -> None:
        """``counts`` of settings. The pseudo-log-likelihood with an L2 penalty is climbed for all weights at once. The skip
        weight is drawn to ``prior_skip``, as a sample may have few repeated mentions or none; all others to 0."""
        rows = sorted(counts)
        names = sorted({f for r in rows for f in r[0]})
        self.index = {f: i for i, f in enumerate(names)}
        size = len(LABELS)
        x = np.zeros((len(rows), len(names) + 1))
        x[:, -1] = 1
        y, n = np.zeros((len(rows), size)), np.array([counts[r] for r in rows], dtype=float)
        before, after, skips = (np.zeros((len(rows), size)) for _ in range(3))
        for i, (features, label, left, right, linked) in enumerate(rows):
            x[i, [self.index[f] for f in features]] = 1
            y[i, label] = 1
            if left >= 0:
                before[i, left] = 1
            if right >= 0:
                after[i, right] = 1
            for k in linked:
                skips[i, k] += 1
        self.weights, self.step, self.skip = np.zeros((len(names) + 1, size)), np.zeros((size, size)), prior_skip
        shrink = min(0.1, penalty / max(n.sum(), 1))  # a prior of variance 1 / penalty, whatever the sample's size
        n = n / max(n.sum(), 1)
        for _ in range(rounds if rows else 0):
            z = x @ self.weights + before @ self.step + after @ self.step.T + self.skip * skips
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (y - p) * n[:, None]
            self.weights += 2.0 * (x.T @ error - shrink * self.weights)
            self.step += 1.0 * (before.T @ error + error.T @ after - shrink * self.step)
            self.skip += 2.0 * (float((error * skips).sum()) - shrink * (self.skip - prior_skip))

    def unary(self, node: Mention) -> np.ndarray:
        out = self.weights[-1].copy()
        for f in node.features:
            if f in self.index:
                out += self.weights[self.index[f]]
        return out

    def marginals(self, nodes: list[Mention], rounds: int = 100) -> np.ndarray:
        """Label probabilities of each node by loopy sum-product, until messages no longer change (or for ``rounds``)."""
        size = len(LABELS)
        local = np.array([self.unary(x) for x in nodes])
        for i, node in enumerate(nodes):
            if node.label >= 0:
                local[i] = np.where(np.arange(size) == node.label, 0.0, -60.0)
        local -= local.max(axis=1, keepdims=True)
        factors = {(i, i + 1): self.step for i in range(len(nodes) - 1)}
        same = self.skip * np.eye(size)
        for pair in skip_edges(nodes):
            factors[pair] = factors[pair] + same if pair in factors else same
        if not factors:
            p = np.exp(local)
            return p / p.sum(axis=1, keepdims=True)
        ends = np.array(list(factors))
        source, target = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
        factor = np.exp(np.array([*factors.values(), *(f.T for f in factors.values())]))
        back = np.roll(np.arange(len(source)), len(ends))
        message = np.zeros((len(source), size))
        for _ in range(rounds):
            belief = local.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ea,eab->eb", out, factor) + 1e-300)
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - message).max()
            message = 0.5 * (message + new)
            if change < 1e-4:
                break
        belief = local.copy()
        np.add.at(belief, target, message)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, found: list[Span], least: float) -> list[Span]:
        """Spans of free mentions that the field labels with a kind."""
        nodes = mentions(text, found)
        if not any(x.label < 0 for x in nodes):
            return []
        p = self.marginals(nodes)
        best = p.argmax(axis=1)
        return [(int(best[i]) - 1, x.start, x.end) for i, x in enumerate(nodes) if x.label < 0 and best[i] > 0 and p[i, best[i]] >= least]


def fit_field(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample_documents: int = 20_000) -> SkipChainField:
    """Weights from about ``sample_documents`` documents, chosen by a hash of the identifier (a fixed share of all)."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    total = rows.select("id").count()
    share = min(1.0, sample_documents / max(total, 1))
    h = F.xxhash64(F.lit("personal"), "id").bitwiseAND(F.lit((1 << 62) - 1))
    sample = rows.where((h < F.lit(int(share * (1 << 62)))) | F.lit(share >= 1.0)).where(F.col("text").rlike("[0-9@]")).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(json.dumps(x) for x in settings(mentions(text, base_spans(text))))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["setting", "n"])

    # one row a setting: their number has a bound, that of shapes times labels around, whatever the sample
    found: Counter = Counter()
    for setting, n in sample.mapInArrow(count, "setting string, n bigint").groupBy("setting").agg(F.sum("n")).collect():
        features, label, left, right, linked = json.loads(setting)
        found[tuple(features), label, left, right, tuple(linked)] += n
    return SkipChainField(found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(documents: DataFrame, field: SkipChainField, id_column: str = "doc_id", text_column: str = "text", least: float = 0.9) -> DataFrame:
    """One row per document: ``<id>, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Counts and digest cover the patterns' spans; ``spans`` has those and the field's, as kind:start:end
    (code points, end exclusive) by kind, then start. A null text is an empty one; rows that repeat are kept and alike; an empty table
    gives no rows; a very long text is one task's, in memory its mentions only; ties between labels go to the first in the list
    of kinds. Other columns are ignored.
    """
    id_type = dict(documents.dtypes)[id_column]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                found = base_spans(text) if text and ANY.search(text) else []
                more = field.added(text, found, least) if text and (found or ANY.search(text)) else []
                kinds = Counter(k for k, _, _ in found)
                counts.append([kinds[k] for k in range(4)])
                digests.append(hashlib.sha256(written(found).encode()).hexdigest())
                spans.append(written(found + more))
            table = np.array(counts, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(table[:, k]) for k in range(4)), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                [id_column, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    schema = f"`{id_column}` {id_type}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return documents.select(id_column, text_column).mapInArrow(find, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together) replaced by its kind in brackets."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_personal_data(documents: DataFrame, field: SkipChainField, text_column: str = "text", least: float = 0.9) -> DataFrame:
    """The same rows and columns with personal data in the text masked; null texts stay null."""
    at = documents.columns.index(text_column)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 500) for b in batches for first in range(0, b.num_rows, 500)):
            out = []
            for text in batch.column(at).to_pylist():
                if text and ANY.search(text):
                    found = base_spans(text)
                    text = masked(text, found + field.added(text, found, least))
                out.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], documents_columns)

    documents_columns = documents.columns
    return documents.mapInArrow(mask, documents.schema)
