"""Language identification by interpolated Kneser-Ney character language models.

Each language has a model of character n-grams within words (a word is a run of letters with a border mark on
both sides, so a context never crosses a border). All levels are interpolated Kneser-Ney: raw counts at the
top, continuation counts below, a uniform distribution over the alphabet at the bottom. A model is two sorted
arrays of 64-bit hashes per level: n-grams with their discounted probability and contexts with their
interpolation weight, found by binary search.

The prediction is the language of the lowest cross-entropy per character. A text is rejected when that
cross-entropy is above its language's bound, which texts kept out of the counts calibrate: half-way between
the 95th percentile of the language's own and the median of the other languages' texts, neither of which a few wrong
labels move. A text of n characters has a share of 1 / sqrt(n) more, as short texts vary more.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrid.llm.common import trim_worker

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
BORDER = 0
#: Words whose scores a worker keeps; emptied beyond that, which changes no result.
MEMO_WORDS = 120_000


def _hash_rows(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(codes), 0x9E3779B97F4A7C15 ^ codes.shape[1], dtype=np.uint64)
    for k in range(codes.shape[1]):
        h = (h ^ codes[:, k]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


class SortedHashes:
    """A map from strings of one length to a vector of numbers (one a language): hashes in order, and their vectors."""

    def __init__(self, maps: list[dict[str, float]], length: int) -> None:
        rows = list(set().union(*maps))
        codes = np.array([[ord(c) for c in r] for r in rows], dtype=np.uint64)
        keys = _hash_rows(codes.reshape(len(rows), length))
        values = np.array([[m.get(r, 0.0) for m in maps] for r in rows]).reshape(len(rows), len(maps))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of the keys; zeros for those that are absent."""
        if not len(self.keys):
            return np.zeros((len(keys), self.values.shape[1]))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys)[:, None], self.values[at], 0.0)


def gram_counts(words: Counter, order: int) -> Counter:
    """The n-grams that end at each letter and at the closing border of each word, as long as the order and the word allow."""
    out: Counter = Counter()
    for word, n in words.items():
        text = chr(BORDER) + word + chr(BORDER)
        for i in range(1, len(text)):
            out[text[max(0, i - order + 1) : i + 1]] += n
    return out


def kneser_ney(counts: Counter, order: int, discount: float = 0.75) -> tuple[int, list[dict], list[dict]]:
    """One language's model from its ``gram_counts``: the size of its alphabet and, for n-grams of length 1 to ``order``, the
    discounted probabilities of n-grams and the interpolation weights of contexts."""
    by_length: list[Counter] = [Counter() for _ in range(order + 1)]
    for gram, n in counts.items():
        by_length[len(gram)][gram] += n
    grams: list[dict] = [{} for _ in range(order)]
    contexts: list[dict] = [{} for _ in range(order)]
    for length in range(order, 0, -1):
        level, totals, kinds = by_length[length], Counter(), Counter()
        for gram, n in level.items():
            totals[gram[:-1]] += n
            kinds[gram[:-1]] += 1
            if length > 1:
                by_length[length - 1][gram[1:]] += 1  # continuation: in how many ways it is preceded
        grams[length - 1] = {g: max(n - discount, 0.0) / totals[g[:-1]] for g, n in level.items()}
        contexts[length - 1] = {c: discount * kinds[c] / totals[c] for c in totals}
    return len(by_length[1]) + 1, grams, contexts


class LanguageModels:
    """The models of all languages (from their ``gram_counts``), and the bounds above which texts are rejected."""

    def __init__(self, counts: dict[str, Counter], order: int) -> None:
        self.languages, self.order = sorted(counts), order
        fitted = [kneser_ney(counts[x], order) for x in self.languages]
        self.floor = np.array([1.0 / f[0] for f in fitted])
        self.grams = [SortedHashes([f[1][k] for f in fitted], k + 1) for k in range(order)]
        self.contexts = [SortedHashes([f[2][k] for f in fitted], k) for k in range(order)]
        self.bounds = np.full(len(self.languages), np.inf)
        self.memo: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)))
        self.lengths = np.zeros(0)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}, "scores": np.zeros((0, len(self.languages))), "lengths": np.zeros(0)}

    def _log2(self, codes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log2 probability of each position (row) under each language; ``before``: positions of its word before it."""
        p = np.tile(self.floor, (len(codes), 1))
        for length in range(1, self.order + 1):
            at = np.flatnonzero(before >= length - 1)
            window = np.stack([codes[at - length + 1 + k] for k in range(length)], axis=1).astype(np.uint64)
            weight = self.contexts[length - 1].get(_hash_rows(window[:, :-1]))
            p[at] = np.where(weight > 0, self.grams[length - 1].get(_hash_rows(window)) + weight * p[at], p[at])
        return np.log2(p)

    def _learn(self, words: list[str]) -> None:
        codes = np.array([c for w in words for c in (BORDER, *map(ord, w), BORDER)], dtype=np.int64)
        lengths = np.array([len(w) + 2 for w in words])
        offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        before = np.arange(len(codes)) - np.repeat(offsets, lengths)
        bits = np.where((before > 0)[:, None], -self._log2(codes, before), 0.0)  # the opening border is given
        first = len(self.scores)
        self.scores = np.concatenate([self.scores, np.add.reduceat(bits, offsets, axis=0)])
        self.lengths = np.concatenate([self.lengths, lengths - 1.0])
        self.memo.update(zip(words, range(first, first + len(words)), strict=True))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text (row) under each language (column), NaN without letters; and its characters."""
        if len(self.memo) > MEMO_WORDS:
            self.__dict__.update(self.__getstate__())
        split = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        fresh = list(set().union(*split).difference(self.memo)) if split else []
        for at in range(0, len(fresh), 8000):
            self._learn(fresh[at : at + 8000])
        get = self.memo.__getitem__
        out, sizes = np.full((len(texts), len(self.languages)), np.nan), np.zeros(len(texts))
        for i, words in enumerate(split):
            if words:
                at = np.fromiter(map(get, words), dtype=np.int64, count=len(words))
                sizes[i] = self.lengths[at].sum()
                out[i] = self.scores[at].sum(axis=0) / sizes[i]
        return out, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected, for each text."""
        bits, sizes = self.entropies(texts)
        known = ~np.isnan(bits).any(axis=1) if self.languages else np.zeros(len(texts), dtype=bool)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        best = np.argmin(np.where(np.isnan(bits), np.inf, bits), axis=1)
        least = bits[np.arange(len(texts)), best]
        share = np.exp2(-4 * (bits - least[:, None])).sum(axis=1)
        score = np.where(known, 1 / share, 0.0)
        rejected = ~known | (least > self.bounds[best] * (1 + 1 / np.sqrt(np.maximum(sizes, 1))))
        return [self.languages[b] if k else "und" for b, k in zip(best, known, strict=True)], np.nan_to_num(score), rejected

    def calibrate(self, texts: list[str], languages: list[str]) -> None:
        bits, _ = self.entropies(texts)
        for k, name in enumerate(self.languages):
            mine = np.array([x == name for x in languages])
            valid = ~np.isnan(bits[:, k])
            own, other = bits[mine & valid, k], bits[~mine & valid, k]
            if len(own) > 1:
                high = np.percentile(own, 95)
                self.bounds[k] = (high + max(np.median(other) if len(other) else 0, 1.5 * high)) / 2


def fit_languages(
    labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", order: int = 4, sample_per_language: int = 1000, calibration_per_language: int = 250
) -> LanguageModels:
    """Models of the labels of ``labelled`` (rows with a null label or text are left out).

    The counts come from a bounded sample: the ``sample_per_language`` rows of each label with the smallest
    hash of the identifier; the next ``calibration_per_language`` set the bounds of rejection. Only the counts
    of n-grams of the sample and the calibration texts come to the driver.
    """
    rows = labelled.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label")).where(F.col("label").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    wanted = sample_per_language + calibration_per_language
    h = F.xxhash64(F.lit("language"), "id").bitwiseAND(F.lit((1 << 62) - 1)) / F.lit(float(1 << 62))
    # a first cut by hash leaves about twice the sample, so that the exact cut ranks only so many rows
    share = F.lit(1.0)
    for name, n in sizes.items():
        share = F.when(F.col("label") == name, F.lit(min(1.0, 2.0 * (wanted + 50) / n))).otherwise(share)
    ranked = (
        rows.withColumn("h", h)
        .where(F.col("h") <= share)
        .withColumn("k", F.row_number().over(Window.partitionBy("label").orderBy("h", "id", "text")))
        .where(F.col("k") <= wanted)
        .select("label", "text", "k")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.setdefault(label, Counter()).update(LETTERS.findall(text.lower()))
        for label, words in counts.items():
            grams = gram_counts(words, order)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(grams), pa.string()), pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["label", "gram", "n"])

    # every fifth of a small label's sample goes to calibration where there aren't rows enough for both
    every = F.lit(5)
    held = F.when(F.col("k") > sample_per_language, True).otherwise((F.col("k") % every == 0) & F.col("label").isin([x for x, n in sizes.items() if n <= wanted]))
    ranked = ranked.withColumn("held", held)
    counted = ranked.where(~F.col("held")).select("label", "text").mapInArrow(count, "label string, gram string, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = {}
    for label, gram, n in counted.collect():
        counts.setdefault(label, Counter())[gram] = n
    models = LanguageModels(counts, order)
    kept = ranked.where("held").select("label", "text").collect()
    models.calibrate([r[1] for r in kept], [r[0] for r in kept])
    return models


def identify_languages(documents: DataFrame, models: LanguageModels, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: the identifier) and ``lang_pred, score, rejected`` for every document.

    ``lang_pred`` is ``und`` and the score 0 if the text is null or has no letter (such a text is rejected).
    The score is the share of the best language in 2^(-4 * bits per character) over all languages. Rows that repeat are judged
    alike, of equal cross-entropies the first language by name wins, a very long text is held by one task as its words; an empty
    table gives no rows. Kept columns with the names of the results aren't allowed; other columns are ignored.
    """
    kept = keep or [id_column]
    if clash := {"lang_pred", "score", "rejected"} & set(kept):
        raise ValueError(f"columns of the result: {', '.join(sorted(clash))}")
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(models)  # bounded by the sample
    fields = [f for f in documents.select(*kept).schema.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double, rejected boolean"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                languages, score, rejected = own.predict(part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], pa.array(languages, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    [*kept, "lang_pred", "score", "rejected"],
                )
        own.__dict__.update(own.__getstate__())  # the memo goes with the task
        trim_worker()

    return documents.select(*kept, F.col(text_column).alias("__text")).mapInArrow(predict, ddl)
