"""Quality classifier from weak labels.

Overlapping heuristics vote on every document. Expectation-maximisation over the counts of vote patterns
estimates how far each heuristic can be trusted; the posterior labels then train a linear scorer on hashed
word and shape features, which judges all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketloom.llm.common import BY_BLANKS, Words, keyed, mix, slices, store, sums_by

GOOD, BAD, NONE = 1, 0, 2
BITS = 16
SAMPLE_PER_CLASS = 2000
# Each heuristic votes bad above the first bound and good below the second (or, where the
# first is smaller, bad below it and good above the second); it abstains between them.
HEURISTICS = {
    "capitals": (0.35, 0.10),
    "symbol_ends": (0.20, 0.05),
    "repeated_words": (0.25, 0.05),
    "wordless_tokens": (0.15, 0.05),
    "variety": (0.30, 0.55),
    "punctuation": (0.15, 0.08),
    "token_length": (20.0, 15.0),
}
SHORT_WORDS = 20
# Different words are counted in runs of at most this many, as their share falls with the length of what is counted.
RUN_WORDS = 200
# Added to the word count that shares are taken of, so that a few words alone do not decide.
FEW_WORDS = 10
UPPER, LETTER, DIGIT, OTHER = 1, 2, 4, 8
KINDS = np.full(256, OTHER, np.uint8)
KINDS[65:91] = UPPER | LETTER
KINDS[97:123] = KINDS[128:] = LETTER
KINDS[48:58] = DIGIT
SHAPES = np.arange(256, dtype=np.uint8)
SHAPES[65:91], SHAPES[97:123], SHAPES[128:], SHAPES[48:58] = ord("A"), ord("a"), ord("a"), ord("0")


def _per_word(words: Words, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def _per_text(words: Words, values: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[words.first[1:]] - total[words.first[:-1]]


def _variety(words: Words, codes: np.ndarray) -> np.ndarray:
    """The share of different words in each text: the mean over its runs of (nearly) equal size, all words counted."""
    n = np.diff(words.first)
    parts = -(-n // RUN_WORDS)
    place = np.arange(len(words)) - np.repeat(words.first[:-1], n)
    run = np.repeat(np.cumsum(parts) - parts, n) + place * np.repeat(parts, n) // np.repeat(np.maximum(n, 1), n)
    kinds = int(codes.max(initial=0)) + 1
    total = int(parts.sum())
    distinct = np.bincount(np.unique(run * kinds + codes) // kinds, minlength=total)
    shares = np.concatenate(([0.0], np.cumsum(distinct / np.maximum(np.bincount(run, minlength=total), 1))))
    ends = np.concatenate(([0], np.cumsum(parts)))
    return (shares[ends[1:]] - shares[ends[:-1]]) / np.maximum(parts, 1)


def measures(words: Words, codes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The word counts of the texts, and what the heuristics look at."""
    kinds = KINDS[words.data]
    n = np.diff(words.first)
    size = np.diff(words.offsets)
    some = np.maximum(n, 1)
    letters = _per_word(words, (kinds & LETTER) > 0)
    other = (kinds & OTHER) > 0
    ends = np.zeros(len(words), bool)
    long = size >= 2
    ends[long] = other[words.offsets[1:][long] - 1] & other[words.offsets[1:][long] - 2]
    solid = letters + _per_word(words, (kinds & DIGIT) > 0) > 0
    text = np.repeat(np.arange(len(n)), n)
    again = np.zeros(len(words), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])
    sizes = np.maximum(_per_text(words, size), 1)
    return n, {
        "capitals": _per_text(words, _per_word(words, (kinds & UPPER) > 0)) / np.maximum(_per_text(words, letters), 1),
        "symbol_ends": _per_text(words, ends & solid) / some,
        "repeated_words": _per_text(words, again) / some,
        "wordless_tokens": _per_text(words, ~solid) / some,
        "variety": _variety(words, codes),
        "punctuation": _per_text(words, _per_word(words, other)) / sizes,
        "token_length": sizes / some,
    }


def votes(words: Words, codes: np.ndarray) -> np.ndarray:
    """One row for each text, one vote for each heuristic. Texts without words get bad votes only."""
    n, found = measures(words, codes)
    out = np.full((len(n), len(HEURISTICS)), NONE, np.int8)
    for i, (name, (bad, good)) in enumerate(HEURISTICS.items()):
        value = found[name]
        worse, better = (value > bad, value < good) if bad > good else (value < bad, value > good)
        out[worse, i], out[better, i] = BAD, GOOD
        if name == "variety":
            out[n < SHORT_WORDS, i] = NONE
    out[n == 0] = BAD
    return out


def pattern_of(rows: np.ndarray) -> np.ndarray:
    return rows.astype(np.int64) @ (3 ** np.arange(rows.shape[1]))


@dataclass
class LabelModel:
    """log_good, log_bad: the log-probability of each vote of each heuristic in either class."""

    prior_good: float
    log_good: np.ndarray
    log_bad: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability that documents with these vote patterns are good."""
        m = len(self.log_good)
        rows = (patterns[:, None] // 3 ** np.arange(m)) % 3
        at = np.arange(m)
        margin = self.log_good[at, rows].sum(axis=1) - self.log_bad[at, rows].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin + np.log(self.prior_good / (1 - self.prior_good)), -50, 50)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, m: int, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over all documents, by way of the counts of their at most 3**m patterns."""
    rows = (patterns[:, None] // 3 ** np.arange(m)) % 3
    good = np.where((rows == BAD).any(axis=1), 0.1, 0.9)
    model = LabelModel(0.5, np.zeros((m, 3)), np.zeros((m, 3)))
    for _ in range(rounds):
        tables = []
        for weight in (counts * good, counts * (1 - good)):
            votes = np.stack([np.bincount(rows[:, i], weights=weight, minlength=3) for i in range(m)]) + 0.5
            tables.append(np.log(votes / votes.sum(axis=1, keepdims=True)))
        prior = ((counts * good).sum() + 1) / (counts.sum() + 2)
        model = LabelModel(float(np.clip(prior, 1e-6, 1 - 1e-6)), *tables)
        now = model.posterior(patterns)
        if np.abs(now - good).max(initial=0) < 1e-9:
            break
        good = now
    return model


def _buckets(strings: pa.Array, seed: int) -> np.ndarray:
    hashes = np.fromiter((xxh64_intdigest(s, seed) for s in strings.to_pylist()), np.uint64, len(strings))
    return (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _shape_buckets(strings: pa.Array) -> np.ndarray:
    """The bucket of each string's shape: letters, capitals and digits as one sign each, runs as one."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    shapes = SHAPES[np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]] if len(strings) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    keep = np.ones(len(shapes), bool)
    keep[1:] = shapes[1:] != shapes[:-1]
    keep[offsets[:-1]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    buffers = [None, pa.py_buffer(total[offsets].astype(np.int64)), pa.py_buffer(shapes[keep])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(strings), buffers).dictionary_encode()
    return _buckets(coded.dictionary, 2)[np.asarray(coded.indices)]


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, word buckets and shape buckets of the distinct words, buckets of the texts' own measures)."""
    codes, distinct = words.encoded()
    n, found = measures(words, codes)
    bins = np.stack([np.minimum(found[name] * 20, 19).astype(np.int64) for name in ("repeated_words", "wordless_tokens", "variety")])
    bins = np.vstack((bins, np.minimum(np.log2(n + 1).astype(np.int64), 19)))
    bins = np.where(n == 0, 20, bins) + 32 * np.arange(len(bins))[:, None]
    own = (mix(bins.astype(np.uint64) + np.uint64(1 << 50)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return codes, _buckets(distinct, 1), _shape_buckets(distinct), own


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        words = Words(texts, BY_BLANKS)
        codes, by_word, by_shape, own = features(words)
        each = (self.weights[by_word] + self.weights[by_shape])[codes]
        n = np.diff(words.first) + FEW_WORDS
        margin = self.bias + _per_text(words, each) / n + self.weights[own].sum(axis=0)
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def _sparse(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    words = Words(texts, BY_BLANKS)
    codes, by_word, by_shape, own = features(words)
    out = []
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        buckets = np.concatenate((by_word[codes[a:b]], by_shape[codes[a:b]]))
        distinct, counts = np.unique(buckets, return_counts=True)
        out.append((np.concatenate((distinct, own[:, i])), np.concatenate((counts / (b - a + FEW_WORDS), np.ones(len(own))))))
    return out


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 400, rate: float = 2.0, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels; both classes weigh the same."""
    if not rows:
        return Scorer(np.zeros(1 << BITS), 0.0)
    owner = np.repeat(np.arange(len(rows)), [len(b) for b, _ in rows])
    bucket, value = np.concatenate([b for b, _ in rows]), np.concatenate([v for _, v in rows])
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(good > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(rows)
    weights, bias = np.zeros(1 << BITS), 0.0
    speed_w, speed_b = np.zeros(1 << BITS), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(bias + sums_by(owner, weights[bucket] * value, len(rows)), -50, 50))) - good
        error *= weight
        speed_w = 0.9 * speed_w + np.bincount(bucket, weights=error[owner] * value, minlength=1 << BITS) + decay * weights
        speed_b = 0.9 * speed_b + error.sum()
        weights -= rate * speed_w
        bias -= 0.1 * rate * speed_b
    return Scorer(weights, bias)


def voted(docs: DataFrame) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                words = Words(part.column("text"), BY_BLANKS)
                pattern = pattern_of(votes(words, words.encoded()[0]))
                yield pa.RecordBatch.from_arrays([part.column("k1"), part.column("k2"), pa.array(pattern)], names=["k1", "k2", "pattern"])

    return docs.select("k1", "k2", "text").mapInArrow(found, "k1 long, k2 long, pattern long")


def fit(docs: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> tuple[LabelModel, Scorer]:
    """The label model from all documents, and the scorer from a bounded sample of each class.

    The sample has the documents whose keys hash to the smallest numbers, at most ``sample_per_class`` of each.
    """
    docs = keyed(docs)
    patterns = store(voted(docs), "votes")
    counts = patterns.groupBy("pattern").count().toArrow()
    names, amounts = np.asarray(counts["pattern"]), np.asarray(counts["count"]).astype(float)
    labels = fit_labels(names, amounts, len(HEURISTICS))
    posterior = dict(zip(names.tolist(), labels.posterior(names).tolist(), strict=True))
    order = [F.xxhash64("k2", "k1"), "k1", "k2"]
    picked = None
    for good in (True, False):
        own = [p for p, v in posterior.items() if (v > 0.5) == good]
        part = patterns.filter(F.col("pattern").isin(own)).orderBy(*order).limit(sample_per_class)
        picked = part if picked is None else picked.union(part)
    picked = store(picked.dropDuplicates(["k1", "k2"]), "sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                rows = _sparse(part.column("text"))
                columns = [part.column("pattern"), pa.array([b for b, _ in rows], pa.list_(pa.int64())), pa.array([v for _, v in rows], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["pattern", "bucket", "value"])

    sample = docs.select("k1", "k2", "text").join(F.broadcast(picked), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    sample = sample.select("text", "pattern").mapInArrow(vectors, "pattern long, bucket array<long>, value array<double>").toArrow()
    rows = [(np.array(b), np.array(v)) for b, v in zip(sample["bucket"].to_pylist(), sample["value"].to_pylist(), strict=True)]
    good = np.array([posterior[p] for p in sample["pattern"].to_pylist()])
    return labels, train_scorer(rows, good)


def scored(docs: DataFrame, model: Scorer) -> DataFrame:
    """k1, k2, doc_id, score of ``keyed`` documents."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text")):
                part = batch.slice(i, j - i)
                columns = [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(model.score(part.column("text")))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "k1", "k2", "score"])

    return docs.select("doc_id", "k1", "k2", "text").mapInArrow(found, "doc_id long, k1 long, k2 long, score double")


def judge_quality(docs: DataFrame, threshold: float = 0.5, sample_per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1, higher is better), kept.

    Null and wordless texts get bad votes only. Equal rows get equal scores; an empty table gives none; other
    columns are ignored. Labels are not used. The sample bounds what the scorer is trained on; votes,
    pattern counts and scores cover every document and whole texts.
    """
    model = fit(docs, sample_per_class)[1]
    return scored(keyed(docs), model).select("doc_id", "score", (F.col("score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, threshold: float = 0.5, sample_per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns."""
    model = fit(docs, sample_per_class)[1]

    @F.pandas_udf("double")
    def score(texts):
        column = pa.Array.from_pandas(texts, type=pa.large_string())
        parts = [model.score(column.slice(i, j - i)) for i, j in slices(column)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(score(F.coalesce("text", F.lit(""))) >= threshold)
