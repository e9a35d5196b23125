"""Toxicity scorer: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is a learned vector, if the word is in the vocabulary, beside the mean of learned vectors of
its hashed character n-grams. Overlapping windows of words go through a gated recurrent network in both
directions; attention pools the states to one logit a window. A document scores as its worst window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import BY_ALNUM, Words, ngram_buckets, slices

WINDOW, STRIDE = 32, 16
WORD_SIZE, CHAR_SIZE, HIDDEN, ATTENTION = 8, 8, 8, 8
CHAR_BITS = 16
NGRAMS = range(3, 6)
VOCABULARY, LEAST_COUNT = 8192, 5
MAX_TOXIC, MAX_OTHER, MAX_CHARS = 1000, 1500, 8000
EPOCHS, BATCH, RATE = 3, 32, 0.02
LEAST_STEPS = 240
CHUNK = 4096
HELD_OUT_PARTS = 5


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT_PARTS == 0, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length) of the windows: every STRIDE words, so that all words lie in some window.

    A text without words has one empty window.
    """
    number = np.maximum(1, 1 + -(-np.maximum(counts - WINDOW, 0) // STRIDE))
    text = np.repeat(np.arange(len(counts)), number)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    start = rank * STRIDE
    return text, start, np.minimum(counts[text] - start, WINDOW)


@dataclass
class Inputs:
    """Distinct words of some texts: vocabulary numbers, n-gram buckets; and the windows' words (-1: none)."""

    word: np.ndarray
    gram_owner: np.ndarray
    gram: np.ndarray
    grams_of: np.ndarray
    text: np.ndarray
    cells: np.ndarray
    n_texts: int

    @classmethod
    def of(cls, texts: pa.Array, vocabulary: pa.Array) -> Inputs:
        words = Words(texts, BY_ALNUM)
        codes, distinct = words.encoded()
        known = pc.index_in(distinct, value_set=vocabulary)
        word = np.asarray(pc.fill_null(known, len(vocabulary)), dtype=np.int64)
        offsets = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
        data = np.frombuffer(distinct.buffers()[2], np.uint8)[: offsets[-1]] if len(distinct) else np.zeros(0, np.uint8)
        owner, gram = ngram_buckets(data, offsets, NGRAMS, CHAR_BITS)
        counts = np.bincount(owner, minlength=len(distinct))[: len(distinct)]
        text, start, length = windows_of(np.diff(words.first))
        at = np.arange(WINDOW)
        cells = words.first[text][:, None] + start[:, None] + at
        inside = at < length[:, None]
        cells = np.where(inside, codes[np.where(inside, cells, 0)] if len(codes) else 0, -1).astype(np.int32)
        return cls(word, owner, gram, np.maximum(counts, 1), text, cells, len(texts))


def _start(shape: tuple[int, ...], scale: float, rng: np.random.Generator) -> np.ndarray:
    return (rng.standard_normal(shape) * scale).astype(np.float32)


@dataclass
class Network:
    vocabulary: pa.Array
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, vocabulary: pa.Array, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        d, h, a = WORD_SIZE + CHAR_SIZE, HIDDEN, ATTENTION
        p = {"word": _start((len(vocabulary) + 1, WORD_SIZE), 0.1, rng), "char": _start((1 << CHAR_BITS, CHAR_SIZE), 0.1, rng)}
        for way in "fb":
            p |= {f"x{way}": _start((d, 3 * h), 0.4, rng), f"u{way}": _start((h, 3 * h), 0.3, rng), f"c{way}": np.zeros(3 * h, np.float32)}
        p |= {"wa": _start((2 * h, a), 0.3, rng), "ba": np.zeros(a, np.float32), "va": _start((a,), 0.3, rng)}
        p |= {"out": _start((2 * h,), 0.5, rng), "bias": np.full(1, -1.0, np.float32)}
        return cls(vocabulary, p)

    def word_inputs(self, x: Inputs) -> np.ndarray:
        sums = np.stack([np.bincount(x.gram_owner, weights=column[x.gram], minlength=len(x.word))[: len(x.word)] for column in self.p["char"].T], axis=1)
        return np.hstack((self.p["word"][x.word], (sums / np.sqrt(x.grams_of)[:, None]).astype(np.float32)))

    def _projected(self, inputs: np.ndarray, way: str) -> np.ndarray:
        """Input terms of the gates for each word; the last row is for no word."""
        rows = inputs @ self.p[f"x{way}"] + self.p[f"c{way}"]
        return np.vstack((rows, self.p[f"c{way}"][None, :]))

    def _run(self, table: np.ndarray, cells: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """States after each word, from left to right or from right to left; steps without a word change nothing."""
        h, u = HIDDEN, self.p[f"u{way}"]
        state = np.zeros((len(cells), h), np.float32)
        states = np.empty((cells.shape[1], len(cells), h), np.float32)
        order = range(cells.shape[1]) if way == "f" else range(cells.shape[1] - 1, -1, -1)
        for t in order:
            here = cells[:, t]
            x = table[here]
            gates = 1 / (1 + np.exp(-(x[:, : 2 * h] + state @ u[:, : 2 * h])))
            r, z = gates[:, :h], gates[:, h:]
            reset = r * state
            n = np.tanh(x[:, 2 * h :] + reset @ u[:, 2 * h :])
            z = np.where(here[:, None] < 0, np.float32(1), z)
            if keep is not None:
                keep.append((t, state, r, z, n, reset))
            state = n + z * (state - n)
            states[t] = state
        return states

    def logits(self, x: Inputs) -> np.ndarray:
        """One logit for each window."""
        inputs = self.word_inputs(x)
        tables = [self._projected(inputs, way) for way in "fb"]
        out = np.empty(len(x.cells), np.float32)
        for at in range(0, len(out), CHUNK):
            cells = x.cells[at : at + CHUNK]
            states = np.concatenate([self._run(table, cells, way, None) for table, way in zip(tables, "fb", strict=True)], axis=2)
            out[at : at + CHUNK] = self._pool(states, cells)[0]
        return out

    def _pool(self, states: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, ...]:
        mid = np.tanh(states @ self.p["wa"] + self.p["ba"])
        weight = np.exp(mid @ self.p["va"]) * (cells.T >= 0)
        weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        return pooled @ self.p["out"] + self.p["bias"][0], pooled, weight, mid

    def scores(self, texts: pa.Array) -> np.ndarray:
        x = Inputs.of(texts, self.vocabulary)
        worst = np.full(x.n_texts, -np.inf)
        np.maximum.at(worst, x.text, self.logits(x))
        return _sigmoid(worst)

    def gradients(self, x: Inputs, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for documents whose logit is the softmax-weighted mean of their windows' logits."""
        p, h = self.p, HIDDEN
        inputs = self.word_inputs(x)
        kept: dict[str, list] = {"f": [], "b": []}
        tables = {way: self._projected(inputs, way) for way in "fb"}
        states = np.concatenate([self._run(tables[way], x.cells, way, kept[way]) for way in "fb"], axis=2)
        logit, pooled, weight, mid = self._pool(states, x.cells)
        top = np.full(x.n_texts, -np.inf)
        np.maximum.at(top, x.text, logit)
        share = np.exp(logit - top[x.text])
        share /= np.bincount(x.text, weights=share, minlength=x.n_texts)[x.text]
        doc = np.bincount(x.text, weights=share * logit, minlength=x.n_texts)
        prob = _sigmoid(doc)
        loss = -(weights * (labels * np.log(prob + 1e-9) + (1 - labels) * np.log(1 - prob + 1e-9))).sum()
        d_logit = ((weights * (prob - labels))[x.text] * share * (1 + logit - doc[x.text])).astype(np.float32)
        g = {"bias": np.array([d_logit.sum()]), "out": d_logit @ pooled}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["va"] = np.einsum("tb,tba->a", d_score, mid)
        d_mid = d_score[:, :, None] * p["va"] * (1 - mid**2)
        g["wa"] = np.einsum("tbh,tba->ha", states, d_mid, optimize=True)
        g["ba"] = d_mid.sum(axis=(0, 1))
        d_states = d_states + d_mid @ p["wa"].T
        d_inputs = np.zeros_like(inputs)
        flat = x.cells.T.ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-2))
        for k, way in enumerate("fb"):
            u = p[f"u{way}"]
            d_u, d_x = np.zeros_like(u), np.zeros((*x.cells.T.shape, 3 * h), np.float32)
            carry = np.zeros((len(x.cells), h), np.float32)
            for t, before, r, z, n, reset in reversed(kept[way]):
                d = carry + d_states[t, :, k * h : (k + 1) * h]
                d_n = d * (1 - z) * (1 - n**2)
                d_z = d * (before - n) * z * (1 - z)
                d_reset = d_n @ u[:, 2 * h :].T
                d_r = d_reset * before * r * (1 - r)
                d_gates = np.hstack((d_r, d_z))
                carry = d * z + d_reset * r + d_gates @ u[:, : 2 * h].T
                d_u[:, : 2 * h] += before.T @ d_gates
                d_u[:, 2 * h :] += reset.T @ d_n
                d_x[t] = np.hstack((d_gates, d_n))
            d_x[x.cells.T < 0] = 0
            d_x = d_x.reshape(-1, 3 * h)
            g[f"u{way}"], g[f"c{way}"] = d_u, d_x.sum(axis=0)
            by_word = np.add.reduceat(d_x[order], first, axis=0) if len(order) else d_x
            named = flat[order][first]
            total = np.zeros((len(inputs), 3 * h), np.float32)
            total[named[named >= 0]] = by_word[named >= 0]
            g[f"x{way}"] = inputs.T @ total
            d_inputs += total @ p[f"x{way}"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], x.word, d_inputs[:, :WORD_SIZE])
        by_gram = d_inputs[:, WORD_SIZE:] / np.sqrt(x.grams_of)[:, None]
        g["char"] = np.stack([np.bincount(x.gram, weights=column[x.gram_owner], minlength=1 << CHAR_BITS) for column in by_gram.T], axis=1)
        return float(loss), g


def fit_network(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Trains on whole texts with Adam; both classes weigh the same. The result depends on the input alone."""
    counts: Counter = Counter()
    for text in texts:
        words = Words(pa.array([text], pa.large_string()), BY_ALNUM)
        counts.update(words.encoded()[1].to_pylist())
    common = sorted((w for w, c in counts.items() if c >= LEAST_COUNT), key=lambda w: (-counts[w], w))[:VOCABULARY]
    network = Network.fresh(pa.array(common, pa.large_binary()), seed)
    labels = np.asarray(labels, float)
    if not len(texts) or labels.min() == labels.max():
        network.p["out"][:] = 0
        network.p["bias"][0] = 3.0 if len(texts) and labels.min() == 1 else -3.0
        return network
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    step = 0
    # Batches hold texts of similar length, so that one long text does not set the size of many.
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(texts) // BATCH)))
    by_length = np.argsort([len(t) for t in texts], kind="stable")
    batches = [by_length[i : i + BATCH] for i in range(0, len(texts), BATCH)]
    prepared = [Inputs.of(pa.array([texts[i] for i in b], pa.large_string()), network.vocabulary) for b in batches]
    for _ in range(epochs):
        for number in rng.permutation(len(batches)):
            some = batches[number]
            _, g = network.gradients(prepared[number], labels[some], balance[some] / len(some))
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, v in g.items():
                v = np.clip(v, -1, 1).astype(np.float32)
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                network.p[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-6)).astype(np.float32)
    return network


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER, max_chars: int = MAX_CHARS) -> Network:
    """A network from labelled rows outside the held-out part.

    A bounded sample is used: of either label the rows whose ids hash to the smallest numbers, at most
    ``max_toxic`` and ``max_other``, without texts of more than ``max_chars`` characters.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    sample = usable.filter("toxic = 1").orderBy(*order).limit(max_toxic).union(usable.filter("toxic = 0").orderBy(*order).limit(max_other))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic").toArrow()
    chosen = sorted({(d, t, y) for d, t, y in zip(*(rows[c].to_pylist() for c in ("doc_id", "text", "toxic")), strict=True)})
    return fit_network([t for _, t, _ in chosen], np.array([y for _, _, y in chosen], float))


def judge_toxicity(docs: DataFrame, network: Network) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Every window of the whole text is scored. Null and wordless texts get the score of an empty window.
    Repeated rows get equal scores, an empty table none; null ids are not held out; other columns are ignored.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column("text"), 2 << 20):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(network.scores(part.column("text")))], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
