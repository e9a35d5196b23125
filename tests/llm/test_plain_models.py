"""The scorers of op1 and op8 against the same formulas one number at a time."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm import toxicity as T
from marketloom.llm import url_filter as U
from marketloom.llm.url_filter import UrlModel, judge_urls

MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD & MASK
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & MASK
    return x ^ x >> 33


def buckets(text, sizes, bits, seed=0):
    marked = b"\x01" + text + b"\x01"
    out = []
    for n in sizes:
        for i in range(len(marked) - n + 1):
            out.append(mixed(int.from_bytes(marked[i : i + n], "big") + ((n << 56) ^ seed) & MASK) & ((1 << bits) - 1))
    return out


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


URLS = [
    None, "", "no scheme", "http://", "https://a.example.net/x", "https://A.Example.NET/X?q#f", "http://h/" + "p" * 5000, "https://é.org/ü",
    "https://a.example.net/x", "ftp://only-host",
]


def test_url_scores_one_ngram_at_a_time(spark):
    rng = np.random.default_rng(3)
    model = UrlModel(rng.normal(0, 1, 1 << U.BITS), 0.25)
    pages = spark.createDataFrame([(i, u, 0.5) for i, u in enumerate(URLS)], "page_id long, url string, score double").repartition(2)
    found = {r.page_id: r for r in judge_urls(pages, (("allow", "com/"),), model).collect()}
    assert len(found) == len(URLS)
    for r in found.values():
        marks = buckets(r.host.encode(), U.HOST_SIZES, U.BITS, U.HOST_SEED) + buckets(r.path.encode(), U.PATH_SIZES, U.BITS, U.PATH_SEED)
        wanted = sigmoid(0.25 + sum(model.weights[b] for b in marks) / math.sqrt(max(1, len(marks))))
        assert r.score == pytest.approx(wanted, abs=1e-9) and r.verdict == ("block" if wanted >= 0.5 else "allow")
    assert found[4].score == found[8].score and len(found[6].path) == 5001


def plain_windows(words):
    """Every STRIDE words a window of at most WINDOW, until the last word is in one."""
    start, out = 0, []
    while True:
        out.append(words[start : start + T.WINDOW])
        if start + T.WINDOW >= len(words):
            return out
        start += T.STRIDE


def plain_logit(p, vocabulary, words):
    """The network over one window, word by word, with lists of numbers only."""
    h = T.HIDDEN
    inputs = []
    for word in words:
        marks = buckets(word, T.NGRAMS, T.CHAR_BITS)
        own = p["word"][vocabulary.get(word, len(vocabulary))].tolist()
        chars = [sum(float(p["char"][b][c]) for b in marks) / math.sqrt(max(1, len(marks))) for c in range(T.CHAR_SIZE)]
        inputs.append(own + chars)

    def run(way):
        state, states = [0.0] * h, []
        x_w, u_w, c_w = (p[f"{k}{way}"].tolist() for k in "xuc")
        for x in inputs if way == "f" else inputs[::-1]:
            def term(j, s, x=x):
                return c_w[j] + sum(a * x_w[i][j] for i, a in enumerate(x)) + sum(a * u_w[i][j] for i, a in enumerate(s))
            r, z = ([sigmoid(term(g * h + j, state)) for j in range(h)] for g in (0, 1))
            reset = [a * b for a, b in zip(r, state)]
            n = [math.tanh(term(2 * h + j, reset)) for j in range(h)]
            state = [a + b * (s - a) for a, b, s in zip(n, z, state)]
            states.append(state)
        return states if way == "f" else states[::-1]

    both = [a + b for a, b in zip(run("f"), run("b"))]
    weights = []
    for s in both:
        mid = [math.tanh(float(p["ba"][j]) + sum(a * float(p["wa"][i][j]) for i, a in enumerate(s))) for j in range(T.ATTENTION)]
        weights.append(math.exp(sum(m * float(v) for m, v in zip(mid, p["va"]))))
    pooled = [sum(w * s[j] for w, s in zip(weights, both)) / sum(weights) if both else 0.0 for j in range(2 * h)]
    return float(p["bias"][0]) + sum(a * float(b) for a, b in zip(pooled, p["out"]))


def test_toxicity_scores_one_word_at_a_time(spark):
    rng = random.Random(6)
    pool = ["plain", "Words", "of", "é", "vile", "42", "x" * 60, *[f"w{i}" for i in range(30)]]
    network = T.Network.fresh(pa.array([b"plain", b"of", b"vile"], pa.large_binary()))
    for k, v in network.p.items():
        network.p[k] = v * 3 if k in ("word", "char") else v
    texts = [None, "", " ,. "] + [" ".join(rng.choice(pool) for _ in range(n)) for n in (1, 5, 31, 32, 33, 47, 48, 49, 64, 130)]
    docs = spark.createDataFrame([(i, t, 9.0, 9) for i, t in enumerate(texts)] + [(None, "of", 1.0, 1)], "doc_id long, text string, score double, predicted int")
    found = T.judge_toxicity(docs, network).collect()
    vocabulary = {b"plain": 0, b"of": 1, b"vile": 2}
    assert len(found) == len(texts) + 1
    for r in found:
        text = "of" if r.doc_id is None else texts[r.doc_id] or ""
        words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text).encode()
        words = words.lower().split(b" ") if words else []
        words = [w for w in words if w]
        wanted = sigmoid(max(plain_logit(network.p, vocabulary, w) for w in plain_windows(words)))
        assert r.score == pytest.approx(wanted, abs=2e-5) and r.predicted == int(r.score >= 0.5)
