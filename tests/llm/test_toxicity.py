import zlib

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm.common import table
from marketloom.llm.toxicity import WINDOW, Inputs, Network, fit_network, judge_toxicity, train, windows_of


def test_windows_cover_all_words_and_overlap():
    counts = np.array([0, 1, WINDOW, WINDOW + 1, 500])
    text, start, length = windows_of(counts)
    for i, n in enumerate(counts.tolist()):
        own = text == i
        covered = {w for s, m in zip(start[own], length[own], strict=True) for w in range(s, s + m)}
        assert covered == set(range(n)) and own.sum() >= 1
        assert all(b - a < WINDOW for a, b in zip(start[own], start[own][1:], strict=False))


def test_gradients_equal_differences():
    network = Network.fresh(pa.array([b"you", b"are", b"hello"], pa.large_binary()))
    network.p = {k: v.astype(float) for k, v in network.p.items()}
    x = Inputs.of(pa.array(["You are a bad one " * 4, "", "hello world " * 30, "x"]), network.vocabulary)
    labels, weights = np.array([1, 0, 0, 1.0]), np.full(4, 0.25)
    gradients = network.gradients(x, labels, weights)[1]
    rng = np.random.default_rng(0)
    for name, value in network.p.items():
        for at in map(tuple, rng.permutation(np.argwhere(np.abs(gradients[name]) > 1e-5))[:3]):
            old = value[at]
            losses = []
            for step in (1e-3, -1e-3):
                value[at] = old + step
                losses.append(network.gradients(x, labels, weights)[0])
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - gradients[name][at]) < 1e-4


def test_learns_words_and_stems_anywhere_in_a_long_text():
    rng = np.random.default_rng(1)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    stems = ["zozzle", "quimp"]
    texts, labels = [], []
    for i in range(400):
        text = list(rng.choice(words, rng.integers(5, 150)))
        if i % 4 == 0:
            text.insert(rng.integers(len(text)), f"{rng.choice(stems)}{rng.choice(words)}")
        texts.append(" ".join(text))
        labels.append(i % 4 == 0)
    network = fit_network(texts, np.array(labels))
    long = " ".join(rng.choice(words, 3000))
    new = [long, f"{long} zozzlebal {long}", "Zozzlefem", "", "bal fem"]
    assert (network.scores(pa.array(new)) >= 0.5).tolist() == [False, True, True, False, False]
    assert network.scores(pa.array(new[:1]))[0] == pytest.approx(network.scores(pa.array([new[2], new[0]]))[1], abs=1e-5)


def test_query_on_the_sample(spark, sample):
    docs, labels = table(spark, sample, "documents"), table(spark, sample, "labels")
    network = train(docs, labels)
    odd = spark.createDataFrame([(None, "x"), (-1, None), (-2, ""), (-3, " ,. "), (-4, "word " * 30000), (-4, "again")], "doc_id long, text string")
    found = judge_toxicity(docs.select("doc_id", "text").union(odd).selectExpr("*", "1 as score"), network).toPandas()
    assert len(found) == docs.count() + 6
    assert ((found.score >= 0) & (found.score <= 1)).all() and ((found.score >= 0.5) == found.predicted).all()
    held = [not np.isnan(d) and zlib.crc32(str(int(d)).encode()) % 5 == 0 for d in found.doc_id]
    assert held == found.held_out.tolist()
    both = found.merge(labels.toPandas(), on="doc_id")
    shown = both[~both.held_out]
    assert (shown.predicted == shown.toxic).mean() > 0.95
    assert judge_toxicity(docs.limit(0), network).count() == 0


def test_nothing_to_learn_from(spark):
    network = train(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert network.scores(pa.array(["any text"]))[0] < 0.5
