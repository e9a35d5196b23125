import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm.common import BY_BLANKS, Words, table
from marketloom.llm.quality import BAD, GOOD, HEURISTICS, NONE, fit_labels, judge_quality, keep_good, measures, pattern_of, votes


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.7
    right = np.array([0.95, 0.9, 0.8, 0.7])
    rows = np.where(rng.random((20000, 4)) < right, truth[:, None], ~truth[:, None]).astype(np.int8)
    rows[rng.random(rows.shape) < 0.2] = NONE
    patterns, counts = np.unique(pattern_of(rows), return_counts=True)
    model = fit_labels(patterns, counts.astype(float), 4, rounds=500)
    given = 1 - np.exp(model.log_good[:, NONE])
    assert np.abs(np.exp(model.log_good[:, GOOD]) / given - right).max() < 0.05 and abs(model.prior_good - 0.7) < 0.05
    assert ((model.posterior(pattern_of(rows)) > 0.5) == truth).mean() > 0.93


def test_votes():
    texts = ["plain words that read like a sentence, with much variety of words in it and more to come here now",
             "ALL OF THIS SHOUTS!! AT YOU!!", "spam spam spam spam " * 10, "a | b | c | d | e |", "", None]
    words = Words(pa.array(texts), BY_BLANKS)
    found = dict(zip(HEURISTICS, votes(words, words.encoded()[0]).T, strict=True))
    assert (np.stack(list(found.values()))[:, 0] != BAD).all()
    assert found["capitals"][1] == BAD and found["symbol_ends"][1] == BAD
    assert found["repeated_words"][2] == BAD and found["variety"][2] == BAD and found["variety"][3] == NONE
    assert found["wordless_tokens"][3] == BAD
    assert all((v[4:] == BAD).all() for v in found.values())


@pytest.fixture(scope="module")
def judged(spark, sample):
    return judge_quality(table(spark, sample, "documents")).toPandas()


def test_accuracy_on_labels_that_were_not_used(spark, sample, judged):
    both = judged.merge(table(spark, sample, "labels").toPandas(), on="doc_id")
    assert ((both.kept.astype(int) == both.quality).mean()) > 0.95


def test_keep_good_keeps_whole_rows(spark, sample, judged):
    docs = table(spark, sample, "documents").selectExpr("*", "1 as k1", "'x' as score")
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(judged.doc_id[judged.kept].tolist())


def test_edge_rows(spark, sample):
    odd = spark.createDataFrame([(None, "some words"), (-1, None), (-2, ""), (-3, "  \n"), (-4, "ok " * 50000), (-5, "x"), (-5, "x")], "doc_id long, text string")
    docs = table(spark, sample, "documents").select("doc_id", "text").union(odd)
    found = judge_quality(docs).filter("doc_id is null or doc_id < 0").collect()
    assert len(found) == 7 and all(0 <= r.score <= 1 for r in found)
    assert not any(r.kept for r in found if r.doc_id in (-1, -2, -3, -4))
    assert judge_quality(docs.limit(0)).count() == 0 and keep_good(docs.limit(0)).count() == 0


def test_variety_does_not_depend_on_length(spark, sample):
    rng = np.random.default_rng(0)
    clean = [r.text for r in table(spark, sample, "documents").join(table(spark, sample, "labels").filter("quality = 1"), "doc_id").orderBy("doc_id").collect()]
    words = sorted({w for t in clean for w in t.split()})[:4000]
    long = " ".join(rng.choice(words, 150_000))
    spam = " ".join(rng.choice(words[:20], 150_000))
    found = Words(pa.array([long, long[: len(long) // 500], spam]), BY_BLANKS)
    value = measures(found, found.encoded()[0])[1]["variety"]
    assert abs(value[0] - value[1]) < 0.05 and value[2] < HEURISTICS["variety"][0]
    docs = table(spark, sample, "documents").select("doc_id", "text")
    whole = "\n".join(clean)
    longest = "\n".join([whole] * (150_000 // len(whole.split()) + 1))
    judged = judge_quality(docs.union(spark.createDataFrame([(-1, longest), (-2, spam)], docs.schema))).filter("doc_id < 0").collect()
    assert {r.doc_id: r.kept for r in judged} == {-1: True, -2: False}
