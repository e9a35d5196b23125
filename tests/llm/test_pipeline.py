from itertools import combinations

import numpy as np

import __spark_entry__ as driver
import corpus_pipeline as pipeline
from marketloom.llm.near_dedup import fingerprint

from .test_near_copies import plain_set
from .test_near_dedup import brute_groups
from .test_substring_dedup import brute as without_passages


def test_each_stage_on_what_the_last_one_kept(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    columns, results = docs.columns, {}
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = pipeline.store(stage(spark, docs, sample), name)
        results[name] = before, docs
        assert name == pipeline.STAGES[-1][0] or docs.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sample}/labels.parquet").collect()}
    before, kept = results["quality_classifier"]
    ids = {r.doc_id for r in kept.collect()}
    assert np.mean([(d in ids) == bool(q) for d, q in labels.items()]) > 0.95
    before, after = results["line_dedup"]
    after = {r.doc_id: r.text for r in after.collect()}
    assert after.keys() == before.keys()
    lines = [x for t in after.values() for x in t.split("\n") if x.strip()]
    assert len(set(lines)) == len(lines)
    before, after = results["near_dedup"]
    ids = sorted(before)
    texts = [before[d] or "" for d in ids]
    groups, sets = list(brute_groups([fingerprint(t) for t in texts])), [plain_set(t) for t in texts]
    for i, j in combinations(range(len(ids)), 2):
        if groups[i] != groups[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            low, high = sorted((groups[i], groups[j]))
            groups = [low if g == high else g for g in groups]
    assert {r.doc_id for r in after.collect()} == {min(d for d, g in zip(ids, groups, strict=True) if g == h) for h in groups}
    before, after = results["substring_dedup"]
    rows = sorted(before.items())
    wanted = {d: (t if not w[2] else w[4]) for (d, t), w in zip(rows, without_passages(rows, 35), strict=True)}
    assert {r.doc_id: r.text for r in after.collect()} == wanted
    before, after = results["best_fit_packing"]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == set(before)
    assert after.groupBy("sequence_id").agg({"length": "sum"}).toPandas()["sum(length)"].max() <= 1024


def test_every_operator_is_registered():
    names = set(driver.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(driver.oracle_sql()) <= names


def test_odd_rows_go_through_all_stages(spark, sample):
    """Null ids and texts, empty and blank texts, repeated rows, a long text and columns with an operator's own names."""
    words = " ".join(f"word{i % 97} other{i % 89}" for i in range(400))
    rows = [(1, words, "a"), (1, words, "a"), (None, words + " end", "b"), (None, None, "c"), (2, None, None), (3, "", "d"), (4, " \n\t ", "e")]
    rows += [(5, " ".join(f"t{i}" for i in range(60_000)), "f"), (None, "short text", "g"), (6, "short text", "h")]
    docs = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, node int, k1 int")
    columns = docs.columns
    for name, stage in pipeline.STAGES[1:-1]:
        docs = pipeline.store(stage(spark, docs, sample), name)
        assert docs.columns == columns
    kept = [r.doc_id for r in docs.collect()]
    assert kept.count(1) <= 1 and 5 in kept
    packed = pipeline.STAGES[-1][1](spark, docs, sample)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(kept)


def test_an_empty_table_goes_through_all_stages(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES[1:]:
        docs = pipeline.store(stage(spark, docs, sample), name)
    assert docs.count() == 0

