import random
import re
from collections import Counter
from itertools import groupby
from math import log

import pyarrow as pa
import pytest

from marketloom.llm import search
from marketloom.llm.search import top_k


def terms(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, queries, k):
    bags = [Counter(terms(t)) for _, t in docs]
    n = len(docs)
    average = sum(sum(b.values()) for b in bags) / n
    df = Counter(t for b in bags for t in b)
    out = Counter()
    for q, text in set(queries):
        scores = []
        for (doc, _), bag in zip(docs, bags, strict=True):
            size = sum(bag.values())
            score = sum(
                times * log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * 2.2 / (bag[t] + 1.2 * (0.25 + 0.75 * size / average))
                for t, times in Counter(terms(text)).items() if bag[t]
            )
            if score > 0:
                scores.append((-round(score, 6), doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1):
            out[q, rank, doc, -score] += 1
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(4000)] + ["Été", "x-Y", "字", "a_b"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 20, 80, 200])))) for i in range(n)]


@pytest.mark.parametrize("shard_bytes", [1 << 26, 20_000])
@pytest.mark.parametrize("dense", [1 / 16, 0.01])
def test_equals_brute_force(spark, monkeypatch, shard_bytes, dense):
    monkeypatch.setattr(search, "DENSE_SHARE", dense)
    monkeypatch.setattr(search, "BLOCK", 8)
    rows = corpus(1, 300)
    rows += [(300, None), (301, ""), (302, "..."), (None, rows[4][1]), (304, rows[4][1]), (305, rows[4][1]), (305, rows[4][1]), (306, "w1 " * 20000)]
    queries = [(i, t) for i, t in rows if i is not None and i % 25 == 0] + [(900, "nothing like it"), (901, None), (902, "w1 w1 w2"), (902, "w1 w1 w2")]
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, shard int").repartition(4)
    asked = spark.createDataFrame([(q, t, 1) for q, t in queries], "query_id long, text string, weight int")
    found = top_k(docs, asked, 7, shard_bytes)
    assert Counter(map(tuple, found.select("query_id", "rank", "doc_id", "score").collect())) == brute(rows, queries, 7)


def test_empty_tables(spark):
    docs = spark.createDataFrame(corpus(2, 5), "doc_id long, text string")
    queries = docs.withColumnRenamed("doc_id", "query_id")
    assert top_k(docs.limit(0), queries).count() == 0 and top_k(docs, queries.limit(0)).count() == 0


@pytest.mark.parametrize("query_bytes", [1 << 26, 700])
def test_answers_do_not_grow_with_the_shards(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(search, "SLOTS", 8)
    made = []
    plain = search.slot_bests
    monkeypatch.setattr(search, "slot_bests", lambda *given: made.append(plain(*given)) or made[-1])
    rows = [(i, t) for i, t in corpus(3, 400)] + [(7, "w1 w2 w3")] * 40
    queries = [(i, t) for i, t in rows if i % 40 == 0] + [(None, "w1 w2"), (7, "w1 w2 w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame(queries, "query_id long, text string")
    found = [Counter(map(tuple, top_k(docs, asked, 3, size, query_bytes).collect())) for size in (1 << 20, 400)]
    assert found[0] == found[1] == brute(rows, queries, 3)
    assert max(m.count() for m in made) <= 8 * 3 * len(queries)


def answers(rows, queries, k, size):
    """What one task finds with shards of ``size`` documents, ranked."""
    bags = [Counter(terms(t)) for _, t in rows]
    df = Counter(t for b in bags for t in b)
    asked = search.Asked(k)
    for i in range(0, len(queries), 7):
        some = [(q, sorted(Counter(terms(t)).items())) for q, t in queries[i : i + 7]]
        weights = [[times * log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) for t, times in bag] for _, bag in some]
        columns = [pa.array([q for q, _ in some], pa.int64()), pa.array(range(i, i + len(some))), pa.array([" ".join(t for t, _ in bag) for _, bag in some])]
        asked.add(pa.RecordBatch.from_arrays([*columns, pa.array(weights, pa.list_(pa.float64()))], names=["id", "query_key", "text", "weights"]))
    asked.close()
    average = sum(sum(b.values()) for b in bags) / len(rows)
    for i in range(0, len(rows), size):
        ids, texts = zip(*rows[i : i + size], strict=True)
        asked.answer(search.Shard([pa.array(ids, pa.int64())], [pa.array(texts, pa.string())], average))
    out = Counter()
    best = sorted(asked.found().to_pylist(), key=lambda r: (r["query_key"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0))
    for _, found in groupby(best, key=lambda r: r["query_key"]):
        out.update((r["query_id"], rank, r["doc_id"], r["score"]) for rank, r in enumerate(found, 1))
    return out


SMALL = {"BLOCK": 4, "PANEL": 2, "DENSE_SHARE": 0.02, "POSTINGS": 300, "TERMS": 500, "SCORES": 600}


@pytest.mark.parametrize("cells", [0, 2000, 1 << 22])
@pytest.mark.parametrize("size", [1000, 37])
def test_batches_of_queries_equal_brute_force(monkeypatch, cells, size):
    """Few and many frequent terms, in small batches, and with copies that tie with the k-th best."""
    for name, value in {**SMALL, "DENSE_CELLS": cells}.items():
        monkeypatch.setattr(search, name, value)
    rows = corpus(5, 250)
    rows += [(400 - i, rows[8][1]) for i in range(30)] + [(None, rows[8][1]), (500, "w1 " * 70_000), (501, None), (502, "..."), (503, "only here")]
    random.Random(6).shuffle(rows)
    queries = [(i, t) for i, t in rows if i is not None and i % 8 == 0 and terms(t)] + [(None, "w1 w2"), (900, "unknown only"), (901, "w1 w1 w2"), (902, "here")]
    assert answers(rows, queries, 6, size) == brute(rows, queries, 6)


def test_a_shard_answers_many_queries_at_once(monkeypatch):
    calls, best = [], search.Shard.best
    monkeypatch.setattr(search.Shard, "best", lambda self, *given: calls.append(0) or best(self, *given))
    rows = corpus(7, 200)
    queries = [(i, t) for i, t in rows if i % 2 == 0]
    assert answers(rows, queries, 5, 50) == brute(rows, queries, 5)
    assert len(calls) == 4
